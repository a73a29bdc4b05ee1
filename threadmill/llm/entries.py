"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, binary_ids, conversations, digest, langid, linededup, maxscore, mixing, neardup_vectors, packing, sharding, simhash, toxicity
from .scratch import new_path


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(n: int, doc_id: str = "doc_id"):
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(n))


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path(), 4096, end_id=1)


def op2_nnpu_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    learned = remainder(4) != 2
    model = toxicity.fit(docs.filter(learned), labels.filter(learned))
    score = toxicity.toxicity(model, docs)
    scored = docs.select("doc_id", F.coalesce(remainder(4) == 2, F.lit(False)).alias("held_out"), score(F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


def op3_rotated_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), query_every=20, k=20)


def op4_canonical_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest.fingerprint_documents(table(spark, sf_dir, "documents"))


def op5_pivotal_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = mixing.choose_copies(table(spark, sf_dir, "documents"), weights=(1.0, 2.0, 3.0), most=3.0, share=1.0)
    return chosen.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies")


def op6_two_pass_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    path = new_path(spark, "shards")
    sharding.shuffle_to_shards(docs, path, n_shards=16)
    shards = sharding.read_shards(spark, path, docs)
    text = F.coalesce("row.text", F.lit(""))
    return shards.select(
        "row.doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op7_output_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs.filter(remainder(3) != 1))
    guess = langid.language(model, docs)
    predicted = docs.select("doc_id", F.coalesce(remainder(3) == 1, F.lit(False)).alias("held_out"), guess(F.col("text")).alias("g"))
    return predicted.select("doc_id", "held_out", "g.lang_pred", "g.score", "g.ambiguous")


def op8_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.near_groups(table(spark, sf_dir, "documents"), distance=4, words_each=4)
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    marked = linededup.with_bitmaps(docs, min_docs=10, keep_first=False, min_chars=1)
    lines = linededup.lines_of(F.col("row.text"))
    kept = linededup.kept_lines(lines, F.col("dropped"))
    counted = marked.select("row.doc_id", F.size(lines).cast("long").alias("n_lines"), F.array_join(kept, "\n").alias("kept"), "dropped")
    dropped = F.aggregate(F.coalesce(F.map_values("dropped"), F.array().cast("array<bigint>")), F.lit(0).cast("long"), lambda a, w: a + F.bit_count(w))
    return counted.select("doc_id", "n_lines", dropped.alias("n_dropped"), F.sha2("kept", 256).alias("kept_sha256"))


def op10_packed_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "ids")
    binary_ids.write_ids(table(spark, sf_dir, "documents"), path, tokenizer_path(), end_id=1)
    return binary_ids.read_digests(spark, path)


def op11_pair_maxscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maxscore.top_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=50).select("item_id", "rank", "doc_id", "score")


def op12_sorted_projections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup_vectors.near_groups(table(spark, sf_dir, "embeddings"), least=0.95)


def damaged(rows: DataFrame) -> DataFrame:
    """The conversations with faults put in by a checksum of conversation and turn, as :func:`conversations.standard` gives them."""
    shown = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.pmod(F.crc32(F.concat(shown("conv"), F.lit(":"), shown("turn")).cast("binary")), F.lit(20)).cast("int")
    marked = conversations.standard(rows.select("conv_id", "turn", "role", "text")).withColumn("fault", fault)
    copies = F.explode(F.when(F.col("fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    role = F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role")
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text")
    return marked.select("conv", "turn", role, text, (F.col("fault") != 0).alias("here"), copies.alias("copy")).drop("copy")


def op13_auction_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair(damaged(table(spark, sf_dir, "conversations"))).withColumnRenamed("conv", "conv_id")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_best_fit_packing,
        op2_nnpu_toxicity,
        op3_rotated_codes,
        op4_canonical_digest,
        op5_pivotal_mixing,
        op6_two_pass_shuffle,
        op7_output_codes,
        op8_simhash_groups,
        op9_line_dedup,
        op10_packed_ids,
        op11_pair_maxscore,
        op12_sorted_projections,
        op13_auction_repair,
    )
}

#: DuckDB SQL for the queries that SQL can express over whole tables.
ORACLE_SQL: dict[str, str] = {
    "op9_line_dedup": r"""
        WITH lines AS (
            SELECT doc_id, n, line, lower_ascii AS key FROM (
                SELECT doc_id, n, line, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lower_ascii
                FROM (SELECT doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS n
                      FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents))
            )
        ),
        bad AS (SELECT key FROM lines WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
        SELECT doc_id, count(*) AS n_lines, count(b.key) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY n) FILTER (WHERE b.key IS NULL), '')) AS kept_sha256
        FROM lines l LEFT JOIN bad b ON l.key = b.key
        GROUP BY doc_id""",
    "op11_pair_maxscore": r"""
        WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS words FROM documents),
        q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
        totals AS (SELECT count(*)::BIGINT AS docs, sum(len(words))::BIGINT AS words FROM d WHERE len(words) > 0),
        tf AS (SELECT doc_id, n, term, count(*)::BIGINT AS tf FROM (SELECT doc_id, len(words)::BIGINT AS n, unnest(words) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY ALL),
        w AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w FROM (SELECT term, count(*)::BIGINT AS df FROM tf GROUP BY term), totals),
        impact AS (SELECT doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // words))) AS impact FROM tf JOIN w USING (term), totals),
        scored AS (SELECT item_id, doc_id, sum(impact)::BIGINT AS score FROM impact JOIN q USING (term) GROUP BY item_id, doc_id)
        SELECT item_id, rank::INT AS rank, doc_id, score FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0) WHERE rank <= 50""",
}
