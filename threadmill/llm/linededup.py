"""Removing repeated lines, with per-document keep bitmaps as the result.

Lines become 128-bit hashes of their keys; the hashes are range-partitioned and
sorted by document and position behind them, so that equal keys stream by and
the first occurrence and the number of documents fall out of one pass. A salt
from the document, hashed with the key, splits a hot key over many ranges, and
the few rows that the salts leave per key are then combined. Only decisions travel back: a bitmap of
64-line words per document, of which only words with a dropped line are kept.

Everything is DataFrame functions. Defined cases: a null or empty text is one
empty line; a key shorter than ``min_chars`` is never dropped; each row counts
as a document, also when its doc_id is null or repeated; equal rows get equal
bitmaps; of equal first occurrences all count as first; a very long text is a
row of hashes per line, so no task holds more of it than Spark's split does;
columns of any name, also those used here, come back as they were; an empty
table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scratch import boxed, parallelism, written
from .skew import join_counted

#: What is stripped from both ends of a key: [\x20\x09-\x0D].
SPACE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Parts that a key's occurrences are split into at most.
SALTS = 256
#: Keys to drop that are broadcast, some 5 MB; more are joined by shuffling.
BROADCAST_KEYS = 100_000


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def stripped(line: Column) -> Column:
    return F.btrim(line, F.lit(SPACE))


def line_key(bare: Column) -> Column:
    """A stripped line with A-Z in lower case; ``lower`` does that, and faster, if all is ASCII."""
    return F.when(F.octet_length(bare) == F.length(bare), F.lower(bare)).otherwise(F.translate(bare, UPPER, LOWER))


def occurrences(docs: DataFrame, min_chars: int, text: str, doc_id: str) -> DataFrame:
    """doc_id, tag (hash of the text), pos, h1, h2 for every line with a key of ``min_chars``."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(text).alias("tag"), F.posexplode(lines_of(F.col(text))).alias("pos", "line"))
    bare = rows.select("doc_id", "tag", "pos", stripped(F.col("line")).alias("bare")).filter(F.length("bare") >= min_chars)
    keyed = bare.select("doc_id", "tag", "pos", line_key(F.col("bare")).alias("key"))
    return keyed.select("doc_id", "tag", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(7), "key").alias("h2"))


def key_decisions(lines: DataFrame, partitions: int) -> DataFrame:
    """Per key: n_docs, n_lines and its first occurrence (first_id, first_tag, first_pos)."""
    salted = lines.withColumn("salt", F.pmod(F.xxhash64("doc_id", "tag"), F.lit(SALTS)))
    # hashes are uniform, so equal ranges of them hold equally many: no sample of the lines is needed to cut them
    share = F.shiftrightunsigned(F.xxhash64("h1", "salt"), 11).cast("double") * F.lit(2.0**-53)
    ranged = salted.withColumn("range", F.floor(share * partitions).cast("int"))
    key = ["range", "h1", "h2", "salt"]
    streamed = ranged.repartitionById(partitions, "range").sortWithinPartitions(*key, "doc_id", "tag", "pos")
    # a key's first line in a document stands for the document; equal rows each have one
    in_doc = Window.partitionBy(*key, "doc_id", "tag")
    first = (F.col("pos") == F.min("pos").over(in_doc)).cast("long")
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "tag", "pos")
    part = streamed.withColumn("is_first", first).groupBy(*key).agg(F.sum("is_first").alias("n"), F.count("*").alias("lines"), F.min(place).alias("first"))
    whole = part.groupBy("h1", "h2").agg(F.sum("n").alias("n_docs"), F.sum("lines").alias("n_lines"), F.min("first").alias("first"))
    return whole.select("h1", "h2", "n_docs", "n_lines", F.col("first.doc_id").alias("first_id"), F.col("first.tag").alias("first_tag"), F.col("first.pos").alias("first_pos"))


def drop_bitmaps(docs: DataFrame, min_docs: int = 2, keep_first: bool = True, min_chars: int = 1, per_text: bool = False, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, tag and ``dropped``, a map from word number to 64 bits, for documents that lose a line.

    A key in at least ``min_docs`` documents loses all its lines, or all but its
    first occurrence with ``keep_first``. Bit ``i`` of word ``w`` is line 64 w + i;
    a line whose bit is clear, or whose word is absent, is kept. With ``per_text``
    documents with equal texts count as one, so copies do not empty each other.
    """
    lines = occurrences(docs, min_chars, text, doc_id)
    partitions = parallelism(docs.sparkSession)
    decisions = key_decisions(lines, partitions).filter(F.col("n_docs") >= min_docs)
    decisions = written(decisions, "line-keys")
    few = decisions.count() <= BROADCAST_KEYS
    key = ["h1", "h2"]

    def at_keys(rows: DataFrame, table: DataFrame) -> DataFrame:
        """Rows with a key of ``table``, which has the key's number of rows in ``n``."""
        if few:
            return rows.join(F.broadcast(table.drop("n")), key)
        return join_counted(rows, table, key, table.agg(F.sum("n")).first()[0] or 0)

    hit = at_keys(lines, decisions.drop("n_docs").withColumnRenamed("n_lines", "n"))
    if per_text:  # a key is in no more texts than documents, so only the keys found above are counted again
        hit = written(hit, "line-hits")
        in_text = hit.groupBy(*key, "tag").agg(F.count("*").alias("n"))
        texts = in_text.groupBy(*key).agg(F.count("*").alias("texts"), F.sum("n").alias("n")).filter(F.col("texts") >= min_docs)
        hit = at_keys(hit, written(texts.drop("texts"), "text-keys"))
    if keep_first:
        first = F.col("doc_id").eqNullSafe(F.col("first_id")) & (F.col("tag") == F.col("first_tag")) & (F.col("pos") == F.col("first_pos"))
        hit = hit.filter(~first)
    words = hit.groupBy("doc_id", "tag", F.floor(F.col("pos") / 64).cast("int").alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, pos % 64)")).alias("bits"))
    entry = F.struct("word", "bits")
    return words.groupBy("doc_id", "tag").agg(F.map_from_entries(F.collect_list(entry)).alias("dropped"))


def kept_lines(lines: Column, dropped: Column) -> Column:
    """The lines whose bit is clear in the bitmap; all of them where it is null."""

    def stays(_, i: Column) -> Column:
        word = F.coalesce(dropped[F.floor(i / 64).cast("int")], F.lit(0).cast("long"))
        return F.getbit(word, F.pmod(i, F.lit(64))) == 0

    return F.when(dropped.isNull(), lines).otherwise(F.filter(lines, stays))


def with_bitmaps(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", **options) -> DataFrame:
    """``row``, a struct of each row's columns, and ``dropped`` as of :func:`drop_bitmaps` (null: nothing dropped)."""
    maps = drop_bitmaps(docs, text=text, doc_id=doc_id, **options)
    rows = boxed(docs, id=F.col(doc_id).cast("long"), mark=F.xxhash64(text))
    return rows.join(maps, F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("mark") == F.col("tag")), "left").select("row", "dropped")


def dedup_lines(docs: DataFrame, text: str = "text", **options) -> DataFrame:
    """``docs`` with the kept lines of each text, joined by newlines; a null text stays null."""
    marked = with_bitmaps(docs, text=text, **options)
    whole, dropped = F.col("row")[text], F.col("dropped")
    clean = F.array_join(kept_lines(lines_of(whole), dropped), "\n")
    kept = F.when(dropped.isNull(), whole).otherwise(clean)
    return marked.select(*[(kept if c == text else F.col("row")[c]).alias(c) for c in docs.columns])
