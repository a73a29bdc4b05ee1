"""Token index, keyword and vector ranking, and fusion of ranked lists."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FIELDS = ("title", "author", "content")
WORD = r"[\p{L}\p{N}]+"
CJK_RUN = r"[\x{4E00}-\x{9FFF}]{2,}"
#: Bytes of query vectors that go to every task.
QUERY_BYTES = 32 << 20
#: Bytes of vectors, or of queries, of a block at least, and of scores that a task holds at a time.
BLOCK_BYTES, SCORE_BYTES = 8 << 20, 16 << 20


def _plain_letters() -> tuple[str, str]:
    """Latin letters with marks, and the letters without, by Unicode's decomposition."""
    marked = [c for c in map(chr, [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)]) if unicodedata.normalize("NFD", c)[0].isascii()]
    return "".join(marked), "".join(unicodedata.normalize("NFD", c)[0] for c in marked)


def without_marks(text: Column) -> Column:
    """Latin letters without their diacritics, which may be part of the letter or follow it."""
    return F.translate(F.regexp_replace(text, r"[\x{0300}-\x{036F}]", ""), *_plain_letters())


def tokens(text: Column, cjk_bigrams: bool = False, fold_marks: bool = False) -> Column:
    """Lower-cased runs of letters and digits; optionally also the pairs inside runs of ideographs, or without diacritics."""
    lower = F.lower(F.coalesce(text, F.lit("")))
    words = F.regexp_extract_all(without_marks(lower) if fold_marks else lower, F.lit(WORD), F.lit(0))
    if not cjk_bigrams:
        return words
    runs = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(CJK_RUN), F.lit(0))
    pairs = F.flatten(F.transform(runs, lambda r: F.transform(F.sequence(F.lit(1), F.length(r) - 1), lambda i: F.substring(r, i, F.lit(2)))))
    return F.concat(words, pairs)


def with_counts(df: DataFrame, words: str = "words") -> DataFrame:
    """``df`` with ``counts``, the different words of a list and how often each stands there, without a shuffle; null or empty lists have none.

    The list is sorted and its runs measured, in steps of their own so that none is worked out twice.
    """
    # sort_array compares natively, array_sort by a function that is called for each pair
    ordered = df.withColumn("__sorted", F.sort_array(words))
    n = F.size("__sorted")
    starts = F.filter(F.sequence(F.lit(0), n - 1), lambda i: (i == 0) | (F.get("__sorted", i) != F.get("__sorted", i - 1)))
    begun = ordered.withColumn("__starts", F.when(n > 0, starts).otherwise(F.array().cast("array<int>")))
    run = lambda s, j: F.struct(F.get("__sorted", s).alias("token"), (F.coalesce(F.get("__starts", j + 1), n) - s).cast("long").alias("tf"))
    return begun.withColumn("counts", F.transform("__starts", run)).drop("__sorted", "__starts")


def token_index(posts: DataFrame, keys: Sequence[str] = ("tid", "floor"), fields: Sequence[str] = FIELDS, cjk_bigrams: bool = False, fold_marks: bool = False) -> DataFrame:
    """token, keys, field, tf. Counts form inside a document's row, so nothing is shuffled; ``keys`` tell documents apart."""
    named = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), tokens(F.col(f), cjk_bigrams, fold_marks).alias("words")) for f in fields])).alias("f")
    counted = with_counts(posts.select(*keys, named).select(*keys, "f.field", "f.words"))
    # outer: for the inner form Spark would work the counts out once more, to see whether there are any
    spread = counted.select(*keys, "field", F.explode_outer("counts").alias("c")).filter("c is not null")
    return spread.select("c.token", *keys, "field", "c.tf")


def refresh_index(index: DataFrame, changed: DataFrame, keys: Sequence[str] = ("tid", "floor"), removed: DataFrame | None = None, **options) -> DataFrame:
    """The index after posts changed: their old entries out, new ones in; ``removed`` keys only go."""
    gone = changed.select(*keys)
    if removed is not None:
        gone = gone.unionByName(removed.select(*keys))
    kept = index.join(gone.distinct(), list(keys), "left_anti")
    return kept.unionByName(token_index(changed, keys, **options).select(*kept.columns))


def match_all(index: DataFrame, words: Sequence[str], keys: Sequence[str] = ("tid", "floor"), field: str | None = None) -> DataFrame:
    """Keys of documents that hold every word, in one field or any."""
    wanted = sorted({w.lower() for w in words})
    hits = index.filter(F.col("token").isin(wanted))
    if field:
        hits = hits.filter(F.col("field") == field)
    return hits.groupBy(*keys).agg(F.count_distinct("token").alias("n")).filter(F.col("n") == len(wanted)).select(*keys)


def bm25(docs: DataFrame, queries: DataFrame, k: int = 10, k1: float = 1.2, b: float = 0.75, doc_id: str = "doc_id", query_id: str = "query_id", text: str = "text") -> DataFrame:
    """query_id, rank, doc_id, score of the ``k`` best documents by BM25.

    Words are counted inside a document's row, and only those of the queries leave it. A query set
    of up to ``QUERY_BYTES`` goes to every task, so no posting is shuffled: document
    frequencies and a document's scores combine where it is read. Larger sets are joined by shuffles.
    """
    size = queries.agg(F.coalesce(F.sum(F.octet_length(text) + 16), F.lit(0))).first()[0]
    sent = F.broadcast if size <= QUERY_BYTES else (lambda df: df)
    asked = queries.select(F.col(query_id).alias("query_id"), F.explode(F.array_distinct(tokens(F.col(text)))).alias("token"))
    words = docs.select(F.col(doc_id).alias("doc_id"), tokens(F.col(text)).alias("words"))
    # counting words is cheaper than listing them once more
    totals = docs.agg(F.count("*").alias("n"), F.avg(F.regexp_count(F.lower(F.coalesce(F.col(text), F.lit(""))), F.lit(WORD))).alias("mean"))
    counted = with_counts(words).select("doc_id", F.size("words").alias("length"), F.explode_outer("counts").alias("c"))
    tf = counted.filter("c is not null").select("doc_id", "length", "c.token", "c.tf").join(sent(asked.select("token").distinct()), "token", "left_semi")
    df = tf.groupBy("token").agg(F.count("*").alias("df"))
    idf = df.crossJoin(F.broadcast(totals)).select("token", "mean", F.log((F.col("n") - F.col("df") + 0.5) / (F.col("df") + 0.5) + 1).alias("idf"))
    weight = F.col("idf") * F.col("tf") * (k1 + 1) / (F.col("tf") + k1 * (1 - b + b * F.col("length") / F.col("mean")))
    weighted = tf.join(sent(idf.join(sent(asked), "token")), "token").select("query_id", "doc_id", weight.alias("w"))
    scored = weighted.groupBy("query_id", "doc_id").agg(F.sum("w").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.round("score", 9).desc(), "doc_id")
    return scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "doc_id", "score")


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def unit(vector: Column) -> Column:
    """A vector of doubles scaled to length one; the length is worked out once."""
    return F.transform(F.array(F.sqrt(dot(vector, vector))), lambda n: F.transform(vector, lambda x: x.cast("double") / n))[0]


def best_of_block(names: np.ndarray, queries: np.ndarray, own: np.ndarray, vectors: np.ndarray, k: int) -> pa.Table:
    """query_id, vec_id, score of each query's best ``k`` among some vectors, its own id left out; scores are held for some queries at a time."""
    some = []
    each = max(1, SCORE_BYTES // (8 * max(1, len(own))))
    for at in range(0, len(names), each):
        score = queries[at : at + each] @ vectors.T
        score[names[at : at + each, None] == own[None, :]] = -np.inf
        for row, rounded in zip(score, np.round(score, 9)):
            near = np.flatnonzero(rounded >= np.partition(rounded, -min(k, len(own)))[-min(k, len(own))])
            near = near[np.lexsort((own[near], -rounded[near]))][:k]
            some.append((near, row[near]))
    row, at = np.repeat(np.arange(len(names)), [len(x) for x, _ in some]), np.concatenate([x for x, _ in some])
    return pa.table([pa.array(names[row]), pa.array(own[at]), pa.array(np.concatenate([x for _, x in some]))], names=["query_id", "vec_id", "score"])


def as_matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    return np.stack(column.to_numpy(zero_copy_only=False)) if isinstance(column, pa.Array) else np.stack(column.to_numpy())


def vector_topk(vectors: DataFrame, queries: DataFrame, k: int = 10, vec_id: str = "vec_id", embedding: str = "embedding", query_id: str = "query_id", query_bytes: int | None = None) -> DataFrame:
    """query_id, rank, vec_id, score by cosine similarity against a stated query set; a vector does not find its own id.

    Queries are unit-scaled once. If they take at most ``query_bytes`` they go to
    every task as a matrix, and a task hands on the best k of each batch of vectors;
    larger sets are cut into blocks of that size or ``BLOCK_BYTES``, if that is more, and so are the vectors: each block of the
    one meets each of the other in a task of its own, which hands on each query's
    best k. All vectors must have as many components as the queries.
    """
    limit = QUERY_BYTES if query_bytes is None else query_bytes
    asked = queries.select(F.col(query_id).alias("query_id"), unit(F.col(embedding)).alias("q")).filter("q is not null")
    rows = vectors.select(F.col(vec_id).alias("vec_id"), unit(F.col(embedding)).alias("v")).filter("v is not null")
    size = queries.agg(F.count("*"), F.max(F.size(embedding))).first()
    taken = size[0] * (size[1] or 0) * 8
    schema = "query_id long, vec_id long, score double"
    if taken <= limit:
        found = asked.collect()  # no larger than the bound just checked
        ids = np.array([r["query_id"] for r in found], dtype=np.int64)
        matrix = vectors.sparkSession.sparkContext.broadcast((ids, np.array([r["q"] for r in found], dtype=np.float64)))

        def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            names, q = matrix.value
            for batch in batches:
                if batch.num_rows and len(names):
                    own = batch.column(0).to_numpy(zero_copy_only=False)
                    yield from best_of_block(names, q, own, as_matrix(batch.column(1)), k).to_batches()

        scored = rows.mapInArrow(best, schema)
    else:
        # every block of queries is a copy of the vectors, and the reverse: small blocks would send the tables many times over
        block = max(limit, BLOCK_BYTES)
        q_blocks, v_blocks = -(-taken // block), max(1, -(-vectors.count() * size[1] * 8 // block))
        number = lambda c, n: F.pmod(F.xxhash64(c), F.lit(n)).cast("int")
        every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
        left = asked.select(number("query_id", q_blocks).alias("a"), every(v_blocks).alias("b"), "query_id", "q").groupBy("a", "b")
        right = rows.select(every(q_blocks).alias("a"), number("vec_id", v_blocks).alias("b"), "vec_id", "v").groupBy("a", "b")

        def meet(some: pa.Table, others: pa.Table) -> pa.Table:
            if not (some.num_rows and others.num_rows):
                return pa.table([pa.array([], pa.int64()), pa.array([], pa.int64()), pa.array([], pa.float64())], names=["query_id", "vec_id", "score"])
            return best_of_block(some.column("query_id").to_numpy(), as_matrix(some.column("q")), others.column("vec_id").to_numpy(), as_matrix(others.column("v")), k)

        scored = left.cogroup(right).applyInArrow(meet, schema)
    order = Window.partitionBy("query_id").orderBy(F.round("score", 9).desc(), "vec_id")
    whole = scored.filter("score > double('-Infinity')").withColumn("rank", F.row_number().over(order))
    return whole.filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def fuse(lists: Sequence[DataFrame], weights: Sequence[float] | None = None, constant: int = 60, k: int | None = None) -> DataFrame:
    """query_id, doc_id, score: reciprocal ranks of several lists (query_id, rank, doc_id) summed by weight."""
    weights = weights or [1.0] * len(lists)
    parts = [d.select("query_id", "doc_id", (F.lit(float(w)) / (F.lit(constant) + F.col("rank"))).alias("part")) for d, w in zip(lists, weights)]
    both = parts[0]
    for other in parts[1:]:
        both = both.unionByName(other)
    fused = both.groupBy("query_id", "doc_id").agg(F.sum("part").alias("score"))
    if k is None:
        return fused
    order = Window.partitionBy("query_id").orderBy(F.round("score", 12).desc(), "doc_id")
    return fused.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
