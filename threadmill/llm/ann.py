"""Nearest neighbours by inner product with randomly rotated one-bit codes.

Every vector, padded with zeros to at least ``BITS`` dimensions, is turned by one
random orthogonal matrix and keeps a sign bit per dimension, packed into 64-bit
words, with two scalars: its length and the inner product of its direction with
its code's. A query, turned alike and rounded to four bits per dimension, meets a
code by and-ing bit planes and counting bits, which estimates the inner product;
the scalars also bound the error (Gao & Long 2024). A block's vectors are taken
some thousands at a time. Of the first, those with the largest estimates are
compared exactly, which gives a threshold; from then on the k-th best score so far
is the threshold, and only vectors whose upper bound reaches it are compared
exactly, in double precision on the original components.

All queries meet all vectors, block by block: rows are dealt to blocks by a hash
of their id and their components, and a task holds one block of each. Only each
block's best k leave it. Blocks are as large as leaves every core two, up to
``block_rows``: large blocks have high thresholds, and rows are sent once per block
of the other side. ``epsilon`` sets the bounds; 1.9 misses some two neighbours in
a thousand.

Defined cases: vectors that are null, empty, zero, of another length than most,
or hold a null or non-finite component take no part; equal scores go to the
smaller id; rows with a null id are left out; of rows with the same id each takes
part as a vector, the one with the smallest components (compared in order) is
the query, and a query does not find its own id; an empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

#: Bits of a query's rounded component.
PLANES = 4
#: Least number of bits in a code.
BITS = 128
#: Queries, and vectors, looked at together.
SOME = 64
CHUNK = 8192
#: Times k vectors that are compared before a threshold is known.
FIRST = 5
#: Components copied at once for exact comparison.
COMPONENTS = 4_000_000
#: Components in a block.
BLOCK_COMPONENTS = 16_777_216
#: Least number of rows in a block of several.
LEAST_ROWS = 16_384


def rotation(dim: int, seed: int = 7) -> np.ndarray:
    """The first ``dim`` columns of a random orthogonal matrix of whole words and ``BITS`` rows at least, the same in every task."""
    bits = max(BITS, -(-dim // 64) * 64)
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((bits, bits)))
    return (q * np.sign(np.diag(r)))[:, :dim]


def packed(bits: np.ndarray) -> np.ndarray:
    return np.packbits(bits, axis=1, bitorder="little").view("<u8")


class Codes:
    """Sign bits of vectors, word by word, and what their estimates need."""

    def __init__(self, vectors: np.ndarray, turn: np.ndarray):
        turned = vectors.astype(np.float64) @ turn.T
        n_bits = turn.shape[0]
        length = np.linalg.norm(turned, axis=1)
        # a vector that is nothing beside the largest one has no direction left
        fit = np.abs(turned).sum(axis=1) / (math.sqrt(n_bits) * np.maximum(length, 1e-300))
        codes = packed(turned > 0)
        self.words = [np.ascontiguousarray(codes[:, w]) for w in range(codes.shape[1])]
        self.ones = np.bitwise_count(codes).sum(axis=1).astype(np.float32)
        self.length = length
        stretch = length / np.maximum(fit, 1e-30)
        self.scale = (stretch / math.sqrt(n_bits)).astype(np.float32)
        self.stretch2 = (stretch**2).astype(np.float32)
        self.spread2 = (np.maximum(0, 1 - fit**2) / (n_bits - 1) * stretch**2).astype(np.float32)


def estimate(codes: Codes, at: slice, queries: np.ndarray, turn: np.ndarray, epsilon: float) -> tuple[np.ndarray, np.ndarray]:
    """Estimated inner products and their upper bounds, queries x codes.

    The code's error and that of rounding the query are independent, so that their variances add.
    """
    n_bits = turn.shape[0]
    turned = queries @ turn.T
    low = turned.min(axis=1)
    step = np.maximum((turned.max(axis=1) - low) / (2**PLANES - 1), 1e-30)
    levels = np.rint((turned - low[:, None]) / step[:, None]).astype(np.uint8)
    planes = [packed((levels >> j) & 1) for j in range(PLANES)]
    # a word's planes count to 64 * 15 at most
    wide = np.uint16 if n_bits * 2**PLANES < 2**16 else np.uint32
    hits = np.zeros((len(queries), len(codes.ones[at])), dtype=wide)
    for w, word in enumerate(codes.words):
        for j, plane in enumerate(planes):
            hits += np.left_shift(np.bitwise_count(word[None, at] & plane[:, w, None]), j, dtype=wide)

    def each(per_query: np.ndarray) -> np.ndarray:
        return per_query.astype(np.float32)[:, None]

    # <query, signs>/sqrt(bits), signs being 2 bits - 1, from the rounded query
    guess = hits * each(2 * step) + each(2 * low) * codes.ones[None, at] - each(low * n_bits + step * levels.sum(axis=1))
    guess *= codes.scale[None, at]
    error = each((queries**2).sum(axis=1)) * codes.spread2[None, at] + each(step**2 / 12) * codes.stretch2[None, at]
    return guess, guess + np.float32(epsilon) * np.sqrt(error)


def exact(vectors: np.ndarray, rows: np.ndarray, queries: np.ndarray, asks: np.ndarray) -> np.ndarray:
    """Inner products of vectors[rows] with queries[asks] in double precision, the same for equal vectors."""
    each = max(1, COMPONENTS // vectors.shape[1])
    parts = [(vectors[rows[a : a + each]].astype(np.float64) * queries[asks[a : a + each]]).sum(axis=1) for a in range(0, len(rows), each)]
    return np.concatenate(parts) if parts else np.empty(0)


def promising(vectors: np.ndarray, rows: np.ndarray, queries: np.ndarray, asks: np.ndarray, least: np.ndarray) -> np.ndarray:
    """Whether inner products, in single precision, may reach the queries' ``least``, which allows for the precision."""
    each, own = max(1, COMPONENTS // vectors.shape[1]), queries.astype(vectors.dtype)
    parts = [~(np.einsum("pd,pd->p", vectors[rows[a : a + each]], own[asks[a : a + each]]) < least[asks[a : a + each]]) for a in range(0, len(rows), each)]
    return np.concatenate(parts) if parts else np.empty(0, dtype=bool)


def search_block(ids: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int, epsilon: float, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query id, vector id, score) of each query's best ``k`` in the block."""
    # estimates are made of vectors and queries divided by their largest components, which keeps them in single precision's range
    peak = float(np.abs(vectors).max(initial=0))
    small = np.empty(vectors.shape, dtype=np.float32)
    for at in range(0, len(ids), CHUNK):
        small[at : at + CHUNK] = vectors[at : at + CHUNK].astype(np.float64) / peak
    codes = Codes(small, turn)
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for group in range(0, len(queries), SOME):
        some, own = queries[group : group + SOME], query_ids[group : group + SOME]
        peaks = np.abs(some).max(axis=1)
        even = some / peaks[:, None]
        # what single precision may hide
        slack = 1e-4 * np.linalg.norm(even, axis=1) * codes.length.max(initial=0)
        score, best = np.full((len(some), k), -np.inf), np.zeros((len(some), k), dtype=np.int64)
        for at in range(0, len(ids), CHUNK):
            here = ids[at : at + CHUNK]
            part = vectors[at : at + CHUNK]
            guess, upper = estimate(codes, slice(at, at + CHUNK), even, turn, epsilon)
            least = score[:, -1]
            first = min(len(here), FIRST * k)
            if at == 0 and first > k:
                rows = np.argpartition(-guess, first - 1, axis=1)[:, :first]
                known = exact(part, rows.ravel(), some, np.repeat(np.arange(len(some)), first)).reshape(rows.shape)
                known[here[rows] == own[:, None]] = -np.inf
                least = -np.partition(-known, k - 1, axis=1)[:, k - 1]
                np.put_along_axis(upper, rows, np.inf, axis=1)
            least = least / peaks / peak
            asks, rows = np.nonzero(~(upper < least[:, None]))
            stay = promising(small[at : at + CHUNK], rows, even, asks, least - slack) & (here[rows] != own[asks])
            asks, rows = asks[stay], rows[stay]
            every = np.concatenate([np.repeat(np.arange(len(some)), k), asks])
            scores = np.concatenate([score.ravel(), exact(part, rows, some, asks)])
            names = np.concatenate([best.ravel(), here[rows]])
            order = np.lexsort((names, -scores, every))
            starts = np.searchsorted(every[order], np.arange(len(some)))
            pick = order[starts[:, None] + np.arange(k)]
            score, best = scores[pick], names[pick]
        held = score > -np.inf
        found.append((np.repeat(own, held.sum(axis=1)), best[held], score[held]))
    return tuple(np.concatenate(c) for c in zip(*found)) if found else (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))


def usable(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """vec_id and components (floats, if they are, or doubles) of the vectors without a null, non-finite or only zero components."""
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).alias("v"))
    if not isinstance(rows.schema["v"].dataType.elementType, FloatType):
        rows = rows.withColumn("v", F.col("v").cast("array<double>"))
    fine = ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists("v", lambda x: x != 0)
    return rows.filter("vec_id is not null and size(v) > 0").filter(fine)


def nearest(vectors: DataFrame, query_every: int = 20, k: int = 20, epsilon: float = 1.9, block_rows: int = 131_072, block_queries: int = 65_536, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score of the ``k`` best for every row whose id divides by ``query_every``."""
    rows = usable(vectors, vec_id, embedding)
    asks = F.pmod("vec_id", F.lit(query_every)) == 0
    common = rows.groupBy(F.size("v").alias("dim")).agg(F.count("*").alias("n"), F.count_if(asks).alias("m")).orderBy(F.desc("n"), "dim").first()
    dim, n, m = (common["dim"], common["n"], common["m"]) if common else (0, 0, 0)
    rows = rows.filter(F.size("v") == dim)
    asked = rows.filter(asks).groupBy("vec_id").agg(F.min("v").alias("v"))
    block_rows = min(block_rows, max(1, BLOCK_COMPONENTS // max(1, dim)))
    q_blocks = max(1, math.ceil(m / min(block_queries, block_rows)))
    cores = 2 * vectors.sparkSession.sparkContext.defaultParallelism
    n_blocks = max(1, math.ceil(n / block_rows), min(math.ceil(n / LEAST_ROWS), cores))
    mine = F.pmod(F.xxhash64("vec_id", "v"), F.lit(n_blocks)).cast("int")
    theirs = F.pmod(F.xxhash64(F.lit(1), "vec_id"), F.lit(q_blocks)).cast("int")
    data = rows.select(mine.alias("x"), F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1))).alias("y"), "vec_id", "v")
    query = asked.select(F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("x"), theirs.alias("y"), "vec_id", "v")

    def arrays(block: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        ids = block["vec_id"].to_numpy()
        flat = [c.flatten().to_numpy() for c in block["v"].chunks]
        vectors = np.concatenate(flat).reshape(len(ids), dim)
        # one order, whatever order the rows came in, without runs of neighbouring ids
        order = np.lexsort((vectors[:, 0], ids))[np.random.default_rng(5).permutation(len(ids))]
        return ids[order], vectors[order]

    def cell(block: pa.Table, queries: pa.Table) -> pa.Table:
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        if len(block) and len(queries):
            turn, (some_ids, some) = rotation(dim), arrays(queries)
            # a block of many equal vectors may be larger than planned: take it in pieces
            for at in range(0, len(block), 2 * block_rows):
                found.append(search_block(*arrays(block.slice(at, 2 * block_rows)), some_ids, some.astype(np.float64), k, epsilon, turn))
        columns = [np.concatenate(c) for c in zip(*found)] or [np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)]
        return pa.table(dict(zip(("query_id", "vec_id", "score"), columns)))

    best = data.groupBy("x", "y").cogroup(query.groupBy("x", "y")).applyInArrow(cell, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
