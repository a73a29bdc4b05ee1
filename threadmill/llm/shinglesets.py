"""Links between texts by the Jaccard similarity of their word-shingle sets.

These help SimHash groups, whose fingerprints tell only near-identical texts:
at similarity 0.8 two of them differ in some ten of 64 bits, too many for blocks
to find. Candidates come from MinHash: ``BANDS`` keys of ``EACH`` minima of the
same hashes that a fingerprint is made of. Texts that share a key are compared by
their whole sets, so a link is always a verified one. Of pairs at similarity 0.8,
0.2 % share no key. Pairs of small buckets are joined to their sets; larger
buckets go by tiles of two chunks, which return a spanning forest.

Defined cases: a text of fewer words than a shingle is one shingle; a text
without words has no link here; null text counts as empty; a very long text has
as many keys as any other and a set of eight bytes a shingle; equal texts are
one; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import written
from .skew import join_counted
from .wordbpe import forget

BANDS, EACH = 20, 6
#: Texts of a bucket that are paired as rows; larger buckets go by tiles.
JOIN_MAX = 32
#: Texts of a chunk, about; a tile has two chunks.
CHUNK = 512
#: Texts to compare that are broadcast by hash; with more, texts are shuffled.
BROADCAST_TEXTS = 200_000
#: Shingles whose minima are taken at a time.
SOME = 1 << 12
#: Shingles of other sets that one set is compared with at a time.
TOGETHER = 1 << 20
#: Texts whose sets are handed on together.
SLICE = 500
_FACTORS = np.random.default_rng(17).integers(0, 2**63, BANDS * EACH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_hashes(text: bytes | None, words_each: int, seed: int = 42) -> np.ndarray:
    """XXH64 of every shingle of a text's words, in order; the whole sequence of fewer words is one, and no words are none."""
    words = (text or b"").lower().split()
    if not words:
        return np.empty(0, dtype="<u8")
    digest = xxhash.xxh64_intdigest
    if len(words) < words_each:
        return np.array([digest(b" ".join(words), seed)], dtype="<u8")
    shingles = map(b" ".join, zip(*(words[i:] for i in range(words_each))))
    return np.fromiter((digest(s, seed) for s in shingles), dtype="<u8", count=len(words) - words_each + 1)


def band_keys(found: np.ndarray) -> list[int]:
    """A signed key per band; none for an empty set."""
    if not len(found):
        return []
    low = np.full(BANDS * EACH, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(found), SOME):
        low = np.minimum(low, (_FACTORS[:, None] * found[None, at : at + SOME]).min(axis=1))
    return [xxhash.xxh3_64_intdigest(row.tobytes(), k) - (1 << 63) for k, row in enumerate(low.reshape(BANDS, EACH))]


def similarity(one: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """Jaccard similarity of a set with each of ``others``, none of them empty, some ``TOGETHER`` shingles at a time."""
    if len(others) > 1 and sum(map(len, others)) > TOGETHER:
        half = len(others) // 2
        return np.concatenate([similarity(one, others[:half]), similarity(one, others[half:])])
    sizes = np.array([len(o) for o in others])
    every = np.concatenate(others)
    at = np.minimum(np.searchsorted(one, every), len(one) - 1)
    both = np.add.reduceat((one[at] == every).astype(np.int64), np.concatenate(([0], np.cumsum(sizes)[:-1])))
    return both / (len(one) + sizes - both)


def sets_of(column: pa.Array | pa.ChunkedArray) -> list[np.ndarray]:
    """The sets in a column of bytes, without copying them."""
    return [np.frombuffer(x.as_buffer(), np.uint64) for x in column]


def spanning_forest(sets: list[np.ndarray], least: float) -> list[tuple[int, int]]:
    """Links (from, to) that connect what all links of similarity ``least`` connect."""
    left, links = list(range(len(sets))), []
    while left:
        front = [left.pop()]
        while front and left:
            one = front.pop()
            near = similarity(sets[one], [sets[i] for i in left]) >= least
            reached = [i for i, hit in zip(left, near) if hit]
            links += [(one, i) for i in reached]
            front += reached
            left = [i for i, hit in zip(left, near) if not hit]
    return links


def links(docs: DataFrame, each: DataFrame, least: float, words_each: int, text: str = "text") -> DataFrame:
    """Verified links (a, b) between nodes. ``each``: tag (hash of a text), node and keys of every different text."""
    each = written(each.select("tag", "node", "keys"), "keys")
    keyed = each.select("tag", "node", F.explode("keys").alias("key"))
    shared = written(keyed.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").withColumn("size", F.col("n")), "shared")
    held = join_counted(keyed, shared, "key", BANDS * each.count())
    members = written(held.withColumnRenamed("size", "n"), "shared-keys")
    wanted = written(members.select("tag").distinct(), "compared")
    if wanted.count() <= BROADCAST_TEXTS:
        wanted = F.broadcast(wanted)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                made = [np.unique(shingle_hashes(t.as_py(), words_each)).tobytes() for t in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(made, pa.binary())], names=["tag", "made"])

    texts = docs.select(F.xxhash64(text).alias("tag"), F.col(text).cast("binary").alias("text")).join(wanted, "tag", "left_semi")
    sets = written(texts.mapInArrow(hashed, "tag long, made binary").dropDuplicates(["tag"]), "shingles")

    cold, hot = members.filter(F.col("n") <= JOIN_MAX), members.filter(F.col("n") > JOIN_MAX)
    left, right = cold.select("key", F.col("tag").alias("x"), F.col("node").alias("a")), cold.select("key", F.col("tag").alias("y"), F.col("node").alias("b"))
    # texts of one fingerprint are together already
    pairs = left.join(right, "key").filter((F.col("x") < F.col("y")) & (F.col("a") != F.col("b"))).select("x", "y", "a", "b").distinct()

    def verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            one, other = (sets_of(batch.column(k)) for k in (2, 3))
            fits = pa.array([bool(similarity(x, [y])[0] >= least) for x, y in zip(one, other)], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(k).filter(fits) for k in (0, 1)], schema=pa.schema([batch.schema.field(k) for k in (0, 1)]))

    node = pairs.schema["a"].dataType.simpleString()
    with_x = pairs.join(sets.select(F.col("tag").alias("x"), F.col("made").alias("one")), "x")
    both = with_x.join(sets.select(F.col("tag").alias("y"), F.col("made").alias("other")), "y").select("a", "b", "one", "other")
    small = both.mapInArrow(verified, f"a {node}, b {node}")

    mine = hot.withColumn("c", F.ceil(F.col("n") / CHUNK)).withColumn("mine", F.pmod(F.xxhash64("tag"), F.col("c")))
    tile = F.transform(F.sequence(F.lit(0).cast("long"), F.col("c") - 1), lambda j: F.struct(F.least("mine", j).alias("x"), F.greatest("mine", j).alias("y")))
    tiled = mine.select("key", "tag", "node", F.explode(tile).alias("t")).select("key", "t.x", "t.y", "tag", "node").join(sets, "tag")

    def connected(table: pa.Table) -> pa.Table:
        found = spanning_forest(sets_of(table.column("made")), least)
        nodes = table.column("node").combine_chunks()
        ends = [nodes.take(pa.array([p[k] for p in found], pa.int64())) for k in (0, 1)]
        return pa.table(ends, names=["a", "b"])

    large = tiled.groupBy("key", "x", "y").applyInArrow(connected, f"a {node}, b {node}")
    return small.unionByName(large).distinct()
