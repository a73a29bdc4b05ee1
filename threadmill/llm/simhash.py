"""SimHash near-duplicate groups by pigeonhole blocks.

Fingerprints that differ in at most ``distance`` bits agree on at least
``blocks - distance`` of ``blocks`` bit blocks, so they share one of the keys
made of that many blocks. Fingerprints (each distinct value once) are joined on
keys and verified by their Hamming distance. Small buckets join in the JVM. A
bucket of over ``JOIN_MAX`` fingerprints is cut into tiles of two chunks; a task
compares one tile with numpy and returns a spanning forest of its links, never
all pairs. Links are closed into components by alternating star contractions.

Defined cases: null text counts as empty; a text without words has fingerprint
zero and is linked like any other; a very long text's hashes are eight bytes a
shingle; rows with a null doc_id take part, and a component's id is its smallest
non-null doc_id; repeated rows share a row's fingerprint and component; an empty
table gives no rows; columns other than the named ones are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shinglesets
from .scratch import boxed, unboxed, written
from .skew import join_counted
from .wordbpe import forget

#: Fingerprints of a bucket that are joined as rows; larger buckets go by tiles.
JOIN_MAX = 32
#: Fingerprints of a chunk, about; a tile has two chunks.
CHUNK = 4096
#: Rows to drop that are broadcast by id; with more, texts are shuffled.
BROADCAST_ROWS = 200_000
#: Shingles whose bits are counted at a time.
SOME = 1 << 15


def fingerprint(hashes: np.ndarray) -> int:
    """SimHash of shingle hashes as an unsigned 64-bit integer: bits set in over half of them."""
    if not len(hashes):
        return 0
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), SOME):
        ones += np.unpackbits(hashes[at : at + SOME].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words_each: int = 4, text: str = "text", doc_id: str = "doc_id", with_keys: bool = False) -> DataFrame:
    """doc_id, tag (a hash of the text, to find the row again) and fp (signed 64 bits) of every row.

    ``with_keys`` adds ``keys``, those of :func:`shinglesets.band_keys` for the same shingles.
    """
    names = ["doc_id", "tag", "fp"] + ["keys"] * with_keys

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in batches:
            fps, keys = np.empty(batch.num_rows, dtype=np.uint64), []
            for i, t in enumerate(batch.column(2)):
                hashes = shinglesets.shingle_hashes(t.as_py(), words_each)
                fps[i] = fingerprint(hashes)
                if with_keys:
                    keys.append(shinglesets.band_keys(np.unique(hashes)))
            made = [batch.column(0), batch.column(1), pa.array(fps.view(np.int64), pa.int64())]
            yield pa.RecordBatch.from_arrays(made + [pa.array(keys, pa.list_(pa.int64()))] * with_keys, names=names)

    narrow = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(text).alias("tag"), F.col(text).cast("binary").alias("text"))
    return narrow.mapInArrow(each, "doc_id long, tag long, fp long" + ", keys array<long>" * with_keys)


def block_masks(distance: int, blocks: int, bits: int = 64) -> list[int]:
    """Signed masks of every choice of ``blocks - distance`` blocks."""
    edges = [round(bits * i / blocks) for i in range(blocks + 1)]
    each = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]
    return [m - (1 << 64) if m >> 63 else m for m in (sum(c) for c in combinations(each, blocks - distance))]


def spanning_forest(fps: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Indices (from, to) of links that connect what links within ``distance`` bits connect."""
    left = np.arange(len(fps))
    heads, tails = [], []
    while left.size > 1:
        front, left = left[:1], left[1:]
        while front.size and left.size:
            reached = []
            for at in range(0, front.size, 64):
                some = front[at : at + 64]
                near = np.bitwise_count(fps[some][:, None] ^ fps[left][None, :]) <= distance
                hit = near.any(axis=0)
                if hit.any():
                    heads.append(some[near[:, hit].argmax(axis=0)])
                    tails.append(left[hit])
                    reached.append(left[hit])
                    left = left[~hit]
                    if not left.size:
                        break
            front = np.concatenate(reached) if reached else front[:0]
    none = np.empty(0, dtype=np.int64)
    return (np.concatenate(heads), np.concatenate(tails)) if heads else (none, none)


def close_pairs(nodes: DataFrame, distance: int = 4, blocks: int = 6) -> DataFrame:
    """Links (a, b) between ``node`` values of distinct ``fp`` that give the same components as all links.

    ``blocks`` sets the key width, 64 * (blocks - distance) / blocks bits: raise
    it when 2 to that power is small beside the number of fingerprints.
    """
    masks = F.array(*[F.struct(F.lit(k).alias("k"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for k, m in enumerate(block_masks(distance, blocks))])
    keyed = nodes.select("node", "fp", F.explode(masks).alias("b")).select("b.k", "b.key", "fp", "node")
    shared = written(keyed.groupBy("k", "key").agg(F.count("*").alias("n")).filter("n > 1").withColumn("size", F.col("n")), "shared")
    held = join_counted(keyed, shared, ["k", "key"], len(list(combinations(range(blocks), distance))) * nodes.count())
    members = written(held.withColumnRenamed("size", "n"), "buckets")
    cold = members.filter(F.col("n") <= JOIN_MAX)
    left = cold.select("k", "key", F.col("fp").alias("x"), F.col("node").alias("a"))
    right = cold.select("k", "key", F.col("fp").alias("y"), F.col("node").alias("b"))
    near = (F.col("x") < F.col("y")) & (F.bit_count(F.col("x").bitwiseXOR(F.col("y"))) <= distance)
    small = left.join(right, ["k", "key"]).filter(near).select("a", "b")

    chunks = F.ceil(F.col("n") / CHUNK)
    hot = members.filter(F.col("n") > JOIN_MAX).withColumn("c", chunks).withColumn("mine", F.pmod(F.xxhash64("fp"), F.col("c")))
    tile = F.transform(F.sequence(F.lit(0).cast("long"), F.col("c") - 1), lambda j: F.struct(F.least("mine", j).alias("x"), F.greatest("mine", j).alias("y")))
    tiled = hot.select("k", "key", "fp", "node", F.explode(tile).alias("t")).select("k", "key", "t.x", "t.y", "fp", "node")

    def links(table: pa.Table) -> pa.Table:
        ends = spanning_forest(table.column("fp").to_numpy().view(np.uint64), distance)
        nodes = table.column("node").combine_chunks()
        return pa.table([nodes.take(pa.array(at)) for at in ends], names=["a", "b"])

    node = small.schema["a"].dataType.simpleString()
    large = tiled.groupBy("k", "key", "x", "y").applyInArrow(links, f"a {node}, b {node}")
    return small.unionByName(large).distinct()


def components(edges: DataFrame, max_rounds: int = 50) -> DataFrame:
    """node, root (the smallest node reachable) for every node of an edge (a, b); nodes are of any type with an order.

    Alternates large-star and small-star (Kiveris et al. 2014) until a round
    changes nothing; each round's edges are written, so lineage stays short. A
    node with very many neighbours has its least one broadcast to them.
    """
    edges = written(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v"), "edges")
    before = None
    for _ in range(max_rounds):
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == before or not now[0]:
            break
        before = tuple(now)
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")).select("u", F.least("u", "m").alias("m"), "n")
        large = join_counted(both.filter("v > u"), least, "u", 2 * now[0]).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
        small = join_counted(large, low, "u", 2 * now[0]).filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = written(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "edges")
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())


def near_groups(docs: DataFrame, distance: int = 4, blocks: int = 6, words_each: int = 4, least: float | None = None, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, tag, fp, root and component_id of every row of ``docs``.

    A fingerprint is a node that begins with its smallest doc_id, so a component's
    root names it. ``least`` adds links between texts whose shingle sets are that
    similar, which 64 bits within ``distance`` mostly miss.
    """
    rows = written(fingerprints(docs, words_each, text, doc_id, with_keys=least is not None), "fingerprints")
    per = rows.groupBy("fp").agg(F.min("doc_id").alias("id"), F.count("*").alias("n"))
    nodes = written(per.select("fp", F.struct(F.col("id").isNull().alias("none"), "id", "fp").alias("node"), "n"), "nodes")
    total = nodes.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    links = close_pairs(nodes, distance, blocks)
    if least is not None:
        each = rows.groupBy("tag").agg(F.first("fp").alias("fp"), F.first("keys").alias("keys"))
        links = links.unionByName(shinglesets.links(docs, join_counted(each, nodes, "fp", total), least, words_each, text))
    roots = components(links).select(F.col("node.fp").alias("fp"), "root")
    groups = nodes.join(roots, "fp", "left").select("fp", F.coalesce("root", "node").alias("root"), "n")
    found = join_counted(rows.select("doc_id", "tag", "fp"), written(groups, "groups"), "fp", total)
    return found.select("doc_id", "tag", "fp", F.col("root.fp").alias("root"), F.col("root.id").alias("component_id"))


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one row of each near-duplicate group: its smallest doc_id, then smallest text hash.

    Null doc_ids count as largest. The columns of ``docs``, whatever their names, are returned unchanged.
    """
    groups = written(near_groups(docs, **options), "grouped")
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "tag")
    per = groups.groupBy("root").agg(F.min(place).alias("first"), F.count("*").alias("n"))
    placed = join_counted(groups, per, "root", groups.count())
    lost = written(placed.filter(place != F.col("first")).select("doc_id", "tag").distinct(), "lost")
    if lost.count() <= BROADCAST_ROWS:
        lost = F.broadcast(lost)
    rows = boxed(docs, id=F.col("doc_id").cast("long"), mark=F.xxhash64("text"))
    stay = rows.join(lost, F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("mark") == F.col("tag")), "left_anti")
    if not groups.groupBy("doc_id", "tag").count().filter("count > 1").isEmpty():  # only then do texts need a shuffle
        stay = stay.dropDuplicates(["id", "mark"])
    return unboxed(stay)
