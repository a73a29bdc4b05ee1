"""Near-duplicate vectors by sorted projection passes.

Each pass hashes every distinct vector with random projections of its own, a bit each, and
sorts the vectors by the concatenated bits. Close vectors agree on most leading bits and
come to lie near each other; each is compared with at least ``window`` vectors before and
after it. The number of passes follows from the number of vectors, so that two at the
threshold miss each other in all passes with probability ``miss`` (were vectors spread
evenly). Only an eight-bit sketch travels with the keys; it bounds the cosine to some
0.01, and what may reach the threshold is linked, by a spanning forest of each window.
The links of all passes together, closed into components, give candidate groups. Inside each
group every pair is then compared exactly, in double precision, tile by tile; a tile
returns counts and a spanning forest of true links, never all pairs.

So whatever groups the passes bring together, links inside them are all found; links
between groups that no pass saw are what can be missed. A group of very many different
vectors costs the square of its size in comparisons, spread over tiles, and each of its
rows is sent to ``size / CHUNK`` tiles.

Defined cases: vectors that are null, empty, zero or hold a null or non-finite component
link with nothing; vectors of different lengths are not compared; repeated rows and equal
vectors are compared as one and count as links of each other; a component's id is its
smallest non-null id; a row with a null id takes part; an empty table gives no rows; columns
other than the named ones are ignored, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import parallelism, written
from .simhash import components
from .skew import join_counted

#: Vectors of a block; each is compared with its own block and both neighbours.
WINDOW = 256
#: Bits of a key.
BITS = 62
#: Vectors of a chunk, about; a tile has two chunks.
CHUNK = 4096
#: Rows of a matrix of cosines.
SOME = 512
#: Least number of blocks in a partition, whose edges do not meet the next partition's.
BLOCKS = 32


def usable(vector: Column) -> Column:
    """Not null, and some component not zero, all of them finite."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return F.coalesce(~F.exists(vector, bad) & F.exists(vector, lambda x: x != 0), F.lit(False))


def units(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one in double precision, whatever their scale."""
    v = vectors.astype(np.float64)
    v /= np.abs(v).max(axis=1, keepdims=True)
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def matrix(column: pa.Array) -> np.ndarray:
    """A list column of equal lengths as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def n_passes(n: int, least: float, window: int = WINDOW, miss: float = 0.02) -> int:
    """Passes after which a pair with cosine ``least`` has been in a window with probability 1 - ``miss``."""
    agree = 1 - math.acos(least) / math.pi
    seen = agree ** max(0.0, math.log2(max(n, 1) / window))
    return max(2, math.ceil(math.log(miss) / math.log(max(1e-9, 1 - seen))))


def hashes(v: np.ndarray, number: int, seed: int) -> np.ndarray:
    """The keys of one pass: signs of ``BITS`` random projections, the first one highest."""
    planes = np.random.default_rng([seed, number, v.shape[1]]).standard_normal((v.shape[1], BITS))
    return (v @ planes > 0) @ (np.int64(1) << np.arange(BITS - 1, -1, -1, dtype=np.int64))


def sketch(v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unit vectors as signed bytes, their scales, and how far each is from what it stands for."""
    scale = np.abs(v).max(axis=1) / 127
    codes = np.rint(v / scale[:, None]).astype(np.int8)
    return codes, scale, np.linalg.norm(v - codes * scale[:, None], axis=1)


def forest(linked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(from, to) of links that connect what a symmetric matrix of links connects."""
    left = np.flatnonzero(linked.any(axis=1))
    heads, tails = [], []
    while left.size > 1:
        front, left = left[:1], left[1:]
        while front.size and left.size:
            near = linked[np.ix_(front, left)]
            hit = near.any(axis=0)
            heads.append(front[near[:, hit].argmax(axis=0)])
            tails.append(left[hit])
            front, left = left[hit], left[~hit]
    none = np.empty(0, dtype=np.int64)
    return (np.concatenate(heads), np.concatenate(tails)) if heads else (none, none)


def distinct_vectors(rows: DataFrame) -> DataFrame:
    """node (the smallest id, and a hash of the vector), dim, n and v of each distinct vector; rows: id, h1, h2, v."""
    per = rows.groupBy("h1", "h2").agg(F.min("id").alias("id"), F.count("*").alias("n"), F.first("v").alias("v"))
    node = F.struct(F.col("id").isNull().alias("none"), "id", "h1", "h2").alias("node")
    return per.select(node, "n", F.size("v").alias("dim"), "v")


def pass_rows(nodes: DataFrame, passes: int, seed: int) -> DataFrame:
    """A row per node and pass: the pass, dim, key, node's hash and sketch."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column(0).to_numpy()
            for dim in np.unique(dims):
                at = pa.array(np.flatnonzero(dims == dim))
                names, v = batch.column(1).take(at), units(matrix(batch.column(2).take(at)))
                codes, scale, off = sketch(v)
                made = [pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(scale.astype(np.float32)), pa.array(off.astype(np.float32))]
                for number in range(passes):
                    key = pa.array(hashes(v, number, seed))
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(v), number, dtype=np.int32)), pa.array(np.full(len(v), dim, dtype=np.int32)), key, names, *made], names=["p", "dim", "key", "node", "codes", "scale", "off"])

    node = nodes.schema["node"].dataType.simpleString()
    return nodes.select("dim", "node", "v").mapInArrow(each, f"p int, dim int, key long, node {node}, codes binary, scale float, off float")


def window_links(rows: DataFrame, least: float, window: int) -> DataFrame:
    """Links (a, b) between nodes that may reach ``least``; rows sorted by p, dim and key, as :func:`pass_rows` makes them."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before: pa.Table | None = None  # the last block, of which pairs inside are known
        held: list[pa.RecordBatch] = []

        def run(table: pa.Table, known: int) -> pa.RecordBatch:
            v = np.frombuffer(b"".join(table.column("codes").to_pylist()), dtype=np.int8).reshape(table.num_rows, -1).astype(np.float32)
            scale, off = (table.column(c).to_numpy().astype(np.float64) for c in ("scale", "off"))
            # the sketches' product, and what both distances may add to it
            reach = (v @ v.T) * np.outer(scale, scale) + off[:, None] + off[None, :] + np.outer(off, off)
            linked = reach >= least - 1e-5
            linked[:known, :known] = False
            np.fill_diagonal(linked, False)
            a, b = forest(linked)
            names = table.column("node").combine_chunks()
            return pa.RecordBatch.from_arrays([names.take(pa.array(a)), names.take(pa.array(b))], names=["a", "b"])

        def blocks(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal before, held
            if not held:
                return
            whole = pa.Table.from_batches(held)
            p, dim = whole.column("p").to_numpy(), whole.column("dim").to_numpy()
            cuts = [0, *(np.flatnonzero((np.diff(p) != 0) | (np.diff(dim) != 0)) + 1).tolist(), len(p)]
            done = 0
            for start, end in zip(cuts, cuts[1:]):
                at = start
                while end - at >= window or (at < end and (last or end < len(p))):
                    block = whole.slice(at, min(window, end - at))
                    same = before is not None and before.column("p")[0] == block.column("p")[0] and before.column("dim")[0] == block.column("dim")[0]
                    yield run(pa.concat_tables([before, block]), before.num_rows) if same else run(block, 0)
                    before, at = block, at + block.num_rows
                done = at
            held = whole.slice(done).to_batches()

        for batch in batches:
            held.append(batch)
            yield from blocks(False)
        yield from blocks(True)

    node = rows.schema["node"].dataType.simpleString()
    return rows.mapInArrow(each, f"a {node}, b {node}")


def candidate_links(nodes: DataFrame, n: int, least: float, window: int = WINDOW, miss: float = 0.02, seed: int = 11) -> DataFrame:
    """Links between the ``n`` nodes that the sorted passes bring together; a superset of the true links among those."""
    passes = n_passes(n, least, window, miss)
    # partitions of enough blocks that few windows end at an edge
    width = max(1, min(parallelism(nodes.sparkSession), n * passes // (BLOCKS * window)))
    keyed = written(pass_rows(nodes, passes, seed), "projections") if width > 1 else pass_rows(nodes, passes, seed)
    ranged = keyed.repartitionByRange(width, "p", "dim", "key", "node") if width > 1 else keyed.repartition(1)
    return window_links(ranged.sortWithinPartitions("p", "dim", "key", "node"), least, window)


def exact_links(members: DataFrame, least: float) -> DataFrame:
    """Per node of a group the number of rows linked to it in each tile (b null), and links (a, b) of a spanning forest.

    ``members``: root (of the candidate group), size, node, n (equal rows), v.
    """
    chunks = F.ceil(F.col("size") / CHUNK)
    placed = members.withColumn("c", chunks).withColumn("mine", F.pmod(F.xxhash64("node"), F.col("c")))
    tile = F.transform(F.sequence(F.lit(0).cast("long"), F.col("c") - 1), lambda j: F.struct(F.least("mine", j).alias("x"), F.greatest("mine", j).alias("y")))
    tiled = placed.select("root", "node", "n", "v", "mine", F.explode(tile).alias("t")).select("root", "t.x", "t.y", "mine", "node", "n", "v")

    def links(table: pa.Table) -> pa.Table:
        v, n, mine = units(matrix(table.column("v").combine_chunks())), table.column("n").to_numpy(), table.column("mine").to_numpy()
        one = table.column("x")[0] == table.column("y")[0]
        linked = np.empty((len(v), len(v)), dtype=bool)
        for at in range(0, len(v), SOME):
            linked[at : at + SOME] = v[at : at + SOME] @ v.T >= least
        linked &= linked.T  # rounding alike both ways
        np.fill_diagonal(linked, False)
        if not one:
            linked &= mine[:, None] != mine[None, :]
        counts = np.concatenate([linked[at : at + SOME] @ n for at in range(0, len(v), SOME)])
        a, b = forest(linked)
        some = np.flatnonzero(counts)
        names = table.column("node").combine_chunks()
        left = names.take(pa.array(np.concatenate([a, some])))
        right = names.take(pa.array(np.concatenate([b, some]), mask=np.repeat([False, True], [len(b), len(some)])))
        return pa.table([left, right, pa.array(np.concatenate([np.zeros(len(a), dtype=np.int64), counts[some]]))], names=["a", "b", "links"])

    node = members.schema["node"].dataType.simpleString()
    return tiled.groupBy("root", "x", "y").applyInArrow(links, f"a {node}, b {node}, links long")


def near_groups(vectors: DataFrame, least: float = 0.95, window: int = WINDOW, miss: float = 0.02, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """vec_id, n_links, component_id and kept of every row of ``vectors``."""
    hash_of = [F.xxhash64("v").alias("h1"), F.xxhash64(F.lit(1), "v").alias("h2")]
    plain = vectors.select(F.col(vec_id).cast("long").alias("id"), F.col(embedding).alias("v"))
    rows = plain.filter(usable(F.col("v"))).select("id", "v", *hash_of)
    nodes = written(distinct_vectors(rows), "vectors")
    n, total = nodes.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    groups = components(candidate_links(nodes, n, least, window, miss))
    sizes = groups.groupBy("root").agg(F.count("*").alias("size"))
    rooted = join_counted(groups, sizes.withColumn("m", F.col("size")), "root", n, "m")
    exact = written(exact_links(rooted.join(nodes, "node"), least), "exact-links")
    roots = components(exact.filter("b is not null").select("a", "b"))
    counted = exact.filter("b is null").groupBy("a").agg(F.sum("links").alias("others")).withColumnRenamed("a", "node")
    found = nodes.select("node", "n").join(counted, "node", "left").join(roots, "node", "left")
    values = found.select("node.h1", "node.h2", (F.coalesce("others", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("root.id", "node.id").alias("component_id"), F.col("n").alias("m"))
    good = join_counted(rows.select("id", "h1", "h2"), written(values, "vector-groups"), ["h1", "h2"], total, "m")
    bad = plain.filter(~usable(F.col("v"))).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    both = good.select("id", "n_links", "component_id").unionByName(bad)
    return both.select(F.col("id").alias("vec_id"), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
