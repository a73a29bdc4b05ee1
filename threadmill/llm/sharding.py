"""Two-pass external shuffle into shards with equal row counts.

Pass one scatters whole records into memory-sized buckets by a seeded hash, a
partition each. Pass two shuffles each bucket with Spark's ``shuffle``, a
Fisher-Yates shuffle seeded by the bucket's number, and writes it. A bucket
that turns out larger than planned is cut in hash order first. A record's
position is the rows in earlier buckets plus its place in its own; shard k is
the k-th of equal ranges of positions, so counts differ by one at most. Order
follows from the rows, the seed and ``bucket_bytes``, not from Spark's settings.

Everything is DataFrame functions. Defined cases: a null text is a record like
any other; rows with equal doc_id and text stay in one bucket, which is cut by
rows and bytes, unless there are over ``BUCKET_ROWS`` of them: these are dealt to
all buckets, in the order in which the input's partitions hold them; a very long
text is a record of one bucket; an empty table writes no rows; other columns of
the records, whatever their names, are carried along.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .scratch import boxed, written

#: Rows that are shuffled together at most, beside their bytes.
BUCKET_ROWS = 50_000


def _heavy(docs: DataFrame, mixed: Column, counts: DataFrame, buckets: int) -> DataFrame | None:
    """Hashes that over ``BUCKET_ROWS`` rows have: looked for in crowded buckets only, and no more than n / BUCKET_ROWS."""
    crowded = counts.filter(F.col("n") > BUCKET_ROWS).select("bucket")
    if crowded.isEmpty():
        return None
    per = docs.select(mixed.alias("h")).join(crowded, F.pmod("h", F.lit(buckets)) == F.col("bucket"), "left_semi")
    heavy = written(per.groupBy("h").count().filter(F.col("count") > BUCKET_ROWS).select(F.col("h").alias("many")), "heavy")
    return None if heavy.isEmpty() else heavy


def shuffle_to_shards(docs: DataFrame, path: str, n_shards: int = 16, bucket_bytes: int = 16 << 20, seed: int = 17, text: str = "text", doc_id: str = "doc_id") -> None:
    """Write ``docs`` to ``path`` as Parquet: a folder per shard with ``slot`` and the struct ``row``, in slot order.

    A task holds one bucket, some three times ``bucket_bytes`` in memory: raise it
    with the corpus, so that buckets (two numbers each) stay some hundred thousand.
    """
    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 64
    mixed = F.xxhash64(F.lit(seed), F.col(doc_id), F.col(text))
    total = docs.agg(F.coalesce(F.sum(size), F.lit(0)).alias("bytes")).first()["bytes"]
    buckets = max(1, math.ceil(total / bucket_bytes))

    rows = boxed(docs, h=mixed, size=size)
    counts = written(docs.select(mixed.alias("h")).groupBy(F.pmod("h", F.lit(buckets)).alias("bucket")).agg(F.count("*").alias("n")), "buckets")
    heavy = _heavy(docs, mixed, counts, buckets)
    if heavy is not None:
        turn = F.when(F.col("many").isNotNull(), F.xxhash64(F.lit(seed), F.monotonically_increasing_id())).otherwise(F.col("h"))
        # written, so that a record counted for a bucket is the record put there
        rows = written(rows.join(F.broadcast(heavy), F.col("h") == F.col("many"), "left").withColumn("h", turn).drop("many"), "dealt")
        counts = written(rows.groupBy(F.pmod("h", F.lit(buckets)).alias("bucket")).agg(F.count("*").alias("n")), "buckets")
    n = counts.agg(F.sum("n")).first()[0] or 1
    # one row per bucket of some megabytes, not per record
    before = F.sum("n").over(Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select(F.col("bucket").alias("of"), F.coalesce(before, F.lit(0)).alias("before"))

    scattered = rows.withColumn("bucket", F.pmod("h", F.lit(buckets)).cast("int")).repartitionById(buckets, "bucket")
    order = Window.partitionBy("bucket").orderBy("h", "size")
    running = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = scattered.withColumn("rank", F.row_number().over(order) - 1).withColumn("bytes", F.sum("size").over(running))
    cut = F.greatest(F.floor(F.col("bytes") / (2 * bucket_bytes)), F.floor(F.col("rank") / BUCKET_ROWS))
    whole = ranked.withColumn("cut", cut).groupBy("bucket", "cut").agg(F.min("rank").alias("from"), F.collect_list("row").alias("rows"))
    dealt = whole.select("bucket", "from", F.posexplode(F.shuffle("rows", F.lit(seed))).alias("place", "row"))
    placed = dealt.join(starts, F.col("bucket") == F.col("of")).withColumn("at", F.col("before") + F.col("from") + F.col("place"))
    shard = F.expr(f"cast(at * {n_shards} div {n} as int)")
    first = F.expr(f"(shard * {n}L + {n_shards} - 1) div {n_shards}")
    out = placed.withColumn("shard", shard).withColumn("slot", F.col("at") - first).select("shard", "slot", "row")
    out.sortWithinPartitions("shard", "slot").write.partitionBy("shard").option("compression", "zstd").parquet(path)


def read_shards(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """The shards as written: shard, slot and the records as a struct ``row`` with the columns of ``like``."""
    schema = boxed(like.limit(0)).select(F.lit(0).cast("long").alias("slot"), "row", F.lit(0).alias("shard")).schema
    return spark.read.schema(schema).parquet(path)
