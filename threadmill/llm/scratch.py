"""Tables that cut lineage, kept in the cluster's shared checkpoint folder.

A written table survives the loss of any executor and is read back by all of
them. The folder is the one that ``spark.checkpoint.dir`` names; only a local
session may leave it unset, and then gets a temporary folder of its own.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Paths made for scratch tables since the last :func:`clear_scratch`.
_made: list[str] = []


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; an error on a cluster that names none."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="threadmill-checkpoints-")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no earlier run used."""
    path = f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _made.append(path)
    return path


def clear_scratch(spark: SparkSession) -> int:
    """Delete the scratch tables made so far and return their number.

    Results that read them, lazily or not, must have been written elsewhere.
    """
    done = len(_made)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    while _made:
        path = hadoop.Path(_made.pop())
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    return done


def written(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` once and return the table read back."""
    spark = df.sparkSession
    path = new_path(spark, name)
    writer = df.write.option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def boxed(docs: DataFrame, **keys: Column) -> DataFrame:
    """``docs`` as one struct column ``row`` beside ``keys``, so that no name of the caller's can clash."""
    return docs.select(F.struct(*[named(c) for c in docs.columns]).alias("row"), *[c.alias(k) for k, c in keys.items()])


def unboxed(rows: DataFrame) -> DataFrame:
    """The columns that :func:`boxed` put away."""
    return rows.select("row.*")


def named(column: str) -> Column:
    """A column by its name, whatever characters that holds."""
    return F.col("`" + column.replace("`", "``") + "`")


def parallelism(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
