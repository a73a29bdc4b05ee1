"""Reading and writing the archive's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas


def read_raw_pages(spark: SparkSession, path: str) -> DataFrame:
    """Landed pages: a Parquet table of url, body, fetched_at."""
    return spark.read.schema(schemas.RAW_PAGES_DDL).parquet(path)


def read_page_files(spark: SparkSession, path: str, base: str = "") -> DataFrame:
    """Landed page files, one page each; a file's name after ``base`` is its url."""
    files = spark.read.format("binaryFile").load(path)
    return files.select(F.substring_index("path", "/", -1).alias("name"), "content", "modificationTime").select(F.concat(F.lit(base), "name").alias("url"), F.col("content").alias("body"), F.col("modificationTime").alias("fetched_at"))


def stream_raw_pages(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    return spark.readStream.schema(schemas.RAW_PAGES_DDL).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def read_posts_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """Posts, a JSON object per line; blank lines are skipped, a broken line is an error, absent keys get defaults."""
    posts = spark.read.schema(schemas.POSTS_WITH_EXTRAS_DDL).option("mode", "FAILFAST").json(path)
    return schemas.with_defaults(posts, schemas.POSTS_WITH_EXTRAS_DDL)


def append_posts_jsonl(posts: DataFrame, path: str) -> None:
    posts.write.mode("append").json(path)


def append_posts(posts: DataFrame, path: str) -> None:
    """The native archive: Parquet in a folder per board, so that one board's reads touch its own files."""
    # a board may hold much of the archive: spread it over tasks by thread
    posts.repartition("fid", F.pmod(F.xxhash64("tid"), F.lit(16))).write.mode("append").partitionBy("fid").parquet(path)


def write_chunks_jsonl(chunks: DataFrame, path: str) -> None:
    chunks.write.mode("overwrite").json(path)


def write_report(report: DataFrame, path: str) -> None:
    """A one-row report as JSON."""
    report.coalesce(1).write.mode("overwrite").json(path)


def append_rejects(rejects: DataFrame, path: str) -> None:
    rejects.write.mode("append").option("sep", "\t").csv(path)


def posts_for_sql(posts: DataFrame) -> DataFrame:
    """The posts with lists as JSON text and ``content_len``, for export to a row store."""
    full = schemas.with_defaults(posts, schemas.POSTS_DDL)
    kept = ["tid", "fid", "board", "category", "title", "author", "floor", "page", "position", "post_time", "content"]
    return full.select(*kept, F.length("content").alias("content_len"), F.to_json("tags").alias("tags"))


def write_version(df: DataFrame, root: str, version: int) -> str:
    """A new version of a table beside the old ones; readers of those are not disturbed."""
    path = f"{root.rstrip('/')}/v{version:08d}"
    df.write.mode("errorifexists").parquet(path)
    return path
