"""The same updates as Structured Streaming jobs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..functions.textops import post_timestamp
from ..functions.vocab import Vocab
from ..operators.archive import PAGE_SIZE, floor_of, one_each, post_records
from ..sources.pages import decode_pages, is_error_page, newest_pages, number_in_page, page_identity, thread_posts


def parse_pages(pages: DataFrame, vocab: Vocab = Vocab(), page_size: int = PAGE_SIZE) -> DataFrame:
    """Full posts of a batch of raw thread pages, numbered in their page and their thread."""
    named = page_identity(decode_pages(pages) if "body" in pages.columns else pages)
    good = named.filter((F.col("kind") == "thread") & ~is_error_page(F.col("html")))
    # a page landed twice in one batch is one page, the later one
    once = newest_pages(good, ["tid", "page"]).select("url", "tid", "page", "html")
    posts = number_in_page(thread_posts(once), ["tid", "page"])
    return post_records(posts.withColumn("floor", floor_of(F.col("page"), F.col("position"), page_size)), vocab)


def first_seen(posts: DataFrame, delay: str | None = None, ts: str = "post_ts", keys: tuple[str, ...] = ("tid", "floor")) -> DataFrame:
    """Each of ``keys`` once.

    With ``delay`` the state holds only keys within the watermark on ``ts``; later
    repeats may pass again and must be caught by the sink. Without it the state
    grows with the number of posts.
    """
    if delay is None:
        return posts.dropDuplicates(list(keys))
    return posts.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))


def with_event_time(posts: DataFrame) -> DataFrame:
    return posts.withColumn("post_ts", post_timestamp(F.col("post_time")))


def running_counts(posts: DataFrame) -> DataFrame:
    """tid, posts so far; for update mode."""
    return posts.groupBy("tid").agg(F.count("*").alias("posts"))


def count_stream(posts: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """:func:`running_counts` in update mode: each batch writes the counts that it changed to ``batch=<id>`` under ``path``."""

    def add(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch={batch_id}")

    counts = running_counts(posts).writeStream.outputMode("update").foreachBatch(add)
    return counts.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def latest_counts(written: DataFrame) -> DataFrame:
    """tid, posts as the last batch that changed them has them; input: what :func:`count_stream` wrote."""
    return written.groupBy("tid").agg(F.max_by("posts", "batch").alias("posts"))


def archive_stream(rows: DataFrame, path: str, checkpoint: str, keys: tuple[str, ...] = ("tid", "floor"), prepare: Callable[[DataFrame], DataFrame] | None = None) -> StreamingQuery:
    """Append unseen posts to the Parquet archive at ``path``; a repeated batch adds nothing.

    ``prepare`` turns a batch of the stream (such as raw pages) into posts. Each
    batch is one folder ``batch=<id>``, overwritten if the batch is run again, and
    drops keys that earlier batches wrote; of those only the keys are read.
    """

    def add(batch: DataFrame, batch_id: int) -> None:
        fresh = one_each(prepare(batch) if prepare else batch, list(keys))
        if batch_id > 0:
            kept = StructType([f for f in fresh.schema if f.name in keys]).add("batch", "long")
            old = batch.sparkSession.read.schema(kept).option("basePath", path).parquet(path)
            fresh = fresh.join(old.filter(F.col("batch") < batch_id).select(*keys), list(keys), "left_anti")
        fresh.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch={batch_id}")

    return rows.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
