"""Updating the archive from newly landed pages, in batches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.vocab import Vocab
from ..operators.archive import highest_tid, one_each, post_counts, thread_rollup, upsert_threads


def first_pages(listings: DataFrame, pages: int = 2) -> DataFrame:
    return listings.filter(F.col("page") <= pages)


def new_threads(listings: DataFrame, threads: DataFrame) -> DataFrame:
    """Listed threads above the highest archived tid, each once at its first place."""
    mark = F.broadcast(highest_tid(threads))  # one row
    row = F.min(F.struct("fid", "page", "pos", "title")).alias("__first")
    found = listings.crossJoin(mark).filter(F.col("tid") > F.col("highest_tid"))
    return found.groupBy("tid").agg(row).select("tid", "__first.*")


def updated_threads(live: DataFrame, posts: DataFrame) -> DataFrame:
    """tid, live, stored of threads with more posts now than archived. ``live``: tid, live."""
    stored = post_counts(posts).withColumnRenamed("posts", "stored")
    both = live.join(stored, "tid", "left").withColumn("stored", F.coalesce("stored", F.lit(0).cast("long")))
    return both.filter(F.col("live") > F.col("stored"))


def work_list(new: DataFrame, updated: DataFrame) -> DataFrame:
    """tid, priority: new threads, then updated ones; a thread that is both comes first."""
    both = new.select("tid", F.lit(0).alias("priority")).unionByName(updated.select("tid", F.lit(1).alias("priority")))
    return both.groupBy("tid").agg(F.min("priority").alias("priority"))


def unseen_floors(parsed: DataFrame, stored: DataFrame) -> DataFrame:
    """Parsed posts whose (tid, floor) is not archived, each once; a second run finds none."""
    # archived ones go first, so that only new rows are sorted and compared
    unseen = parsed.join(stored.select("tid", "floor"), ["tid", "floor"], "left_anti").select(*parsed.columns)
    return one_each(unseen, ["tid", "floor"])


def beyond_count(parsed: DataFrame, posts: DataFrame) -> DataFrame:
    """Parsed posts with a floor above the number archived for their thread."""
    stored = post_counts(posts).withColumnRenamed("posts", "__stored")
    return parsed.join(stored, "tid", "left").filter(F.col("floor") > F.coalesce("__stored", F.lit(0))).drop("__stored")


def unfinished(frontier: DataFrame, landed: DataFrame, key: str = "tid") -> DataFrame:
    """What a restarted run still has to do: the frontier without what has landed."""
    return frontier.join(landed.select(key).distinct(), key, "left_anti")


def skip_archived(queue: DataFrame, threads: DataFrame, progress: DataFrame | None = None) -> DataFrame:
    """``queue`` without archived threads.

    With ``progress`` (fid, last_processed) a thread counts as archived only if its
    board's run has also come to it, tid <= last_processed; the table has a row per board.
    """
    done = threads.select(F.col("tid").alias("__tid"))
    if progress is None:
        return queue.join(done, F.col("tid") == F.col("__tid"), "left_anti")
    reached = queue.join(progress.select("fid", F.col("last_processed").alias("__last")), "fid", "left")
    passed = (F.col("tid") == F.col("__tid")) & (F.col("tid") <= F.col("__last"))
    return reached.join(done, passed, "left_anti").select(*queue.columns)


def apply_update(posts: DataFrame, threads: DataFrame, parsed: DataFrame, last_crawl: str, vocab: Vocab = Vocab()) -> tuple[DataFrame, DataFrame]:
    """New versions of posts and threads after a run; only threads with new floors are rolled up again, by the same ``vocab``."""
    return with_added(posts, threads, unseen_floors(parsed, posts).select(*posts.columns), last_crawl, vocab)


def with_added(posts: DataFrame, threads: DataFrame, added: DataFrame, last_crawl: str, vocab: Vocab = Vocab()) -> tuple[DataFrame, DataFrame]:
    """:func:`apply_update` of posts known to be unseen."""
    whole = posts.unionByName(added)
    touched = added.select("tid").distinct()
    fresh = thread_rollup(whole.join(touched, "tid", "left_semi"), vocab, F.lit(last_crawl))
    return whole, upsert_threads(threads, fresh.select(*threads.columns))


def archive_state(threads: DataFrame, posts: DataFrame) -> DataFrame:
    """One row: highest_tid, total_archived, last_run."""
    t = threads.agg(F.coalesce(F.max("tid"), F.lit(0).cast("long")).alias("highest_tid"), F.max("last_crawl").alias("last_run"))
    return t.crossJoin(posts.agg(F.count("*").alias("total_archived")))
