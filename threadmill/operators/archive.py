"""Posts and threads: numbering, joins with boards and interaction data, roll-ups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import schemas
from ..functions.tagging import with_tags
from ..functions.textops import post_timestamp
from ..functions.vocab import Vocab

PAGE_SIZE = 15


def one_each(df: DataFrame, keys: list[str], *latest: Column | str) -> DataFrame:
    """One row per ``keys``: the largest by ``latest``; of equals the one whose columns have the largest hash, whatever the order of rows."""
    order = F.struct(*latest, F.xxhash64(*df.columns).alias("__hash"))
    return df.groupBy(*keys).agg(F.max_by(F.struct(*df.columns), order).alias("__row")).select("__row.*")


def only_board(df: DataFrame, fid: int) -> DataFrame:
    """One board's rows; on a table partitioned by fid no other files are read."""
    return df.filter(F.col("fid") == fid)


def floor_of(page: Column, position: Column, page_size: int = PAGE_SIZE) -> Column:
    return ((page - 1) * page_size + position).cast("int")


def page_of(floor: Column, page_size: int = PAGE_SIZE) -> Column:
    return (F.floor((floor - 1) / page_size) + 1).cast("int")


def position_of(floor: Column, page_size: int = PAGE_SIZE) -> Column:
    return (F.pmod(floor - 1, F.lit(page_size)) + 1).cast("int")


def number_floors(posts: DataFrame, order: list[str] | None = None) -> DataFrame:
    """Running floor numbers over a thread's pages; for complete pages :func:`floor_of` needs no window."""
    return posts.withColumn("floor", F.row_number().over(Window.partitionBy("tid").orderBy(*(order or ["page", "position"]))))


def number_by_pages(posts: DataFrame) -> DataFrame:
    """The floors of :func:`number_floors` in two levels: places in a page, and the posts on the pages before it.

    Only a thread's page counts, a row per page, are ever in one window, so a giant
    thread's posts spread over tasks by page. A page without a number comes first.
    """
    in_page = Window.partitionBy("tid", "page").orderBy("position")
    earlier = Window.partitionBy("tid").orderBy("page").rowsBetween(Window.unboundedPreceding, -1)
    counts = posts.groupBy("tid", "page").agg(F.count("*").alias("__n"))
    before = counts.select(F.col("tid").alias("__tid"), F.col("page").alias("__page"), F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before"))
    placed = posts.withColumn("__place", F.row_number().over(in_page))
    both = placed.join(before, F.col("tid").eqNullSafe(F.col("__tid")) & F.col("page").eqNullSafe(F.col("__page")))
    return both.withColumn("floor", (F.col("__before") + F.col("__place")).cast("int")).drop("__tid", "__page", "__before", "__place")


def live_post_count(page_counts: DataFrame, page_size: int = PAGE_SIZE) -> DataFrame:
    """tid, live: posts on all full pages before the last, plus those on the last. Input: tid, page, posts_on_page."""
    last = page_counts.groupBy("tid").agg(F.max("page").alias("pages"), F.max_by("posts_on_page", "page").alias("on_last"))
    return last.select("tid", ((F.col("pages") - 1) * page_size + F.col("on_last")).cast("long").alias("live"))


def unique_meta(meta: DataFrame) -> DataFrame:
    """One row per (tid, page, pid): its last value at its first place. Input: tid, page, at, pid, meta."""
    once = meta.groupBy("tid", "page", "pid").agg(F.min("at").alias("at"), F.max_by("meta", "at").alias("meta"))
    return once.withColumn("position", F.row_number().over(Window.partitionBy("tid", "page").orderBy("at")))


def attach_meta(posts: DataFrame, meta: DataFrame) -> DataFrame:
    """``posts`` with the interaction data at the same place of the same page; null where there is none."""
    return posts.join(unique_meta(meta).select("tid", "page", "position", "meta"), ["tid", "page", "position"], "left")


def post_records(posts: DataFrame, vocab: Vocab = Vocab()) -> DataFrame:
    """Full post rows: defaults filled, tags computed, columns in schema order; ``meta`` stays if there is one."""
    ddl = schemas.POSTS_DDL + (f", {schemas.META_DDL}" if "meta" in posts.columns else "")
    return with_tags(schemas.with_defaults(posts, ddl), vocab).select(*schemas.struct(ddl).fieldNames())


def with_post_ts(posts: DataFrame) -> DataFrame:
    return posts.withColumn("post_ts", post_timestamp(F.col("post_time")))


def thread_rollup(posts: DataFrame, vocab: Vocab = Vocab(), last_crawl: Column | None = None) -> DataFrame:
    """One row per thread: first author and time, post count, and the tags of its first post.

    ``min_by`` and ``count`` combine before the shuffle, so a huge thread is a row per task.
    """
    first = lambda c: F.min_by(c, "floor").alias(c)
    per = posts.groupBy("tid").agg(
        *[first(c) for c in ("fid", "board", "category", "title", "content", "url")],
        F.min_by("author", "floor").alias("first_author"),
        F.min_by("post_time", "floor").alias("first_time"),
        F.count("*").cast("int").alias("post_count"),
    )
    names = schemas.struct(schemas.THREADS_DDL).fieldNames()
    return with_tags(per, vocab).withColumn("last_crawl", (F.lit("") if last_crawl is None else last_crawl).cast("string")).select(*names)


def post_counts(posts: DataFrame) -> DataFrame:
    return posts.groupBy("tid").agg(F.count("*").alias("posts"))


def highest_tid(threads: DataFrame) -> DataFrame:
    return threads.agg(F.coalesce(F.max("tid"), F.lit(0).cast("long")).alias("highest_tid"))


def status_report(threads: DataFrame, posts: DataFrame, boards: DataFrame) -> DataFrame:
    """One row: threads, posts, highest_tid, boards_done, boards_total."""
    t = threads.agg(F.count("*").alias("threads"), F.coalesce(F.max("tid"), F.lit(0).cast("long")).alias("highest_tid"), F.count_distinct("fid").alias("boards_done"))
    p = posts.agg(F.count("*").alias("posts"))
    b = boards.agg(F.count("*").alias("boards_total"))
    # three tables of one row each
    return t.crossJoin(p).crossJoin(b)


def upsert_threads(old: DataFrame, new: DataFrame) -> DataFrame:
    """All threads, each tid's latest row by last_crawl; at equal times the new one."""
    both = old.withColumn("__new", F.lit(0)).unionByName(new.withColumn("__new", F.lit(1)))
    row = F.struct(*old.columns)
    latest = both.groupBy("tid").agg(F.max_by(row, F.struct("last_crawl", "__new")).alias("__row"))
    return latest.select("__row.*")


def latest_posts(posts: DataFrame, version: str) -> DataFrame:
    """One row per (tid, floor): the one with the largest ``version``."""
    return one_each(posts, ["tid", "floor"], version)


def orphans(posts: DataFrame, threads: DataFrame) -> DataFrame:
    """Posts whose thread is missing."""
    return posts.join(threads.select("tid"), "tid", "left_anti")


def tag_facets(posts: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Posts per tag (and further columns).

    The outer form of explode keeps Spark from testing the list's size first,
    which would compute a list made by expressions twice.
    """
    each = posts.select(*(by or []), F.explode_outer("tags").alias("tag")).filter("tag is not null")
    return each.groupBy(*(by or []), "tag").agg(F.count("*").alias("posts"))


def facet_rollup(posts: DataFrame, levels: list[str]) -> DataFrame:
    """Counts at every level of a hierarchy such as category and year; totals have nulls."""
    return posts.rollup(*levels).agg(F.count("*").alias("posts"))
