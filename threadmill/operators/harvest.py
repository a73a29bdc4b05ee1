"""From landed pages to the whole archive, and from newly landed ones to its next version."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, fields

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.vocab import Vocab
from ..sources import io
from ..sources import pages as parsers
from ..streaming import incremental
from . import archive, retrieval, sampling


@dataclass(frozen=True)
class Archive:
    """The tables of an archive; ``page_counts`` has the posts on each landed thread page."""

    boards: DataFrame
    listings: DataFrame
    posts: DataFrame
    threads: DataFrame
    index: DataFrame
    page_counts: DataFrame
    rejects: DataFrame


def saved(tables: Archive, root: str, version: int) -> Archive:
    """``tables`` written as a version of theirs under ``root``, and read back, so that what is built on them starts from files."""
    spark = tables.posts.sparkSession
    return Archive(**{f.name: spark.read.parquet(io.write_version(getattr(tables, f.name), f"{root.rstrip('/')}/{f.name}", version)) for f in fields(Archive)})


def sorted_pages(pages: DataFrame) -> DataFrame:
    """Raw or decoded pages with kind, numbers, version and reason (null for good ones)."""
    raw = parsers.decode_pages(pages) if "body" in pages.columns else pages
    return parsers.with_version(parsers.with_reason(parsers.page_identity(raw)))


def listing_table(good: DataFrame) -> DataFrame:
    """fid, page, pos, tid, title of the threads on board pages."""
    once = parsers.newest_pages(good.filter("kind = 'board'"), ["fid", "page"])
    return parsers.thread_listings(once.select("fid", "page", "html"))


def parsed_posts(good: DataFrame, page_size: int, numeric: bool, meta_pages: DataFrame | None) -> DataFrame:
    """Posts of thread pages with page, position and floor, yet without board and title."""
    once = parsers.newest_pages(good.filter("kind = 'thread'"), ["tid", "page"])
    found = parsers.number_in_page(parsers.thread_posts(once.select("tid", "page", "html"), numeric=numeric), ["tid", "page"])
    if meta_pages is not None:
        found = archive.attach_meta(found, parsers.thread_meta(meta_pages))
    return found.withColumn("floor", archive.floor_of(F.col("page"), F.col("position"), page_size))


def placed_posts(found: DataFrame, threads: DataFrame, base: str, vocab: Vocab) -> DataFrame:
    """Full post records: ``found`` with board, category and title of their thread (tid, fid, board, category, title) and tags by these."""
    named = found.drop("fid", "board", "category", "title").join(threads.select("tid", "fid", "board", "category", "title"), "tid", "left")
    return archive.post_records(named.withColumn("url", parsers.thread_web_url(base, F.col("tid"))), vocab)


def homes(listings: DataFrame, boards: DataFrame) -> DataFrame:
    """tid, fid, board, category and title of every listed thread, by its first listing."""
    return sampling.home_boards(listings).select("tid", "fid", "title").join(boards, "fid", "left")


def page_counts(posts: DataFrame) -> DataFrame:
    return posts.groupBy("tid", "page").agg(F.count("*").alias("posts_on_page"))


def archive_pages(
    pages: DataFrame,
    base: str,
    categories: DataFrame,
    vocab: Vocab = Vocab(),
    page_size: int = archive.PAGE_SIZE,
    last_crawl: str = "",
    meta_pages: DataFrame | None = None,
    numeric: bool = True,
    root: str | None = None,
    version: int = 1,
) -> Archive:
    """Everything that pages (url, html or GBK body, fetched_at) hold.

    A thread's board and title are those of its first listing; a thread that no
    landed listing names has neither, and tags from its text alone. ``categories``
    (fid, category) is the board dimension, ``meta_pages`` (tid, page, html) the
    pages with interaction data. Of a page that landed twice the later one counts.
    Numbers that fit no column are in the rejects.

    With ``root`` every table is written as a version under it: the decoded pages
    once, by kind, and the posts once; threads, index and counts are made from
    these posts. Without it the tables are plans that each start from ``pages``.
    """
    keep = _keeper(root, version)
    every = sorted_pages(pages)
    if root is not None:
        path = f"{root.rstrip('/')}/pages/v{version:08d}"
        every.write.mode("errorifexists").partitionBy("kind").parquet(path)
        every = pages.sparkSession.read.schema(every.schema).parquet(path)
    good = every.filter("reason is null")
    rejects = every.filter("reason is not null").select("url", "reason", F.current_timestamp().alias("ts"))
    rejects = keep(rejects.unionByName(parsers.unfit_numbers(good)), "rejects")
    boards = keep(parsers.with_category(parsers.discover_boards(good.filter("kind = 'other'")), categories), "boards")
    listings = keep(listing_table(good), "listings")
    posts = keep(placed_posts(parsed_posts(good, page_size, numeric, meta_pages), homes(listings, boards), base, vocab), "posts")
    threads = keep(archive.thread_rollup(posts, vocab, F.lit(last_crawl)), "threads")
    return Archive(boards, listings, posts, threads, keep(retrieval.token_index(posts), "index"), keep(page_counts(posts), "page_counts"), rejects)


def _keeper(root: str | None, version: int) -> Callable[[DataFrame, str], DataFrame]:
    """What writes a named table as a version under ``root`` and reads it back; without ``root`` the table stays a plan."""
    if root is None:
        return lambda df, name: df
    return lambda df, name: df.sparkSession.read.parquet(io.write_version(df, f"{root.rstrip('/')}/{name}", version))


def newer_rows(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of ``new``, and those of ``old`` whose ``keys`` it does not have."""
    return old.join(new.select(*keys).distinct(), keys, "left_anti").select(*new.columns).unionByName(new)


def known_threads(old: Archive, landed: Archive) -> DataFrame:
    """tid, fid, board, category and title: of an archived thread as archived, where it has a title, else by the first listing so far."""
    boards, listings = newer_rows(old.boards, landed.boards, ["fid"]), newer_rows(old.listings, landed.listings, ["fid", "page"])
    archived = old.threads.filter("title <> ''").select("tid", "fid", "board", "category", "title")
    listed = homes(listings, boards).select(*archived.columns)
    return archived.unionByName(listed.join(archived.select("tid"), "tid", "left_anti"))


def landed_work(old: Archive, landed: Archive, page_size: int, listed_pages: int) -> DataFrame:
    """tid, priority of what a run looks at: new threads on the first listing pages, and threads with more posts than are archived."""
    counts = newer_rows(old.page_counts, landed.page_counts, ["tid", "page"])
    grown = incremental.updated_threads(archive.live_post_count(counts.join(landed.page_counts.select("tid").distinct(), "tid", "left_semi"), page_size), old.posts)
    new = incremental.new_threads(incremental.first_pages(landed.listings, listed_pages), old.threads)
    return incremental.work_list(new, grown)


def update_archive(
    old: Archive,
    landed: Archive,
    base: str,
    vocab: Vocab = Vocab(),
    page_size: int = archive.PAGE_SIZE,
    last_crawl: str = "",
    listed_pages: int = 2,
    root: str | None = None,
    version: int = 1,
) -> Archive:
    """The next version of ``old`` after ``landed`` pages, which may be few, were parsed by :func:`archive_pages`.

    Only new threads on the first listing pages, and threads that have more posts
    than are archived, are looked at; of these only unseen floors are added, with
    board and title of the archived thread (or its listing, old or new), the
    thread rows rolled up again, and the index entries replaced. Boards, listings and
    page counts that did not land again stay. Both archives are read several
    times: for large ones pass written ones, as ``root`` of :func:`archive_pages` makes them.

    With ``root`` every table is written as a version under it, and before them the
    added posts, once; posts, threads and index are made from these. Without it each
    of the three works out the added posts anew.
    """
    keep = _keeper(root, version)
    found = landed.posts if "meta" in landed.posts.columns or "meta" not in old.posts.columns else landed.posts.withColumn("meta", F.lit(None).cast(old.posts.schema["meta"].dataType))
    parsed = placed_posts(found.join(landed_work(old, landed, page_size, listed_pages), "tid", "left_semi"), known_threads(old, landed), base, vocab)
    added = keep(incremental.unseen_floors(parsed, old.posts).select(*old.posts.columns), "added")
    posts, threads = incremental.with_added(old.posts, old.threads, added, last_crawl, vocab)
    return Archive(
        keep(newer_rows(old.boards, landed.boards, ["fid"]), "boards"),
        keep(newer_rows(old.listings, landed.listings, ["fid", "page"]), "listings"),
        keep(posts, "posts"),
        keep(threads, "threads"),
        keep(retrieval.refresh_index(old.index, added), "index"),
        keep(newer_rows(old.page_counts, landed.page_counts, ["tid", "page"]), "page_counts"),
        keep(old.rejects.unionByName(landed.rejects), "rejects"),
    )
