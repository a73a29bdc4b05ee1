"""Landed pages as tables: boards, listings, posts and interaction data out of HTML.

Every parser is a narrow projection and an explode over the pages table; no page
meets another before its rows do.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.textops import SPACE, clean_title, decode_gbk, strip, with_clean_html
from ..functions.vocab import BOARDS, NO_AUTHOR, NO_CATEGORY, NOTICE, TIME_MARK

# The link and page-number forms of the archived pages.
BOARD_LINK = r'(?s)href="forum\.php\?mod=forumdisplay(?:&amp;|&)fid=(\d+)"[^>]*>(.*?)</a>'
THREAD_LINK = r'(?s)<li>\s*<a\s+href="\?tid-(\d+)\.html"[^>]*>(.*?)</a>'
BOARD_PAGE = r'href="\?fid-\d+\.html&page=(\d+)"'
THREAD_PAGE = r'href="\?tid-\d+\.html&page=(\d+)"'
AUTHOR_BLOCK = r'(?i)<\w+\s+class="author">'
#: More parts than a page can have.
REST = 1 << 30
#: Pages that a board or thread is believed to have at most.
MOST_PAGES = 1_000_000
#: Pages of a block of the frontier.
PAGES_EACH = 1000
#: Keys of repeated pages that go to every task.
REPEATED_KEYS = 100_000
AUTHOR = r"(?s)<strong>(.*?)</strong>"
POSTED = rf"{TIME_MARK}[{SPACE}]*([^<]+)"
HEADING = r"(?is)<h3>.*?</h3>"
POST_OPENER = r'<(?:div|table)\s+id="(?:post_|pid)(\d+)"[^>]*>'


def decode_pages(raw: DataFrame) -> DataFrame:
    """``raw_pages`` with ``html`` in place of the GBK ``body``."""
    return raw.withColumn("html", decode_gbk(F.col("body"))).drop("body")


def page_identity(pages: DataFrame, url: str = "url") -> DataFrame:
    """``pages`` with kind ('board', 'thread' or 'other'), fid, tid and page (1 if the URL has none)."""
    u = F.col(url)
    number = lambda pattern, kind: F.nullif(F.regexp_extract(u, pattern, 1), F.lit("")).try_cast(kind)
    fid = number(r"\?fid-(\d+)\.html", "int")
    tid = F.coalesce(number(r"\?tid-(\d+)\.html", "long"), number(r"mod=viewthread&(?:amp;)?tid=(\d+)", "long"))
    kind = F.when(fid.isNotNull(), "board").when(tid.isNotNull(), "thread").otherwise("other")
    return pages.withColumns({"kind": kind, "fid": fid, "tid": tid, "page": F.coalesce(number(r"&(?:amp;)?page=(\d+)", "int"), F.lit(1))})


def board_url(base: str, fid: Column, page: Column) -> Column:
    return _archived(base, "fid", fid, page)


def thread_url(base: str, tid: Column, page: Column) -> Column:
    return _archived(base, "tid", tid, page)


def _archived(base: str, kind: str, number: Column, page: Column) -> Column:
    first = F.format_string(f"{base}/archiver/?{kind}-%d.html", number)
    return F.when(page <= 1, first).otherwise(F.concat(first, F.format_string("&page=%d", page)))


def thread_web_url(base: str, tid: Column) -> Column:
    return F.format_string(f"{base}/forum.php?mod=viewthread&tid=%d", tid)


def _links(pages: DataFrame, html: str, pattern: str) -> DataFrame:
    return pages.select("*", F.posexplode(F.regexp_extract_all(F.col(html), F.lit(pattern), F.lit(0))).alias("pos", "link"))


def discover_boards(pages: DataFrame, html: str = "html", order: str = "url") -> DataFrame:
    """fid, board of every board linked with a text, first link per fid; numbers beyond an int are left to :func:`unfit_numbers`."""
    found = _links(pages.select(order, html), html, BOARD_LINK)
    named = found.select(order, "pos", F.regexp_extract("link", BOARD_LINK, 1).try_cast("int").alias("fid"), clean_title(F.regexp_extract("link", BOARD_LINK, 2), "").alias("board")).filter("fid is not null and board <> ''")
    # the first of each fid, combined before it is shuffled
    return named.groupBy("fid").agg(F.min_by("board", F.struct(order, "pos")).alias("board")).orderBy("fid")


def board_dimension(spark) -> DataFrame:
    """The default boards as a table of fixed size."""
    return spark.createDataFrame([(k, b, c) for k, (b, c) in BOARDS.items()], "fid int, board string, category string")


def with_category(df: DataFrame, boards: DataFrame, fid: str = "fid") -> DataFrame:
    """``df`` with the category of its board, or the default for unknown boards; the planner sizes the join."""
    dim = boards.select(F.col("fid").alias("__fid"), F.col("category").alias("__category"))
    joined = df.join(dim, df[fid] == dim["__fid"], "left")
    return joined.withColumn("category", F.coalesce("__category", F.lit(NO_CATEGORY))).drop("__fid", "__category")


def thread_listings(pages: DataFrame, html: str = "html") -> DataFrame:
    """``pages``' other columns with pos, tid and title of each listed thread; numbers beyond a long are left to :func:`unfit_numbers`."""
    keep = [c for c in pages.columns if c not in (html, "tid", "title", "pos")]
    found = _links(pages, html, THREAD_LINK)
    rows = found.select(*keep, "pos", F.regexp_extract("link", THREAD_LINK, 1).try_cast("long").alias("tid"), clean_title(F.regexp_extract("link", THREAD_LINK, 2)).alias("title"))
    return rows.filter("tid is not null and title <> ''")


def max_page(html: Column, pattern: str) -> Column:
    """The largest page number linked, 1 without one."""
    numbers = F.transform(F.regexp_extract_all(html, F.lit(pattern), F.lit(1)), lambda n: n.try_cast("int"))
    return F.coalesce(F.array_max(numbers), F.lit(1))


def frontier(things: DataFrame, key: str, last: str, landed: DataFrame, most: int = MOST_PAGES) -> DataFrame:
    """(key, page) from 1 to ``last`` of each thing that is not among ``landed``.

    Page numbers come from pages and may be anything: a thing with more than ``most``
    pages is left out (:func:`beyond_frontier` names it), and ranges are dealt in blocks.
    """
    blocks = things.filter(F.col(last).between(1, most)).select(key, F.col(last).alias("__last"), F.explode(F.sequence(F.lit(0), F.floor((F.col(last) - 1) / PAGES_EACH).cast("int"))).alias("__block"))
    first = F.col("__block") * PAGES_EACH + 1
    pages = blocks.select(key, F.explode(F.sequence(first, F.least("__last", first + (PAGES_EACH - 1)))).alias("page"))
    return pages.join(landed.select(key, "page").distinct(), [key, "page"], "left_anti")


def beyond_frontier(things: DataFrame, key: str, last: str, most: int = MOST_PAGES) -> DataFrame:
    """Rejects (url, reason, ts): things whose page number :func:`frontier` does not take at its word."""
    far = things.filter(F.col(last) > most)
    return far.select(F.concat(F.lit(f"{key}-"), F.col(key).cast("string")).alias("url"), F.concat(F.lit("page number "), F.col(last).cast("string")).alias("reason"), F.current_timestamp().alias("ts"))


def _numbers() -> tuple[tuple[str, str, str], ...]:
    """Where pages hold numbers, the type that each must fit, and what it is called."""
    user = r"home\.php\?mod=space(?:&amp;|&)uid=(\d+)"
    return (
        (BOARD_LINK, "int", "board number"), (THREAD_LINK, "bigint", "thread number"), (BOARD_PAGE, "int", "page number"), (THREAD_PAGE, "int", "page number"),
        (POST_OPENER, "bigint", "post number"), (RATE_ROW, "bigint", "user number"), (user, "bigint", "user number"), (COINS, "int", "coins"), (RATERS, "int", "raters"),
    )


def unfit_numbers(pages: DataFrame, html: str = "html") -> DataFrame:
    """Rejects (url, reason, ts) for numbers that fit no column; the rest of such a page is parsed. One row per page and kind."""
    def unfit(pattern: str, kind: str, name: str) -> Column:
        numbers = F.regexp_extract_all(F.col(html), F.lit(pattern), F.lit(1))
        return F.transform(F.filter(numbers, lambda n: n.try_cast(kind).isNull()), lambda n: F.concat(F.lit(f"{name} "), F.substring(n, 1, 40)))

    found = [unfit(*each) for each in _numbers()]
    # only a run of ten digits can be too large for any of them
    some = pages.filter(F.rlike(html, F.lit(r"[0-9]{10}"))).select("url", F.explode(F.array_distinct(F.flatten(F.array(*found)))).alias("reason"))
    return some.select("url", "reason", F.current_timestamp().alias("ts"))


def is_error_page(html: Column) -> Column:
    """A notice near the start and no author block."""
    return F.contains(F.substring(html, 1, 200), F.lit(NOTICE)) & ~F.contains(html, F.lit('class="author"'))


def with_version(pages: DataFrame) -> DataFrame:
    """``pages`` with what tells versions of a page apart, so that these columns can be read without the text."""
    fetched = F.col("fetched_at") if "fetched_at" in pages.columns else F.lit(0)
    return pages.withColumn("version", F.struct(fetched.alias("fetched"), F.length("html").alias("size"), F.xxhash64("html").alias("mark")))


def newest_pages(pages: DataFrame, keys: list[str]) -> DataFrame:
    """Each page once, as it was fetched last; of versions fetched together the longest, then the one with the largest hash.

    Versions are counted by keys alone. Where none repeats, the pages stay where they
    are; otherwise only pages with a repeated key are shuffled.
    """
    versioned = pages if "version" in pages.columns else with_version(pages)
    repeated = versioned.select(*keys, "version").groupBy(*keys).agg(F.count("*").alias("__n")).filter("__n > 1").drop("__n")
    n = repeated.count()
    if n == 0:
        return pages
    if n <= REPEATED_KEYS:
        repeated = F.broadcast(repeated)
    single = versioned.join(repeated, keys, "left_anti").select(*pages.columns)
    newest = versioned.join(repeated, keys, "left_semi").groupBy(*keys).agg(F.max_by(F.struct(*pages.columns), "version").alias("__page"))
    return single.unionByName(newest.select("__page.*"))


def with_reason(pages: DataFrame, html: str = "html") -> DataFrame:
    """``pages`` with the reason why one is not parsed, null for good ones."""
    return pages.withColumn("reason", F.when(F.col(html).isNull(), "no body").when(is_error_page(F.col(html)), "notice page"))


def split_errors(pages: DataFrame, html: str = "html") -> tuple[DataFrame, DataFrame]:
    """Good pages, and rejects (url, reason, ts)."""
    judged = with_reason(pages, html)
    rejects = judged.filter("reason is not null").select("url", "reason", F.current_timestamp().alias("ts"))
    return judged.filter("reason is null").drop("reason"), rejects


def _matched(text: Column, pattern: str, default: str = "") -> Column:
    """Group 1 of the first match, or the default where nothing matches."""
    return F.when(F.regexp_like(text, F.lit(pattern)), F.regexp_extract(text, pattern, 1)).otherwise(F.lit(default))


def thread_posts(pages: DataFrame, html: str = "html", numeric: bool = True, nav_marker: str | None = None) -> DataFrame:
    """``pages``' other columns with position (from 1), author, post_time and content of each post.

    ``nav_marker`` ends the text before a page's navigation; without it the last
    post of a page keeps that text. A post without content and author is dropped,
    and positions count only those kept.
    """
    keep = [c for c in pages.columns if c not in (html, "position", "author", "post_time", "content")]
    source = F.col(html)
    if nav_marker:
        source = F.substring_index(source, nav_marker, 1)
    parts = F.split(source, AUTHOR_BLOCK)
    blocks = pages.select(*keep, F.posexplode(F.slice(parts, 2, REST)).alias("__at", "__part"))
    part = F.col("__part")
    closing = F.when(F.contains(F.substring(part, 1, 200), F.lit("</p>")), F.lit("</p>")).otherwise(F.lit("</div>"))
    at = F.locate("</p>", part)
    end = F.when(closing == "</p>", at + 3).otherwise(F.when(F.locate("</div>", part) > 0, F.locate("</div>", part) + 5).otherwise(F.lit(0)))
    body = F.regexp_replace(F.substring(part, end + 1, F.length(part)), HEADING, "")
    rows = blocks.select(
        *keep,
        F.col("__at").alias("position"),
        strip(_matched(part, AUTHOR, NO_AUTHOR)).alias("author"),
        strip(_matched(part, POSTED)).alias("post_time"),
        body.alias("__body"),
    )
    cleaned = with_clean_html(rows, F.col("__body"), "content", numeric).drop("__body")
    # one row of what was just made: a filter on plain columns would be moved below them and clean every text again, to judge it
    made = F.explode_outer(F.array(F.struct("author", "post_time", "content"))).alias("__post")
    return cleaned.select(*keep, "position", made).select(*keep, "position", "__post.*").filter((F.col("author") != NO_AUTHOR) | (F.col("content") != ""))


def number_in_page(posts: DataFrame, page_keys: list[str]) -> DataFrame:
    """Positions 1.. of the posts kept on each page; a page's posts are few, so the window is small."""
    return posts.withColumn("position", F.row_number().over(Window.partitionBy(*page_keys).orderBy("position")))


def number_of(block: Column, pattern: str) -> Column:
    """A counter in a block, 0 if absent."""
    return F.coalesce(F.nullif(F.regexp_extract(block, pattern, 1), F.lit("")).try_cast("int"), F.lit(0))


def _fit(digits: Column, kind: str) -> Column:
    """A number, 0 where it does not fit."""
    return F.coalesce(digits.try_cast(kind), F.lit(0).cast(kind))


# Where the interaction data of a post stand.
RATERS = r'参与人数[^<]*<span[^>]*class="[^"]*xi1[^"]*"[^>]*>(\d+)'
COINS = r'金币[^<]*<i><span[^>]*class="[^"]*xi1[^"]*"[^>]*>\s*\+?(\d+)'
RATE_ROW = (
    r'(?s)<tr\s+id="rate_\d+_(\d+)"[^>]*>.*?<a[^>]*home\.php\?mod=space[^>]*>([^<]+)</a>'
    r'.*?<td[^>]*class="[^"]*xi1[^"]*"[^>]*>\s*\+?\s*(\d+).*?<td[^>]*class="[^"]*xg1[^"]*"[^>]*>([^<]*)'
)
ADDED = r'id="recommendv_add[^"]*"[^>]*>(\d+)'
SUBTRACTED = r'id="recommendv_subtract[^"]*"[^>]*>(\d+)'
FAVORITES = r'id="favoritenumber[^"]*"[^>]*>(\d+)'
COMMENT_BLOCK = r'(?s)<div[^>]*class="[^"]*pstl[^"]*"[^>]*>(.*?)</div>\s*</div>\s*</div>'
COMMENT_USER = r'(?s)home\.php\?mod=space(?:&amp;|&)uid=(\d+)[^>]*>.*?<a[^>]*>([^<]+)</a>'
COMMENT_TEXT = r"</a>\s*([^<]{1,200})"


def thread_meta(pages: DataFrame, html: str = "html") -> DataFrame:
    """``pages``' other columns with at, pid and meta of each post block.

    Pages are split at the openers rather than matched by one lazy pattern, so a
    malformed page costs no backtracking.
    """
    keep = [c for c in pages.columns if c not in (html, "at", "pid", "meta")]
    pids = F.regexp_extract_all(F.col(html), F.lit(POST_OPENER), F.lit(1))
    parts = F.split(F.col(html), POST_OPENER)
    pairs = F.arrays_zip(pids.alias("pid"), F.slice(parts, 2, REST).alias("block"))
    blocks = pages.select(*keep, F.posexplode(pairs).alias("at", "__pair"))
    block = F.col("__pair.block")
    rows = F.regexp_extract_all(block, F.lit(RATE_ROW), F.lit(0))
    rated = F.transform(
        rows,
        lambda r: F.struct(
            _fit(F.regexp_extract(r, RATE_ROW, 1), "long").alias("uid"),
            strip(F.regexp_extract(r, RATE_ROW, 2)).alias("username"),
            _fit(F.regexp_extract(r, RATE_ROW, 3), "int").alias("coins"),
            strip(F.regexp_extract(r, RATE_ROW, 4)).alias("reason"),
        ),
    )
    said = F.regexp_extract(block, COMMENT_BLOCK, 1)
    texts = F.regexp_extract_all(said, F.lit(COMMENT_TEXT), F.lit(1))
    comments = F.transform(
        F.regexp_extract_all(said, F.lit(COMMENT_USER), F.lit(0)),
        lambda c, i: F.struct(
            _fit(F.regexp_extract(c, COMMENT_USER, 1), "long").alias("uid"),
            strip(F.regexp_extract(c, COMMENT_USER, 2)).alias("username"),
            strip(F.coalesce(F.get(texts, i), F.lit(""))).alias("content"),
        ),
    )
    meta = F.struct(
        number_of(block, RATERS).alias("rating_count"),
        number_of(block, COINS).alias("rating_coins"),
        rated.alias("rating_details"),
        number_of(block, ADDED).alias("recommend_add"),
        number_of(block, SUBTRACTED).alias("recommend_subtract"),
        number_of(block, FAVORITES).alias("favorite_count"),
        F.size(comments).alias("comment_count"),
        comments.alias("comments"),
    )
    # a number beyond a long still tells posts apart
    pid = F.coalesce(F.col("__pair.pid").try_cast("long"), F.xxhash64("__pair.pid"))
    return blocks.select(*keep, "at", pid.alias("pid"), meta.alias("meta"))
