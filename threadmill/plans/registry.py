"""The registered queries of the forum library, each beside the SQL with the same result."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Sequence
from functools import partial
from string import ascii_lowercase

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions import chunking, tagging, textops
from ..functions.textops import BREAKS, ENTITIES, SPACE
from ..functions.vocab import LATIN, NO_CATEGORY
from ..operators import archive, harvest, postings, quality, retrieval, sampling
from ..operators.store import Store
from ..sources import io, pages
from ..streaming import incremental, stateful, streams
from . import fixtures
from .fixtures import PAGE_SIZE, THREADS, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def _scratch(spark, name: str) -> str:
    """A new path in the shared folder that ``spark.checkpoint.dir`` names; only a local session may leave it unset."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="threadmill-checkpoints-")
        spark.sparkContext.setCheckpointDir(root)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def register(sql: str | None = None) -> Callable[[Query], Query]:
    def add(query: Query) -> Query:
        QUERIES[query.__name__] = query
        if sql is not None:
            ORACLE_SQL[query.__name__] = sql
        return query

    return add


# --- pieces of SQL ---------------------------------------------------------------


def _q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _strip(t: str) -> str:
    return f"regexp_replace({t}, '^[{SPACE}]+|[{SPACE}]+$', '', 'g')"


def _tidy(t: str) -> str:
    t = f"replace(replace({t}, chr(13) || chr(10), chr(10)), chr(13), chr(10))"
    t = f"replace(replace({t}, chr(12288), ' '), chr(65533), '')"
    return _strip(f"regexp_replace(regexp_replace({t}, '[ \\t]+', ' ', 'g'), '\\n{{3,}}', chr(10) || chr(10), 'g')")


def _clean(t: str) -> str:
    for tag in BREAKS:
        t = f"regexp_replace({t}, {_q(tag)}, chr(10), 'g')"
    t = f"regexp_replace({t}, '<[^>]+>', '', 'g')"
    for name, char in ENTITIES:
        t = f"replace({t}, {_q(name)}, {_q(char)})"
    return _tidy(t)


def _named(t: str) -> str:
    for name, char in ENTITIES:
        t = f"replace({t}, {_q(name)}, {_q(char)})"
    return t


def _list(words: Sequence[str]) -> str:
    return "[" + ", ".join(_q(w) for w in words) + "]"


def _in(text: str, words: Sequence[str]) -> str:
    return f"list_filter({_list(words)}, lambda w: contains({text}, w))"


POSTS = """(SELECT doc_id AS tid, CAST(regexp_extract(source, '(\\d+)', 1) AS INT) AS fid, source AS board, text AS content,
    split_part(text, chr(10), 1) AS title, lang AS author FROM documents)"""
CONV = f"""(SELECT conv_id AS tid, conv_id % 7 AS fid, 'b' || (conv_id % 7) AS board, 'thread ' || conv_id AS title, role AS author, turn + 1 AS floor,
    turn // {PAGE_SIZE} + 1 AS page, turn % {PAGE_SIZE} + 1 AS position, '2026-4-3 10:' || (turn + 10) || ':36' AS post_time, text AS content FROM conversations)"""
LISTED = f"""(SELECT user_id AS fid, event_id % 3 + 1 AS page, event_id AS pos, event_id % {THREADS} AS tid,
    event_type || ' ' || (event_id % {THREADS}) AS title FROM events)"""
SCAN = "title || chr(10) || substr(content, 1, 500)"
STICKY = f"(SELECT tid FROM {LISTED} GROUP BY tid HAVING count(DISTINCT fid) >= 3)"
_FIRST = f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY tid ORDER BY fid, page, pos) AS rn FROM {LISTED}) WHERE rn = 1"


# --- text -----------------------------------------------------------------------


@register(f"SELECT page_id, {_clean('html')} AS content FROM pages")
def clean_html_pages(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", textops.clean_html(F.col("html"), numeric=False).alias("content"))


LIST_LINK = r'(?s)<li><a href="([^"]*)">(.*?)</a>'


@register(
    f"""SELECT page_id, regexp_extract(link, {_q(LIST_LINK)}, 1) AS href, {_strip(f"regexp_replace(regexp_extract(link, {_q(LIST_LINK)}, 2), '<[^>]+>', '', 'g')")} AS title
    FROM (SELECT page_id, unnest(regexp_extract_all(html, {_q(LIST_LINK)})) AS link FROM pages)"""
)
def page_links(spark, sf_dir):
    links = table(spark, sf_dir, "pages").select("page_id", F.explode(F.regexp_extract_all("html", F.lit(LIST_LINK), F.lit(0))).alias("link"))
    return links.select("page_id", F.regexp_extract("link", LIST_LINK, 1).alias("href"), textops.strip(textops.strip_tags(F.regexp_extract("link", LIST_LINK, 2))).alias("title"))


@register(f"SELECT DISTINCT tid, page, 'thread' AS kind FROM {CONV}")
def page_id_from_url(spark, sf_dir):
    rendered = fixtures.rendered_thread_pages(spark, sf_dir).select("url")
    return pages.page_identity(rendered).select("tid", "page", "kind")


@register(f"SELECT tid, page, position, author, post_time, {_tidy('content')} AS content FROM {CONV}")
def thread_page_posts(spark, sf_dir):
    named = pages.page_identity(fixtures.rendered_thread_pages(spark, sf_dir))
    good, _ = pages.split_errors(named)
    posts = pages.number_in_page(pages.thread_posts(good), ["tid", "page"])
    return posts.select("tid", "page", "position", "author", "post_time", "content")


@register(f"SELECT DISTINCT fid, 'Board' || fid AS board FROM {LISTED}")
def discovered_boards(spark, sf_dir):
    return pages.discover_boards(fixtures.rendered_index_pages(spark, sf_dir))


@register(
    f"""SELECT tid, page, '{fixtures.BASE}/archiver/?tid-' || tid || '.html' || CASE WHEN page > 1 THEN '&page=' || page ELSE '' END AS thread_url,
    '{fixtures.BASE}/archiver/?fid-' || fid || '.html' || CASE WHEN page > 1 THEN '&page=' || page ELSE '' END AS board_url,
    '{fixtures.BASE}/forum.php?mod=viewthread&tid=' || tid AS web_url FROM {CONV}"""
)
def page_urls(spark, sf_dir):
    posts = fixtures.conversation_posts(spark, sf_dir)
    return posts.select(
        "tid",
        "page",
        pages.thread_url(fixtures.BASE, F.col("tid"), F.col("page")).alias("thread_url"),
        pages.board_url(fixtures.BASE, F.col("fid"), F.col("page")).alias("board_url"),
        pages.thread_web_url(fixtures.BASE, F.col("tid")).alias("web_url"),
    )


_NOTICED = "(SELECT page_id, CASE WHEN page_id % 3 = 0 THEN '提示信息' ELSE '' END || CASE WHEN page_id % 2 = 0 THEN '<p class=\"author\">' ELSE '' END || html AS html FROM pages)"


def _noticed(spark, sf_dir):
    notice = F.when(F.pmod("page_id", F.lit(3)) == 0, "提示信息").otherwise("")
    author = F.when(F.pmod("page_id", F.lit(2)) == 0, '<p class="author">').otherwise("")
    return table(spark, sf_dir, "pages").select(F.col("page_id").cast("string").alias("url"), F.concat(notice, author, "html").alias("html"))


@register(f"SELECT page_id, CASE WHEN contains(substr(html, 1, 200), '提示信息') AND NOT contains(html, 'class=\"author\"') THEN 'notice page' ELSE 'good' END AS verdict FROM {_NOTICED}")
def error_pages(spark, sf_dir):
    good, bad = pages.split_errors(_noticed(spark, sf_dir))
    both = good.select("url", F.lit("good").alias("verdict")).unionByName(bad.select("url", F.col("reason").alias("verdict")))
    return both.select(F.col("url").cast("long").alias("page_id"), "verdict")


@register(f"SELECT tid, page, max(page) OVER (PARTITION BY tid) AS last_page FROM (SELECT DISTINCT tid, page FROM {CONV})")
def thread_max_page(spark, sf_dir):
    rendered = pages.page_identity(fixtures.rendered_thread_pages(spark, sf_dir)).select("tid", "page")
    last = rendered.groupBy("tid").agg(F.max("page").alias("n"))
    linked = rendered.join(last, "tid").withColumn("html", F.array_join(F.transform(F.sequence(F.lit(1), "n"), lambda p: F.format_string('<a href="?tid-%d.html&page=%d">', F.col("tid"), p)), " "))
    return linked.select("tid", "page", pages.max_page(F.col("html"), pages.THREAD_PAGE).alias("last_page"))


@register(f"SELECT fid, pos // 10 % 40 + 1 AS page, tid, title || ' ' || pos AS title FROM {LISTED}")
def board_page_threads(spark, sf_dir):
    named = pages.page_identity(fixtures.rendered_board_pages(spark, sf_dir)).drop("tid")
    return pages.thread_listings(named).select("fid", "page", "tid", "title")


@register(f"SELECT fid, pos // 10 % 40 + 1 AS page, max(pos % 50 + 1) AS last_page FROM {LISTED} GROUP BY ALL")
def board_max_page(spark, sf_dir):
    named = pages.page_identity(fixtures.rendered_board_pages(spark, sf_dir))
    return named.select("fid", "page", pages.max_page(F.col("html"), pages.BOARD_PAGE).alias("last_page"))


@register(
    f"""WITH last AS (SELECT fid, max(pos % 50 + 1) AS n FROM {LISTED} GROUP BY fid),
    wanted AS (SELECT fid, unnest(range(1, n + 1)) AS page FROM last)
    SELECT fid, page FROM wanted EXCEPT SELECT fid, pos // 10 % 40 + 1 FROM {LISTED}"""
)
def fetch_frontier(spark, sf_dir):
    named = pages.page_identity(fixtures.rendered_board_pages(spark, sf_dir))
    last = named.groupBy("fid").agg(F.max(pages.max_page(F.col("html"), pages.BOARD_PAGE)).alias("last"))
    return pages.frontier(last, "fid", "last", named)


@register(f"SELECT doc_id, {_tidy(chr(39) + '  ' + chr(39) + ' || text || chr(13) || chr(10) || chr(9) || chr(12288)')} AS norm FROM documents")
def normalize_text(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", textops.normalize(F.concat(F.lit("  "), "text", F.lit("\r\n\t　"))).alias("norm"))


@register(f"SELECT doc_id, chr(CAST(65 + doc_id % 26 AS INT)) || chr(CAST(20013 + doc_id % 50 AS INT)) || '<' || {_named('text')} AS decoded FROM documents")
def numeric_entities(spark, sf_dir):
    """Whole texts with a reference in place of every blank, behind some more."""
    number = F.format_string("&#%d;&#x%s;&amp;lt;", 65 + F.pmod("doc_id", F.lit(26)), F.lower(F.hex(20013 + F.pmod("doc_id", F.lit(50)))))
    return table(spark, sf_dir, "documents").select("doc_id", textops.decode_entities(F.concat(number, F.replace("text", F.lit(" "), F.lit("&#x20;")))).alias("decoded"))


@register(f"SELECT doc_id, chr(CAST(65 + doc_id % 26 AS INT)) || chr(CAST(20013 + doc_id % 50 AS INT)) || '<' || {_named('text')} AS decoded FROM documents")
def whole_text_entities(spark, sf_dir):
    number = F.format_string("&#%d;&#x%s;&amp;lt;", 65 + F.pmod("doc_id", F.lit(26)), F.lower(F.hex(20013 + F.pmod("doc_id", F.lit(50)))))
    return table(spark, sf_dir, "documents").select("doc_id", textops.decode_entities(F.concat(number, "text")).alias("decoded"))


@register(f"SELECT doc_id, {_named('text')} || '?' || chr(20013) || '?!' AS decoded FROM documents")
def surrogate_entities(spark, sf_dir):
    """Lone surrogates become question marks, numbers beyond the last code point vanish; before them the whole text."""
    return table(spark, sf_dir, "documents").select("doc_id", textops.decode_entities(F.concat("text", F.lit("&#55296;&#x4e2d;&#1114112;&#xdfff;!"))).alias("decoded"))


@register()
def clean_html_numeric(spark, sf_dir):
    return textops.with_clean_html(table(spark, sf_dir, "pages").select("page_id", "html"), F.col("html"), "content").drop("html")


@register(
    f"""SELECT doc_id, len(list_filter(string_split(regexp_replace(text, '([。？！.?!])[{SPACE}]*', '\\1' || chr(30), 'g'), chr(30)), lambda s: {_strip('s')} <> '')) AS n_sentences FROM documents"""
)
def sentence_count(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.size(chunking.sentences(F.col("text"))).alias("n_sentences"))


@register(
    f"""SELECT doc_id, w AS chunk FROM (SELECT doc_id, unnest(list_transform(range(0, length(text), 1300), lambda s: {_strip('substr(text, s + 1, 1500)')})) AS w FROM documents) WHERE w <> ''"""
)
def fixed_windows(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.explode(chunking.windows(F.col("text"), 1500, 200)).alias("chunk"))


_CUES = "concat_ws(',', " + ", ".join(f"CASE WHEN len({_in('title || chr(10) || norm', w)}) > 0 THEN {_q(n)} END" for n, w in LATIN.cues.items()) + ")"
_NORM = f"(SELECT *, {_tidy('content')} AS norm FROM {POSTS})"


@register(f"SELECT tid, {_CUES} AS cues FROM {_NORM}")
def cues(spark, sf_dir):
    posts = fixtures.document_posts(spark, sf_dir)
    return posts.select("tid", chunking.cues(F.col("title"), textops.normalize(F.col("content")), LATIN).alias("cues"))


_HAY = "title || chr(10) || substr(norm, 1, 800)"
_LABEL = "coalesce(" + ", ".join(f"nullif(regexp_extract({_HAY}, {_q(p)}, 0), '')" for p in LATIN.labels) + ", '')"


@register(f"SELECT tid, {_LABEL} AS label FROM {_NORM}")
def source_label(spark, sf_dir):
    posts = fixtures.document_posts(spark, sf_dir)
    return posts.select("tid", chunking.source_label(F.col("title"), textops.normalize(F.col("content")), LATIN.labels).alias("label"))


_ROLES = _in("content", LATIN.roles)


@register(
    f"""SELECT tid, '【' || board || '】《' || title || '》第1楼｜' || author || '｜2026-4-3 10:52:36' || chr(10) || '链接: {fixtures.BASE}/forum.php?mod=viewthread&tid=' || tid || chr(10)
    || CASE WHEN len(roles) > 0 THEN '标签: ' || array_to_string(roles, '，') || chr(10) ELSE '' END
    || CASE WHEN cues <> '' THEN '语义线索: ' || cues || chr(10) ELSE '' END || chr(10) AS prefix
    FROM (SELECT *, {_ROLES} AS roles, {_CUES} AS cues FROM {_NORM})"""
)
def chunk_prefix(spark, sf_dir):
    posts = fixtures.document_posts(spark, sf_dir)
    posts = posts.withColumn("tags", tagging.contained(F.col("content"), LATIN.roles)).withColumn("cues", chunking.cues(F.col("title"), textops.normalize(F.col("content")), LATIN))
    names = ("board", "title", "floor", "author", "post_time", "url", "tags", "cues")
    return posts.select("tid", chunking.chunk_prefix(*[F.col(n) for n in names]).alias("prefix"))


# --- tags -----------------------------------------------------------------------

# the documents hold no season words: a title and a content with some are put before them
SEASONED = """(SELECT doc_id AS tid, CASE doc_id % 5 WHEN 0 THEN (2000 + doc_id % 30) || '年 ' WHEN 1 THEN lpad(CAST(doc_id % 100 AS VARCHAR), 2, '0') || '春 '
    WHEN 2 THEN 'x' || lpad(CAST(doc_id % 100 AS VARCHAR), 2, '0') || ' 秋 ' WHEN 3 THEN '暑 寒 ' WHEN 4 THEN repeat('x', CAST(20 + doc_id % 15 AS INT)) || '春 ' ELSE '' END || split_part(text, chr(10), 1) AS title,
    CASE WHEN doc_id % 3 = 0 THEN '1998 ' ELSE '' END || text AS content FROM documents)"""
_SHORT = f"(\\p{{Nd}}{{2}})[{SPACE}]*([春秋暑寒])"
_YY = "CAST(nullif(regexp_extract(title, '{0}', 1), '') AS INT)"
_YEAR = f"""coalesce(nullif(regexp_extract(title, '(?:19|20)\\p{{Nd}}{{2}}', 0), ''), nullif(regexp_extract({SCAN}, '(?:19|20)\\p{{Nd}}{{2}}', 0), ''),
    CAST({_YY.format('^' + _SHORT)} + CASE WHEN {_YY.format('^' + _SHORT)} < 50 THEN 2000 ELSE 1900 END AS VARCHAR),
    CAST({_YY.format(_SHORT)} + CASE WHEN {_YY.format(_SHORT)} <= 50 THEN 2000 ELSE 1900 END AS VARCHAR), '')"""
_SEASON = f"""coalesce(nullif(regexp_extract(title, '{_SHORT}', 2), ''), nullif(regexp_extract({SCAN}, '{_SHORT}', 2), ''),
    {", ".join(f"CASE WHEN contains(substr(title, 1, 30), '{s}') THEN '{s}' END" for s in "暑寒春秋")}, '')"""


def _seasoned(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    two = F.lpad(F.pmod("doc_id", F.lit(100)).cast("string"), 2, "0")
    kind = F.pmod("doc_id", F.lit(5))
    start = (
        F.when(kind == 0, F.concat((2000 + F.pmod("doc_id", F.lit(30))).cast("string"), F.lit("年 ")))
        .when(kind == 1, F.concat(two, F.lit("春 ")))
        .when(kind == 2, F.concat(F.lit("x"), two, F.lit(" 秋 ")))
        .when(kind == 3, F.lit("暑 寒 "))
        .when(kind == 4, F.concat(F.repeat(F.lit("x"), (20 + F.pmod("doc_id", F.lit(15))).cast("int")), F.lit("春 ")))
        .otherwise(F.lit(""))
    )
    content = F.concat(F.when(F.pmod("doc_id", F.lit(3)) == 0, F.lit("1998 ")).otherwise(F.lit("")), "text")
    return d.select(F.col("doc_id").alias("tid"), F.concat(start, F.substring_index("text", "\n", 1)).alias("title"), content.alias("content"))


@register(f"SELECT tid, {_YEAR} AS year, {_SEASON} AS season FROM {SEASONED}")
def classify_year_season(spark, sf_dir):
    found = tagging.classify(F.col("title"), F.col("content"), vocab=LATIN)
    return _seasoned(spark, sf_dir).select("tid", found["year"].alias("year"), found["season"].alias("season"))


_EVENT = f"coalesce({_in('substr(title, 1, 40)', LATIN.event_types)}[1], {_in('title', LATIN.event_types)}[1], '')"
_ACTIVITY = f"coalesce({_in('title', LATIN.activity_types)}[1], {_in(f'substr({SCAN}, 1, 200)', LATIN.activity_types)}[1], '')"


@register(f"SELECT tid, {_EVENT} AS event_type, {_ACTIVITY} AS activity_type FROM {POSTS}")
def classify_event_activity(spark, sf_dir):
    found = tagging.classify(F.col("title"), F.col("content"), vocab=LATIN)
    return fixtures.document_posts(spark, sf_dir).select("tid", found["event_type"].alias("event_type"), found["activity_type"].alias("activity_type"))


_ROUTES, _PROBLEMS = _in(SCAN, LATIN.routes), _in("content", LATIN.problems)


@register(f"SELECT tid, array_to_string({_ROUTES}, '|') AS routes, array_to_string({_ROLES}, '|') AS roles, array_to_string({_PROBLEMS}, '|') AS problems FROM {POSTS}")
def classify_vocab_lists(spark, sf_dir):
    found = tagging.classify(F.col("title"), F.col("content"), vocab=LATIN)
    return fixtures.document_posts(spark, sf_dir).select("tid", *[F.array_join(found[k], "|").alias(k) for k in ("routes", "roles", "problems")])


_ALL_TAGS = f"""list_concat([{_YEAR}, CASE WHEN {_SEASON} = '' THEN '' WHEN length({_YEAR}) = 4 THEN substr({_YEAR}, 3, 2) || {_SEASON} ELSE {_SEASON} END, {_EVENT}, {_ACTIVITY}],
    {_ROUTES}, {_ROLES}, {_PROBLEMS}, ['b'])"""


@register(
    f"""SELECT tid, string_agg(tag, '|' ORDER BY spot) AS tags FROM (
        SELECT tid, tag, min(spot) AS spot FROM (SELECT tid, unnest(tags) AS tag, generate_subscripts(tags, 1) AS spot FROM (SELECT tid, {_ALL_TAGS} AS tags FROM {SEASONED}))
        WHERE tag <> '' GROUP BY tid, tag) GROUP BY tid"""
)
def merged_tags(spark, sf_dir):
    posts = _seasoned(spark, sf_dir).withColumn("board", F.lit("b·2026"))
    return tagging.with_tags(posts, LATIN).select("tid", F.array_join("tags", "|").alias("tags"))


_TAGGED = f"(SELECT tid, author, unnest(list_distinct(list_concat({_ROUTES}, {_ROLES}, {_PROBLEMS}, list_filter([{_EVENT}, {_ACTIVITY}, {_YEAR}], lambda x: x <> '')))) AS tag FROM {POSTS})"


@register(f"SELECT author, tag, count(*) AS posts FROM {_TAGGED} GROUP BY ALL")
def tag_facets(spark, sf_dir):
    return archive.tag_facets(tagging.with_tags(fixtures.document_posts(spark, sf_dir), LATIN, board=None), ["author"])


@register("SELECT lang, source, count(*) AS posts FROM documents GROUP BY ROLLUP (lang, source)")
def facet_rollup(spark, sf_dir):
    return archive.facet_rollup(table(spark, sf_dir, "documents"), ["lang", "source"])


_TAG_ROWS = """(SELECT {key}, tag, min(spot) AS spot FROM (SELECT {key}, unnest(tags) AS tag, generate_subscripts(tags, 1) AS spot FROM (SELECT {key}, {tags} AS tags FROM {table})) WHERE tag <> '' GROUP BY {key}, tag)"""


def _tag_text(table: str, key: str = "tid", by: str = "，") -> str:
    """Every row of ``table`` (title, content, board) with tags, joined by a mark in order of first place."""
    tags = _ALL_TAGS.replace("['b']", "[CASE WHEN contains(board, '·') THEN split_part(board, '·', 1) ELSE '' END]")
    return f"(SELECT {key}, string_agg(tag, '{by}' ORDER BY spot) AS tags FROM {_TAG_ROWS.format(key=key, tags=tags, table=table)} GROUP BY {key})"


# sentences packed in order: the state is the open chunk and those done
_WINDOWS = f"list_filter(list_transform(range(0, length(x.open), 1300), lambda k: {_strip('substr(x.open, k + 1, 1500)')}), lambda w: w <> '')"
_SENTENCES = f"list_filter(string_split(regexp_replace(norm, '([。？！.?!])[{SPACE}]*', '\\1' || chr(30), 'g'), chr(30)), lambda s: {_strip('s')} <> '')"
_CLOSED = "CASE WHEN {0} <> '' THEN [{0}] ELSE [] END"
_PACKED = f"""list_reduce(list_prepend({{'open': '', 'done': []::VARCHAR[]}}, list_transform({_SENTENCES}, lambda s: {{'open': s, 'done': []::VARCHAR[]}})), lambda a, x:
    CASE WHEN length(x.open) > 1500 THEN {{'open': right(list_extract({_WINDOWS}, -1), 200), 'done': list_concat(a.done, {_CLOSED.format(_strip('a.open'))}, {_WINDOWS})}}
    WHEN a.open <> '' AND length(a.open) + length(x.open) > 1500 THEN
        {{'open': CASE WHEN length(a.open) > 200 THEN right(a.open, 200) ELSE '' END || x.open, 'done': list_append(a.done, {_strip('a.open')})}}
    ELSE {{'open': a.open || x.open, 'done': a.done}} END)"""
_CHUNKS = f"""WITH n AS (SELECT *, {_CUES} AS cues, {_LABEL} AS label FROM {_NORM} WHERE norm <> ''),
    t AS {_tag_text(POSTS)},
    long AS (SELECT tid, {_PACKED} AS r FROM n WHERE length(norm) > 1500),
    parts AS (SELECT tid, [norm] AS parts FROM n WHERE length(norm) <= 1500 UNION ALL SELECT tid, list_concat(r.done, {_CLOSED.format(_strip('r.open'))}) FROM long),
    each AS (SELECT tid, len(parts) AS chunk_count, unnest(parts) AS part, generate_subscripts(parts, 1) AS chunk_index FROM parts),
    chunk AS (SELECT 'fid' || fid || '_tid' || tid || '_f1_idx' || chunk_index AS id,
        '【' || board || '】《' || title || '》第1楼｜' || author || '｜2026-4-3 10:52:36' || chr(10) || '链接: {fixtures.BASE}/forum.php?mod=viewthread&tid=' || tid || chr(10)
        || CASE WHEN tags IS NOT NULL THEN '标签: ' || tags || chr(10) ELSE '' END || CASE WHEN cues <> '' THEN '语义线索: ' || cues || chr(10) ELSE '' END || chr(10) || part AS text,
        chunk_index, chunk_count, cues, label AS source_label FROM each JOIN n USING (tid) LEFT JOIN t USING (tid))"""


def _chunks(spark, sf_dir):
    posts = tagging.with_tags(fixtures.document_posts(spark, sf_dir), LATIN)
    return chunking.to_chunks(posts, 1500, 200, LATIN)


@register(f"{_CHUNKS} SELECT * FROM chunk")
def chunk_documents(spark, sf_dir):
    return _chunks(spark, sf_dir).select("id", "text", "source.chunk_index", "source.chunk_count", "source.cues", "source.source_label")


@register(f"{_CHUNKS} SELECT id, text, chunk_index FROM chunk")
def chunk_documents_folded(spark, sf_dir):
    """The same chunks without Python."""
    posts = tagging.with_tags(fixtures.document_posts(spark, sf_dir), LATIN)
    return chunking.to_chunks(posts, 1500, 200, LATIN, fold=True).select("id", "text", "source.chunk_index")


@register(f"{_CHUNKS} SELECT (SELECT count(*) FROM documents) AS posts, (SELECT count(*) FROM chunk) AS chunks, (SELECT count(*) FROM chunk) / greatest((SELECT count(*) FROM documents), 1) AS mean_chunks")
def chunk_stats(spark, sf_dir):
    posts = fixtures.document_posts(spark, sf_dir)
    return chunking.chunk_statistics(posts, chunking.to_chunks(posts, 1500, 200, LATIN))


@register(f"{_CHUNKS} SELECT id, text, chunk_index FROM chunk")
def chunk_files(spark, sf_dir):
    """Chunks written as JSON lines and read back."""
    path = _scratch(spark, "chunks")
    io.write_chunks_jsonl(_chunks(spark, sf_dir), path)
    return spark.read.schema(schemas.CHUNKS_DDL).json(path).select("id", "text", "source.chunk_index")


#: All pairs of letters, and those with a vowel behind: 806 words, each of the longer ones with a shorter inside.
_PAIRS = [a + b for a in ascii_lowercase for b in ascii_lowercase]
DICTIONARY = (*_PAIRS, *[p + v for p in _PAIRS[:26] for v in "aeiou"])


@register(f"SELECT doc_id, len(found) AS n_found, array_to_string(found, ',') AS words FROM (SELECT doc_id, {_in('text', DICTIONARY)} AS found FROM documents)")
def dictionary_scan(spark, sf_dir):
    """The words of a long list that each document contains, by one scan of its text."""
    found = table(spark, sf_dir, "documents").select("doc_id", tagging.contained(F.col("text"), DICTIONARY).alias("found"))
    return found.select("doc_id", F.size("found").alias("n_found"), F.array_join("found", ",").alias("words"))


# --- threads --------------------------------------------------------------------


@register(f"SELECT tid, CASE WHEN fid % 3 <> 0 THEN 'c·' || board ELSE '{NO_CATEGORY}' END AS category FROM {POSTS}")
def board_category_join(spark, sf_dir):
    posts = fixtures.document_posts(spark, sf_dir).select("tid", "fid")
    return pages.with_category(posts, fixtures.board_names(spark, sf_dir)).select("tid", "category")


@register(f"SELECT tid, fid, title, arg_min(author, floor) AS first_author, arg_min(post_time, floor) AS first_time, count(*) AS post_count FROM {CONV} GROUP BY tid, fid, title")
def thread_rollup(spark, sf_dir):
    rolled = archive.thread_rollup(fixtures.conversation_posts(spark, sf_dir), LATIN)
    return rolled.select("tid", "fid", "title", "first_author", "first_time", "post_count")


@register(f"SELECT tid, count(*) AS posts FROM {CONV} GROUP BY tid")
def post_counts(spark, sf_dir):
    return archive.post_counts(fixtures.conversation_posts(spark, sf_dir))


@register(
    f"""SELECT (SELECT count(DISTINCT tid) FROM {CONV}) AS threads, (SELECT max(tid) FROM {CONV}) AS highest_tid, (SELECT count(DISTINCT fid) FROM {CONV}) AS boards_done,
    (SELECT count(*) FROM {CONV}) AS posts, (SELECT count(DISTINCT source) FROM documents WHERE CAST(regexp_extract(source, '(\\d+)', 1) AS INT) % 3 <> 0) AS boards_total"""
)
def status_report(spark, sf_dir):
    posts = fixtures.conversation_posts(spark, sf_dir)
    return archive.status_report(archive.thread_rollup(posts, LATIN), posts, fixtures.board_names(spark, sf_dir))


@register(f"SELECT tid, page, position, floor FROM {CONV}")
def floor_numbering(spark, sf_dir):
    posts = fixtures.conversation_posts(spark, sf_dir).drop("floor")
    return archive.number_floors(posts).select("tid", "page", "position", "floor")


@register(f"SELECT tid, page, position, row_number() OVER (PARTITION BY tid ORDER BY page, position) AS floor FROM {CONV} WHERE (tid + floor) % 4 <> 1")
def floor_numbering_by_pages(spark, sf_dir):
    """Floors of threads with gaps in their pages, without a window over a thread's posts."""
    posts = fixtures.conversation_posts(spark, sf_dir).filter("(tid + floor) % 4 <> 1").drop("floor")
    return archive.number_by_pages(posts).select("tid", "page", "position", "floor")


@register(f"SELECT tid, floor, page, position, floor AS floor_again FROM {CONV}")
def floor_page_position(spark, sf_dir):
    posts = fixtures.conversation_posts(spark, sf_dir).select("tid", "floor")
    placed = posts.withColumns({"page": archive.page_of(F.col("floor"), PAGE_SIZE), "position": archive.position_of(F.col("floor"), PAGE_SIZE)})
    return placed.withColumn("floor_again", archive.floor_of(F.col("page"), F.col("position"), PAGE_SIZE))


@register(f"SELECT tid, count(*) AS live FROM {CONV} GROUP BY tid")
def live_counts(spark, sf_dir):
    posts = fixtures.conversation_posts(spark, sf_dir)
    return archive.live_post_count(posts.groupBy("tid", "page").agg(F.count("*").alias("posts_on_page")), PAGE_SIZE)


@register(f"SELECT tid, floor, length(content) AS added, floor AS favorites FROM {CONV}")
def meta_positional_join(spark, sf_dir):
    posts = fixtures.conversation_posts(spark, sf_dir).select("tid", "page", "position", "floor")
    meta = pages.thread_meta(fixtures.rendered_meta_pages(spark, sf_dir))
    return archive.attach_meta(posts, meta).select("tid", "floor", F.col("meta.recommend_add").alias("added"), F.col("meta.favorite_count").alias("favorites"))


_EVEN = "CASE WHEN floor % 2 = 0 THEN {0} ELSE {1} END"


@register(
    f"""SELECT tid, floor, {_EVEN.format('floor', '0')} AS rating_count, {_EVEN.format('floor * 5', '0')} AS rating_coins, length(content) AS recommend_add, floor * 2 AS recommend_subtract,
    floor AS favorite_count, {_EVEN.format('1', '0')} AS comment_count, {_EVEN.format("tid || ':' || author || ':' || floor || ':for ' || author", 'NULL')} AS rated,
    {_EVEN.format('2', '0')} AS ratings, {_EVEN.format("tid || ':u' || floor || ':said ' || tid", "''")} AS said FROM {CONV}"""
)
def meta_fields(spark, sf_dir):
    """All eight fields of the interaction data, at their posts."""
    posts = fixtures.conversation_posts(spark, sf_dir).select("tid", "page", "position", "floor")
    both = archive.attach_meta(posts, pages.thread_meta(fixtures.rendered_meta_pages(spark, sf_dir)))
    text = lambda r, *names: F.concat_ws(":", *[r[n].cast("string") for n in names])
    rated = F.array_join(F.array_distinct(F.transform("meta.rating_details", lambda r: text(r, "uid", "username", "coins", "reason"))), "|")
    said = F.array_join(F.transform("meta.comments", lambda c: text(c, "uid", "username", "content")), "|")
    counts = [F.col(f"meta.{c}") for c in ("rating_count", "rating_coins", "recommend_add", "recommend_subtract", "favorite_count", "comment_count")]
    return both.select("tid", "floor", *counts, F.nullif(rated, F.lit("")).alias("rated"), F.size("meta.rating_details").alias("ratings"), said.alias("said"))


@register(f"SELECT tid, floor, length(content) AS content_len, '[]' AS tags FROM {CONV}")
def posts_for_sql(spark, sf_dir):
    return io.posts_for_sql(fixtures.conversation_posts(spark, sf_dir)).select("tid", "floor", "content_len", "tags")


_FIELDS = ("tid", "fid", "board", "title", "author", "floor", "page", "position", "post_time", "content", "url")
_URL = f"'{fixtures.BASE}/forum.php?mod=viewthread&tid=' || tid AS url"
_ALL_FIELDS = ", ".join(_FIELDS[:-1]) + f", {_URL}"


@register(f"SELECT {_ALL_FIELDS}, '' AS category, 0 AS tags FROM {CONV}")
def posts_jsonl_round_trip(spark, sf_dir):
    """The posts as JSON lines in two appends, and read back with the fixed schema and defaults."""
    posts, path = fixtures.conversation_posts(spark, sf_dir), _scratch(spark, "posts")
    for part in ("floor % 2 = 0", "floor % 2 = 1"):
        io.append_posts_jsonl(posts.filter(part), path)
    return io.read_posts_jsonl(spark, path).select(*_FIELDS, "category", F.size("tags").alias("tags"))


@register(f"SELECT {_ALL_FIELDS} FROM {CONV} WHERE fid = 3")
def one_board_archive(spark, sf_dir):
    """One board's posts from the native archive, of which only that board's folder is read."""
    path = _scratch(spark, "archive")
    io.append_posts(fixtures.conversation_posts(spark, sf_dir), path)
    return archive.only_board(spark.read.parquet(path), 3).select(*_FIELDS)


_HEAD = "chr(20013) || chr(25991) || chr(65533) || ' '"


@register(f"SELECT page_id, {_HEAD} || regexp_replace(html, '[^\\x00-\\x7F]', '?', 'g') AS html FROM pages")
def raw_page_files(spark, sf_dir):
    """GBK bytes, one of them illegal, landed as Parquet, read back and decoded."""
    plain = F.regexp_replace("html", r"[^\x00-\x7F]", "?").cast("binary")
    body = F.concat(F.unhex(F.lit("D6D0CEC48020")), plain)  # two characters, 0x80 and a blank
    path = _scratch(spark, "raw")
    landed = table(spark, sf_dir, "pages").select(F.col("page_id").cast("string").alias("url"), body.alias("body"), F.lit("2026-04-03").cast("timestamp").alias("fetched_at"))
    landed.write.parquet(path)
    return pages.decode_pages(io.read_raw_pages(spark, path)).select(F.col("url").cast("long").alias("page_id"), "html")


@register("SELECT CAST(page_id AS VARCHAR) AS url, 'notice page' AS reason, true AS stamped FROM pages WHERE page_id % 6 = 3")
def rejects_file(spark, sf_dir):
    """Rejected pages appended to a file of tab-separated values and read back."""
    path = _scratch(spark, "rejects")
    io.append_rejects(pages.split_errors(_noticed(spark, sf_dir))[1], path)
    rows = spark.read.schema("url string, reason string, ts timestamp").option("sep", "\t").csv(path)
    return rows.select("url", "reason", F.col("ts").isNotNull().alias("stamped"))


_CONV_TAGS = _tag_text(f"(SELECT tid * 100 + floor AS post, title, content, board FROM {CONV})", "post", "|")


@register(f"SELECT tid, floor, title, author, category, coalesce(tags, '') AS tags FROM (SELECT *, '' AS category, tid * 100 + floor AS post FROM {CONV}) LEFT JOIN {_CONV_TAGS} USING (post)")
def post_records(spark, sf_dir):
    records = archive.post_records(fixtures.conversation_posts(spark, sf_dir), LATIN)
    return records.select("tid", "floor", "title", "author", "category", F.array_join("tags", "|").alias("tags"))


# --- the whole archive ------------------------------------------------------------

# what the pages hold: contents as parsing tidies them, boards with their categories
_CATEGORY = f"CASE WHEN fid % 3 <> 0 THEN 'c·b' || fid ELSE '{NO_CATEGORY}' END AS category"
_PARSED = f"(SELECT * REPLACE ({_tidy('content')} AS content), {_CATEGORY}, tid * 100 + floor AS post FROM {CONV})"
_PARSED_TAGS = _tag_text(_PARSED, "post", "|")
_TAGGED_POSTS = f"(SELECT p.*, {_URL}, coalesce(tags, '') AS tags FROM {_PARSED} p LEFT JOIN {_PARSED_TAGS} USING (post))"


def _rolled(last_crawl: str) -> str:
    first = ", ".join(f"min({c}) AS {c}" for c in ("fid", "board", "category", "title", "url"))
    return f"""SELECT tid, {first}, arg_min(author, floor) AS first_author, arg_min(post_time, floor) AS first_time, count(*) AS post_count, arg_min(tags, floor) AS tags,
        {last_crawl} AS last_crawl FROM {_TAGGED_POSTS} GROUP BY tid"""


_ENTRIES = f"""SELECT field, token, count(*) AS posts, sum(tf)::BIGINT AS tf FROM (SELECT tid, floor, field, token, count(*) AS tf FROM (
    {" UNION ALL ".join(f"SELECT tid, floor, '{f}' AS field, unnest(regexp_extract_all(lower({f}), '[\\p{{L}}\\p{{N}}]+')) AS token FROM {_PARSED}" for f in ("title", "author", "content"))}) GROUP BY ALL) GROUP BY field, token"""


def _landed(spark, sf_dir, some=None, last_crawl="t2", root=None):
    """The archive of the rendered pages, or of some of them; written under ``root`` if one is given."""
    landed = fixtures.rendered_archive(spark, sf_dir)
    landed = landed if some is None else landed.filter(some)
    return harvest.archive_pages(landed, fixtures.BASE, fixtures.conversation_categories(spark, sf_dir), LATIN, PAGE_SIZE, last_crawl, root=root)


def _updated(spark, sf_dir, written=False):
    """An archive of the first page of the threads below number 50, and its next version after all pages landed, ``written`` if several of its tables are read."""
    number, page = F.regexp_extract("url", r"tid-(\d+)", 1).try_cast("long"), F.regexp_extract("url", r"page=(\d+)", 1).try_cast("int")
    root = _scratch(spark, "archives")
    old = _landed(spark, sf_dir, number.isNull() | ((number < 50) & (page == 1)), "t1", f"{root}/old")
    landed = _landed(spark, sf_dir, root=f"{root}/landed")
    return old, landed, harvest.update_archive(old, landed, fixtures.BASE, LATIN, PAGE_SIZE, "t2", root=f"{root}/new" if written else None, version=2)


def _index_entries(index):
    return index.groupBy("field", "token").agg(F.count("*").alias("posts"), F.sum("tf").alias("tf"))


_POST_COLUMNS = "tid, fid, board, category, title, author, floor, page, position, post_time, content, url, tags"


def _flat(df, names):
    return df.withColumn("tags", F.array_join("tags", "|")).select(*[n.strip() for n in names.split(",")])


@register(f"SELECT {_POST_COLUMNS} FROM {_TAGGED_POSTS}")
def archive_posts(spark, sf_dir):
    """Pages to posts with board, title and tags."""
    return _flat(_landed(spark, sf_dir).posts, _POST_COLUMNS)


_THREAD_COLUMNS = "tid, fid, board, category, title, first_author, first_time, post_count, tags, url, last_crawl"


@register(_rolled("'t2'"))
def archive_threads(spark, sf_dir):
    """Pages to threads."""
    return _flat(_landed(spark, sf_dir).threads, _THREAD_COLUMNS)


@register(_ENTRIES)
def archive_index(spark, sf_dir):
    """Pages to the token index."""
    return _index_entries(_landed(spark, sf_dir).index)


@register(f"SELECT DISTINCT fid, board, {_CATEGORY} FROM {CONV}")
def archive_boards(spark, sf_dir):
    return _landed(spark, sf_dir).boards.select("fid", "board", "category")


@register(f"SELECT {_POST_COLUMNS} FROM {_TAGGED_POSTS}")
def archive_update_posts(spark, sf_dir):
    """An old archive brought up to date: all posts, each once."""
    return _flat(_updated(spark, sf_dir)[2].posts, _POST_COLUMNS)


@register(_rolled(f"CASE WHEN tid < 50 AND count(*) <= {PAGE_SIZE} THEN 't1' ELSE 't2' END"))
def archive_update_threads(spark, sf_dir):
    return _flat(_updated(spark, sf_dir)[2].threads, _THREAD_COLUMNS)


@register(_ENTRIES)
def archive_update_index(spark, sf_dir):
    return _index_entries(_updated(spark, sf_dir)[2].index)


@register(f"SELECT (SELECT count(*) FROM {CONV} WHERE tid >= 50 OR floor > {PAGE_SIZE}) AS added, 0::BIGINT AS added_again")
def update_twice(spark, sf_dir):
    """Posts that an update adds, and that the same update adds to its own result."""
    old, landed, new = _updated(spark, sf_dir, written=True)
    again = harvest.update_archive(new, landed, fixtures.BASE, LATIN, PAGE_SIZE, "t3")
    # posts are told apart, and so counted, by their keys
    unseen = lambda posts, stored, name: incremental.unseen_floors(posts.select("tid", "floor"), stored).agg(F.count("*").alias(name))
    return unseen(new.posts, old.posts, "added").crossJoin(unseen(again.posts, new.posts, "added_again"))


# an update of which little lands: the second pages of the archived threads, one new thread with its listing, no front page
_NEW_THREAD = "(SELECT min(conv_id) FROM conversations WHERE conv_id >= 50 AND conv_id % 7 = 3)"
_SEEN_LATER = f"(tid < 50 AND page <= 2 OR tid = {_NEW_THREAD})"


def _partly_updated(spark, sf_dir):
    """An archive of first pages, and its version after few pages landed; both written."""
    root = _scratch(spark, "partial")
    number, page = F.regexp_extract("url", r"tid-(\d+)", 1).try_cast("long"), F.regexp_extract("url", r"page=(\d+)", 1).try_cast("int")
    fresh = table(spark, sf_dir, "conversations").filter("conv_id >= 50 and conv_id % 7 = 3").agg(F.min("conv_id").alias("fresh"))
    old = _landed(spark, sf_dir, (number.isNull() & ~F.col("url").rlike(r"fid-3\.html&page=(?!1$)")) | ((number < 50) & (page == 1)), "t1", f"{root}/old")
    pages_ = fixtures.rendered_archive(spark, sf_dir).crossJoin(F.broadcast(fresh))
    listing = F.concat(F.lit(f"{fixtures.BASE}/archiver/?fid-3.html&page=1"))
    own = F.format_string('<li><a href="?tid-%d.html">thread %d</a></li>', "fresh", "fresh")
    landed = pages_.filter(((number < 50) & (page == 2)) | (number == F.col("fresh")) | (F.col("url") == listing))
    landed = landed.withColumn("html", F.when(F.col("url") == listing, F.concat(own, "html")).otherwise(F.col("html"))).drop("fresh")
    found = harvest.archive_pages(landed, fixtures.BASE, fixtures.conversation_categories(spark, sf_dir), LATIN, PAGE_SIZE, "t2", root=f"{root}/landed")
    return harvest.update_archive(old, found, fixtures.BASE, LATIN, PAGE_SIZE, "t2")


@register(f"SELECT {_POST_COLUMNS} FROM {_TAGGED_POSTS} WHERE {_SEEN_LATER}")
def archive_update_partial(spark, sf_dir):
    """Added posts have the board, category, title and tags of their threads, although no page with these landed again."""
    return _flat(_partly_updated(spark, sf_dir).posts, _POST_COLUMNS)


@register(f"SELECT * FROM ({_rolled(f'max(CASE WHEN page = 2 OR tid = {_NEW_THREAD} THEN chr(116) || 2 ELSE chr(116) || 1 END)').replace(_TAGGED_POSTS, f'(SELECT * FROM {_TAGGED_POSTS} WHERE {_SEEN_LATER})')})")
def archive_update_partial_threads(spark, sf_dir):
    return _flat(_partly_updated(spark, sf_dir).threads, _THREAD_COLUMNS)


@register(
    f"""SELECT 'board ' || fid AS kept, board AS value FROM (SELECT DISTINCT fid, board FROM {CONV}) UNION ALL
    SELECT 'counts ' || tid || ' ' || page, CAST(count(*) AS VARCHAR) FROM {CONV} WHERE {_SEEN_LATER} GROUP BY tid, page UNION ALL
    SELECT 'listing ' || fid || ' ' || (tid // 70 + 1) || ' ' || tid, max(title) FROM {CONV} GROUP BY fid, tid HAVING fid <> 3 OR tid < 70 UNION ALL
    SELECT 'listing 3 1 ' || tid, max(title) FROM {CONV} WHERE tid = {_NEW_THREAD} AND tid >= 70 GROUP BY tid"""
)
def archive_update_partial_state(spark, sf_dir):
    """Boards, listings and page counts that did not land again are still there."""
    new = _partly_updated(spark, sf_dir)
    rows = [
        new.boards.select(F.format_string("board %d", "fid").alias("kept"), F.col("board").alias("value")),
        new.page_counts.select(F.format_string("counts %d %d", "tid", "page").alias("kept"), F.col("posts_on_page").cast("string").alias("value")),
        new.listings.select(F.format_string("listing %d %d %d", "fid", "page", "tid").alias("kept"), F.col("title").alias("value")).distinct(),
    ]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


@register(f"SELECT {_POST_COLUMNS} FROM {_TAGGED_POSTS}")
def forged_pages_posts(spark, sf_dir):
    """Pages with numbers that fit no column give the posts of the others."""
    found = harvest.archive_pages(fixtures.forged_pages(spark, sf_dir), fixtures.BASE, fixtures.conversation_categories(spark, sf_dir), LATIN, PAGE_SIZE, "t2")
    return _flat(found.posts, _POST_COLUMNS)


@register(
    f"""WITH p AS (SELECT DISTINCT tid, page FROM {CONV} UNION ALL SELECT DISTINCT -1 - fid, tid // 70 + 1 FROM {CONV} UNION ALL SELECT -100, 1 UNION ALL SELECT -101, 1)
    SELECT k AS kind, count(*) AS pages FROM p, (VALUES ('board number'), ('thread number'), ('page number')) AS kinds(k) GROUP BY k"""
)
def forged_pages_rejects(spark, sf_dir):
    """What was wrong with the forged pages (those of threads and boards, the front page, and the notice, which they push out of sight), by kind, in the archive's rejects."""
    forged = fixtures.forged_pages(spark, sf_dir)
    rejects = harvest.archive_pages(forged, fixtures.BASE, fixtures.conversation_categories(spark, sf_dir), LATIN, PAGE_SIZE, "t2").rejects
    return rejects.groupBy(F.trim(F.regexp_replace("reason", "[0-9]+", "")).alias("kind")).agg(F.count("*").alias("pages"))


@register(f"SELECT tid, page FROM (SELECT DISTINCT tid, unnest(range(1, tid % 2500 + 1)) AS page FROM {CONV} WHERE tid % 5 <> 0) WHERE page > 3")
def frontier_blocks(spark, sf_dir):
    """Long ranges of pages in blocks; things with a forged page number are left out."""
    things = fixtures.conversation_posts(spark, sf_dir).select("tid").distinct().withColumn("last", F.when(F.pmod("tid", F.lit(5)) == 0, F.lit(2_000_000_000)).otherwise(F.pmod("tid", F.lit(2500))).cast("int"))
    landed = things.select("tid", F.explode(F.array(*[F.lit(i) for i in (1, 2, 3)])).alias("page"))
    return pages.frontier(things, "tid", "last", landed)


def _stored_update(spark, sf_dir):
    """An archive of first pages in bucketed tables, updated twice by all pages."""
    root = _scratch(spark, "store")
    number, page = F.regexp_extract("url", r"tid-(\d+)", 1).try_cast("long"), F.regexp_extract("url", r"page=(\d+)", 1).try_cast("int")
    old = _landed(spark, sf_dir, number.isNull() | ((number < 50) & (page == 1)), "t1", f"{root}/old")
    landed = _landed(spark, sf_dir, root=f"{root}/landed")
    store = Store(spark, f"archive_{uuid.uuid4().hex}", f"{root}/tables", 8).create(old.posts, old.threads)
    store.update(landed.posts, "t2", LATIN)
    store.update(landed.posts, "t3", LATIN)
    return store


@register(f"SELECT {_POST_COLUMNS} FROM {_TAGGED_POSTS}")
def store_update_posts(spark, sf_dir):
    return _flat(_stored_update(spark, sf_dir).posts(), _POST_COLUMNS)


@register(_rolled(f"CASE WHEN tid < 50 AND count(*) <= {PAGE_SIZE} THEN 't1' ELSE 't2' END"))
def store_update_threads(spark, sf_dir):
    """Only the boards whose threads changed are written again; the second update changes none."""
    return _flat(_stored_update(spark, sf_dir).threads(), _THREAD_COLUMNS)


# --- samples --------------------------------------------------------------------


@register(f"SELECT tid, count(DISTINCT fid) AS n_boards FROM {LISTED} GROUP BY tid HAVING count(DISTINCT fid) >= 3")
def sticky_threads(spark, sf_dir):
    return sampling.sticky_threads(fixtures.listings(spark, sf_dir))


@register(f"SELECT tid, fid, page, pos, title FROM ({_FIRST}) WHERE tid IN {STICKY}")
def sticky_home_board(spark, sf_dir):
    return sampling.sticky_home(fixtures.listings(spark, sf_dir))


@register(f"SELECT tid, array_to_string(list_sort(list(DISTINCT fid)), ',') AS fids FROM {LISTED} GROUP BY tid")
def boards_per_thread(spark, sf_dir):
    return sampling.boards_per_thread(fixtures.listings(spark, sf_dir)).select("tid", F.array_join(F.col("fids").cast("array<string>"), ",").alias("fids"))


@register(f"SELECT tid, fid, page, pos, title FROM ({_FIRST}) WHERE tid IN {STICKY} UNION ALL SELECT tid, fid, page, pos, title FROM {LISTED} WHERE tid NOT IN {STICKY}")
def one_board_each(spark, sf_dir):
    return sampling.one_board_each(fixtures.listings(spark, sf_dir))


@register(f"SELECT fid, count(*) AS listed FROM {LISTED} GROUP BY fid")
def listing_counts(spark, sf_dir):
    return sampling.listing_counts(fixtures.listings(spark, sf_dir))


_SAMPLE = f"""SELECT fid, tid, title FROM (SELECT fid, tid, title, row_number() OVER (PARTITION BY fid ORDER BY md5('42:' || fid || ':' || tid), tid) AS rn
    FROM (SELECT fid, tid, arg_min(title, pos + 10000000000 * page) AS title FROM {LISTED} WHERE tid NOT IN {STICKY} GROUP BY fid, tid)) WHERE rn <= 3"""


@register(_SAMPLE)
def stratified_sample(spark, sf_dir):
    rest = sampling.without_stickies(fixtures.listings(spark, sf_dir))
    return sampling.board_sample(rest, 3, 42).select("fid", "tid", "title")


@register(
    f"""WITH s AS (SELECT fid FROM ({_SAMPLE}) UNION ALL SELECT fid FROM ({_FIRST}) WHERE tid IN {STICKY})
    SELECT fid, threads, coalesce(sampled, 0) AS sampled FROM (SELECT fid, count(DISTINCT tid) AS threads FROM {LISTED} GROUP BY fid)
    LEFT JOIN (SELECT fid, count(*) AS sampled FROM s GROUP BY fid) USING (fid)"""
)
def sample_report(spark, sf_dir):
    seen = fixtures.listings(spark, sf_dir)
    return sampling.board_report(seen, sampling.sample_threads(seen, 3, 42))


_SAMPLED = f"(SELECT fid, tid, 0 AS sticky FROM ({_SAMPLE}) UNION ALL SELECT fid, tid, 2 FROM ({_FIRST}) WHERE tid IN {STICKY})"


@register(
    f"""SELECT (SELECT count(DISTINCT fid) FROM {LISTED}) AS boards_scanned, count(*) FILTER (WHERE sticky = 2) AS sticky_threads, count(*) FILTER (WHERE sticky = 0) AS normal_threads,
    count(DISTINCT tid) AS total_threads, (SELECT count(*) FROM conversations) AS total_posts,
    (SELECT string_agg(fid || ':' || threads || ':' || sampled, ' ' ORDER BY fid) FROM (SELECT l.fid, count(DISTINCT l.tid) AS threads, (SELECT count(*) FROM {_SAMPLED} s WHERE s.fid = l.fid) AS sampled
        FROM {LISTED} l GROUP BY l.fid)) AS per_board FROM {_SAMPLED}"""
)
def sample_totals(spark, sf_dir):
    """The sample's report written as JSON and read back."""
    seen, path = fixtures.listings(spark, sf_dir), _scratch(spark, "report")
    report = sampling.sample_report(seen, sampling.sample_threads(seen, 3, 42), fixtures.conversation_posts(spark, sf_dir))
    io.write_report(report, path)
    back = spark.read.schema("boards_scanned long, sticky_threads long, normal_threads long, total_threads long, total_posts long, per_board map<string, struct<threads long, sampled long>>").json(path)
    entries = F.array_sort(F.transform(F.map_entries("per_board"), lambda e: F.struct(e["key"].cast("int").alias("fid"), e["value"].alias("n"))))
    boards = F.array_join(F.transform(entries, lambda e: F.concat_ws(":", e["fid"].cast("string"), e["n"]["threads"].cast("string"), e["n"]["sampled"].cast("string"))), " ")
    return back.withColumn("per_board", boards)


@register(f"SELECT DISTINCT tid FROM {_SAMPLED}")
def sampled_threads(spark, sf_dir):
    seen = fixtures.listings(spark, sf_dir)
    return sampling.sampled_tids(sampling.sample_threads(seen, 3, 42))


# --- updates --------------------------------------------------------------------

# stored: the first three floors of the threads below the median; landed: everything
_HALF = "(SELECT median(conv_id) FROM conversations)"
_STORED = f"(SELECT * FROM {CONV} WHERE floor <= 3 AND tid < {_HALF})"


def _stored(spark, sf_dir):
    posts = fixtures.conversation_posts(spark, sf_dir)
    half = posts.agg(F.median("tid").alias("half"))
    return posts.crossJoin(F.broadcast(half)).filter("floor <= 3 and tid < half").drop("half")


@register(f"SELECT tid, min(fid) AS fid FROM {CONV} WHERE tid > (SELECT max(tid) FROM {_STORED}) GROUP BY tid")
def new_threads(spark, sf_dir):
    threads = archive.thread_rollup(_stored(spark, sf_dir), LATIN)
    listed = fixtures.conversation_posts(spark, sf_dir).select("tid", "fid", "page", F.col("position").alias("pos"), "title")
    return incremental.new_threads(listed, threads).select("tid", "fid")


@register(
    f"""SELECT tid, live, coalesce(stored, 0) AS stored FROM (SELECT tid, count(*) AS live FROM {CONV} GROUP BY tid)
    LEFT JOIN (SELECT tid, count(*) AS stored FROM {_STORED} GROUP BY tid) USING (tid) WHERE live > coalesce(stored, 0)"""
)
def updated_threads(spark, sf_dir):
    return incremental.updated_threads(live_counts(spark, sf_dir), _stored(spark, sf_dir))


@register(
    f"""WITH n AS (SELECT DISTINCT tid FROM {CONV} WHERE tid > (SELECT max(tid) FROM {_STORED})),
    u AS (SELECT tid FROM {CONV} c GROUP BY tid HAVING count(*) > (SELECT count(*) FROM {_STORED} s WHERE s.tid = c.tid))
    SELECT tid, min(priority) AS priority FROM (SELECT tid, 0 AS priority FROM n UNION ALL SELECT tid, 1 FROM u) GROUP BY tid"""
)
def work_list(spark, sf_dir):
    return incremental.work_list(new_threads(spark, sf_dir), updated_threads(spark, sf_dir))


@register(f"SELECT tid, floor, author FROM {CONV} WHERE (tid, floor) NOT IN (SELECT tid, floor FROM {_STORED})")
def unseen_floors(spark, sf_dir):
    return incremental.unseen_floors(fixtures.conversation_posts(spark, sf_dir), _stored(spark, sf_dir)).select("tid", "floor", "author")


@register(f"SELECT DISTINCT tid FROM {CONV} WHERE tid NOT IN (SELECT tid FROM {_STORED}) AND page <= 2")
def skip_archived(spark, sf_dir):
    queue = incremental.first_pages(fixtures.conversation_posts(spark, sf_dir).select("tid", "page")).select("tid").distinct()
    return incremental.skip_archived(queue, archive.thread_rollup(_stored(spark, sf_dir), LATIN))


@register(f"SELECT DISTINCT tid, fid FROM {CONV} WHERE NOT (tid IN (SELECT tid FROM {_STORED}) AND fid <> 6 AND tid <= 10 * fid)")
def skip_processed(spark, sf_dir):
    """Archived threads up to each board's last processed one are passed over; board 6 has not begun."""
    queue = fixtures.conversation_posts(spark, sf_dir).select("tid", "fid").distinct()
    progress = queue.select("fid").distinct().filter("fid <> 6").select("fid", (F.col("fid") * 10).cast("long").alias("last_processed"))
    return incremental.skip_archived(queue, archive.thread_rollup(_stored(spark, sf_dir), LATIN), progress)


@register(f"SELECT tid, floor FROM {CONV} c WHERE floor > (SELECT count(*) FROM {_STORED} s WHERE s.tid = c.tid)")
def floors_beyond_count(spark, sf_dir):
    return incremental.beyond_count(fixtures.conversation_posts(spark, sf_dir), _stored(spark, sf_dir)).select("tid", "floor")


@register(f"SELECT DISTINCT tid FROM {CONV} WHERE tid NOT IN (SELECT tid FROM {_STORED})")
def unfinished_threads(spark, sf_dir):
    queue = fixtures.conversation_posts(spark, sf_dir).select("tid").distinct()
    return incremental.unfinished(queue, _stored(spark, sf_dir))


@register(
    f"""SELECT tid, count(*) AS post_count, CASE WHEN count(*) > (SELECT count(*) FROM {_STORED} s WHERE s.tid = c.tid) THEN 't2' ELSE 't1' END AS last_crawl, arg_min(coalesce(tags, ''), floor) AS tags
    FROM (SELECT *, tid * 100 + floor AS post FROM {CONV}) c LEFT JOIN {_CONV_TAGS} USING (post) GROUP BY tid"""
)
def thread_upsert(spark, sf_dir):
    stored = _stored(spark, sf_dir)
    threads = archive.thread_rollup(stored, LATIN, F.lit("t1"))
    _, updated = incremental.apply_update(stored, threads, fixtures.conversation_posts(spark, sf_dir), "t2", LATIN)
    return updated.select("tid", "post_count", "last_crawl", F.array_join("tags", "|").alias("tags"))


@register(f"SELECT tid, floor, max(version) AS version FROM (SELECT tid, floor, 1 AS version FROM {_STORED} UNION ALL SELECT tid, floor, floor % 2 * 2 FROM {CONV}) GROUP BY tid, floor")
def latest_posts(spark, sf_dir):
    old = _stored(spark, sf_dir).select("tid", "floor", F.lit(1).alias("version"))
    new = fixtures.conversation_posts(spark, sf_dir).select("tid", "floor", (F.pmod("floor", F.lit(2)) * 2).alias("version"))
    return archive.latest_posts(old.unionByName(new), "version")


@register(f"SELECT (SELECT max(tid) FROM {CONV}) AS highest_tid, (SELECT count(*) FROM {CONV}) AS total_archived")
def archive_state(spark, sf_dir):
    posts = fixtures.conversation_posts(spark, sf_dir)
    return incremental.archive_state(archive.thread_rollup(posts, LATIN), posts).select("highest_tid", "total_archived")


@register(f"SELECT tid, floor FROM {CONV} WHERE tid NOT IN (SELECT tid FROM {_STORED})")
def orphan_posts(spark, sf_dir):
    threads = archive.thread_rollup(_stored(spark, sf_dir), LATIN)
    return archive.orphans(fixtures.conversation_posts(spark, sf_dir), threads).select("tid", "floor")


# --- search ---------------------------------------------------------------------

_WORDS = "regexp_extract_all(lower(coalesce({0}, '')), '[\\p{{L}}\\p{{N}}]+')"
_INDEX = f"""(SELECT token, doc_id, field, count(*) AS tf FROM (SELECT doc_id, 'author' AS field, unnest({_WORDS.format('lang')}) AS token FROM documents
    UNION ALL SELECT doc_id, 'content', unnest({_WORDS.format('text')}) FROM documents) GROUP BY ALL)"""


def _index(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("lang").alias("author"), F.col("text").alias("content"))
    return docs, retrieval.token_index(docs, ["doc_id"], ["author", "content"])


@register(f"SELECT field, token, sum(tf)::BIGINT AS tf, count(*) AS docs FROM {_INDEX} GROUP BY field, token")
def token_index(spark, sf_dir):
    return _index(spark, sf_dir)[1].groupBy("field", "token").agg(F.sum("tf").alias("tf"), F.count("*").alias("docs"))


@register(f"SELECT doc_id FROM {_INDEX} WHERE token IN ('the', 'of', 'and') GROUP BY doc_id HAVING count(DISTINCT token) = 3")
def term_match(spark, sf_dir):
    return retrieval.match_all(_index(spark, sf_dir)[1], ["the", "of", "And"], ["doc_id"])


@register(
    """SELECT field, count(*) AS entries, sum(tf)::BIGINT AS tf FROM (SELECT 'author' AS field, doc_id, lower(lang) AS token, 1 AS tf FROM documents WHERE doc_id % 3 <> 1
    UNION ALL SELECT 'content', doc_id, 'replaced', 1 FROM documents WHERE doc_id % 3 = 0
    UNION ALL SELECT 'content', doc_id, token, count(*) FROM (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+')) AS token FROM documents WHERE doc_id % 3 = 2) GROUP BY ALL) GROUP BY field"""
)
def index_refresh(spark, sf_dir):
    docs, index = _index(spark, sf_dir)
    changed = docs.filter("doc_id % 3 = 0").withColumn("content", F.lit("Replaced"))
    fresh = retrieval.refresh_index(index, changed, ["doc_id"], docs.filter("doc_id % 3 = 1"), fields=["author", "content"])
    return fresh.groupBy("field").agg(F.count("*").alias("entries"), F.sum("tf").alias("tf"))


_BM25 = f"""WITH w AS (SELECT doc_id, {_WORDS.format('text')} AS words FROM documents),
    q AS (SELECT DISTINCT item_id AS query_id, unnest({_WORDS.format('text')}) AS token FROM benchmark),
    totals AS (SELECT count(*) AS n, avg(len(words)) AS mean FROM w),
    tf AS (SELECT token, doc_id, length, count(*) AS tf FROM (SELECT doc_id, len(words) AS length, unnest(words) AS token FROM w) WHERE token IN (SELECT token FROM q) GROUP BY ALL),
    df AS (SELECT token, count(*) AS df FROM tf GROUP BY token),
    scored AS (SELECT query_id, doc_id, sum(ln((n - df + 0.5) / (df + 0.5) + 1) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * length / mean))) AS score
        FROM tf JOIN df USING (token) JOIN q USING (token), totals GROUP BY query_id, doc_id),
    kw AS (SELECT * FROM (SELECT query_id, doc_id, score, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, doc_id) AS rank FROM scored) WHERE rank <= 10)"""


@register(f"{_BM25} SELECT query_id, rank, doc_id, round(score, 6) AS score FROM kw")
def bm25_topk(spark, sf_dir):
    items = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), "text")
    return retrieval.bm25(table(spark, sf_dir, "documents"), items, 10).withColumn("score", F.round("score", 6))


def _stored_index(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("content"))
    index = postings.Index(spark, _scratch(spark, "postings"), width=1024, parts=16)
    index.add(docs, 0, ["content"])
    return index, docs


@register(f"{_BM25} SELECT query_id, rank, doc_id, round(score, 6) AS score FROM kw")
def bm25_stored(spark, sf_dir):
    """The same ranking from stored lists, of which only blocks that can reach the best ten are scored."""
    items = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), "text")
    return _stored_index(spark, sf_dir)[0].search(items, 10).rows.withColumn("score", F.round("score", 6))


_SEGMENTS = """SELECT token, doc_id, count(*) AS tf FROM (SELECT 'replaced' AS token, doc_id FROM documents WHERE doc_id % 10 = 3
    UNION ALL SELECT unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+')), doc_id FROM documents WHERE doc_id % 10 NOT IN (3, 7)) GROUP BY ALL"""


def _refreshed_index(spark, sf_dir):
    """Every tenth document replaced twice by later segments, and every tenth removed."""
    index, docs = _stored_index(spark, sf_dir)
    changed = docs.filter("doc_id % 10 = 3")
    index.add(changed.withColumn("content", F.lit("Once more")), 1, ["content"])
    index.add(changed.withColumn("content", F.lit("Replaced")), 2, ["content"], removed=docs.filter("doc_id % 10 = 7"))
    return index


@register(_SEGMENTS)
def index_segments(spark, sf_dir):
    """Every posting of an index with delta segments."""
    return _refreshed_index(spark, sf_dir).entries().select("token", "doc_id", "tf")


@register(_SEGMENTS)
def index_merged(spark, sf_dir):
    """Every posting after the segments were merged into one."""
    return _refreshed_index(spark, sf_dir).merged(_scratch(spark, "merged")).entries().select("token", "doc_id", "tf")


@register("SELECT b.item_id AS query_id, d.doc_id FROM benchmark b, documents d WHERE contains(d.text, substr(b.text, 1 + b.item_id % 20, 2 + b.item_id % 7))")
def substring_search(spark, sf_dir):
    """Texts of two to eight characters anywhere in the documents, from an index of character pairs."""
    index = postings.bigram_index(table(spark, sf_dir, "documents"))
    items = table(spark, sf_dir, "benchmark")
    start, size = (1 + F.pmod("item_id", F.lit(20))).cast("int"), (2 + F.pmod("item_id", F.lit(7))).cast("int")
    return postings.substring_match(index, items.select(F.col("item_id").alias("query_id"), F.substring("text", start, size).alias("text")))


_COSINES = """SELECT query_id, rank, vec_id, round(score, 6) AS score FROM (SELECT q.vec_id AS query_id, v.vec_id, list_cosine_similarity(q.embedding::DOUBLE[], v.embedding::DOUBLE[]) AS score,
        row_number() OVER (PARTITION BY q.vec_id ORDER BY round(list_cosine_similarity(q.embedding::DOUBLE[], v.embedding::DOUBLE[]), 9) DESC, v.vec_id) AS rank
        FROM embeddings q JOIN embeddings v ON q.vec_id <> v.vec_id WHERE q.vec_id % 50 = 0) WHERE rank <= 10"""


@register(_COSINES)
def vector_topk(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    queries = vectors.filter("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), "embedding")
    return retrieval.vector_topk(vectors, queries, 10).withColumn("score", F.round("score", 6))


@register(_COSINES)
def vector_topk_blocks(spark, sf_dir):
    """The same for query sets too large to go to every task: blocks of queries meet blocks of vectors."""
    vectors = table(spark, sf_dir, "embeddings")
    queries = vectors.filter("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), "embedding")
    return retrieval.vector_topk(vectors, queries, 10, query_bytes=2048).withColumn("score", F.round("score", 6))


@register(
    f"""{_BM25}, late AS (SELECT query_id, doc_id, row_number() OVER (PARTITION BY query_id ORDER BY doc_id DESC) AS rank FROM kw),
    fused AS (SELECT query_id, doc_id, sum(part) AS score FROM (SELECT query_id, doc_id, 2.0 / (60 + rank) AS part FROM kw UNION ALL SELECT query_id, doc_id, 1.0 / (60 + rank) FROM late) GROUP BY ALL)
    SELECT query_id, doc_id, round(score, 9) AS score FROM fused"""
)
def rrf_fusion(spark, sf_dir):
    from pyspark.sql import Window

    items = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), "text")
    path = _scratch(spark, "ranks")  # both lists read the ranking, which is made once
    retrieval.bm25(table(spark, sf_dir, "documents"), items, 10).write.parquet(path)
    by_words = spark.read.parquet(path)
    by_id = by_words.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("doc_id"))))
    return retrieval.fuse([by_words, by_id], [2.0, 1.0]).select("query_id", "doc_id", F.round("score", 9).alias("score"))


# --- quality --------------------------------------------------------------------

_AUDIT = " UNION ALL ".join(f"SELECT {_q(k)} AS kind, 'content' AS field, count(*) FILTER (WHERE regexp_matches(content, {_q(p)})) AS hits FROM {POSTS}" for k, p in quality.PRIVATE.items())


@register(f"{_AUDIT} UNION ALL SELECT kind, 'tags', 0 FROM (VALUES {', '.join(f'({_q(k)})' for k in quality.PRIVATE)}) AS t(kind)")
def privacy_audit(spark, sf_dir):
    posts = tagging.with_tags(fixtures.document_posts(spark, sf_dir), LATIN)
    return quality.privacy_audit(posts, ["content"], ["tags"])


@register(f"SELECT tid, count(DISTINCT fid) AS n_boards FROM {LISTED} WHERE tid IN {STICKY} GROUP BY tid")
def sticky_twice(spark, sf_dir):
    seen = fixtures.listings(spark, sf_dir)
    marked = seen.join(sampling.sticky_threads(seen), "tid", "left_semi").withColumn("sticky", F.lit(2))
    return quality.sticky_twice(marked)


@register(f"SELECT (SELECT count(*) FROM documents) AS posts, (SELECT count(*) FROM documents WHERE len({_WORDS.format('text')}) + len({_WORDS.format('lang')}) > 0) AS with_words, (SELECT count(DISTINCT doc_id) FROM {_INDEX}) AS indexed")
def index_matches_posts(spark, sf_dir):
    docs, index = _index(spark, sf_dir)
    return quality.index_matches(docs.withColumn("title", F.lit("")), index, ["doc_id"])


@register(f"SELECT author, strftime(strptime(post_time, '%Y-%-m-%-d %H:%M:%S'), '%Y-%m-%d %H:%M:%S') AS at, count(*) AS posts FROM {CONV} GROUP BY ALL")
def post_times(spark, sf_dir):
    posts = archive.with_post_ts(fixtures.conversation_posts(spark, sf_dir))
    return posts.groupBy("author", F.date_format("post_ts", "yyyy-MM-dd HH:mm:ss").alias("at")).agg(F.count("*").alias("posts"))


# --- streams --------------------------------------------------------------------


def _landing(spark, sf_dir):
    """The conversations as a stream of posts."""
    source = f"{sf_dir}/conversations.parquet"
    # a stream reads folders; a single file is matched in its folder by a pattern
    landed = spark.readStream.schema(spark.read.parquet(source).schema).parquet(source[:-1] + "[t]")
    return landed.select(F.col("conv_id").alias("tid"), (F.col("turn") + 1).alias("floor"), F.col("role").alias("author"))


@register(f"SELECT tid, count(*) AS posts FROM {CONV} GROUP BY tid")
def streamed_counts(spark, sf_dir):
    """The posts arrive as a stream and are archived; the archive then gives the batch result."""
    root = _scratch(spark, "stream")
    streams.archive_stream(_landing(spark, sf_dir), f"{root}/archive", f"{root}/checkpoint").awaitTermination()
    return archive.post_counts(spark.read.parquet(f"{root}/archive"))


@register(f"SELECT tid, count(*) AS posts FROM {CONV} GROUP BY tid")
def streamed_running_counts(spark, sf_dir):
    """Counts kept as state of a stream, in update mode."""
    root = _scratch(spark, "stream")
    streams.count_stream(_landing(spark, sf_dir), f"{root}/counts", f"{root}/checkpoint").awaitTermination()
    return streams.latest_counts(spark.read.parquet(f"{root}/counts"))


@register(f"SELECT tid, floor, author FROM {CONV}")
def streamed_first_seen(spark, sf_dir):
    """A stream in which every post comes twice, and leaves once."""
    root = _scratch(spark, "stream")
    twice = _landing(spark, sf_dir).withColumn("again", F.explode(F.array(F.lit(0), F.lit(1)))).drop("again")
    sink = streams.first_seen(twice).writeStream.format("parquet").option("path", f"{root}/posts").option("checkpointLocation", f"{root}/checkpoint")
    sink.trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{root}/posts").select("tid", "floor", "author")


@register(f"SELECT tid, floor, page, position, author, {_tidy('content')} AS content FROM {CONV}")
def streamed_pages(spark, sf_dir):
    """Raw thread pages that land as files, each in two versions, parsed in the stream and archived."""
    root = _scratch(spark, "stream")
    rendered = fixtures.rendered_thread_pages(spark, sf_dir)
    versions = F.array(F.struct(F.lit("2026-04-03 10:00:00").cast("timestamp").alias("at"), F.lit("<html></html>").alias("body")), F.struct(F.lit("2026-04-03 11:00:00").cast("timestamp").alias("at"), F.col("html").alias("body")))
    both = rendered.select("url", F.explode(versions).alias("v")).select("url", F.col("v.body").alias("html"), F.col("v.at").alias("fetched_at"))
    both.write.parquet(f"{root}/landed")
    landed = spark.readStream.schema(both.schema).parquet(f"{root}/landed")
    parse = partial(streams.parse_pages, vocab=LATIN, page_size=PAGE_SIZE)
    streams.archive_stream(landed, f"{root}/archive", f"{root}/checkpoint", prepare=parse).awaitTermination()
    return spark.read.parquet(f"{root}/archive").select("tid", "floor", "page", "position", "author", "content")


@register(f"SELECT tid, floor, fid, author, content FROM {CONV}")
def streamed_stateful(spark, sf_dir):
    """Posts that land in many files, a third of them again in later ones; the stream ends, goes on from its checkpoint, and reads no archive."""
    root = _scratch(spark, "stateful")
    posts = fixtures.conversation_posts(spark, sf_dir).select("tid", "floor", "fid", "author", "content")
    for run in (0, 1):
        mine = posts.filter(F.pmod(F.xxhash64("tid", "floor"), F.lit(3)) != run)
        mine.repartition(3).write.mode("append").parquet(f"{root}/landed")
        landed = spark.readStream.schema(posts.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/landed")
        stateful.archive_unseen(spark, landed, f"{root}/archive", f"{root}/checkpoint").awaitTermination()
    return spark.read.schema(posts.schema).parquet(f"{root}/archive").select(*posts.columns)


# events in batches of six days; every tenth comes again in the next batch, every tenth plus one only there
_BATCHES = """(SELECT event_id, ts, event_type, slice, slice + CASE WHEN event_id % 10 = 1 THEN 1 ELSE 0 END AS batch FROM (
    SELECT *, (epoch_ms(ts) - (SELECT min(epoch_ms(ts)) FROM events)) // (6 * 86400000) AS slice FROM events))"""


@register(
    f"""WITH b AS {_BATCHES}, newest AS (SELECT batch, max(epoch_ms(ts)) AS top FROM (SELECT batch, ts FROM b UNION ALL SELECT slice + 1, ts FROM b WHERE event_id % 10 = 0) GROUP BY batch),
    -- what is late goes by the batch before the last one, but after a run's end by the last one
    mark AS (SELECT batch, (SELECT max(top) FROM newest o WHERE o.batch < n.batch - CASE WHEN n.batch = (SELECT max(batch) FROM newest) // 2 + 1 THEN 0 ELSE 1 END) - 86400000 AS ms FROM newest n)
    SELECT event_id, event_type FROM b JOIN mark USING (batch) WHERE ms IS NULL OR epoch_ms(ts) > ms"""
)
def streamed_recent(spark, sf_dir):
    """A stream by event time in several batches and two runs, with repeats and late events; a day's delay bounds its state."""
    root = _scratch(spark, "recent")
    events = table(spark, sf_dir, "events").select("event_id", "event_type", F.col("ts").cast("timestamp").alias("ts"))
    first = F.broadcast(events.agg(F.min(F.unix_millis("ts")).alias("first")))  # one row
    sliced = events.crossJoin(first).withColumn("slice", F.floor((F.unix_millis("ts") - F.col("first")) / (6 * 86400000)).cast("int")).drop("first")
    late = F.when(F.pmod("event_id", F.lit(10)) == 1, F.col("slice") + 1).otherwise(F.col("slice"))
    again = sliced.filter("event_id % 10 = 0").withColumn("batch", F.col("slice") + 1)
    dealt = sliced.withColumn("batch", late).unionByName(again)
    last = dealt.agg(F.max("batch")).first()[0]
    for batch in range(last + 1):
        dealt.filter(F.col("batch") == batch).select(*events.columns).coalesce(1).write.mode("append").parquet(f"{root}/landed")
        if batch in (last // 2, last):
            landed = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/landed")
            stateful.archive_recent(landed, f"{root}/archive", f"{root}/checkpoint", "1 day", "ts", ("event_id",), ("event_type",)).awaitTermination()
    return spark.read.schema(events.schema).parquet(f"{root}/archive").select("event_id", "event_type")
