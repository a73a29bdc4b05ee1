"""Views that read the test tables as forum data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BASE = "http://forum.example"
#: Posts on a page of the rendered conversations.
PAGE_SIZE = 3
#: Threads that the events are dealt to.
THREADS = 4000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def document_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A post of one floor per document; its source is the board."""
    d = table(spark, sf_dir, "documents")
    return d.select(
        F.col("doc_id").alias("tid"),
        F.regexp_extract("source", r"(\d+)", 1).cast("int").alias("fid"),
        F.col("source").alias("board"),
        F.substring_index("text", "\n", 1).alias("title"),
        F.col("lang").alias("author"),
        F.lit(1).alias("floor"),
        F.lit(1).alias("page"),
        F.lit(1).alias("position"),
        F.lit("2026-4-3 10:52:36").alias("post_time"),
        F.col("text").alias("content"),
        F.format_string(f"{BASE}/forum.php?mod=viewthread&tid=%d", "doc_id").alias("url"),
    )


def conversation_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A thread per conversation, a floor per turn, ``PAGE_SIZE`` floors a page."""
    c = table(spark, sf_dir, "conversations")
    floor = F.col("turn") + 1
    return c.select(
        F.col("conv_id").alias("tid"),
        F.pmod("conv_id", F.lit(7)).cast("int").alias("fid"),
        F.concat(F.lit("b"), F.pmod("conv_id", F.lit(7)).cast("string")).alias("board"),
        F.lit("").alias("category"),
        F.format_string("thread %d", "conv_id").alias("title"),
        F.col("role").alias("author"),
        floor.cast("int").alias("floor"),
        (F.floor(F.col("turn") / PAGE_SIZE) + 1).cast("int").alias("page"),
        (F.pmod("turn", F.lit(PAGE_SIZE)) + 1).cast("int").alias("position"),
        F.format_string("2026-4-3 10:%d:36", F.col("turn") + 10).alias("post_time"),
        F.col("text").alias("content"),
        F.format_string(f"{BASE}/forum.php?mod=viewthread&tid=%d", "conv_id").alias("url"),
    )


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Threads seen on boards: an event is a sighting."""
    e = table(spark, sf_dir, "events")
    tid = F.pmod("event_id", F.lit(THREADS)).cast("long")
    return e.select(
        F.col("user_id").cast("int").alias("fid"),
        (F.pmod("event_id", F.lit(3)) + 1).cast("int").alias("page"),
        F.col("event_id").cast("long").alias("pos"),
        tid.alias("tid"),
        F.format_string("%s %d", F.col("event_type"), tid).alias("title"),
    )


def rendered_thread_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Thread pages of the conversations in the archived form; a page has ``PAGE_SIZE`` posts, so groups are small."""
    posts = conversation_posts(spark, sf_dir)
    block = F.concat(F.lit('<p class="author"><strong>'), "author", F.lit("</strong> 发表于 "), "post_time", F.lit("</p>"), F.regexp_replace("content", "\n", "<br />"))
    one = F.struct("position", block.alias("block"))
    pages = posts.groupBy("tid", "page").agg(F.sort_array(F.collect_list(one)).alias("all"))
    url = F.format_string(f"{BASE}/archiver/?tid-%d.html&page=%d", "tid", "page")
    return pages.select(url.alias("url"), F.concat(F.lit("<html><body>"), F.array_join(F.transform("all", lambda x: x["block"]), ""), F.lit("</body></html>")).alias("html"))


def rendered_meta_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with each post's interaction data; every block stands twice, as div and as table. Odd floors have no ratings or comments."""
    posts = conversation_posts(spark, sf_dir)
    pid = F.col("tid") * 100 + F.col("floor")
    counters = F.format_string('<a id="recommendv_add_%d">%d</a><a id="recommendv_subtract_%d">%d</a><span id="favoritenumber">%d</span>', pid, F.length("content"), pid, F.col("floor") * 2, "floor")
    totals = F.format_string('参与人数 <span class="xi1">%d</span> 金币 <i><span class="xi1">+%d</span></i>', "floor", F.col("floor") * 5)
    row = F.format_string(
        '<tr id="rate_%d_%d"><td><a href="home.php?mod=space&amp;uid=1"> %s </a></td><td class="y xi1"> + %d</td><td class="xg1">for %s</td></tr>',
        pid, "tid", F.col("author"), "floor", F.col("author"),
    )
    said = F.format_string('<div class="pstl"><a href="home.php?mod=space&amp;uid=%d"><img></a><a href="x">u%d</a> said %d</div></div></div>', "tid", "floor", "tid")
    rated = F.when(F.pmod("floor", F.lit(2)) == 0, F.concat(totals, row, row, said)).otherwise(F.lit(""))
    block = F.concat(F.format_string('<div id="post_%d">', pid), F.lit("x</div>"), F.format_string('<table id="pid%d">', pid), counters, rated, F.lit("</table>"))
    pages = posts.groupBy("tid", "page").agg(F.sort_array(F.collect_list(F.struct("position", block.alias("block")))).alias("all"))
    return pages.select("tid", "page", F.array_join(F.transform("all", lambda x: x["block"]), "\n").alias("html"))


def rendered_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages of the conversations as a forum: a front page, board pages of ten threads, thread pages, and a notice."""
    threads = conversation_posts(spark, sf_dir).select("tid", "fid", "board", "title").distinct()
    front = threads.select("fid", "board").distinct().agg(F.sort_array(F.collect_list(F.struct("fid", F.format_string('<a href="forum.php?mod=forumdisplay&amp;fid=%d">%s</a>', "fid", F.col("board")).alias("link")))).alias("all"))
    link = F.format_string('<li><a href="?tid-%d.html">%s</a></li>', "tid", F.col("title"))
    listed = threads.groupBy("fid", (F.floor(F.col("tid") / 70) + 1).alias("page")).agg(F.sort_array(F.collect_list(F.struct("tid", link.alias("link")))).alias("all"))
    body = F.array_join(F.transform("all", lambda x: x["link"]), "\n").alias("html")
    parts = [
        front.select(F.lit(f"{BASE}/forum.php").alias("url"), body),
        listed.select(F.format_string(f"{BASE}/archiver/?fid-%d.html&page=%d", "fid", "page").alias("url"), body),
        rendered_thread_pages(spark, sf_dir).select("url", "html"),
        threads.limit(1).select(F.lit(f"{BASE}/archiver/?tid-0.html").alias("url"), F.lit("<p>提示信息</p>").alias("html")),
    ]
    whole = parts[0]
    for other in parts[1:]:
        whole = whole.unionByName(other)
    return whole.withColumn("fetched_at", F.lit("2026-04-03 10:52:36").cast("timestamp"))


def rendered_board_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing pages of the events, ten threads each, with links to the board's other pages."""
    seen = listings(spark, sf_dir).withColumn("page", (F.floor(F.col("pos") / 10) % 40 + 1).cast("int"))
    link = F.format_string('<li><a href="?tid-%d.html"><b>%s</b>&nbsp;%d</a></li><a href="?fid-%d.html&page=%d">n</a>', "tid", F.col("title"), F.col("pos"), "fid", F.pmod("pos", F.lit(50)) + 1)
    pages = seen.groupBy("fid", "page").agg(F.sort_array(F.collect_list(F.struct("pos", link.alias("link")))).alias("all"))
    url = F.format_string(f"{BASE}/archiver/?fid-%d.html&page=%d", "fid", "page")
    return pages.select(url.alias("url"), F.array_join(F.transform("all", lambda x: x["link"]), "\n").alias("html"))


def rendered_index_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Front pages with links to ten boards each: a link without text before the one with the name."""
    seen = listings(spark, sf_dir)
    start = F.format_string('<a href="forum.php?mod=forumdisplay%sfid=%d">', F.when(F.pmod("pos", F.lit(2)) == 0, "&amp;").otherwise("&"), "fid")
    link = F.concat(start, F.lit('<img src="x"></a>'), start, F.format_string("<b>Board</b> &nbsp;%d\n</a>", "fid"))
    pages = seen.groupBy(F.floor(F.col("pos") / 10).alias("n")).agg(F.sort_array(F.collect_list(F.struct("pos", link.alias("link")))).alias("all"))
    return pages.select(F.format_string(f"{BASE}/forum.php?n=%d", "n").alias("url"), F.array_join(F.transform("all", lambda x: x["link"]), "").alias("html"))


def board_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boards of the documents' sources; numbers that divide by three are unknown."""
    rows = document_posts(spark, sf_dir).select("fid", "board").distinct()
    return rows.filter("fid % 3 <> 0").withColumn("category", F.concat(F.lit("c·"), "board"))


def conversation_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The conversations' boards with a category; numbers that divide by three have none."""
    fids = table(spark, sf_dir, "conversations").select(F.pmod("conv_id", F.lit(7)).cast("int").alias("fid")).distinct()
    return fids.filter("fid % 3 <> 0").withColumn("category", F.format_string("c·b%d", "fid"))


def forged_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages of :func:`rendered_archive`, to whose text links, page numbers and years were added that fit no column."""
    far = "9" * 30
    forged = (
        f'<a href="forum.php?mod=forumdisplay&fid={far}">Far</a><li><a href="?tid-{far}.html">Far</a></li>'
        f'<a href="?fid-1.html&page={far}">n</a><a href="?tid-1.html&page=2000000000">n</a>'
    )
    return rendered_archive(spark, sf_dir).withColumn("html", F.concat(F.lit(forged), "html"))
