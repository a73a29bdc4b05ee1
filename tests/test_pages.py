"""Parsers on hand-written pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from threadmill.operators import archive
from threadmill.sources import pages
from threadmill.streaming import streams


def frame(spark, *htmls):
    return spark.createDataFrame([(f"http://f/archiver/?tid-{i + 1}.html", h) for i, h in enumerate(htmls)], "url string, html string")


def test_identity(spark):
    urls = ["http://f/archiver/?fid-7.html", "http://f/archiver/?fid-7.html&page=35", "http://f/archiver/?tid-9.html&page=2", "http://f/forum.php?mod=viewthread&tid=12", "http://f/forum.php?mod=viewthread&amp;tid=12&page=4", "http://f/"]
    rows = pages.page_identity(spark.createDataFrame([(u,) for u in urls], "url string")).collect()
    assert [(r["kind"], r["fid"], r["tid"], r["page"]) for r in rows] == [("board", 7, None, 1), ("board", 7, None, 35), ("thread", None, 9, 2), ("thread", None, 12, 1), ("thread", None, 12, 4), ("other", None, None, 1)]
    one = spark.range(1, 2).select(pages.board_url("http://f", F.col("id"), F.lit(1)), pages.thread_url("http://f", F.col("id"), F.lit(3)), pages.thread_web_url("http://f", F.col("id"))).first()
    assert list(one) == ["http://f/archiver/?fid-1.html", "http://f/archiver/?tid-1.html&page=3", "http://f/forum.php?mod=viewthread&tid=1"]


def test_boards(spark):
    link = '<a href="forum.php?mod=forumdisplay{}fid={}" class="x">{}</a>'
    html = link.format("&", 9, "<img src=a>") + link.format("&amp;", 9, "<b>板 块</b>&nbsp;九") + link.format("&", 3, "三\n") + link.format("&", 9, "again")
    rows = pages.discover_boards(frame(spark, html)).collect()
    assert [tuple(r) for r in rows] == [(3, "三"), (9, "板块九")]
    dim = pages.board_dimension(spark)
    assert dim.count() == 38
    marked = pages.with_category(spark.createDataFrame([(2,), (999,)], "fid int"), dim).collect()
    assert {r["fid"]: r["category"] for r in marked} == {2: "日常·活动", 999: "未分类"}


def test_listing(spark):
    html = '<li><a href="?tid-5.html">a <b>b</b>\n  c</a></li><li> <a href="?tid-6.html" class="z">&nbsp;</a><li><a href="?tid-7.html"><img></a><li><a href="?tid-8.html">&lt;x</a>'
    rows = pages.thread_listings(frame(spark, html)).collect()
    assert [(r["tid"], r["title"]) for r in rows] == [(5, "a b c"), (6, " "), (8, "&lt;x")]
    counted = frame(spark, '<a href="?fid-1.html&page=35">35</a><a href="?fid-1.html&page=4">', "none").select(pages.max_page(F.col("html"), pages.BOARD_PAGE)).collect()
    assert [r[0] for r in counted] == [35, 1]


def test_posts(spark):
    html = (
        "header"
        '<p class="author"><strong> 甲 </strong> 发表于 2026-4-3 10:52:36</p><h3>题\n目</h3>正文<br>二'
        '<DIV class="author"><strong>乙</strong></DIV>x&amp;lt;'
        '<div class="author">发表于 t</div>'
        '<p class="author"><strong>丙</strong></p>'
        '<p class="author">no strong</p>kept'
        '<div class="author">no close at all'
    )
    rows = pages.number_in_page(pages.thread_posts(frame(spark, html)), ["url"]).orderBy("position").collect()
    assert [(r["position"], r["author"], r["post_time"], r["content"]) for r in rows] == [
        (1, "甲", "2026-4-3 10:52:36", "正文\n二"),
        (2, "乙", "", "乙\nx<"),  # only a lower-case closing tag ends the author's part
        (3, "丙", "", ""),
        (4, "未知", "", "kept"),
        (5, "未知", "", "no close at all"),
    ]
    cut = pages.thread_posts(frame(spark, '<p class="author"><strong>a</strong></p>b<!--nav-->1 2 3'), nav_marker="<!--nav-->").first()
    assert cut["content"] == "b"
    assert pages.thread_posts(frame(spark, "nothing")).count() == 0


def test_thread_of_37(spark):
    """Pages of 15, 15 and 7 posts: floors by arithmetic equal running numbers."""
    block = '<p class="author"><strong>a{0}</strong> 发表于 2026-4-3 10:00:00</p>post {0}'
    sizes = (15, 15, 7)
    rows, at = [], 0
    for p, n in enumerate(sizes, 1):
        rows.append((f"http://f/?tid-8.html&page={p}", "".join(block.format(at + i) for i in range(n))))
        at += n
    posts = pages.number_in_page(pages.thread_posts(pages.page_identity(spark.createDataFrame(rows, "url string, html string"))), ["tid", "page"])
    floors = posts.withColumn("floor", archive.floor_of(F.col("page"), F.col("position")))
    again = archive.number_floors(posts)
    assert floors.orderBy("floor").select("floor", "content").collect() == again.orderBy("floor").select("floor", "content").collect()
    assert [r["content"] for r in floors.orderBy("floor").collect()] == [f"post {i}" for i in range(37)]
    counts = posts.groupBy("tid", "page").agg(F.count("*").alias("posts_on_page"))
    assert archive.live_post_count(counts).first()["live"] == 37


def test_errors(spark):
    good, bad = pages.split_errors(frame(spark, "提示信息 not found", '提示信息 <p class="author">x</p>', "x" * 250 + "提示信息", None))
    assert good.count() == 2 and {r["reason"] for r in bad.collect()} == {"notice page", "no body"}


META = """<div id="post_11"><table id="pid11" summary="x">参与人数 <span class="xi1">2</span> 金币 <i><span class="xi1"> +7</span></i>
<tr id="rate_11_501"><td><a href="home.php?mod=space&uid=501">阿</a></td><td class="xi1"> + 5</td><td class="xg1"> 好 </td></tr>
<tr id="rate_11_502"><td><a href="home.php?mod=space&uid=502">乙</a></td><td class="xi1">2</td><td class="xg1"></td></tr>
<span id="recommendv_add_11">3</span><span id="recommendv_subtract_11">1</span><span id="favoritenumber">4</span>
<div><div><div class="pstl"><a href="home.php?mod=space&amp;uid=9"><img></a><a href="u">名</a> 说 </div></div></div></table>
<div id="post_12"><table id="pid12">none</table>"""


def test_meta(spark):
    rows = pages.thread_meta(spark.createDataFrame([(1, 1, META)], "tid long, page int, html string"))
    assert [(r["at"], r["pid"]) for r in rows.orderBy("at").collect()] == [(0, 11), (1, 11), (2, 12), (3, 12)]
    once = archive.unique_meta(rows).orderBy("position").collect()
    assert [(r["position"], r["pid"]) for r in once] == [(1, 11), (2, 12)]
    meta = once[0]["meta"].asDict(recursive=True)
    assert (meta["rating_count"], meta["rating_coins"], meta["recommend_add"], meta["recommend_subtract"], meta["favorite_count"]) == (2, 7, 3, 1, 4)
    assert meta["rating_details"] == [{"uid": 501, "username": "阿", "coins": 5, "reason": "好"}, {"uid": 502, "username": "乙", "coins": 2, "reason": ""}]
    assert meta["comment_count"] == 1 and meta["comments"][0]["uid"] == 9 and meta["comments"][0]["username"] == "名"
    assert once[1]["meta"]["rating_count"] == 0 and once[1]["meta"]["comments"] == []
    posts = spark.createDataFrame([(1, 1, 1), (1, 1, 2), (1, 1, 3)], "tid long, page int, position int")
    joined = {r["position"]: r["meta"] for r in archive.attach_meta(posts, rows).collect()}
    assert joined[1]["recommend_add"] == 3 and joined[2]["recommend_add"] == 0 and joined[3] is None


def test_page_stream(spark, tmp_path):
    """Raw pages stream in twice, the second time with a longer last page; the archive holds each floor once."""
    from threadmill.sources import io

    block = '<p class="author"><strong>甲</strong> 发表于 2026-4-3 10:52:36</p>正文{}'
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    for last in (1, 2):
        rows = [(f"http://f/?tid-{t}.html&page={p}", bytearray("".join(block.format(i) for i in range(15 if p == 1 else last)).encode("gbk") + b"\x80"), None) for t in (1, 2) for p in (1, 2)]
        spark.createDataFrame(rows, "url string, body binary, fetched_at timestamp").write.mode("append").parquet(source)
        streams.archive_stream(io.stream_raw_pages(spark, source), out, str(tmp_path / "checkpoint"), prepare=streams.parse_pages).awaitTermination()
    found = spark.read.parquet(out)
    assert {r["tid"]: r["posts"] for r in archive.post_counts(found).collect()} == {1: 17, 2: 17}
    assert sorted(r["floor"] for r in found.filter("tid = 1").collect()) == list(range(1, 18))
    assert found.filter("floor = 17").first()["content"] == "正文1"


def test_page_versions(spark):
    """Of two versions of a page in one batch the later one counts, in whatever order they come."""
    from datetime import datetime

    block = '<p class="author"><strong>a</strong> 发表于 2026-4-3 10:52:36</p>post {}'
    url = "http://f/?tid-1.html"
    rows = [(url, block.format(1), datetime(2026, 4, 3, 10)), (url, block.format(1) + block.format(2), datetime(2026, 4, 3, 11)), (url, block.format(1), None)]
    for some in (rows, rows[::-1]):
        batch = spark.createDataFrame(some, "url string, html string, fetched_at timestamp").coalesce(1)
        assert sorted(r["content"] for r in streams.parse_pages(batch).collect()) == ["post 1", "post 2"]


def test_harvest(spark, tmp_path):
    """A thread on two boards, an unlisted one, GBK bodies and interaction data; an archive saved and read back."""
    from threadmill.operators import harvest

    block = '<p class="author"><strong>甲</strong> 发表于 2026-4-3 10:52:36</p>{}'
    html = {
        "http://f/forum.php": '<a href="forum.php?mod=forumdisplay&fid=2">活动</a><a href="forum.php?mod=forumdisplay&fid=3">闲聊</a>',
        "http://f/?fid-3.html": '<li><a href="?tid-7.html">2026春 通知</a></li>',
        "http://f/?fid-2.html": '<li><a href="?tid-7.html">2026春 通知</a></li>',
        "http://f/?tid-7.html": block.format("队长 一") + block.format("二"),
        "http://f/?tid-8.html": block.format("&#20013;"),
        "http://f/?tid-9.html": "提示信息",
    }
    pages_ = spark.createDataFrame([(u, bytearray(h.encode("gbk")), None) for u, h in html.items()], "url string, body binary, fetched_at timestamp")
    meta = spark.createDataFrame([(7, 1, '<div id="post_1"><a id="recommendv_add_1">4</a></div>')], "tid long, page int, html string")
    found = harvest.archive_pages(pages_, "http://f", pages.board_dimension(spark), last_crawl="t1", meta_pages=meta)
    found = harvest.saved(found, str(tmp_path), 1)
    posts = {(r["tid"], r["floor"]): r for r in found.posts.collect()}
    assert set(posts) == {(7, 1), (7, 2), (8, 1)}
    assert posts[7, 1]["board"] == "活动" and posts[7, 1]["category"] == "日常·活动" and posts[7, 1]["tags"][:3] == ["2026", "26春", "通知"]
    assert posts[7, 1]["meta"]["recommend_add"] == 4 and posts[7, 2]["meta"] is None
    assert posts[8, 1]["title"] == "" and posts[8, 1]["content"] == "中"
    assert {r["tid"]: r["post_count"] for r in found.threads.collect()} == {7: 2, 8: 1}
    assert found.rejects.count() == 1 and found.listings.count() == 2
    same = harvest.update_archive(found, found, "http://f", last_crawl="t2")
    assert same.posts.count() == 3 and {r["last_crawl"] for r in same.threads.collect()} == {"t1"}


def test_text_cleaned_once(spark):
    """Judging whether a post is kept does not clean its text once more."""
    found = pages.thread_posts(frame(spark, '<p class="author"><strong>a</strong></p>b &#99; <br>c<p class="author"></p> <p class="author"></p>d'))
    assert [(r["position"], r["author"], r["content"]) for r in found.orderBy("position").collect()] == [(0, "a", "b c \nc"), (2, "未知", "d")]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and plan.count("</?div[^>]*>") == 1


def test_written_update(spark, tmp_path):
    """An update written under a root has the tables of one that is a plan, its added posts are there once, and again it adds none."""
    from threadmill.operators import harvest

    block = '<p class="author"><strong>a</strong> 发表于 2026-4-3 10:52:36</p>{}'
    html = {
        "http://f/forum.php": '<a href="forum.php?mod=forumdisplay&fid=2">b</a>',
        "http://f/?fid-2.html": '<li><a href="?tid-7.html">2026春</a></li><li><a href="?tid-9.html">new</a></li>',
        "http://f/?tid-7.html": block.format("one") + block.format("two"),
        "http://f/?tid-9.html": block.format("three three"),
    }
    rows = [(u, h, None) for u, h in html.items()]
    made = lambda some, crawl, name: harvest.archive_pages(spark.createDataFrame(some, "url string, html string, fetched_at timestamp"), "http://f", pages.board_dimension(spark), last_crawl=crawl, root=f"{tmp_path}/{name}")
    cut = [(u, block.format("one") if "tid-7" in u else h.partition("<li><a href=\"?tid-9")[0], t) for u, h, t in rows if "tid-9" not in u]
    old, landed = made(cut, "t1", "old"), made(rows, "t2", "landed")
    plan = harvest.update_archive(old, landed, "http://f", last_crawl="t2")
    new = harvest.update_archive(old, landed, "http://f", last_crawl="t2", root=f"{tmp_path}/new", version=2)
    for name in ("boards", "listings", "posts", "threads", "index", "page_counts"):
        both = [sorted(map(str, getattr(a, name).select(*sorted(getattr(a, name).columns)).collect())) for a in (plan, new)]
        assert both[0] == both[1] and both[0], name
    assert sorted((r["tid"], r["floor"]) for r in spark.read.parquet(f"{tmp_path}/new/added/v00000002").collect()) == [(7, 2), (9, 1)]
    assert {(r["tid"], r["post_count"], r["last_crawl"]) for r in new.threads.collect()} == {(7, 2, "t2"), (9, 1, "t2")}
    again = harvest.update_archive(new, landed, "http://f", last_crawl="t3", root=f"{tmp_path}/again", version=3)
    assert spark.read.parquet(f"{tmp_path}/again/added/v00000003").count() == 0 and again.posts.count() == 3
