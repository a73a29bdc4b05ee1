"""Numbers that fit no column: nothing fails, and rejects name them."""

from __future__ import annotations

from pyspark.sql import functions as F

from threadmill.functions import tagging, textops
from threadmill.operators import harvest
from threadmill.sources import pages

FAR = "9" * 30


def test_links_and_frontier(spark):
    html = f'<a href="forum.php?mod=forumdisplay&fid={FAR}">Far</a><a href="forum.php?mod=forumdisplay&fid=2">Near</a><li><a href="?tid-{FAR}.html">Far</a></li><li><a href="?tid-5.html">Near</a></li><a href="?fid-2.html&page={FAR}"><a href="?fid-2.html&page=3">'
    df = spark.createDataFrame([("u", html)], "url string, html string")
    assert [tuple(r) for r in pages.discover_boards(df).collect()] == [(2, "Near")]
    assert [r["tid"] for r in pages.thread_listings(df).collect()] == [5]
    assert df.select(pages.max_page(F.col("html"), pages.BOARD_PAGE)).first()[0] == 3
    assert sorted(r["reason"] for r in pages.unfit_numbers(df).collect()) == [f"board number {FAR}", f"page number {FAR}", f"thread number {FAR}"]
    things = spark.createDataFrame([(1, 2_000_000_000), (2, 2500), (3, 0)], "tid long, last int")
    wanted = pages.frontier(things, "tid", "last", things.withColumn("page", F.lit(1)))
    assert wanted.count() == 2499 and wanted.select("tid").distinct().collect()[0][0] == 2
    assert [tuple(r)[:2] for r in pages.beyond_frontier(things, "tid", "last").collect()] == [("tid-1", "page number 2000000000")]


def test_meta(spark):
    row = f'<tr id="rate_1_{FAR}"><td><a href="home.php?mod=space&amp;uid=1">x</a></td><td class="xi1">+{FAR}</td><td class="xg1">r</td></tr>'
    said = f'<div class="pstl"><a href="home.php?mod=space&amp;uid={FAR}"><img></a><a href="x">u</a> said</div></div></div>'
    html = f'<div id="post_{FAR}">{row}{said}</div><table id="pid{FAR}">{row}{said}</table><div id="post_7">x</div>'
    meta = pages.thread_meta(spark.createDataFrame([(1, 1, html)], "tid long, page int, html string"))
    from threadmill.operators.archive import unique_meta

    rows = unique_meta(meta).orderBy("position").collect()
    assert len(rows) == 2 and rows[1]["pid"] == 7
    assert rows[0]["meta"]["rating_details"][0]["uid"] == 0 and rows[0]["meta"]["rating_details"][0]["coins"] == 0
    assert rows[0]["meta"]["comments"][0]["uid"] == 0


def test_digits_and_entities(spark):
    df = spark.createDataFrame([("١٢春", f"&#{'1' * 5000};&#x{'f' * 5000};&#{'0' * 5000}65;a")], "title string, text string")
    found = df.select(tagging.classify(F.col("title"), F.lit(""))["year"].alias("year"), textops.decode_entities(F.col("text")).alias("text")).first()
    assert tuple(found) == ("2012", "Aa")


def test_versions_of_pages(spark):
    """Only pages with a repeated key are shuffled; without one, no page is."""
    once = spark.createDataFrame([(i, 1, f"h{i}", None) for i in range(5)], "tid long, page int, html string, fetched_at timestamp")
    assert "Exchange" not in pages.newest_pages(once, ["tid", "page"])._jdf.queryExecution().executedPlan().toString()
    twice = once.unionByName(once.filter("tid = 3").withColumn("html", F.lit("longer")))
    assert sorted((r["tid"], r["html"]) for r in pages.newest_pages(twice, ["tid", "page"]).collect()) == [(0, "h0"), (1, "h1"), (2, "h2"), (3, "longer"), (4, "h4")]


def test_pages_are_read_once(spark, tmp_path):
    """A written archive decodes every landed page once."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    block = '<p class="author"><strong>a</strong> 发表于 2026-4-3 10:52:36</p>x'
    rows = [("http://f/forum.php", '<a href="forum.php?mod=forumdisplay&fid=2">B</a>'), ("http://f/?fid-2.html", '<li><a href="?tid-7.html">T</a></li>'), ("http://f/?tid-7.html", block), ("http://f/?tid-9.html", "提示信息"), ("http://f/?tid-8.html", None)]
    df = spark.createDataFrame(rows, "url string, html string").mapInArrow(count, "url string, html string")
    found = harvest.archive_pages(df, "http://f", pages.board_dimension(spark), last_crawl="t1", root=str(tmp_path))
    assert seen.value == len(rows)
    assert found.posts.count() == 1 and found.threads.count() == 1 and found.page_counts.count() == 1 and found.index.count() > 0 and found.listings.count() == 1
    assert sorted(r["reason"] for r in found.rejects.collect()) == ["no body", "notice page"] and seen.value == len(rows)
