"""Scalar operators on literals: the rules and their quirks."""

from __future__ import annotations

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from threadmill import schemas
from threadmill.functions import chunking, tagging, textops
from threadmill.functions.vocab import EVENT_TYPES, Vocab


def evaluate(spark, values, of):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r["out"] for r in rows.select("i", of(F.col("v")).alias("out")).orderBy("i").collect()]


def test_clean_html(spark):
    cases = {
        "a<br/>b<BR />c": "a\nb\nc",
        "<p class='x'>one</p><p>two</p>": "one\n\ntwo",
        "<pre>code</pre>": "code",
        "a<div>b</div>c<hr size=1>d": "a\nb\nc\nd",
        "x\r\ny\rz": "x\ny\nz",
        "全　角�": "全 角",
        "a\n\n\n\nb  \t c": "a\n\nb c",
        "&amp;lt;b&amp;gt;": "<b>",
        "&copy; &mdash; &ldquo;q&rdquo;": '&copy; — "q"',
        "&#20013;&#x4e2d;&#X4E2D;": "中中&#X4E2D;",
        "a&#1114112;b&#55296;": "ab?",
        "&#39;&apos;&nbsp;x": "'' x",
        "\xa0 pad　": "pad",
    }
    assert evaluate(spark, list(cases), textops.clean_html) == list(cases.values())
    assert evaluate(spark, [None], textops.clean_html) == [None]


def test_normalize_and_titles(spark):
    assert evaluate(spark, [None, " a　 b \n\n\n\n c\r"], textops.normalize) == ["", "a b \n\n c"]
    assert evaluate(spark, [" <b>A</b>  b ", "&nbsp;", "x\n y"], textops.clean_title) == ["A b", " ", "x y"]
    assert evaluate(spark, [" <b>A</b>  b "], lambda c: textops.clean_title(c, "")) == ["Ab"]


def test_gbk(spark):
    rows = spark.createDataFrame([(bytearray("中文".encode("gbk") + b"\x80x"),), (None,)], "b binary")
    assert [r[0] for r in rows.select(textops.decode_gbk("b")).collect()] == ["中文�x", None]


def test_times(spark):
    out = evaluate(spark, ["2026-4-3 10:52:36", "2026-04-03 9:02:36", "昨天", None], lambda c: F.date_format(textops.post_timestamp(c), "yyyyMMddHHmmss"))
    assert out == ["20260403105236", "20260403090236", None, None]


def tags_of(spark, title, content="", board="", **kw):
    row = spark.createDataFrame([(title, content, board)], "title string, content string, board string")
    return tagging.with_tags(row, **kw).first().asDict()


@pytest.mark.parametrize(
    ("title", "content", "year", "season"),
    [
        ("2026年春季", "", "2026", "春"),
        ("none", "x" * 490 + "1999", "1999", ""),
        ("none", "x" * 500 + "1999", "", ""),
        ("26春拉练", "", "2026", "春"),
        ("x26春", "", "2026", "春"),
        ("50春", "", "1950", "春"),
        ("x50春", "", "2050", "春"),
        ("２６春", "", "2026", "春"),
        ("99 秋", "", "1999", "秋"),
        ("活动26", "秋游", "", "秋"),
        ("寒暑春秋", "", "", "暑"),
        ("寒春", "", "", "寒"),
        ("秋春", "", "", "春"),
        ("x" * 30 + "春", "", "", ""),
        ("2025秋", "", "2025", "秋"),
        ("", "", "", ""),
    ],
)
def test_year_season(spark, title, content, year, season):
    found = tags_of(spark, title, content)
    assert (found["year"], found["season"]) == (year, season)


def test_types_and_lists(spark):
    first, later = EVENT_TYPES[0], EVENT_TYPES[3]
    assert tags_of(spark, f"{later} {first}")["event_type"] == first
    assert tags_of(spark, later + "x" * 40 + first)["event_type"] == later
    assert tags_of(spark, "x" * 39 + first)["event_type"] == first
    assert tags_of(spark, "t", "比赛")["activity_type"] == "比赛"
    assert tags_of(spark, "t", "x" * 198 + "比赛")["activity_type"] == ""
    assert tags_of(spark, "黄巢拉练", "玉符河")["routes"] == ["黄巢", "玉符河", "黄巢拉练"]
    assert tags_of(spark, "队长", "x")["roles"] == []
    assert tags_of(spark, "t", "x" * 600 + "后骑 队长 爆胎")["roles"] == ["队长", "后骑"]
    assert tags_of(spark, None, None)["tags"] == []


def test_merged_tags(spark):
    found = tags_of(spark, "2026春比赛 26春", "队长 队长 爆胎", "远征·2026")
    assert found["tags"] == ["2026", "26春", "比赛", "队长", "爆胎", "远征"]
    assert tags_of(spark, "暑期")["tags"] == ["暑"]
    assert tags_of(spark, "x", board="无点")["tags"] == []
    latin = Vocab(routes=("a", "ab"), roles=(), problems=(), event_types=(), activity_types=())
    assert tags_of(spark, "ab", vocab=latin)["tags"] == ["a", "ab"]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab .。!\n", max_size=120), st.integers(5, 30), st.integers(0, 12))
def test_split_long_property(text, size, overlap):
    squeeze = lambda t: "".join(t.split())
    if len(text) > size:
        found = chunking.split_long(text, size, overlap)
        assert all(0 < len(c) <= size + overlap and c == c.strip() for c in found)
        assert all(squeeze(c) in squeeze(text) for c in found)
        if overlap == 0:
            assert squeeze("".join(found)) == squeeze(text)
        if text.strip():
            assert squeeze(found[0])[0] == squeeze(text)[0] and squeeze(found[-1])[-1] == squeeze(text)[-1]


def test_chunks(spark):
    texts = ["短。", "a" * 1500, "b" * 1501, "c" * 2000, "d" * 2000 + "。短句。", "3.14 " * 400, "", None]
    found = evaluate(spark, texts, lambda c: chunking.chunks(c))
    assert found[0] == ["短。"] and found[1] == ["a" * 1500]
    assert [len(c) for c in found[3]] == [1500, 700, 200]
    assert [len(c) for c in found[2]] == [1500, 201, 200]
    assert found[4][-1].endswith("短句。")
    assert found[6] == [""]
    assert evaluate(spark, ["c" * 2000], lambda c: chunking.chunks(c, dedupe_tail=True))[0] == ["c" * 1500, "c" * 700]
    assert evaluate(spark, ["x" * 25], lambda c: chunking.chunks(c, 10, 0))[0] == ["x" * 10, "x" * 10, "x" * 5]
    assert evaluate(spark, ["x" * 25], lambda c: chunking.chunks(c, 10, 20))[0]


def test_folded_chunks(spark):
    """The fold without Python equals the plain function, for all kinds of ends and overlaps."""
    draw = random.Random(3)
    texts = ["", " ", "。", "!!!", "a. \x1c\u3000b", "c" * 70, "c" * 29 + "." + "d" * 40, None]
    texts += ["".join(draw.choice("ab字\U0001f600 .。!?\n\x1f\u3000") for _ in range(draw.randrange(120))) for _ in range(300)]
    for size, overlap in ((30, 0), (30, 7), (10, 9), (5, 12)):
        for dedupe in (False, True):
            expected = [None if t is None else chunking.split_long(t, size, overlap, dedupe) for t in texts]
            assert evaluate(spark, texts, lambda c, s=size, o=overlap, d=dedupe: chunking.folded(c, s, o, d)) == expected


def test_long_word_lists(spark, monkeypatch):
    """One scan for all words finds what a search for each does: nested, overlapping, astral and special characters."""
    draw = random.Random(5)
    words = list(dict.fromkeys("".join(draw.choice("abc字典\U0001f600.\\^]") for _ in range(draw.randrange(1, 5))) for _ in range(300)))
    texts = ["", None, "字典字", "\U0001f600a", *["".join(draw.choice("abcd字典\U0001f600.\\^]\n") for _ in range(draw.randrange(80))) for _ in range(200)]]
    expected = [[w for w in words if w in (t or "")] for t in texts]
    assert evaluate(spark, texts, lambda c: tagging.contained(c, words)) == expected
    assert evaluate(spark, texts, lambda c: tagging.contained(c, words[:3], words)) == [[w for w in words[:3] if w in (t or "")] for t in texts]
    assert evaluate(spark, ["xab"], lambda c: tagging.contained(c, ["", "ab", "ab", *words])) == [["", "ab", "ab", *[w for w in words if w in "xab"]]]
    long = Vocab(routes=tuple(words[:90]), roles=tuple(words[90:140]), problems=tuple(words[140:190]), event_types=tuple(words[190:230]), activity_types=tuple(words[200:]), cues={"one": tuple(words[:60]), "two": tuple(words[-60:])})
    posts = spark.createDataFrame([(i, texts[i], texts[-i - 1], "b") for i in range(len(texts))], "tid int, title string, content string, board string").orderBy("tid")
    tagged = lambda: tagging.with_tags(posts, long).withColumn("cues", chunking.cues(F.col("title"), F.coalesce("content", F.lit("")), long)).collect()
    scanned = tagged()
    monkeypatch.setattr(tagging, "MANY_WORDS", 10**9)
    assert scanned == tagged()


def test_cues_and_labels(spark):
    row = spark.createDataFrame([("建议", "x" * 900 + "优点 公示", "财务制度")], "title string, text string, extra string")
    assert row.select(chunking.cues(F.col("title"), F.col("text"))).first()[0] == "proposal,benefit,outcome"
    label = lambda t, c: spark.createDataFrame([(t, c)], "t string, c string").select(chunking.source_label(F.col("t"), F.col("c"))).first()[0]
    assert label("第三次车队执委会", "财务公开") == "第三次车队执委会"
    assert label("x", "2024年度执委会") == "2024年度执委会"
    assert label("x", "理事会的通知，决议") == "理事会的通知"
    assert label("x", "y" * 800 + "财务制度") == "" and label(None, "财务报销") == "财务报销"


def test_to_chunks(spark):
    posts = spark.createDataFrame([(1, 2, "板", "题", 3, "作者", "2026-4-3 1:2:3", "建议。正文", ["a", "b"]), (2, 2, "板", "题", 1, "x", "", " 　\n", [])], "tid long, fid int, board string, title string, floor int, author string, post_time string, content string, tags array<string>")
    rows = chunking.to_chunks(posts).collect()
    assert len(rows) == 1
    row = rows[0]
    assert row["id"] == "fid2_tid1_f3_idx1"
    assert row["text"] == "【板】《题》第3楼｜作者｜2026-4-3 1:2:3\n链接: \n标签: a，b\n语义线索: proposal\n\n建议。正文"
    assert row["source"]["chunk_count"] == 1 and row["source"]["url"] == "" and row["source"]["tags"] == ["a", "b"]
    stats = chunking.chunk_statistics(posts, chunking.to_chunks(posts)).first()
    assert (stats["posts"], stats["chunks"], stats["mean_chunks"]) == (2, 1, 0.5)


def test_defaults(spark):
    row = schemas.with_defaults(spark.createDataFrame([(1, None)], "tid long, title string"), schemas.POSTS_DDL).first()
    assert row["tid"] == 1 and row["title"] == "" and row["page"] == 1 and row["floor"] == 0 and row["tags"] == []


def test_whole_text_numeric_entities(spark, tmp_path):
    """The registered queries decode references anywhere in a text, as plain Python does."""
    import re

    from threadmill.plans import registry

    texts = [f"{'long text ' * n}&#{65 + n}; middle &#x4e{n:02x}; &amp;amp; end &#1114112;&#55296;" for n in range(1, 40)] + ["", None]

    def decoded(text):
        for name, char in textops.ENTITIES:
            text = text.replace(name, char)
        char = lambda n: "" if n >= 0x110000 else "?" if 0xD800 <= n <= 0xDFFF else chr(n)
        text = re.sub(r"&#(\d+);", lambda m: char(int(m[1])), text)
        return re.sub(r"&#x([0-9a-fA-F]+);", lambda m: char(int(m[1], 16)), text)

    spark.createDataFrame(list(enumerate(texts)), "page_id long, html string").write.parquet(f"{tmp_path}/pages.parquet")
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    pages = {r["page_id"]: r["content"] for r in registry.QUERIES["clean_html_numeric"](spark, str(tmp_path)).collect()}
    assert pages == {i: None if t is None else decoded(t) for i, t in enumerate(texts)}
    docs = {r["doc_id"]: r["decoded"] for r in registry.QUERIES["whole_text_entities"](spark, str(tmp_path)).collect()}
    assert docs == {i: None if t is None else chr(65 + i % 26) + chr(20013 + i % 50) + "<" + decoded(t) for i, t in enumerate(texts)}


def test_python_steps_hold_a_slice_of_a_batch():
    """What Python makes of a batch's texts is bounded, and the rows are the same."""
    import tracemalloc

    import pyarrow as pa

    from threadmill.functions import chunking, textops

    texts = pa.array([("&#65;bc. " * 600) + str(i) for i in range(3000)] + [None, ""])
    for work in (textops._numeric_entities.func, lambda t: chunking._split_all(t, 1500, 200, False)):
        tracemalloc.start()
        found = work(texts)
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < 8 << 20 and len(found) == 3002 and found[3000].as_py() is None  # 16 MB of texts
        assert found[7].as_py() == work(texts.slice(7, 1))[0].as_py() and len(work(texts.slice(0, 0))) == 0
    assert textops._numeric_entities.func(texts)[7].as_py() == "Abc. " * 600 + "7"
    assert chunking._split_all(texts, 1500, 200, False)[7].as_py() == chunking.split_long(texts[7].as_py(), 1500, 200)
