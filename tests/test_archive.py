"""Tables, updates, samples, search and checks on small frames."""

from __future__ import annotations

import duckdb
from pyspark.sql import functions as F

from threadmill import schemas
from threadmill.functions.vocab import Vocab
from threadmill.operators import archive, quality, retrieval, sampling
from threadmill.sources import io, pages
from threadmill.streaming import incremental, streams
from threadmill.plans import registry

from .oracle import compare


def posts_of(spark, rows):
    return schemas.with_defaults(spark.createDataFrame(rows, "tid long, fid int, floor int, author string, content string, title string"), schemas.POSTS_DDL)


def test_update_twice(spark):
    stored = posts_of(spark, [(1, 1, 1, "a", "队长", "2026春"), (1, 1, 2, "b", "x", "2026春")])
    threads = archive.thread_rollup(stored, last_crawl=F.lit("t1"))
    parsed = posts_of(spark, [(1, 1, 1, "a", "队长", "2026春"), (1, 1, 3, "c", "y", "2026春"), (5, 2, 1, "d", "z", "新"), (5, 2, 1, "d", "z", "新")])
    posts, updated = incremental.apply_update(stored, threads, parsed, "t2")
    rows = {r["tid"]: r for r in updated.collect()}
    assert posts.count() == 4 and rows[1]["post_count"] == 3 and rows[5]["post_count"] == 1
    assert rows[1]["year"] == "2026" and rows[1]["season"] == "春" and rows[1]["first_author"] == "a"  # tags survive the update
    again, same = incremental.apply_update(posts, updated, parsed, "t3")
    assert again.count() == 4 and {r["last_crawl"] for r in same.collect()} == {"t2"}
    assert archive.orphans(posts, updated).count() == 0


def test_empty_archive(spark):
    none = posts_of(spark, []).limit(0)
    threads = archive.thread_rollup(none)
    assert archive.highest_tid(threads).first()[0] == 0
    assert incremental.archive_state(threads, none).first()["total_archived"] == 0
    listed = spark.createDataFrame([(1, 1, 0, 7, "t"), (2, 1, 0, 7, "t"), (1, 2, 0, 3, "u")], schemas.LISTINGS_DDL)
    assert sorted(r["tid"] for r in incremental.new_threads(listed, threads).collect()) == [3, 7]
    assert incremental.first_pages(listed.withColumn("page", F.lit(3))).count() == 0
    assert incremental.skip_archived(listed, threads).count() == 3
    assert incremental.skip_archived(listed, threads, spark.createDataFrame([(1, 9)], "fid int, last_processed long")).count() == 3


def test_upsert(spark):
    old = spark.createDataFrame([(1, "t1", "a"), (2, "t1", "a")], "tid long, last_crawl string, v string")
    new = spark.createDataFrame([(2, "t1", "b"), (3, "t0", "b")], "tid long, last_crawl string, v string")
    assert {r["tid"]: r["v"] for r in archive.upsert_threads(old, new).collect()} == {1: "a", 2: "b", 3: "b"}


def test_update_vocabulary(spark):
    """An update tags threads by the vocabulary they were made with."""
    vocab = Vocab(roles=("zzz",))
    stored = posts_of(spark, [(1, 1, 1, "a", "zzz", "t")])
    threads = archive.thread_rollup(stored, vocab, F.lit("t1"))
    _, updated = incremental.apply_update(stored, threads, posts_of(spark, [(1, 1, 2, "b", "y", "t")]), "t2", vocab)
    assert updated.first()["roles"] == ["zzz"] and updated.first()["post_count"] == 2


def test_skip_progress(spark):
    queue = spark.createDataFrame([(1, 5), (1, 9), (1, 12), (2, 5), (3, 5)], "fid int, tid long")
    threads = spark.createDataFrame([(5,), (9,)], "tid long")
    progress = spark.createDataFrame([(1, 5), (2, 3)], "fid int, last_processed long")
    left = {(r["fid"], r["tid"]) for r in incremental.skip_archived(queue, threads, progress).collect()}
    assert left == {(1, 9), (1, 12), (2, 5), (3, 5)}


def test_ties(spark):
    """Of equal versions the same row stays, in whatever order rows come."""
    rows = [(1, 1, 7, c) for c in "abcdef"] + [(1, 1, 6, "z")]
    kept = set()
    for some in (rows, rows[::-1], rows[3:] + rows[:3]):
        df = spark.createDataFrame(some, "tid long, floor int, version int, v string").coalesce(1)
        kept.add(archive.latest_posts(df, "version").first()["v"])
        kept.add(incremental.unseen_floors(df.filter("version = 7"), df.limit(0)).first()["v"])
    assert len(kept) == 1 and "z" not in kept


def test_sticky_and_sample(spark):
    rows = [(f, 1, t, t, f"t{t}") for t in range(10) for f in (1,)] + [(2, 1, 0, 0, "t0"), (3, 1, 0, 0, "t0"), (2, 1, 1, 1, "t1"), (2, 2, 5, 1, "t1")]
    listed = spark.createDataFrame(rows, schemas.LISTINGS_DDL)
    assert [r["tid"] for r in sampling.sticky_threads(listed).collect()] == [0]
    home = sampling.sticky_home(listed).first()
    assert (home["tid"], home["fid"]) == (0, 1)
    one = sampling.sample_threads(listed, 3, seed=1)
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, sampling.sample_threads(listed.repartition(7), 3, seed=1).collect()))
    count = {r["fid"]: r["count"] for r in one.filter("sticky = 0").groupBy("fid").count().collect()}
    assert count == {1: 3, 2: 1}
    posts = posts_of(spark, [(0, 1, 1, "a", "b", "c")])
    report = sampling.sample_report(listed, one, posts).first()
    assert report["sticky_threads"] == 1 and report["boards_scanned"] == 3 and report["per_board"][2]["sampled"] == 1
    assert [r["tid"] for r in sampling.sampled_tids(one).collect()] == sorted({r["tid"] for r in one.collect()})
    assert quality.sticky_twice(sampling.one_board_each(listed).withColumn("sticky", F.lit(2)).filter("tid = 0")).count() == 0


def test_io(spark, tmp_path):
    path = tmp_path / "posts.jsonl"
    path.write_text('{"tid": 1, "floor": 2, "title": "题"}\n\n{"tid": 2, "tags": ["a"], "meta": {"rating_count": 3, "comments": []}}\n', encoding="utf-8")
    rows = io.read_posts_jsonl(spark, str(path)).orderBy("tid").collect()
    assert rows[0]["title"] == "题" and rows[0]["tags"] == [] and rows[0]["page"] == 1 and rows[1]["meta"]["rating_count"] == 3
    posts = posts_of(spark, [(1, 4, 1, "a", "b中", "c")])
    io.append_posts(posts, str(tmp_path / "archive"))
    io.append_posts_jsonl(posts, str(tmp_path / "json"))
    assert spark.read.parquet(str(tmp_path / "archive")).filter("fid = 4").count() == 1
    assert io.read_posts_jsonl(spark, str(tmp_path / "json")).first()["content"] == "b中"
    assert io.posts_for_sql(posts).first()["content_len"] == 2
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw" / "?tid-1.html").write_bytes("<p>中</p>".encode("gbk"))
    files = pages.decode_pages(io.read_page_files(spark, str(tmp_path / "raw"), "http://f/archiver/"))
    assert files.first()["html"] == "<p>中</p>"
    io.write_version(posts, str(tmp_path / "v"), 1)
    io.write_report(posts.limit(1), str(tmp_path / "report"))
    io.write_chunks_jsonl(posts, str(tmp_path / "chunks"))
    _, bad = pages.split_errors(spark.createDataFrame([("u", None)], "url string, html string"))
    io.append_rejects(bad, str(tmp_path / "rejects"))
    assert "no body" in spark.read.text(str(tmp_path / "rejects")).first()[0]


def test_index(spark):
    posts = posts_of(spark, [(1, 1, 1, "Ann", "Red bike, red road", "Bike"), (2, 1, 1, "Bob", "骑行路线 blue", "Road")])
    index = retrieval.token_index(posts)
    tf = {(r["token"], r["tid"], r["field"]): r["tf"] for r in index.collect()}
    assert tf["red", 1, "content"] == 2 and tf["骑行路线", 2, "content"] == 1 and ("骑行", 2, "content") not in tf
    assert ("骑行", 2, "content") in {(r["token"], r["tid"], r["field"]) for r in retrieval.token_index(posts, cjk_bigrams=True).collect()}
    assert [r["tid"] for r in retrieval.match_all(index, ["RED", "bike"]).collect()] == [1]
    assert retrieval.match_all(index, ["road"], field="title").count() == 1
    marked = posts_of(spark, [(3, 1, 1, "Zoë", "Ärger naïve cafe\u0301 straße", "Ñandú")])
    folded = {r["token"] for r in retrieval.token_index(marked, fold_marks=True).collect()}
    assert {"zoe", "arger", "naive", "cafe", "straße", "nandu"} <= folded
    assert quality.index_matches(posts, index).first().asDict() == {"posts": 2, "with_words": 2, "indexed": 2}
    changed = posts.filter("tid = 1").withColumn("content", F.lit("green"))
    fresh = {r["token"] for r in retrieval.refresh_index(index, changed).filter("tid = 1").collect()}
    assert fresh == {"ann", "green", "bike"}


def test_partial_update_with_many_listing_pages(spark, tmp_path):
    """The tenth listing page of a board does not count as its first."""
    rows = [(t, n, ("user", "assistant")[n % 2], f"text {t} {n}") for t in (3, 10, 52, 59, 640, 647) for n in range(5)]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{tmp_path}/conversations.parquet/*.parquet')")
    compare(registry.QUERIES["archive_update_partial_state"](spark, str(tmp_path)), con, registry.ORACLE_SQL["archive_update_partial_state"])


def test_fusion(spark):
    a = spark.createDataFrame([(1, 1, 10), (1, 2, 11)], "query_id int, rank int, doc_id int")
    b = spark.createDataFrame([(1, 1, 11)], "query_id int, rank int, doc_id int")
    rows = retrieval.fuse([a, b], k=1).collect()
    assert len(rows) == 1 and rows[0]["doc_id"] == 11 and abs(rows[0]["score"] - (1 / 62 + 1 / 61)) < 1e-12


def test_vector_topk(spark, monkeypatch):
    """Both ways to search, the matrix and the join, agree, also on ties and without usable vectors."""
    rows = [(i, [float(i % 7), 1.0, float(i % 3)]) for i in range(60)] + [(90, None)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    queries = vectors.filter("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), "embedding")
    found = sorted(map(tuple, retrieval.vector_topk(vectors, queries, 5).select("query_id", "rank", "vec_id").collect()))
    monkeypatch.setattr(retrieval, "QUERY_BYTES", 0)
    assert found == sorted(map(tuple, retrieval.vector_topk(vectors, queries, 5).select("query_id", "rank", "vec_id").collect())) and len(found) == 15
    assert retrieval.vector_topk(vectors, queries.limit(0), 5).count() == 0


def test_privacy(spark):
    df = spark.createDataFrame([("call 13812345678 now", ["a@b.cc"]), ("113812345678", ["ok"]), (None, None)], "t string, l array<string>")
    hits = {(r["kind"], r["field"]): r["hits"] for r in quality.privacy_audit(df, ["t"], ["l"]).collect()}
    assert hits["phone", "t"] == 1 and hits["email", "l"] == 1 and hits["id_card", "t"] == 0


def test_privacy_needs(spark):
    """The quick test before each pattern passes whatever the pattern finds."""
    texts = ["a@b.cc", "@", "x@y", "113812345678", "13812345678", "tel 13812345678.", "1234567890123456789", "12345678901234567X", "id 12345678901234567x!", "123456789012345678X", "", None]
    assert quality.NEEDED.keys() == quality.PRIVATE.keys()
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    plain = {k: df.filter(F.rlike("t", F.lit(p))).count() for k, p in quality.PRIVATE.items()}
    assert {r["kind"]: r["hits"] for r in quality.privacy_audit(df, ["t"]).collect()} == plain and all(plain.values())


def test_streams(spark, tmp_path):
    source = str(tmp_path / "in")
    rows = [(1, 1, "2026-4-3 10:52:36"), (1, 1, "2026-4-3 10:52:36"), (1, 2, "2026-4-3 10:53:00")]
    spark.createDataFrame(rows, "tid long, floor int, post_time string").coalesce(1).write.parquet(source)
    stream = spark.readStream.schema("tid long, floor int, post_time string").parquet(source)
    for k, frame in enumerate((streams.first_seen(stream), streams.first_seen(streams.with_event_time(stream), "1 hour"))):
        q = frame.writeStream.format("memory").queryName(f"seen{k}").outputMode("append").trigger(availableNow=True).start()
        q.awaitTermination()
        assert spark.table(f"seen{k}").count() == 2
    q = streams.running_counts(stream).writeStream.format("memory").queryName("counts").outputMode("update").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("counts").first()["posts"] == 3


def test_floors_of_a_giant_thread(spark):
    """A thread of 200,000 posts, and pages with gaps or without a number: both numberings agree, and no window holds a thread's posts."""
    giant = spark.range(200_000).select(F.lit(1).cast("long").alias("tid"), (F.floor(F.col("id") / 15) + 1).cast("int").alias("page"), (F.pmod("id", F.lit(15)) + 1).cast("int").alias("position"))
    rows = [(2, 1, 1), (2, 1, 4), (2, 7, 2), (2, 3, 9), (2, None, 1), (3, 5, 5)]
    posts = giant.unionByName(spark.createDataFrame(rows, "tid long, page int, position int"))
    one, other = archive.number_by_pages(posts), archive.number_floors(posts)
    key = ["tid", "page", "position", "floor"]
    assert one.count() == 200_006 and one.select(*key).exceptAll(other.select(*key)).count() == 0
    assert [r["floor"] for r in one.filter("tid = 2").orderBy("page", "position").collect()] == [1, 2, 3, 4, 5]


def test_unseen_shuffles_little(spark):
    """Archived posts are left out before what is new is compared; of repeated ones the same stays."""
    stored = spark.createDataFrame([(1, 1)], "tid long, floor int")
    parsed = spark.createDataFrame([("a", 1, 1), ("b", 1, 2), ("c", 1, 2), ("c", None, 2)], "v string, tid long, floor int")
    found = incremental.unseen_floors(parsed, stored)
    best = archive.one_each(parsed.filter("tid = 1 and floor = 2"), ["tid", "floor"]).first()["v"]
    assert sorted(map(str, found.select("tid", "floor", "v").collect())) == sorted(map(str, spark.createDataFrame([(1, 2, best), (None, 2, "c")], "tid long, floor int, v string").collect()))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Aggregate") < plan.index("LeftAnti")
