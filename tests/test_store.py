"""Bucketed tables whose updates touch only the boards they concern."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import functions as F

from threadmill import schemas
from threadmill.operators import archive
from threadmill.operators.store import Store


def posts_of(spark, rows):
    return schemas.with_defaults(spark.createDataFrame(rows, "tid long, fid int, floor int, author string, content string, title string"), schemas.POSTS_DDL)


def files(root):
    return {str(p.relative_to(root)): p.stat().st_mtime_ns for p in Path(root).rglob("*.parquet")}


def store_of(spark, tmp_path, name):
    old = posts_of(spark, [(t, t % 3, f, "a", "队长", "2026春") for t in range(12) for f in (1, 2)])
    return Store(spark, name, str(tmp_path), 4).create(old, archive.thread_rollup(old, last_crawl=F.lit("t1")))


def test_update_of_one_board(spark, tmp_path):
    store = store_of(spark, tmp_path, "one_board")
    before = files(tmp_path)
    parsed = posts_of(spark, [(3, 0, 1, "a", "队长", "2026春"), (3, 0, 3, "b", "x", "2026春"), (3, 0, 3, "b", "x", "2026春"), (30, 0, 1, "c", "y", "新")])
    assert store.update(parsed, "t2") == [0]
    after = files(tmp_path)
    for kind in ("posts", "threads"):
        others = {k: v for k, v in before.items() if k.startswith(f"{kind}/fid=") and "fid=0/" not in k}
        assert others and all(after[k] == v for k, v in others.items())  # untouched files keep their names and times
    assert all(k in after for k in before if k.startswith("posts/"))  # posts are only added
    assert not any(k in after for k in before if k.startswith("threads/fid=0/"))
    rows = {r["tid"]: r for r in store.threads().collect()}
    assert len(rows) == 13 and rows[3]["post_count"] == 3 and rows[30]["post_count"] == 1 and rows[6]["last_crawl"] == "t1" and rows[3]["last_crawl"] == "t2"
    assert store.posts().count() == 26
    # a repeated run, and a second one after a break between the two writes
    now = files(tmp_path)
    assert store.update(parsed, "t3") == [] and {k: v for k, v in files(tmp_path).items() if not k.startswith("rolled/")} == {k: v for k, v in now.items() if not k.startswith("rolled/")}
    posts_of(spark, [(4, 1, 3, "z", "w", "2026春")]).select(*store.posts().columns).write.insertInto(store.table("posts"))
    assert store.update(posts_of(spark, [(4, 1, 3, "z", "w", "2026春")]), "t4") == [1]
    assert {r["tid"]: r["post_count"] for r in store.threads().collect()}[4] == 3
    store.drop()


def test_stored_rows_are_not_shuffled(spark, tmp_path):
    store = store_of(spark, tmp_path, "plans")
    parsed = posts_of(spark, [(3, 0, 3, "b", "x", "2026春")])
    plan = store.unseen(parsed, [0])._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Bucketed: true" in plan
    # below the join the stored side goes from its scan to the join without an exchange
    stored = plan[plan.index("SortMergeJoin") :]
    scan = stored.index("Bucketed: true")
    assert stored[:scan].rindex("Filter") > stored[:scan].rfind("Exchange") or "Exchange" not in stored[:scan]
    rows = store.threads().filter("fid = 0").limit(1)
    plan = store.upserted(rows, [0])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "Bucketed: true" in plan
    store.drop()


def test_open_in_another_session(spark, tmp_path):
    store = store_of(spark, tmp_path, "again")
    n = store.posts().count()
    store.drop()
    assert store.open(schemas.POSTS_DDL, schemas.THREADS_DDL).posts().count() == n
    assert store.update(posts_of(spark, [(3, 0, 9, "b", "x", "2026春")]), "t5") == [0]
    store.drop()
