"""State of streams: ranges of floors against sets, restarts, and what a batch reads."""

from __future__ import annotations

import numpy as np

from threadmill.streaming import stateful


def test_ranges_against_sets():
    rng = np.random.default_rng(1)
    for _ in range(200):
        seen, starts, ends = set(), np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
        for _ in range(6):
            floors = rng.integers(-3, 40, rng.integers(0, 12))
            new, starts, ends = stateful.added(starts, ends, floors)
            assert sorted(floors[new].tolist()) == sorted(set(floors.tolist()) - seen)
            seen |= set(floors.tolist())
            assert {x for a, b in zip(starts, ends) for x in range(a, b + 1)} == seen
            assert (starts[1:] > ends[:-1] + 1).all()


def test_restart(spark, tmp_path):
    """Three runs over one folder, each with earlier posts again; a giant thread has several states."""
    root = str(tmp_path)
    schema = "tid long, floor int, fid int, author string"
    lots = [(t, f, t % 2, "a") for t in (1, 2) for f in range(1, 9000, 7)]
    for run in range(3):
        spark.createDataFrame(lots[: len(lots) * (run + 1) // 3] + [(None, 1, 0, "x"), (3, None, 0, "x")], schema).coalesce(2).write.mode("append").parquet(f"{root}/landed")
        landed = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/landed")
        query = stateful.archive_unseen(spark, landed, f"{root}/archive", f"{root}/checkpoint")
        query.awaitTermination()
        # a batch reads what landed and the state, and nothing of the archive
        assert all("archive" not in s["description"] for p in query.recentProgress for s in [dict(description=x.description) for x in p.sources])
        assert spark.read.parquet(f"{root}/archive").count() == len(lots) * (run + 1) // 3
