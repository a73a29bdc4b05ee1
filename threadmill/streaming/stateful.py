"""Streams that keep what they have seen in the state store, instead of reading the archive."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ..operators.store import setting
from .streams import first_seen

#: Floors of a thread that one state holds, so that a giant thread has many.
FLOORS_EACH = 4096
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def added(starts: np.ndarray, ends: np.ndarray, floors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which of ``floors`` (the first of each) lie outside the ranges, and the ranges with them.

    Ranges are sorted, do not touch and include their ends; floors of a thread are
    nearly gapless, so there are few.
    """
    _, first = np.unique(floors, return_index=True)
    new = np.zeros(len(floors), dtype=bool)
    new[first] = True
    at = np.searchsorted(starts, floors, side="right") - 1
    if len(starts):
        new &= (at < 0) | (floors > ends[np.maximum(at, 0)])
    edges = np.concatenate([starts, floors[new]]), np.concatenate([ends, floors[new]])
    order = np.argsort(edges[0], kind="stable")
    low, high = edges[0][order], edges[1][order]
    if not len(low):
        return new, low, high
    cut = np.flatnonzero(low[1:] > high[:-1] + 1) + 1
    return new, low[np.append(0, cut)], high[np.append(cut, len(high)) - 1]


class SeenFloors(StatefulProcessor):
    """Passes each floor of a thread on once; the state of a key is the ranges of floors seen."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("floors", "starts array<bigint>, ends array<bigint>")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        none: tuple[list, list] = ([], [])
        starts, ends = (np.array(x, dtype=np.int64) for x in (self.seen.get() if self.seen.exists() else none))
        for some in rows:
            new, starts, ends = added(starts, ends, some["floor"].to_numpy(dtype=np.int64))
            yield some[new].drop(columns="__block", errors="ignore")
        self.seen.update((starts.tolist(), ends.tolist()))

    def close(self) -> None:
        pass


def unseen_stream(posts: DataFrame) -> DataFrame:
    """A stream of posts, each (tid, floor) once over all batches and restarts.

    Of versions of a post the one that comes first stays; a batch reads no archive. Posts
    without a floor, which is no place in a thread, are left out. The session must use
    the RocksDB state store, as :func:`archive_unseen` sets it.
    """
    keyed = posts.filter("tid is not null and floor is not null").withColumn("__block", F.floor(F.col("floor") / FLOORS_EACH))
    return keyed.groupBy("tid", "__block").transformWithStateInPandas(statefulProcessor=SeenFloors(), outputStructType=posts.schema, outputMode="Append", timeMode="None")


def _written(rows: DataFrame, path: str, checkpoint: str, by: list[str]) -> StreamingQuery:
    # the file sink's log makes a batch's files count once, however often it runs
    sink = rows.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append")
    return sink.partitionBy(*by).trigger(availableNow=True).start()


def archive_unseen(spark: SparkSession, posts: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Archive a stream's unseen posts in a folder per board, until what has landed is done."""
    with setting(spark, "spark.sql.streaming.stateStore.providerClass", ROCKS):
        return _written(unseen_stream(posts), path, checkpoint, ["fid"])


def archive_recent(posts: DataFrame, path: str, checkpoint: str, delay: str, ts: str = "post_ts", keys: tuple[str, ...] = ("tid", "floor"), by: tuple[str, ...] = ("fid",)) -> StreamingQuery:
    """As :func:`archive_unseen`, by event time: keys are forgotten ``delay`` after the newest post.

    A post older than ``delay`` before the newest one is late and dropped, whether or not it
    came before (Spark goes by the batch before the last one, after a run has ended by the last
    one); a repeat that is not late is dropped by its key, which is kept longer than
    that. So nothing is archived twice, and state is bounded by what ``delay`` spans.
    """
    return _written(first_seen(posts, delay, ts, keys), path, checkpoint, list(by))
