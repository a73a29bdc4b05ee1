"""An archive kept in bucketed tables, of which an update touches only the boards that it concerns.

Posts are partitioned by board and bucketed by (tid, floor), so that a giant
thread spreads over all buckets and unseen floors are found without moving a
stored post; threads are partitioned by board and bucketed by tid, so that an upsert
leaves the stored rows where they are. An update appends posts, and rewrites the
folders of the boards whose threads changed and no others.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.vocab import Vocab
from . import archive

KEYS = {"posts": ["tid", "floor"], "threads": ["tid"]}


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A session setting for as long as a block runs."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


@dataclass(frozen=True)
class Store:
    """Tables ``<name>_posts`` and ``<name>_threads``, with their files under ``root``, which all executors share."""

    spark: SparkSession
    name: str
    root: str
    buckets: int = 64

    def table(self, kind: str) -> str:
        return f"{self.name}_{kind}"

    def path(self, kind: str) -> str:
        return f"{self.root.rstrip('/')}/{kind}"

    def create(self, posts: DataFrame, threads: DataFrame) -> "Store":
        """Write new tables; a fixed number of buckets, so raise it with the size of the archive."""
        for kind, rows in (("posts", posts), ("threads", threads)):
            keys = KEYS[kind]
            writer = rows.repartition(self.buckets, *keys).write.format("parquet").partitionBy("fid")
            writer.bucketBy(self.buckets, *keys).sortBy(*keys).option("path", self.path(kind)).saveAsTable(self.table(kind))
        return self

    def open(self, posts_ddl: str, threads_ddl: str) -> "Store":
        """Make files that an earlier session wrote known to this one."""
        for kind, ddl in (("posts", posts_ddl), ("threads", threads_ddl)):
            keys = ", ".join(KEYS[kind])
            self.spark.sql(
                f"CREATE TABLE IF NOT EXISTS {self.table(kind)} ({ddl}) USING parquet PARTITIONED BY (fid)"
                f" CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {self.buckets} BUCKETS LOCATION '{self.path(kind)}'"
            )
            self.spark.catalog.recoverPartitions(self.table(kind))
        return self

    def posts(self) -> DataFrame:
        return self.spark.table(self.table("posts"))

    def threads(self) -> DataFrame:
        return self.spark.table(self.table("threads"))

    def unseen(self, parsed: DataFrame, fids: list[int]) -> DataFrame:
        """Posts of ``parsed`` that boards ``fids`` do not hold; the stored side is read by bucket and not shuffled."""
        stored = self.posts().filter(F.col("fid").isin(fids)).select("tid", "floor")
        fresh = archive.one_each(parsed, ["tid", "floor"])
        return fresh.hint("shuffle_merge").join(stored.hint("shuffle_merge"), ["tid", "floor"], "left_anti").select(*self.posts().columns)

    def rolled_up(self, touched: DataFrame, fids: list[int], last_crawl: str, vocab: Vocab) -> DataFrame:
        """Thread rows of ``touched`` threads from their stored posts; what is shuffled are partial results, a row per thread and task."""
        own = self.posts().filter(F.col("fid").isin(fids)).join(touched.select("tid"), "tid", "left_semi")
        return archive.thread_rollup(own, vocab, F.lit(last_crawl)).select(*self.threads().columns)

    def upserted(self, rows: DataFrame, fids: list[int]) -> DataFrame:
        """All thread rows of boards ``fids``, those of ``rows`` in place of stored ones; stored rows are not shuffled."""
        stored = self.threads().filter(F.col("fid").isin(fids))
        kept = stored.hint("shuffle_merge").join(rows.select("tid").hint("shuffle_merge"), "tid", "left_anti")
        return kept.select(*rows.columns).unionByName(rows)

    def stale(self, fids: list[int]) -> DataFrame:
        """tid of threads of boards ``fids`` whose row is missing or counts other posts than are stored."""
        now = archive.post_counts(self.posts().filter(F.col("fid").isin(fids)))
        rows = self.threads().filter(F.col("fid").isin(fids)).select("tid", "post_count")
        return now.join(rows, "tid", "left").filter(~F.col("posts").eqNullSafe(F.col("post_count").cast("long"))).select("tid")

    def update(self, parsed: DataFrame, last_crawl: str, vocab: Vocab = Vocab()) -> list[int]:
        """Add the unseen posts of ``parsed`` (full records), and bring the rows of their threads up to date; the boards touched.

        Threads are found by comparing counts after posts were added, so a run that
        broke off in between is finished by the next; a repeated run changes nothing.
        """
        fids = sorted(r["fid"] for r in parsed.select("fid").distinct().collect())  # a row per board
        if not fids:
            return []
        self.unseen(parsed, fids).write.insertInto(self.table("posts"))
        fresh = self.rolled_up(self.stale(fids), fids, last_crawl, vocab)
        # what is written replaces what it is made from: a table of the touched threads alone stands between
        path = f"{self.root.rstrip('/')}/rolled/{last_crawl or 'now'}"
        fresh.write.mode("overwrite").parquet(path)
        rows = self.spark.read.schema(fresh.schema).parquet(path)
        touched = sorted(r["fid"] for r in rows.select("fid").distinct().collect())
        if touched:
            with setting(self.spark, "spark.sql.sources.partitionOverwriteMode", "dynamic"):
                self.upserted(rows, touched).write.mode("overwrite").insertInto(self.table("threads"), overwrite=True)
        return touched

    def drop(self) -> None:
        """Forget the tables; their files stay."""
        for kind in KEYS:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.table(kind)}")
