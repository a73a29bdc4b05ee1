"""Threads pinned across boards, and exact samples per board."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

STICKY_BOARDS = 3


def listing_counts(listings: DataFrame) -> DataFrame:
    return listings.groupBy("fid").agg(F.count("*").alias("listed"))


def sticky_threads(listings: DataFrame, boards: int = STICKY_BOARDS) -> DataFrame:
    """tid, n_boards of threads listed on at least ``boards`` different boards."""
    pairs = listings.select("tid", "fid").distinct()
    return pairs.groupBy("tid").agg(F.count("*").alias("n_boards")).filter(F.col("n_boards") >= boards)


def boards_per_thread(listings: DataFrame) -> DataFrame:
    return listings.groupBy("tid").agg(F.sort_array(F.collect_set("fid")).alias("fids"))


def home_boards(listings: DataFrame) -> DataFrame:
    """Each thread's first listing by board, page and place."""
    row = F.struct("fid", "page", "pos", "title")
    return listings.groupBy("tid").agg(F.min(row).alias("__first")).select("tid", "__first.*")


def sticky_home(listings: DataFrame, boards: int = STICKY_BOARDS) -> DataFrame:
    """Global stickies with the board and title of their first listing."""
    return home_boards(listings.join(sticky_threads(listings, boards), "tid", "left_semi"))


def without_stickies(listings: DataFrame, boards: int = STICKY_BOARDS) -> DataFrame:
    return listings.join(sticky_threads(listings, boards), "tid", "left_anti")


def one_board_each(listings: DataFrame, boards: int = STICKY_BOARDS) -> DataFrame:
    """Listings in which a global sticky keeps only its first board."""
    home = sticky_home(listings, boards)
    rest = without_stickies(listings, boards).select(*home.columns)
    return home.unionByName(rest)


def board_sample(listings: DataFrame, n: int, seed: int = 42) -> DataFrame:
    """Exactly ``n`` threads of each board (all, if fewer), the same ones for the same seed.

    Spark keeps the n best of each board in every task before it shuffles.
    """
    draw = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("fid").cast("string"), F.col("tid").cast("string")))
    once = listings.groupBy("fid", "tid").agg(F.min_by("title", F.struct("page", "pos")).alias("title"))
    order = Window.partitionBy("fid").orderBy("__draw", "tid")
    return once.withColumn("__draw", draw).withColumn("draw_rank", F.row_number().over(order)).filter(F.col("draw_rank") <= n).drop("__draw")


def sample_threads(listings: DataFrame, n: int, seed: int = 42, boards: int = STICKY_BOARDS) -> DataFrame:
    """tid, fid, title, sticky (2 for global stickies, 0 for the sample of the others)."""
    pinned = sticky_home(listings, boards).select("tid", "fid", "title", F.lit(2).alias("sticky"))
    normal = board_sample(without_stickies(listings, boards), n, seed).select("tid", "fid", "title", F.lit(0).alias("sticky"))
    return pinned.unionByName(normal)


def board_report(listings: DataFrame, sample: DataFrame) -> DataFrame:
    """Per board: threads listed and threads sampled."""
    listed = listings.groupBy("fid").agg(F.count_distinct("tid").alias("threads"))
    taken = sample.groupBy("fid").agg(F.count("*").alias("sampled"))
    return listed.join(taken, "fid", "left").select("fid", "threads", F.coalesce("sampled", F.lit(0).cast("long")).alias("sampled"))


def sample_report(listings: DataFrame, sample: DataFrame, posts: DataFrame) -> DataFrame:
    """One row with totals, and per_board as a map of structs; :func:`sampled_tids` lists the threads."""
    per = board_report(listings, sample).agg(F.count("*").alias("boards_scanned"), F.map_from_entries(F.sort_array(F.collect_list(F.struct("fid", F.struct("threads", "sampled"))))).alias("per_board"))
    totals = sample.agg(
        F.count_if(F.col("sticky") == 2).alias("sticky_threads"),
        F.count_if(F.col("sticky") == 0).alias("normal_threads"),
        F.count_distinct("tid").alias("total_threads"),
    )
    return per.crossJoin(totals).crossJoin(posts.agg(F.count("*").alias("total_posts")))


def sampled_tids(sample: DataFrame) -> DataFrame:
    """The sampled threads in order, as a table beside the report."""
    return sample.select("tid").distinct().orderBy("tid")
