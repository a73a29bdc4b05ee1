"""Schemas of the forum tables, and the defaults that stand for absent values."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_META = (
    "struct<rating_count int, rating_coins int, rating_details array<struct<uid long, username string, coins int, reason string>>,"
    " recommend_add int, recommend_subtract int, favorite_count int, comment_count int,"
    " comments array<struct<uid long, username string, content string>>>"
)


RAW_PAGES_DDL = "url string, body binary, fetched_at timestamp"
BOARDS_DDL = "fid int, board string, category string"
LISTINGS_DDL = "fid int, page int, pos int, tid long, title string"
POSTS_DDL = (
    "tid long, fid int, board string, category string, title string, author string, floor int, page int, position int,"
    " post_time string, content string, url string, tags array<string>, year string, season string, event_type string,"
    " activity_type string, routes array<string>, roles array<string>, problems array<string>"
)
META_DDL = f"meta {_META}"
POSTS_WITH_EXTRAS_DDL = f"{POSTS_DDL}, sticky int, {META_DDL}"
THREADS_DDL = (
    "tid long, fid int, board string, category string, title string, first_author string, first_time string, post_count int,"
    " tags array<string>, year string, season string, event_type string, routes array<string>, roles array<string>,"
    " problems array<string>, last_crawl string, url string"
)
CHUNKS_DDL = (
    "text string, source struct<fid int, board string, tid long, title string, floor int, chunk_index int, chunk_count int,"
    " author string, post_time string, url string, source_label string, cues string, tags array<string>, year string,"
    " season string, event_type string>, id string"
)


def struct(ddl: str) -> T.StructType:
    """A StructType from its DDL."""
    return T.StructType.fromDDL(ddl)


def with_defaults(df: DataFrame, ddl: str) -> DataFrame:
    """Columns of ``ddl`` in order: missing ones added, nulls replaced by '', 0 or [].

    ``page`` defaults to 1; structs stay null; columns beyond the schema are dropped.
    """
    columns = []
    for field in struct(ddl).fields:
        present = F.col(field.name).cast(field.dataType) if field.name in df.columns else F.lit(None).cast(field.dataType)
        if field.name == "page":
            fill = F.lit(1)
        elif isinstance(field.dataType, T.StringType):
            fill = F.lit("")
        elif isinstance(field.dataType, T.ArrayType):
            fill = F.array().cast(field.dataType)
        elif isinstance(field.dataType, T.NumericType):
            fill = F.lit(0).cast(field.dataType)
        else:
            fill = None
        columns.append((F.coalesce(present, fill) if fill is not None else present).alias(field.name))
    return df.select(*columns)
