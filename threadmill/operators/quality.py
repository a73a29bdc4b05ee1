"""Checks on the archive: personal data in tags, stickies indexed twice, counts that must agree."""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Patterns of personal data; Java and RE2 read them alike.
PRIVATE = {
    "phone": r"(?:^|[^0-9])1[3-9][0-9]{9}(?:[^0-9]|$)",
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}",
    "id_card": r"(?:^|[^0-9])[1-9][0-9]{16}[0-9Xx](?:[^0-9Xx]|$)",
}
#: What every match of a pattern contains; quick to look for, and most texts hold none of it.
NEEDED = {"phone": "1[3-9][0-9]{9}", "email": "@", "id_card": "[0-9]{17}"}


def _matches(kind: str, text: Column) -> Column:
    return F.rlike(text, F.lit(NEEDED[kind])) & F.rlike(text, F.lit(PRIVATE[kind]))


def privacy_audit(df: DataFrame, texts: list[str] = (), lists: list[str] = ()) -> DataFrame:
    """kind, field, hits: rows of each field that hold personal data of each kind."""
    checks = []
    for kind in PRIVATE:
        private = partial(_matches, kind)
        checks += [(kind, name, F.count_if(private(F.col(name)))) for name in texts]
        checks += [(kind, name, F.count_if(F.exists(F.col(name), private))) for name in lists]
    # one pass over the table for all checks
    row = df.agg(*[c.alias(f"c{i}") for i, (_, _, c) in enumerate(checks)])
    entries = F.array(*[F.struct(F.lit(k).alias("kind"), F.lit(n).alias("field"), F.col(f"c{i}").alias("hits")) for i, (k, n, _) in enumerate(checks)])
    return row.select(F.explode(entries).alias("e")).select("e.*")


def sticky_twice(posts: DataFrame) -> DataFrame:
    """Global stickies (sticky = 2) that stand under more than one board."""
    return posts.filter("sticky = 2").groupBy("tid").agg(F.count_distinct("fid").alias("n_boards")).filter("n_boards > 1")


def index_matches(posts: DataFrame, index: DataFrame, keys: list[str] = ("tid", "floor")) -> DataFrame:
    """One row: posts, posts with text, and documents in the index; the last two must agree."""
    from .retrieval import FIELDS, tokens

    some = None
    for f in FIELDS:
        has = F.size(tokens(F.col(f))) > 0
        some = has if some is None else some | has
    n = posts.agg(F.count("*").alias("posts"), F.count_if(some).alias("with_words"))
    return n.crossJoin(index.select(*keys).distinct().agg(F.count("*").alias("indexed")))
