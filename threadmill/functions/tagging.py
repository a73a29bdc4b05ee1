"""Tags of a post in seven dimensions, as column expressions without UDFs."""

from __future__ import annotations

import unicodedata
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .matching import among, hits, literal
from .textops import SPACE, head
from .vocab import SEASONS, Vocab

#: Words of a scan from which one pattern over all of them takes the place of a search for each.
MANY_WORDS = 32

YEAR = r"(?:19|20)\p{Nd}{2}"
SHORT = rf"(\p{{Nd}}{{2}})[{SPACE}]*([{SEASONS}])"
#: Every decimal digit beyond ASCII, by Unicode's rule, and its value.
_DIGITS = [c for c in map(chr, range(0x80, 0x110000)) if c.isdecimal()]
_VALUES = "".join(str(unicodedata.digit(c)) for c in _DIGITS)


def contained(text: Column, words: Sequence[str], scanned: Sequence[str] = ()) -> Column:
    """The words that ``text`` contains, in list order.

    ``scanned`` names the words of every list that is looked for in the same text, so that one scan serves them all.
    """
    every = [*scanned, *words]
    # the scan knows a word once, and no empty one
    if len(set(every)) < MANY_WORDS or len(set(words)) < len(words) or "" in every:
        return F.filter(literal(words), lambda w: F.contains(text, w))
    return among(hits(text, every), words)


def first_contained(words: Sequence[str], *texts: Column) -> Column:
    """The first list word in the first text that contains one, else ''."""
    return F.coalesce(*[F.get(contained(t, words), F.lit(0)) for t in texts], F.lit(""))


def _found(text: Column, pattern: str, group: int) -> Column:
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


def scan_text(title: Column, content: Column) -> Column:
    """Title and the content's first 500 characters, where most tags are looked for."""
    return F.concat(title, F.lit("\n"), head(content, 500))


def year(title: Column, scan: Column) -> Column:
    """A four-digit year, or one from two digits before a season in the title."""
    plain = lambda found: F.translate(found, "".join(_DIGITS), _VALUES).try_cast("int")
    at_start, anywhere = plain(_found(title, rf"\A{SHORT}", 1)), plain(_found(title, SHORT, 1))
    short = F.coalesce(
        F.when(at_start < 50, at_start + 2000).otherwise(at_start + 1900),
        F.when(anywhere <= 50, anywhere + 2000).otherwise(anywhere + 1900),
    )
    return F.coalesce(_found(title, YEAR, 0), _found(scan, YEAR, 0), short.cast("string"), F.lit(""))


def season(title: Column, scan: Column) -> Column:
    start = head(title, 30)
    alone = [F.when(F.contains(start, F.lit(s)), F.lit(s)) for s in "暑寒春秋"]
    return F.coalesce(_found(title, SHORT, 2), _found(scan, SHORT, 2), *alone, F.lit(""))


def event_type(title: Column, vocab: Vocab) -> Column:
    return first_contained(vocab.event_types, head(title, 40), title)


def activity_type(title: Column, scan: Column, vocab: Vocab) -> Column:
    return first_contained(vocab.activity_types, title, head(scan, 200))


def merge_tags(year: Column, season: Column, event: Column, activity: Column, routes: Column, roles: Column, problems: Column, board: Column) -> Column:
    """All dimensions in order, without empties and repetitions."""
    short = F.when(season == "", F.lit("")).when(F.length(year) == 4, F.concat(F.substring(year, 3, 2), season)).otherwise(season)
    section = F.when(F.contains(board, F.lit("·")), F.substring_index(board, "·", 1)).otherwise(F.lit(""))
    every = F.concat(F.array(year, short, event, activity), routes, roles, problems, F.array(section))
    return F.array_distinct(F.filter(every, lambda t: t != ""))


def classify(title: Column, content: Column, board: Column | None = None, vocab: Vocab = Vocab()) -> dict[str, Column]:
    """The tag columns of a post by name; null inputs count as ''."""
    title, content = F.coalesce(title, F.lit("")), F.coalesce(content, F.lit(""))
    board = F.lit("") if board is None else F.coalesce(board, F.lit(""))
    scan = scan_text(title, content)
    found = {
        "year": year(title, scan),
        "season": season(title, scan),
        "event_type": event_type(title, vocab),
        "activity_type": activity_type(title, scan, vocab),
        "routes": contained(scan, vocab.routes),
        "roles": contained(content, vocab.roles, vocab.problems),
        "problems": contained(content, vocab.problems, vocab.roles),
    }
    return {"tags": merge_tags(*found.values(), board), **found}


def with_tags(posts: DataFrame, vocab: Vocab = Vocab(), title: str = "title", content: str = "content", board: str | None = "board") -> DataFrame:
    """``posts`` with its tag columns, replacing any it has."""
    columns = classify(F.col(title), F.col(content), F.col(board) if board else None, vocab)
    tagged = posts.withColumns({k: v for k, v in columns.items() if k != "tags"})
    # the merged list reads the columns just made, so no dimension is computed twice
    order = ("year", "season", "event_type", "activity_type", "routes", "roles", "problems")
    board_column = F.coalesce(F.col(board), F.lit("")) if board else F.lit("")
    return tagged.withColumn("tags", merge_tags(*[F.col(k) for k in order], board_column))
