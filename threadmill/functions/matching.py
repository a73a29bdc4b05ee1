"""Finding the words of long lists in one pass over a text, as column expressions.

The words become one pattern shaped like a trie, tried under look-ahead at every
place of the text. Branches are halved under guards of character ranges, so a
place costs the logarithm of the number of words. A match is the longest word at
its place; every other word there is one of its prefixes, so lists are met with
the prefixes of the different matches.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Branches that are tried one after another.
FEW = 3


def _char(c: str) -> str:
    return f"\\x{{{ord(c):x}}}"


def _choice(branches: list[tuple[str, str]]) -> str:
    """A pattern for one of ``branches``, which are sorted by their first characters."""
    if len(branches) <= FEW:
        return "(?:" + "|".join(_char(c) + rest for c, rest in branches) + ")"
    half = len(branches) // 2
    low, high = branches[:half], branches[half:]
    return f"(?:(?=[{_char(low[0][0])}-{_char(low[-1][0])}]){_choice(low)}|{_choice(high)})"


def _trie(words: list[str], at: int) -> str:
    """A pattern for the rest of sorted, different ``words`` from character ``at``, longest first; they agree before it."""
    ends, longer = len(words[0]) == at, [w for w in words if len(w) > at]
    if not longer:
        return ""
    firsts: dict[str, list[str]] = {}
    for word in longer:
        firsts.setdefault(word[at], []).append(word)
    return _choice([(c, _trie(some, at + 1)) for c, some in firsts.items()]) + ("?" if ends else "")


def pattern(words: Iterable[str]) -> str:
    """A Java pattern whose first group is the longest of ``words`` at a place; none of them is empty."""
    found = sorted(set(words))
    if not found or not found[0]:
        raise ValueError("words must be given, and none be empty")
    return f"(?=({_trie(found, 0)}))"


def hits(text: Column, words: Iterable[str]) -> Column:
    """The different longest matches in ``text`` and their prefixes; [] for null."""
    longest = F.array_distinct(F.regexp_extract_all(text, F.lit(pattern(words)), 1))
    prefixes = F.flatten(F.transform(longest, lambda w: F.transform(F.sequence(F.lit(1), F.length(w)), lambda n: F.substring(w, F.lit(1), n))))
    return F.coalesce(prefixes, F.array().cast("array<string>"))


def literal(words: Sequence[str]) -> Column:
    return F.array(*[F.lit(w) for w in words]) if words else F.array().cast("array<string>")


def among(found: Column, words: Sequence[str]) -> Column:
    """The different ``words`` among :func:`hits`, in list order."""
    return F.array_intersect(literal(words), found)


def any_among(found: Column, words: Sequence[str]) -> Column:
    return F.arrays_overlap(literal(words), found)
