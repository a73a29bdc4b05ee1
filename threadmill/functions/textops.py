"""Cleaning text: HTML to paragraphs, entities, white space, legacy encodings."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: White space as Python's str.strip and \s see it, for use in character classes.
SPACE = r"\x09-\x0D\x1C-\x20\x85\xA0\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"

#: The same characters one by one.
BLANKS = "".join(map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))

# Named entities in the order in which they are replaced.
ENTITIES = (
    ("&nbsp;", " "),
    ("&amp;", "&"),
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&quot;", '"'),
    ("&#39;", "'"),
    ("&apos;", "'"),
    ("&mdash;", "—"),
    ("&ndash;", "–"),
    ("&hellip;", "…"),
    ("&lsquo;", "'"),
    ("&rsquo;", "'"),
    ("&ldquo;", '"'),
    ("&rdquo;", '"'),
)


#: Bytes of texts that a Python step works on at a time.
SLICE_BYTES = 1 << 20


def slices(rows: pa.RecordBatch | pa.Array, text: int = 0) -> Iterator:
    """Consecutive rows of ``rows``, texts or a batch with them in column ``text``, of at most ``SLICE_BYTES`` of text or one row.

    A batch that Spark hands over may have 10,000 texts; what Python makes of them is held for a slice only.
    """
    sizes = pc.binary_length(rows if isinstance(rows, pa.Array) else rows.column(text)).fill_null(0).to_pylist()
    start = total = 0
    for at, size in enumerate(sizes):
        if at > start and total + size > SLICE_BYTES:
            yield rows.slice(start, at - start)
            start, total = at, 0
        total += size
    if start < len(sizes):
        yield rows.slice(start)


def strip(text: Column) -> Column:
    """Without Unicode white space at both ends."""
    return F.btrim(text, F.lit(BLANKS))


def collapse(text: Column, by: str = " ") -> Column:
    """Runs of white space replaced by ``by``."""
    return F.regexp_replace(text, f"[{SPACE}]+", by)


def strip_tags(html: Column) -> Column:
    return F.regexp_replace(html, "<[^>]+>", "")


@F.arrow_udf(StringType())
def _numeric_entities(texts: pa.Array) -> pa.Array:
    def char(digits: str, base: int) -> str:
        digits = digits.lstrip("0") or "0"
        # beyond the last code point, however many digits there are
        code = int(digits, base) if len(digits) <= 8 else 0x110000
        if code >= 0x110000:
            return ""
        return "?" if 0xD800 <= code <= 0xDFFF else chr(code)

    def one(text: str | None) -> str | None:
        if text is None or "&#" not in text:
            return text
        text = re.sub(r"&#(\d+);", lambda m: char(m[1], 10), text)
        return re.sub(r"&#x([0-9a-fA-F]+);", lambda m: char(m[1], 16), text)

    return pa.chunked_array([pa.array(map(one, some.to_pylist()), pa.string()) for some in slices(texts)], pa.string()).combine_chunks()


def decode_numeric_entities(text: Column) -> Column:
    """Decimal, then lower-case-x hexadecimal references; surrogates become '?', larger numbers vanish.

    Only texts with ``&#`` go to Python. ``text`` stands twice in the result, so
    it should be a plain column, as :func:`with_clean_html` makes it.
    """
    return F.coalesce(_numeric_entities(F.when(F.contains(text, F.lit("&#")), text)), text)


def decode_named_entities(text: Column) -> Column:
    """The named entities one after the other, so that ``&amp;lt;`` ends as ``<``."""
    return reduce(lambda t, e: F.replace(t, F.lit(e[0]), F.lit(e[1])), ENTITIES, text)


def decode_entities(text: Column, numeric: bool = True) -> Column:
    named = decode_named_entities(text)
    return decode_numeric_entities(named) if numeric else named


def tidy(text: Column) -> Column:
    """Uniform line ends, no U+3000 or U+FFFD, single blanks, at most one empty line, stripped."""
    text = F.replace(F.replace(text, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))
    # replaced one by one, as translate goes through a text by characters
    text = F.replace(F.replace(text, F.lit("\u3000"), F.lit(" ")), F.lit("\ufffd"), F.lit(""))
    # a single blank, which stays, is no match
    text = F.regexp_replace(text, " [ \t]+|\t[ \t]*", " ")
    return strip(F.regexp_replace(text, "\n{3,}", "\n\n"))


def normalize(text: Column) -> Column:
    """:func:`tidy` with null as the empty string."""
    return tidy(F.coalesce(text, F.lit("")))


# Tags that become line ends, in the order in which they are replaced.
BREAKS = (r"(?i)<br\s*/?>", "(?i)<p[^>]*>", "(?i)</p>", "(?i)</?div[^>]*>", "(?i)<hr[^>]*>")


def break_blocks(html: Column) -> Column:
    """Block tags as line ends, other tags removed."""
    return strip_tags(reduce(lambda t, tag: F.regexp_replace(t, tag, "\n"), BREAKS, html))


def clean_html(html: Column, numeric: bool = True) -> Column:
    """The paragraphs of an HTML fragment as plain text.

    ``numeric=False`` leaves numeric references alone and stays in the JVM.
    """
    return tidy(decode_entities(break_blocks(html), numeric))


def with_clean_html(df: DataFrame, html: Column, name: str, numeric: bool = True) -> DataFrame:
    """``df`` with :func:`clean_html` of ``html`` as the column ``name``; the tags are taken out once."""
    plain = df.withColumn("__plain", decode_named_entities(break_blocks(html)))
    text = F.col("__plain")
    return plain.withColumn(name, tidy(decode_numeric_entities(text) if numeric else text)).drop("__plain")


def clean_title(html: Column, space: str = " ") -> Column:
    """A link's text: tags out, stripped, ``&nbsp;`` as a blank, white-space runs as ``space``."""
    return collapse(F.replace(strip(strip_tags(html)), F.lit("&nbsp;"), F.lit(" ")), space)


@F.pandas_udf(StringType())
def decode_gbk(body: pd.Series) -> pd.Series:
    """GBK bytes as text, illegal ones as U+FFFD; null stays null."""
    return body.map(lambda b: None if b is None else bytes(b).decode("gbk", "replace"))


def post_timestamp(text: Column) -> Column:
    """Timestamp of ``2026-4-3 10:52:36`` with or without padding; null on anything else."""
    return F.try_to_timestamp(strip(text), F.lit("yyyy-M-d H:mm:ss"))


def to_json_text(column: Column) -> Column:
    return F.to_json(column)


def from_json_text(column: Column, ddl: str) -> Column:
    return F.from_json(column, ddl)


def head(text: Column, n: int) -> Column:
    """The first ``n`` code points."""
    return F.substring(text, 1, n)
