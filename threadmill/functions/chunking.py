"""Retrieval chunks of posts: cues, labels, prefix, and splitting at sentence ends."""

from __future__ import annotations

import re
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas
from . import tagging
from .matching import any_among, hits, literal
from .textops import SPACE, head, normalize, slices, strip
from .vocab import Vocab

SENTENCE_END = re.compile(r"(?<=[。？！.?!])\s*")


def sentences(text: Column) -> Column:
    """Pieces that end at a sentence end, its following white space removed; blank pieces left out."""
    return F.filter(F.split(text, r"(?U)(?<=[。？！.?!])\s*"), lambda s: strip(s) != "")


def windows(text: Column, max_chars: int, overlap: int) -> Column:
    """Stripped windows of ``max_chars`` that start every ``max_chars - overlap`` characters, blank ones left out."""
    step = max(1, max_chars - overlap)
    starts = F.when(F.length(text) > 0, F.sequence(F.lit(0), F.length(text) - 1, F.lit(step))).otherwise(F.array().cast("array<int>"))
    return F.filter(F.transform(starts, lambda s: strip(F.substring(text, s + 1, F.lit(max_chars)))), lambda w: w != "")


def _cut(text: str, max_chars: int, overlap: int) -> list[str]:
    step = max(1, max_chars - overlap)
    parts = (text[at : at + max_chars].strip() for at in range(0, len(text), step))
    return [p for p in parts if p]


def split_long(text: str, max_chars: int, overlap: int, dedupe_tail: bool = False) -> list[str]:
    """Chunks of a text longer than ``max_chars``: sentences packed in order, with overlapping ends.

    A sentence over the limit becomes fixed windows, and the end of the last one
    opens the next chunk, also when nothing follows unless ``dedupe_tail``.
    """
    done: list[str] = []
    open_, only_tail = "", False

    def close() -> None:
        if open_.strip() and not (dedupe_tail and only_tail):
            done.append(open_.strip())

    for piece in filter(str.strip, SENTENCE_END.split(text)):
        if len(piece) > max_chars:
            close()
            done += _cut(piece, max_chars, overlap)
            open_, only_tail = (done[-1][-overlap:], True) if done and overlap > 0 else ("", False)
        elif open_ and len(open_) + len(piece) > max_chars:
            done.append(open_.strip())
            open_ = (open_[-overlap:] if 0 < overlap < len(open_) else "") + piece
            only_tail = False
        else:
            open_, only_tail = open_ + piece, False
    close()
    return done


def _split_all(texts: pa.Array, max_chars: int, overlap: int, dedupe_tail: bool) -> pa.Array:
    kind, cut = pa.list_(pa.string()), lambda t: None if t is None else split_long(t, max_chars, overlap, dedupe_tail)
    return pa.chunked_array([pa.array(map(cut, some.to_pylist()), kind) for some in slices(texts)], kind).combine_chunks()


def folded(text: Column, max_chars: int, overlap: int, dedupe_tail: bool = False) -> Column:
    """What :func:`split_long` returns, as a fold over the sentences without Python.

    The fold's state holds the chunks done, the open one, and whether that is only the end of a cut sentence.
    """
    none = F.array().cast("array<string>")
    state = lambda done, open_, tail: F.struct(done.alias("done"), open_.alias("open"), tail.alias("tail"))
    end = lambda s: F.right(s, F.lit(overlap)) if overlap > 0 else F.lit("")

    def closed(at: Column) -> Column:
        kept = strip(at["open"]) != ""
        return F.when(kept & ~at["tail"] if dedupe_tail else kept, F.array(strip(at["open"]))).otherwise(none)

    def step(at: Column, piece: Column) -> Column:
        size, cut = F.length(at["open"]), windows(piece, max_chars, overlap)
        kept = F.when(size > overlap, end(at["open"])).otherwise(F.lit(""))
        return (
            F.when(F.length(piece) > max_chars, state(F.concat(at["done"], closed(at), cut), end(F.element_at(cut, -1)), F.lit(overlap > 0)))
            .when((size > 0) & (size + F.length(piece) > max_chars), state(F.concat(at["done"], F.array(strip(at["open"]))), F.concat(kept, piece), F.lit(False)))
            .otherwise(state(at["done"], F.concat(at["open"], piece), F.lit(False)))
        )

    pieces = F.filter(F.split(text, f"(?<=[。？！.?!])[{SPACE}]*"), lambda s: strip(s) != "")
    return F.aggregate(pieces, state(none, F.lit(""), F.lit(False)), step, lambda at: F.concat(at["done"], closed(at)))


def chunks(text: Column, max_chars: int = 1500, overlap: int = 200, dedupe_tail: bool = False, fold: bool = False) -> Column:
    """``array<string>`` of chunks. A text within the limit is one chunk, made without Python work on it.

    ``fold`` makes the others by :func:`folded`: no Python, but half as fast, and slower still for texts of millions of characters.
    """
    if fold:
        return F.when(F.length(text) > max_chars, folded(text, max_chars, overlap, dedupe_tail)).otherwise(F.array(text))

    @F.arrow_udf("array<string>")
    def long_texts(texts: pa.Array) -> pa.Array:
        return _split_all(texts, max_chars, overlap, dedupe_tail)

    long = F.when(F.length(text) > max_chars, text)  # short texts cross to Python as nulls
    return F.coalesce(long_texts(long), F.array(text))


def cues(title: Column, text: Column, vocab: Vocab = Vocab()) -> Column:
    """Names of the cue categories with a word in title or text, comma-joined in fixed order."""
    hay = F.concat(F.coalesce(title, F.lit("")), F.lit("\n"), text)
    every = {w for words in vocab.cues.values() for w in words}
    if len(every) < tagging.MANY_WORDS or "" in every:
        found = lambda words: F.exists(literal(words), lambda w: F.contains(hay, w))
    else:
        scan = hits(hay, every)
        found = lambda words: any_among(scan, words)
    named = [F.when(found(words), F.lit(name)) for name, words in vocab.cues.items()]
    return F.array_join(F.array_compact(F.array(*named)), ",")


def source_label(title: Column, text: Column, labels: Sequence[str] = Vocab().labels) -> Column:
    """What the first matching label pattern finds in the title and the text's first 800 characters."""
    hay = F.concat(F.coalesce(title, F.lit("")), F.lit("\n"), head(text, 800))
    return F.coalesce(*[F.nullif(F.regexp_extract(hay, p, 0), F.lit("")) for p in labels], F.lit(""))


def chunk_prefix(board: Column, title: Column, floor: Column, author: Column, post_time: Column, url: Column, tags: Column, cue: Column) -> Column:
    """The lines that every chunk of a post starts with."""
    line = F.concat(F.lit("【"), board, F.lit("】《"), title, F.lit("》第"), floor.cast("string"), F.lit("楼｜"), author, F.lit("｜"), post_time, F.lit("\n链接: "), url, F.lit("\n"))
    with_tags = F.when(F.size(tags) > 0, F.concat(F.lit("标签: "), F.array_join(tags, "，"), F.lit("\n"))).otherwise(F.lit(""))
    with_cues = F.when(cue != "", F.concat(F.lit("语义线索: "), cue, F.lit("\n"))).otherwise(F.lit(""))
    return F.concat(line, with_tags, with_cues, F.lit("\n"))


def chunk_id(fid: Column, tid: Column, floor: Column, index: Column) -> Column:
    return F.format_string("fid%d_tid%d_f%d_idx%d", fid, tid, floor, index)


def to_chunks(posts: DataFrame, max_chars: int = 1500, overlap: int = 200, vocab: Vocab = Vocab(), dedupe_tail: bool = False, fold: bool = False) -> DataFrame:
    """Retrieval records (text, source, id) of every post with content."""
    full = schemas.with_defaults(posts, schemas.POSTS_DDL)
    # what normalizing leaves something of; said of the raw text, the test stops at its first word
    norm = full.filter(F.rlike("content", F.lit(f"[^{SPACE}\ufffd]"))).withColumn("content", normalize(F.col("content")))
    marked = norm.withColumn("cues", cues(F.col("title"), F.col("content"), vocab)).withColumn("source_label", source_label(F.col("title"), F.col("content"), vocab.labels))
    names = ("board", "title", "floor", "author", "post_time", "url", "tags", "cues")
    ready = marked.withColumn("prefix", chunk_prefix(*[F.col(n) for n in names])).withColumn("parts", chunks(F.col("content"), max_chars, overlap, dedupe_tail, fold))
    # outer, or Spark would run the Python step once more to test the list's size; a post has one chunk at least
    each = ready.select("*", F.size("parts").alias("chunk_count"), F.posexplode_outer("parts").alias("at", "part")).withColumn("chunk_index", F.col("at") + 1)
    fields = [f.name for f in schemas.struct(schemas.CHUNKS_DDL)["source"].dataType]
    return each.select(F.concat("prefix", "part").alias("text"), F.struct(*fields).alias("source"), chunk_id(F.col("fid"), F.col("tid"), F.col("floor"), F.col("chunk_index")).alias("id"))


def chunk_statistics(posts: DataFrame, chunk_table: DataFrame) -> DataFrame:
    """One row: posts (also empty ones), chunks, and chunks per post."""
    n = posts.agg(F.count("*").alias("posts"))
    m = chunk_table.agg(F.count("*").alias("chunks"))
    return n.crossJoin(m).withColumn("mean_chunks", F.col("chunks") / F.greatest(F.col("posts"), F.lit(1)))
