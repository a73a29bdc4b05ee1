"""Canonical exact document fingerprints.

A text is put in Unicode form NFKC, case-folded, its white-space runs become one
space and its ends are stripped; the fingerprint is the 128-bit xxh3 of the
UTF-8 bytes. Documents with equal digests are then compared byte by byte, by
the smallest and largest canonical form of each group, which Spark combines
before it shuffles; texts without an equal digest are left out before they reach
Python again, by a hash of the text. Where forms differ (a collision) the SHA-256 of the canonical
form is appended, so equal fingerprints of documents mean equal canonical texts.
Edited texts have the same kind of fingerprint; that of an edited text is not
itself compared by bytes with those of others.

To pair each document with the next one by doc_id, documents are sorted once by
range partitions; each partition pairs its rows as they stream by and hands out
its first and last text, which are joined by the partitions' numbers.
Defined cases: a null text is empty; a task holds three forms of a very long
text at a time; equal doc_ids follow each other by text hash, null doc_ids come
first; repeated rows have equal fingerprints; an empty table gives no rows;
columns other than the named ones are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .scratch import parallelism, written

#: Repeated digests, or hashes of their texts, that are broadcast, some 20 MB; with more, rows are joined by shuffling.
BROADCAST_DIGESTS = 200_000

_RUN = re.compile(r"\s+")


def canonical(text: str) -> bytes:
    """The canonical form whose bytes are compared."""
    folded = text.casefold() if text.isascii() else unicodedata.normalize("NFKC", unicodedata.normalize("NFKC", text).casefold())
    return " ".join(_RUN.split(folded.strip())).encode("utf-8", "surrogatepass") if folded else b""


def digest(form: bytes) -> str:
    return xxhash.xxh3_128_hexdigest(form)


PAIRED = "doc_id long, n_chars long, edited_sha256 string, fp string, edited_fp string, near_edited double, near_next double, sha string, edited_sha string, tag long"
_FIELDS = [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fp", pa.string()), ("edited_fp", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()), ("sha", pa.string()), ("edited_sha", pa.string()), ("tag", pa.int64())]
#: Rows of a partition's pass: a pair, or (edge 0 or 1) its first or last text.
STREAMED = f"{PAIRED}, part int, edge int, edge_text string"
_STREAMED = pa.schema([*_FIELDS, ("part", pa.int32()), ("edge", pa.int32()), ("edge_text", pa.string())])


def edited_text(text: str, following: str) -> str:
    """``text`` with its last half replaced by the start of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def compare(one: int | None, text: str, following: str, tag: int, form: bytes | None = None, next_form: bytes | None = None) -> dict:
    """A document's row, given the text that follows it; ``tag`` is a hash of its own text, to find that again."""
    form = canonical(text) if form is None else form
    next_form = canonical(following) if next_form is None else next_form
    edited = edited_text(text, following)
    edited_form = canonical(edited)
    return {
        "doc_id": one,
        "n_chars": len(text),
        "edited_sha256": hashlib.sha256(edited.encode()).hexdigest(),
        "fp": digest(form),
        "edited_fp": digest(edited_form),
        "near_edited": float(form == edited_form),
        "near_next": float(form == next_form),
        "sha": hashlib.sha256(form).hexdigest(),
        "edited_sha": hashlib.sha256(edited_form).hexdigest(),
        "tag": tag,
    }


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    part, held = TaskContext.get().partitionId(), None
    for batch in batches:
        out = []
        for one, text, tag in zip(*(c.to_pylist() for c in batch.columns)):
            form = canonical(text)
            if held is None:
                out.append({"doc_id": one, "part": part, "edge": 0, "edge_text": text})
            else:
                out.append(compare(held[0], held[1], text, held[2], held[3], form))
            held = (one, text, tag, form)
        if out:
            yield pa.RecordBatch.from_pylist(out, _STREAMED)
    if held is not None:
        yield pa.RecordBatch.from_pylist([{"doc_id": held[0], "part": part, "edge": 1, "edge_text": held[1], "tag": held[2]}], _STREAMED)


def _join_edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [compare(*r) for r in zip(*(c.to_pylist() for c in batch.columns))]
        if rows:
            yield pa.RecordBatch.from_pylist(rows, pa.schema(_FIELDS))


def with_next(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Each document's digests, those of its edited text, and their likeness (1 equal, 0 not)."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")).withColumn("tag", F.xxhash64("text"))
    keys = ["doc_id", "tag"]
    ordered = rows.repartitionByRange(parallelism(docs.sparkSession), *keys).sortWithinPartitions(*keys, "text")
    streamed = written(ordered.mapInArrow(_stream, STREAMED), "paired")
    # a text follows another partition's last one by the partitions' numbers, which are all that one task orders
    edges = streamed.filter("edge is not null")
    firsts, lasts = edges.filter("edge = 0").select(F.col("part").alias("at"), F.col("edge_text").alias("following")), edges.filter("edge = 1")
    along = Window.orderBy("at")
    lowest = F.min("at").over(along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    after = firsts.select("at").select("at", F.coalesce(F.lead("at").over(along), lowest).alias("next"))
    pairs = lasts.join(after, F.col("part") == F.col("at")).drop("at").join(firsts, F.col("next") == F.col("at"))
    joined = pairs.select("doc_id", "edge_text", "following", "tag").mapInArrow(_join_edges, PAIRED)
    return streamed.filter("edge is null").select(*joined.columns).unionByName(joined)


def collided(docs: DataFrame, tags: DataFrame, text: str = "text") -> DataFrame:
    """Digests (fp) whose documents have different canonical bytes; ``tags``: hashes of the texts to compare."""

    def forms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [canonical(t) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([digest(f) for f in made], pa.string()), pa.array(made, pa.binary())], names=["fp", "form"])

    texts = docs.select(F.coalesce(F.col(text), F.lit("")).alias("text")).withColumn("tag", F.xxhash64("text"))
    same = texts.join(tags, "tag", "left_semi").select("text").mapInArrow(forms, "fp string, form binary").groupBy("fp").agg(F.min("form").alias("low"), F.max("form").alias("high"))
    return same.filter("low <> high").select("fp")


def _small(table: DataFrame) -> DataFrame:
    return F.broadcast(table) if table.count() <= BROADCAST_DIGESTS else table


def _settled(rows: DataFrame, docs: DataFrame, text: str, columns: list[tuple[str, str]]) -> DataFrame:
    """``rows`` with each (digest, sha) pair of ``columns`` made one fingerprint; byte comparison decides where sha is needed."""
    repeated = written(rows.groupBy("fp").count().filter("count > 1").select("fp"), "repeated")
    tags = written(rows.join(_small(repeated), "fp", "left_semi").select("tag").distinct(), "compared")
    bad = written(collided(docs, _small(tags), text), "collisions")
    for plain, sha in columns:
        marked = bad.select(F.col("fp").alias("__bad"))
        rows = rows.join(marked, F.col(plain) == F.col("__bad"), "left").withColumn(plain, F.when(F.col("__bad").isNull(), F.col(plain)).otherwise(F.concat(plain, F.lit("-"), sha))).drop("__bad")
    return rows


def fingerprints(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, fingerprint and first_id (the smallest doc_id with that fingerprint) of every row."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            forms = [canonical(t) for t in batch.column(1).to_pylist()]
            made = [pa.array([digest(f) for f in forms], pa.string()), pa.array([hashlib.sha256(f).hexdigest() for f in forms], pa.string())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *made, batch.column(2)], names=["doc_id", "fp", "sha", "tag"])

    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")).withColumn("tag", F.xxhash64("text"))
    rows = _settled(written(texts.mapInArrow(each, "doc_id long, fp string, sha string, tag long"), "digests"), docs, text, [("fp", "sha")])
    firsts = rows.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    return rows.join(firsts, "fp").select("doc_id", F.col("fp").alias("fingerprint"), "first_id")


def fingerprint_documents(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Every row of :func:`with_next` with fingerprints settled by byte comparison."""
    rows = _settled(with_next(docs, text, doc_id), docs, text, [("fp", "sha"), ("edited_fp", "edited_sha")])
    return rows.select("doc_id", "n_chars", "edited_sha256", F.col("fp").alias("fingerprint"), F.col("edited_fp").alias("edited_fingerprint"), "near_edited", "near_next")
