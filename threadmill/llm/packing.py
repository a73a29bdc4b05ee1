"""Best-fit packing of documents into fixed-length training sequences.

Vector best fit: every open sequence has three residual capacities (tokens,
number of pieces, attention cost, which is the sum of squared piece lengths).
A piece goes to a sequence where it fits in all three and which the score
prefers: the smallest weighted norm of what would be left (``"norm"``), or the
largest weighted dot product of the piece with what is left (``"dot"``).

A piece whose own attention cost is above the bound has a sequence to itself, and
only such a sequence exceeds it.

Pieces are dealt round robin to groups of about ``group_pieces`` and each group
is packed on its own, longest piece first, so a task's memory does not grow
with the corpus, no key can be hot, and a group wastes about one sequence.

Defined cases: a null or empty text is a document of the end id alone; a very
long text is encoded by one task, some megabytes at a time, and cut into as many
pieces as it needs; null or repeated doc_ids are packed like any other row; of
sequences that score alike the one opened first is taken; an empty table gives
no rows; columns other than the named ones are ignored, whatever their names.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .scratch import written
from .wordbpe import encoder, forget, trim

#: Bytes of pieces, which may carry their ids, that wait to be packed together.
GROUP_BYTES = 128 << 20
#: Texts taken from a batch at a time, and bytes of ids from which pieces are handed on.
SOME, HAND_ON = 1000, 4 << 20
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
_TYPES = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]


def token_pieces(docs: DataFrame, tokenizer: str, max_tokens: int, end_id: int = 1, text: str = "text", doc_id: str = "doc_id", with_ids: bool = False, store_words: int | None = None) -> DataFrame:
    """Pieces of at most ``max_tokens`` ids of each whole text plus ``end_id``.

    ``with_ids`` adds the ids themselves as little-endian uint32.
    """
    end = np.array([end_id], dtype="<u4").tobytes()
    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids

    def made(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _TYPES)], names=names)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trim()
        encode = encoder(tokenizer, store_words).encode
        rows, held = [], 0
        for part in (batch.slice(at, SOME) for batch in batches for at in range(0, batch.num_rows, SOME)):
            for one, raw in zip(part.column(0).to_pylist(), encode(part.column(1).to_pylist())):
                raw += end
                held += len(raw)
                for piece, at in enumerate(range(0, len(raw), 4 * max_tokens)):
                    ids = raw[at : at + 4 * max_tokens]
                    rows.append((one, piece, at // 4, len(ids) // 4, zlib.crc32(ids), ids)[: len(names)])
                if held > HAND_ON:
                    yield made(rows)
                    rows, held = [], 0
        if rows:
            yield made(rows)

    narrow = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text"))
    return narrow.mapInArrow(cut, PIECES + ", ids binary" * with_ids)


def pack_group(lengths: np.ndarray, capacity: tuple[float, float, float], weights: tuple[float, float, float], score: str) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of each piece, given longest first.

    A piece costlier than the attention capacity counts as all of it, so nothing joins it.
    """
    cap, weight = np.array(capacity, dtype=float), np.array(weights, dtype=float)
    n = len(lengths)
    left = np.empty((3, max(16, n)))
    open_ids = np.empty(max(16, n), dtype=np.int64)
    used = np.zeros(n, dtype=np.int64)
    smallest = float(lengths.min()) if n else 0.0
    bins, offsets = np.empty(n, dtype=np.int64), np.empty(n, dtype=np.int64)
    count = made = 0
    for i, length in enumerate(lengths.tolist()):
        need = np.array([length, 1.0, min(float(length) * length, cap[2])])
        rest = left[:, :count] - need[:, None]
        fits = np.flatnonzero((rest[0] >= 0) & (rest[1] >= 0) & (rest[2] >= 0))
        if fits.size:
            if score == "dot":
                best = fits[np.argmax((weight * need / cap / cap) @ left[:, fits])]
            else:
                best = fits[np.argmin(weight @ np.square(rest[:, fits] / cap[:, None]))]
            left[:, best] = rest[:, best]
        else:
            best, open_ids[count] = count, made
            left[:, best] = cap - need
            count, made = count + 1, made + 1
        bins[i] = one = open_ids[best]
        offsets[i] = used[one]
        used[one] += length
        if left[0, best] < smallest or left[1, best] < 1 or left[2, best] < min(smallest**2, cap[2]):  # nothing fits any more: close it
            count -= 1
            left[:, best], open_ids[best] = left[:, count], open_ids[count]
    return bins, offsets


def pack(
    pieces: DataFrame,
    max_tokens: int,
    max_pieces: int | None = None,
    max_attention: float | None = None,
    weights: tuple[float, float, float] = (1.0, 0.01, 0.01),
    score: str = "norm",
    group_pieces: int = 16_384,
) -> DataFrame:
    """``pieces`` (a written table with ``length``, other columns as they are) with ``sequence_id`` and ``offset``.

    ``max_attention`` bounds a sequence's sum of squared lengths, by default at what
    ``max_tokens`` implies; only a sequence of one piece may exceed it.
    """
    capacity = (float(max_tokens), float(max_pieces or max_tokens), float(max_tokens**2 if max_attention is None else max_attention))
    groups = max(1, math.ceil(pieces.count() / group_pieces))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        forget()
        base, turn = TaskContext.get().partitionId(), 0
        waiting: list[pa.RecordBatch] = []

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal turn
            lengths = np.concatenate([b.column("length").to_numpy() for b in waiting])
            order = np.argsort(-lengths, kind="stable")
            bins, offsets = np.empty(len(order), dtype=np.int64), np.empty(len(order), dtype=np.int64)
            bins[order], offsets[order] = pack_group(lengths[order], capacity, weights, score)
            bins += (base << 40) + (turn << 26)
            turn += 1
            at = 0
            for part in waiting:  # batch by batch, so that pieces' ids are not copied
                here = slice(at, at := at + part.num_rows)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(bins[here]), pa.array(offsets[here])], names=[*part.schema.names, "sequence_id", "offset"])
            waiting.clear()

        for batch in batches:
            for at in range(0, batch.num_rows, 2 * group_pieces):
                part = batch.slice(at, 2 * group_pieces)
                full = sum(b.num_rows for b in waiting) + part.num_rows > 2 * group_pieces
                if waiting and (full or sum(b.nbytes for b in waiting) > GROUP_BYTES):
                    yield from flush()
                waiting.append(part)
        if waiting and sum(b.num_rows for b in waiting):
            yield from flush()

    schema = StructType([*pieces.schema.fields, StructField("sequence_id", LongType()), StructField("offset", LongType())])
    return pieces.repartition(groups).mapInArrow(place, schema)


def pack_documents(docs: DataFrame, tokenizer: str, max_tokens: int = 4096, end_id: int = 1, with_ids: bool = False, store_words: int | None = None, **options) -> DataFrame:
    """Tokenize, cut and pack every document; one row per piece. ``store_words`` bounds the words whose ids a worker keeps."""
    return pack(written(token_pieces(docs, tokenizer, max_tokens, end_id, with_ids=with_ids, store_words=store_words), "pieces"), max_tokens, **options)


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id, ids (array of int) and documents (doc_id, piece, offset, length) of pieces packed with their ids.

    A group is one sequence, so it is never larger than the token capacity.
    """

    def numbers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [np.frombuffer(b"".join(parts), "<u4").astype(np.int32) for parts in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], names=["sequence_id", "ids"])

    part = F.struct("offset", "doc_id", "piece", "length", "ids")
    whole = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(part)).alias("parts"))
    ids = whole.select("sequence_id", F.transform("parts", lambda p: p["ids"]).alias("ids")).mapInArrow(numbers, "sequence_id long, ids array<int>")
    documents = F.transform("parts", lambda p: F.struct(p["doc_id"].alias("doc_id"), p["piece"].alias("piece"), p["offset"].alias("offset"), p["length"].alias("length")))
    return ids.join(whole.select("sequence_id", documents.alias("documents")), "sequence_id")
