"""Token ids in fixed-width bit-packed blocks.

File format: a Parquet table of blocks. A block holds whole documents in
ascending doc_id order: ``payload`` has each id in the fewest bits that the
vocabulary needs, little-endian bit order, padded to a byte; ``doc_ids`` and
``ends`` (ids up to the end of each document) are its index, ``shard`` and
``block`` give its place, ``first`` the ids before it in its shard, ``low`` and
``high`` its least and greatest doc_id. A reader needs one block row to decode
any document in it, with numpy alone, and the files' statistics of ``low`` and
``high`` say which file holds that row.

Shards are ranges of doc_id, so the files follow ascending doc_id order. A task
holds one block of ids, or one longer document's, beside the batch of texts that
Arrow hands it. Defined cases: a null or empty text has the end id only; a very
long text has a block to itself; null doc_ids come first; repeated doc_ids stay
next to each other, ordered by text; an empty table gives an empty file and no
rows; columns other than the named ones are ignored, whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .scratch import parallelism
from .wordbpe import encoder

BLOCKS = "shard int, block int, first long, n_ids long, bits int, low long, high long, doc_ids array<long>, ends array<long>, payload binary"
DIGESTS = "shard int, doc_id long, start_in_shard long, n_tokens long, ids_crc32 long"
_ARROW = pa.schema([("shard", pa.int32()), ("block", pa.int32()), ("first", pa.int64()), ("n_ids", pa.int64()), ("bits", pa.int32()), ("low", pa.int64()), ("high", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("ends", pa.list_(pa.int64())), ("payload", pa.binary())])


def bits_for(vocab_size: int) -> int:
    """Fewest bits that hold every id below ``vocab_size``."""
    return max(1, (int(vocab_size) - 1).bit_length())


def pack_bits(ids: np.ndarray, bits: int) -> bytes:
    """``bits`` low bits of each id, one after the other."""
    if bits == 8 or bits == 16 or bits == 32:
        return ids.astype(f"<u{bits // 8}").tobytes()
    parts = []
    for at in range(0, len(ids), 1 << 16):  # 8 ids end on a byte, so pieces join without a gap
        wide = np.ascontiguousarray(ids[at : at + (1 << 16)].astype("<u4"))
        grid = np.unpackbits(wide.view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")[:, :bits]
        parts.append(np.packbits(grid.ravel(), bitorder="little").tobytes())
    return b"".join(parts)


def unpack_bits(payload: bytes, n: int, bits: int, start: int = 0) -> np.ndarray:
    """``n`` ids from the ``start``-th on."""
    if bits == 8 or bits == 16 or bits == 32:
        width = bits // 8
        return np.frombuffer(payload, f"<u{width}", count=n, offset=start * width).astype("<u4")
    out = np.empty(n, dtype="<u4")
    raw = np.frombuffer(payload, np.uint8)
    for at in range(0, n, 1 << 16):
        k = min(1 << 16, n - at)
        low, high = (start + at) * bits, (start + at + k) * bits
        flat = np.unpackbits(raw[low // 8 : -(-high // 8)], bitorder="little")[low % 8 :][: k * bits].reshape(k, bits)
        full = np.zeros((k, 32), dtype=np.uint8)
        full[:, :bits] = flat
        out[at : at + k] = np.packbits(full, axis=1, bitorder="little").view("<u4").ravel()
    return out


def write_ids(docs: DataFrame, path: str, tokenizer: str, end_id: int = 1, block_ids: int = 1 << 16, shards: int | None = None, text: str = "text", doc_id: str = "doc_id") -> None:
    """Encode every whole text and write the blocks to ``path``."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        code, shard = encoder(tokenizer), TaskContext.get().partitionId()
        bits, end = bits_for(code.vocab_size), np.array([end_id], dtype="<u4").tobytes()
        block, first, ids, raws, size = 0, 0, [], [], 0

        def close() -> pa.RecordBatch:
            nonlocal block, first, ids, raws, size
            flat = np.frombuffer(b"".join(raws), "<u4")
            ends = np.cumsum([len(r) // 4 for r in raws])
            known = [i for i in ids if i is not None]
            row = {"shard": shard, "block": block, "first": first, "n_ids": len(flat), "bits": bits, "low": min(known, default=None), "high": max(known, default=None), "doc_ids": ids, "ends": ends.tolist(), "payload": pack_bits(flat, bits)}
            block, first, ids, raws, size = block + 1, first + len(flat), [], [], 0
            return pa.RecordBatch.from_pylist([row], _ARROW)

        for batch in batches:
            for one, raw in zip(batch.column(0).to_pylist(), code.encode(batch.column(1).to_pylist())):
                ids.append(one)
                raws.append(raw + end)
                size += len(raw) // 4 + 1
                if size >= block_ids:
                    yield close()
        if ids:
            yield close()

    narrow = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text"))
    n = shards or parallelism(docs.sparkSession)
    ordered = narrow.repartitionByRange(n, "doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"), "text")
    ordered.mapInArrow(blocks, BLOCKS).write.option("compression", "zstd").parquet(path)


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """Per document from the files: doc_id, start, n_tokens, ids_crc32."""
    table = spark.read.schema(BLOCKS).parquet(path)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                raw = memoryview(unpack_bits(row["payload"], row["n_ids"], row["bits"]).tobytes())
                start = 0
                for one, end in zip(row["doc_ids"], row["ends"]):
                    rows.append((row["shard"], one, row["first"] + start, end - start, zlib.crc32(raw[4 * start : 4 * end])))
                    start = end
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), *[pa.int64()] * 4))], names=["shard", "doc_id", "start_in_shard", "n_tokens", "ids_crc32"])

    # one row per shard, so the running total is over as many rows as there are files
    sizes = table.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = sizes.select("shard", before.alias("before"))
    digests = table.mapInArrow(digest, DIGESTS)
    return digests.join(F.broadcast(offsets), "shard").select("doc_id", (F.col("before") + F.col("start_in_shard")).alias("start"), "n_tokens", "ids_crc32")


def block_of(spark: SparkSession, path: str, doc_id: int) -> DataFrame:
    """The blocks that may hold a document; Spark opens the files whose statistics admit it."""
    blocks = spark.read.schema(BLOCKS).parquet(path)
    return blocks.filter((F.col("low") <= doc_id) & (F.col("high") >= doc_id) & F.array_contains("doc_ids", F.lit(doc_id)))


def read_document(spark: SparkSession, path: str, doc_id: int) -> list[int]:
    """One document's ids by random access: only its block is read and only its ids are decoded."""
    rows = block_of(spark, path, doc_id).limit(1).collect()
    if not rows:
        return []
    at = rows[0]["doc_ids"].index(doc_id)
    start = rows[0]["ends"][at - 1] if at else 0
    return unpack_bits(bytes(rows[0]["payload"]), rows[0]["ends"][at] - start, rows[0]["bits"], start).tolist()
