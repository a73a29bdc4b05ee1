"""Ranked lexical search by MaxScore with joint maxima of term pairs.

Terms are the runs of ASCII letters, ASCII digits and non-ASCII characters of the
whole text, with only A-Z lower-cased. Documents are indexed where they are read:
a block holds, of some thousands of consecutive documents, the postings of the
terms that a stated query set asks for, in document order. Counts over all
documents (documents with a term, terms, document frequencies) then give each
posting its integer impact, and each block its lists of maxima: the largest impact
per term, and per pair of terms that stand next to each other in a query's order
(rarest first) the joint maximum, the largest sum of the two impacts in any
document of the block that holds both.

A query goes through a block's terms in that order. What the terms still to come can
add to any document is bounded by the best combination of their maxima: each term
alone, or with its neighbour by the pair's bound (the joint maximum, or the larger
single one), found by a recursion from the last term. Once that is below the k-th
score so far, no further document can enter, and longer lists are only probed for
the documents that can still reach it. A block whose whole bound is too small is
passed over. Each task keeps its best k of every query and hands only these on.

Queries go to every task in parts of at most ``query_bytes``, so nothing that is sent
grows with the documents. Pruning never drops a document that belongs to a result.

Defined cases: a null or empty text, or one without a term, is no document and asks
for nothing; documents with a null id follow all others among equals; of repeated
rows each is a document; queries of equal id and text are asked once, those of equal
id and another text are ranked by themselves; empty tables give no rows; columns
other than the named ones are ignored, whatever their names.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F

from .scratch import written

#: Bytes of queries that are looked for together.
QUERY_BYTES = 16 << 20
#: Documents, and postings, of a block at most (one document may have more postings).
BLOCK_DOCS = 16_384
BLOCK_POSTINGS = 2_000_000
#: Terms after which the k-th score is looked up again.
LOOK = 4

#: ASCII characters that are in no term, as blanks; capitals as small letters.
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def terms_of(text: bytes | None) -> list[bytes]:
    """The terms of a UTF-8 text, with repeats."""
    return text.translate(_TABLE).split() if text else []


@dataclass(frozen=True)
class Asked:
    """A part of the query set: its terms by number, and each query's terms and place."""

    numbers: dict[bytes, int]
    queries: list[list[int]]
    ids: list[int | None]

    @staticmethod
    def of(rows: list[Row]) -> "Asked":
        numbers: dict[bytes, int] = {}
        found = [(r["item_id"], sorted(set(terms_of(r["text"] and r["text"].encode())))) for r in rows]
        found = [(i, terms) for i, terms in found if terms]
        return Asked(numbers, [[numbers.setdefault(t, len(numbers)) for t in terms] for _, terms in found], [i for i, _ in found])


@dataclass(frozen=True)
class Weights:
    """What impacts are made of: the weight of each term, the number of documents and of their terms."""

    of_term: np.ndarray
    docs: int
    words: int

    def impacts(self, terms: np.ndarray, tf: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        m = 50 + (50 * sizes * self.docs) // self.words
        return self.of_term[terms] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m))


BLOCKS = "docs long, words long, ids array<long>, sizes array<long>, terms array<int>, ends array<long>, at array<int>, tf array<long>"
_BLOCKS = pa.schema(
    [("docs", pa.int64()), ("words", pa.int64()), ("ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64()))]
    + [("terms", pa.list_(pa.int32())), ("ends", pa.list_(pa.int64())), ("at", pa.list_(pa.int32())), ("tf", pa.list_(pa.int64()))]
)


class _Block:
    """Documents being gathered; counts are of all documents, the rest is of those with an asked term."""

    def __init__(self) -> None:
        self.docs = self.words = 0
        self.ids: list[int | None] = []
        self.sizes: list[int] = []
        self.found: list[tuple[int, int, int]] = []

    def row(self) -> pa.RecordBatch:
        term, at, tf = np.array(self.found, dtype=np.int64).reshape(-1, 3).T
        order = np.argsort(term, kind="stable")  # documents stay in order
        term, at, tf = term[order], at[order].astype(np.int32), tf[order]
        terms, starts = np.unique(term, return_index=True)
        ends = np.append(starts[1:], len(term)) if len(term) else starts
        values = [self.docs, self.words, self.ids, self.sizes, terms.astype(np.int32), ends, at, tf]
        return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, _BLOCKS)], schema=_BLOCKS)


def index_blocks(docs: DataFrame, numbers: dict[bytes, int], text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Blocks of postings of the numbered terms; every document is read once and goes nowhere."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, known = _Block(), numbers.keys()
        for batch in batches:
            for i, t in zip(batch.column(0), batch.column(1)):
                words = terms_of(t.as_py())
                if not words:
                    continue
                block.docs += 1
                block.words += len(words)
                counts = Counter(words)
                hits = known & counts.keys()
                if hits:
                    at = len(block.ids)
                    block.ids.append(i.as_py())
                    block.sizes.append(len(words))
                    block.found += [(numbers[w], at, counts[w]) for w in hits]
                if len(block.ids) >= BLOCK_DOCS or len(block.found) >= BLOCK_POSTINGS:
                    yield block.row()
                    block = _Block()
        if block.docs:
            yield block.row()

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text")).mapInArrow(each, BLOCKS)


def weights(blocks: DataFrame, n_terms: int) -> Weights:
    """The weights of the asked terms, of which there is a row each, from counts over all blocks."""
    total = blocks.agg(F.coalesce(F.sum("docs"), F.lit(0)), F.coalesce(F.sum("words"), F.lit(0))).first()
    start = F.when(F.col("i") > 0, F.element_at("ends", F.col("i"))).otherwise(F.lit(0))
    lists = blocks.select("ends", F.posexplode("terms").alias("i", "term")).select("term", (F.element_at("ends", F.col("i") + 1) - start).alias("n"))
    df = np.zeros(n_terms, dtype=np.int64)
    for r in lists.groupBy("term").agg(F.sum("n").alias("n")).collect():  # at most a row per asked term
        df[r["term"]] = r["n"]
    return Weights(np.array([math.floor(1000 * math.log((2 * total[0] + 2) / (2 * n + 1))) for n in df.tolist()], dtype=np.int64), total[0], total[1])


def ordered(queries: list[list[int]], of_term: np.ndarray) -> list[np.ndarray]:
    """Each query's terms, those of the largest weight first."""
    return [np.array(sorted(q, key=lambda t: (-int(of_term[t]), t)), dtype=np.int64) for q in queries]


IMPACTS = "ids array<long>, terms array<int>, ends array<long>, at array<int>, impacts array<long>, tops array<long>, first array<int>, second array<int>, joint array<long>"
_IMPACTS = pa.schema(
    [("ids", pa.list_(pa.int64())), ("terms", pa.list_(pa.int32())), ("ends", pa.list_(pa.int64())), ("at", pa.list_(pa.int32())), ("impacts", pa.list_(pa.int64()))]
    + [("tops", pa.list_(pa.int64())), ("first", pa.list_(pa.int32())), ("second", pa.list_(pa.int32())), ("joint", pa.list_(pa.int64()))]
)


def joint_maxima(n_docs: int, lists: dict[int, tuple[np.ndarray, np.ndarray]], pairs: dict[int, list[int]]) -> list[tuple[int, int, int]]:
    """(a, b, largest sum of their impacts in a document with both) for each of ``pairs`` (a to its b's) that meet."""
    found = []
    for a, partners in pairs.items():
        if a not in lists:
            continue
        dense = np.zeros(n_docs, dtype=np.int64)
        has = np.zeros(n_docs, dtype=bool)
        at, impact = lists[a]
        dense[at], has[at] = impact, True
        for b in partners:
            if b in lists:
                at, impact = lists[b]
                both = has[at]
                if both.any():
                    found.append((a, b, int((dense[at] + impact)[both].max())))
    return found


def with_impacts(blocks: DataFrame, asked: Asked, w: Weights) -> DataFrame:
    """The blocks with impacts for counts, and the lists of maxima of terms and of pairs."""
    pairs: dict[int, list[int]] = {}
    for a, b in sorted({(int(a), int(b)) for q in ordered(asked.queries, w.of_term) for a, b in zip(q, q[1:])}):
        pairs.setdefault(a, []).append(b)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                ids = batch.column("ids")[row]
                sizes, terms, ends, at, tf = (batch.column(c)[row].values.to_numpy(zero_copy_only=False) for c in ("sizes", "terms", "ends", "at", "tf"))
                lengths = np.diff(ends, prepend=0)
                impacts = w.impacts(np.repeat(terms, lengths), tf, sizes[at])
                lists = {int(t): (at[e - n : e], impacts[e - n : e]) for t, e, n in zip(terms, ends, lengths)}
                tops = [int(i.max()) for _, i in lists.values()]
                joint = joint_maxima(len(sizes), lists, pairs)
                values = [ids.as_py(), terms, ends, at, impacts, tops, *([p[k] for p in joint] for k in range(3))]
                yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, _IMPACTS)], schema=_IMPACTS)

    return blocks.filter(F.size("ids") > 0).mapInArrow(each, IMPACTS)


def remaining(query: np.ndarray, tops: dict[int, int], joint: dict[tuple[int, int], int]) -> list[int]:
    """For each place in a query's terms, the most that the terms from there on can add to one document.

    A pair adds at most its joint maximum where both terms are, else the larger single one.
    """
    bound = [0] * (len(query) + 2)
    terms = query.tolist()
    for k in range(len(terms) - 1, -1, -1):
        top = tops.get(terms[k], 0)
        bound[k] = top + bound[k + 1]
        if k + 1 < len(terms):
            pair = max(joint.get((terms[k], terms[k + 1]), 0), top, tops.get(terms[k + 1], 0))
            bound[k] = min(bound[k], pair + bound[k + 2])
    return bound[: len(terms) + 1]


def kth(scores: np.ndarray, k: int) -> int:
    return int(np.partition(scores, len(scores) - k)[len(scores) - k]) if len(scores) >= k else 0


def search_block(n_docs: int, query: np.ndarray, lists: dict[int, tuple[np.ndarray, np.ndarray]], bound: list[int], k: int, least: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Places and whole scores of the documents of a block that may be among the best ``k``, all with at least ``least``; and the postings read."""
    score, read, at = np.zeros(n_docs, dtype=np.int64), 0, 0
    while at < len(query) and bound[at] >= max(least, 1):
        docs, impact = lists.get(int(query[at]), (None, None))
        if docs is not None:
            score[docs] += impact
            read += len(docs)
        at += 1
        if at % LOOK == 0:
            least = max(least, kth(score, k))
    some = np.flatnonzero((score > 0) & (score + bound[at] >= least))
    while at < len(query) and len(some):
        docs, impact = lists.get(int(query[at]), (None, None))
        at += 1
        if docs is None:
            continue
        place = np.minimum(np.searchsorted(docs, some), len(docs) - 1)
        hit = docs[place] == some
        score[some[hit]] += impact[place[hit]]
        read += min(len(docs), len(some))
        least = max(least, kth(score[some], k))
        some = some[score[some] + bound[at] >= least]
    return some, score[some], read


SCORED = "query int, item_id long, doc_id long, score long, asked long, read long"
_SCORED = pa.schema([("query", pa.int32()), ("item_id", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64()), ("asked", pa.int64()), ("read", pa.int64())])


def search_blocks(blocks: DataFrame, asked: Asked, w: Weights, k: int) -> DataFrame:
    """Each task's best ``k`` documents of every query; its rows also say how many postings the queries' lists have and how many were read."""
    queries = ordered(asked.queries, w.of_term)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.empty(0, dtype=np.int64)
        best = [(none, none.astype(bool), none) for _ in queries]  # ids, whether null, scores
        held = np.zeros((len(queries), 2), dtype=np.int64)
        for batch in batches:
            for row in range(batch.num_rows):
                ids = batch.column("ids")[row].values
                null, ids = ids.is_null().to_numpy(zero_copy_only=False), ids.fill_null(0).to_numpy(zero_copy_only=False)
                terms, ends, at, impacts, tops, *pairs = (batch.column(c)[row].values.to_numpy(zero_copy_only=False) for c in _IMPACTS.names[1:])
                lists = {t: (at[s:e], impacts[s:e]) for t, s, e in zip(terms.tolist(), [0, *ends.tolist()], ends.tolist())}
                top, joint = dict(zip(terms.tolist(), tops.tolist())), {(a, b): j for a, b, j in zip(*(p.tolist() for p in pairs))}
                for n, query in enumerate(queries):
                    bound = remaining(query, top, joint)
                    held[n, 0] += sum(len(lists[t][0]) for t in query.tolist() if t in lists)
                    least = kth(best[n][2], k)
                    if bound[0] < max(least, 1):
                        continue
                    some, score, read = search_block(len(ids), query, lists, bound, k, least)
                    held[n, 1] += read
                    i, z, s = (np.concatenate(x) for x in zip(best[n], (ids[some], null[some], score)))
                    order = np.lexsort((i, z, -s))[:k]
                    best[n] = i[order], z[order], s[order]
        for n, (i, z, s) in enumerate(best):
            if len(i):
                values = [np.full(len(i), n, dtype=np.int32), [asked.ids[n]] * len(i), pa.array(i, mask=z), s, np.full(len(i), held[n, 0]), np.full(len(i), held[n, 1])]
                yield pa.RecordBatch.from_arrays([v if isinstance(v, pa.Array) else pa.array(v, f.type) for v, f in zip(values, _SCORED)], schema=_SCORED)

    return blocks.mapInArrow(each, SCORED)


def top_documents(docs: DataFrame, queries: DataFrame, k: int = 50, text: str = "text", doc_id: str = "doc_id", query_id: str = "item_id", query_text: str = "text", query_bytes: int = QUERY_BYTES) -> DataFrame:
    """item_id, rank, doc_id and score of the ``k`` best documents of each query; ``asked`` and ``read`` are postings of the task that found the row."""
    items = queries.select(F.col(query_id).cast("long").alias("item_id"), F.col(query_text).cast("string").alias("text")).filter("text is not null").distinct()
    size = items.agg(F.coalesce(F.sum(F.octet_length("text") + 64), F.lit(0))).first()[0]
    parts = max(1, -(-size // query_bytes))
    found: list[DataFrame] = []
    for part in range(parts):
        some = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part) if parts > 1 else items
        asked = Asked.of(sorted(some.collect(), key=lambda r: (r["item_id"] is None, r["item_id"], r["text"])))  # about query_bytes
        blocks = written(index_blocks(docs, asked.numbers, text, doc_id), "blocks")
        w = weights(blocks, len(asked.numbers))
        scored = search_blocks(written(with_impacts(blocks, asked, w), "impacts"), asked, w, k)
        order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        ranked = scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        found.append(ranked.select("item_id", "rank", "doc_id", "score", "asked", "read"))
    whole = found[0]
    for other in found[1:]:
        whole = whole.unionByName(other)
    return whole
