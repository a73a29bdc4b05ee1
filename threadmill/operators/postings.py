"""A stored token index in segments, and ranking from it by upper bounds.

A segment is written once. Its lists have a row per token, field and block of
``width`` ids: the documents in order, how often each holds the token and how long it
is, and two maxima that bound what any of them can score. Lists lie in folders by a hash of the
token, so a search reads those of its tokens alone. Every document also holds the
empty token, once, whose lists tell which documents there are and how long. Later
documents make later segments; what they replace or remove is a list of ids, void in
earlier segments. Merging makes one segment of all.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.textops import slices
from .retrieval import tokens

LISTS_DDL = "token string, field string, block long, docs array<long>, tf array<int>, lengths array<int>, max_tf int, min_length int, segment int, part int"
GONE_DDL = "doc_id long, before int"
#: What tells the lists of a segment apart.
KEY = ("token", "field", "block")
#: Ids of a block, and folders of a segment.
WIDTH, PARTS = 4096, 64
#: Bytes of queries that one search takes.
QUERY_BYTES = 32 << 20
#: Bytes of void ids, and of the keys of the smaller segments' lists, that go to every task.
VOID_BYTES, KEY_BYTES = 64 << 20, 32 << 20
#: Words that a task counts at a time.
SLICE_WORDS = 1 << 19


def _dense(some: list, width: int) -> list[int]:
    """``some`` (place, before) as a list of ``width`` numbers, 0 where there is none."""
    every = [0] * width
    for place, before in some:
        every[place] = before
    return every


def part_of(token: Column, parts: int) -> Column:
    return F.pmod(F.xxhash64(token), F.lit(parts)).cast("int")


def _word_slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Consecutive documents of ``batch`` with at most ``SLICE_WORDS`` words, or one."""
    ends, start = np.cumsum(pc.list_value_length(batch.column("words")).to_numpy()), 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + SLICE_WORDS, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def _begins(*columns: np.ndarray) -> np.ndarray:
    """Where any of ``columns`` differs from the place before."""
    new = np.zeros(max(len(columns[0]) - 1, 0), dtype=bool)
    for c in columns:
        new |= c[1:] != c[:-1]
    return np.flatnonzero(np.r_[True, new][: len(columns[0])])


def _lists_of(rows: pa.RecordBatch, group: np.ndarray) -> tuple[pa.Table, np.ndarray]:
    """token, field, block, docs, tf, lengths of some documents, which are in the order of ``group``; and the lists' groups, in order."""
    sizes = pc.list_value_length(rows.column("words")).to_numpy()
    words = rows.column("words").flatten().dictionary_encode()
    every, number = np.arange(len(sizes), dtype=np.int32), len(words.dictionary)  # of the empty token, which is in no text
    doc, code = np.r_[np.repeat(every, sizes), every], _small(np.r_[words.indices.to_numpy(), np.full(len(sizes), number, dtype=np.int32)])
    order = np.argsort(code, kind="stable")
    if group[0] != group[-1]:
        order = order[np.argsort(_small(group)[doc[order]], kind="stable")]  # both stable, so documents stay in order
    code, doc = code[order], doc[order]
    posting = _begins(code, doc)
    tf = np.diff(np.r_[posting, len(code)]).astype(np.int32)
    code, doc = code[posting], doc[posting]
    of = _begins(code, group[doc])
    offsets, first = pa.array(np.r_[of, len(code)].astype(np.int32)), pa.array(doc[of])
    lists = [pa.ListArray.from_arrays(offsets, c) for c in (rows.column("doc_id").take(pa.array(doc)), pa.array(tf), pa.array(sizes[doc]))]
    return pa.table([pa.concat_arrays([words.dictionary, pa.array([""])]).take(pa.array(code[of])), rows.column("field").take(first), rows.column("block").take(first), *lists], names=[*KEY, "docs", "tf", "lengths"]), group[doc[of]]


def _joined(pieces: list[pa.Table]) -> pa.Table:
    """Lists of one block and field, of consecutive documents, with those of a token in one."""
    if len(pieces) == 1:
        return pieces[0]
    rows = pa.concat_tables(pieces).combine_chunks()
    code = rows.column("token").combine_chunks().dictionary_encode().indices.to_numpy()
    order = np.argsort(code, kind="stable")
    rows, first = rows.take(pa.array(order)).combine_chunks(), _begins(code[order])
    ends = np.r_[0, np.cumsum(pc.list_value_length(rows.column("docs").combine_chunks()).to_numpy())]
    offsets = pa.array(ends[np.r_[first, len(order)]].astype(np.int32))
    lists = [pa.ListArray.from_arrays(offsets, rows.column(c).combine_chunks().flatten()) for c in ("docs", "tf", "lengths")]
    return pa.table([*(rows.column(c).take(pa.array(first)) for c in KEY), *lists], names=rows.column_names)


def _lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The lists of documents (block, field, doc_id, words) that come in this order, whole blocks of them."""
    pieces: list[pa.Table] = []  # of the last block, which may go on
    last = None
    for batch in batches:
        for rows in _word_slices(batch):
            block, field = rows.column("block"), rows.column("field").dictionary_encode().indices.to_numpy()
            # ids may be null, and so are their blocks
            starts = _begins(pc.fill_null(block, 0).to_numpy(), block.is_null().to_numpy(zero_copy_only=False), field)
            group = np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, len(field)]))
            lists, of = _lists_of(rows, group)
            key = lambda at: (block[at].as_py(), rows.column("field")[at].as_py())
            if pieces and last != key(0):
                yield from _joined(pieces).to_batches(10_000)
                pieces = []
            inner, end = np.searchsorted(of, [1, of[-1]])
            if end:
                yield from _joined([*pieces, lists.slice(0, inner)]).to_batches(10_000)
                yield from lists.slice(inner, end - inner).to_batches(10_000)
                pieces = []
            pieces.append(lists.slice(end))
            last = key(rows.num_rows - 1)
    if pieces:
        yield from _joined(pieces).to_batches(10_000)


class Index:
    """The segments under ``root``, which all executors share."""

    def __init__(self, spark: SparkSession, root: str, width: int = WIDTH, parts: int = PARTS):
        self.spark, self.root, self.width, self.parts = spark, root.rstrip("/"), width, parts

    def _exists(self, kind: str) -> bool:
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{kind}")
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(path)

    def _read(self, kind: str, ddl: str) -> DataFrame:
        return self.spark.read.schema(ddl).parquet(f"{self.root}/{kind}") if self._exists(kind) else self.spark.createDataFrame([], ddl)

    def lists(self) -> DataFrame:
        return self._read("lists", LISTS_DDL).filter(F.col("token") != "")

    def gone(self) -> DataFrame:
        """doc_id, before: what segments with a smaller number hold of the document is void."""
        return self._read("gone", GONE_DDL).groupBy("doc_id").agg(F.max("before").alias("before"))

    def docs(self) -> DataFrame:
        """The documents that are not void, by field."""
        every = self._read("lists", LISTS_DDL).filter((F.col("token") == "") & (F.col("part") == part_of(F.lit(""), self.parts)))
        return self._kept(every).select("field", "segment", F.explode("all").alias("p")).select("p.doc_id", "field", F.col("p.length").cast("long").alias("length"), "segment")

    def add(self, docs: DataFrame, segment: int, fields: Sequence[str], doc_id: str = "doc_id", removed: DataFrame | None = None, **options) -> None:
        """Write ``docs`` as a segment; earlier entries of these documents, and of ``removed`` ones, are void from then on.

        Texts are shuffled once, by blocks of ids; words are listed, counted and gathered where a block's texts lie, so no posting is shuffled.
        """
        named = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("text")) for f in fields])).alias("f")
        texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), named).select(F.floor(F.col("doc_id") / self.width).alias("block"), "f.field", "doc_id", "f.text")
        ordered = texts.repartition("block").sortWithinPartitions("block", "field", "doc_id")
        words = ordered.select("block", "field", "doc_id", tokens(F.col("text"), **options).alias("words"))
        self._write(words.mapInArrow(_lists, "token string, field string, block long, docs array<long>, tf array<int>, lengths array<int>"), segment)
        gone = docs.select(F.col(doc_id).cast("long").alias("doc_id"))
        if removed is not None:
            gone = gone.unionByName(removed.select(F.col(doc_id).cast("long").alias("doc_id")))
        if segment > 0:
            gone.distinct().withColumn("before", F.lit(segment)).write.mode("append").parquet(f"{self.root}/gone")

    def _write(self, lists: DataFrame, segment: int) -> None:
        """``lists``: token, field, block, docs, tf, lengths (at most ``width`` documents, in order). They are written where they are."""
        rows = lists.select(
            *KEY, "docs", "tf", "lengths", F.array_max("tf").alias("max_tf"), F.array_min("lengths").alias("min_length"),
            F.lit(segment).alias("segment"), part_of(F.col("token"), self.parts).alias("part"),
        )
        # sorted, so that a token's blocks follow each other in few row groups
        rows.sortWithinPartitions("part", *KEY).write.mode("append").option("compression", "zstd").partitionBy("segment", "part").parquet(f"{self.root}/lists")

    def _kept(self, lists: DataFrame) -> DataFrame:
        """token, field, block, segment, all: what is not void of each list; empty ones stay out. No list is shuffled unless there are over ``VOID_BYTES`` of void ids."""
        rows = lists.withColumn("all", F.arrays_zip(F.col("docs").alias("doc_id"), F.col("tf"), F.col("lengths").alias("length")))
        if not self._exists("gone"):
            return rows.select(*KEY, "segment", "all")
        width = self.width
        block, place = F.floor(F.col("doc_id") / width).alias("block"), F.pmod("doc_id", F.lit(width)).cast("int")
        # a place for every id of a block, so that a posting is looked up and not searched for
        befores = F.udf(lambda some: _dense(some, width), "array<int>")
        void = self.gone().groupBy(block).agg(F.collect_list(F.struct(place.alias("place"), "before")).alias("some")).select("block", befores("some").alias("void"))
        if self._read("gone", GONE_DDL).select(block).distinct().count() * width * 4 <= VOID_BYTES:
            void = F.broadcast(void)
        kept = F.when(F.col("void").isNull(), F.col("all")).otherwise(F.filter("all", lambda p: F.get("void", F.pmod(p["doc_id"], F.lit(width)).cast("int")) <= F.col("segment")))
        return rows.join(void, "block", "left").withColumn("kept", kept).filter(F.size("kept") > 0).select(*KEY, "segment", F.col("kept").alias("all"))

    def live(self, lists: DataFrame) -> DataFrame:
        """``lists`` as (token, field, block, all) of documents that are not void, one row for all segments; empty ones stay out."""
        # one list of a block in each segment
        return self._kept(lists).groupBy(*KEY).agg(F.array_sort(F.flatten(F.collect_list("all"))).alias("all"))

    def entries(self) -> DataFrame:
        """token, field, doc_id, tf of every live posting."""
        return self._kept(self.lists()).select("token", "field", F.explode("all").alias("p")).select("token", "field", "p.doc_id", F.col("p.tf").cast("long").alias("tf"))

    def merged(self, root: str) -> "Index":
        """An index of one segment with the same live entries, under another root.

        A list of the largest segment that no other segment continues is copied without its void entries, where it is read;
        only lists of one token and block in several segments are brought together. Over ``KEY_BYTES`` of keys in the other segments, all are.
        """
        other, lists = Index(self.spark, root, self.width, self.parts), self._read("lists", LISTS_DDL)
        sizes = lists.groupBy("segment").count().collect()  # a row per segment
        largest = max(sizes, key=lambda r: r["count"])["segment"] if sizes else 0
        rest, most = lists.filter(F.col("segment") != largest), lists.filter(F.col("segment") == largest)
        if len(sizes) < 2:
            rows = self._kept(most).select(*KEY, "all")
        elif rest.agg(F.sum(F.octet_length("token") + F.octet_length("field") + 40)).first()[0] > KEY_BYTES:
            rows = self.live(lists)
        else:
            parts = [r["part"] for r in rest.select("part").distinct().collect()]
            keys = F.broadcast(rest.select(*KEY).distinct())
            again = most.filter(F.col("part").isin(parts)).join(keys, list(KEY), "left_semi").select(*lists.columns)
            alone = most.join(keys, list(KEY), "left_anti").select(*lists.columns)
            rows = self._kept(alone).select(*KEY, "all").unionByName(self.live(again.unionByName(rest)))
        other._write(rows.select(*KEY, F.col("all.doc_id").alias("docs"), F.col("all.tf").alias("tf"), F.col("all.length").alias("lengths")), 0)
        return other

    def search(self, queries: DataFrame, k: int = 10, field: str = "content", k1: float = 1.2, b: float = 0.75, query_id: str = "query_id", text: str = "text", seeds: int = 2) -> "Ranked":
        """The ``k`` best documents of each query by BM25, read from the lists.

        A block's bound for a query is the sum of what its maxima allow. The
        ``seeds`` blocks of largest bounds are scored first; their k-th score is the
        query's threshold, and only blocks whose bound reaches it are scored then, so no
        document is lost. A query's frequent tokens make a row per block, not per document.
        """
        size = queries.agg(F.coalesce(F.sum(F.octet_length(text) + 16), F.lit(0))).first()[0]
        if size > QUERY_BYTES:
            raise ValueError(f"{size} bytes of queries: search in parts of at most {QUERY_BYTES}")
        asked = queries.select(F.col(query_id).alias("query_id"), F.explode(F.array_distinct(tokens(F.col(text)))).alias("token"))
        wanted = F.broadcast(asked.select("token").distinct())
        parts = [r[0] for r in asked.select(part_of(F.col("token"), self.parts)).distinct().collect()]
        lists = self.lists().filter(F.col("part").isin(parts) & (F.col("field") == field)).join(wanted, "token", "left_semi")
        path = f"{self.root}/asked/{abs(hash((size, field, k, k1, b, seeds)))}-{np.random.default_rng().integers(1 << 60)}"
        self.live(lists).write.parquet(path)
        found = self.spark.read.parquet(path)
        n, mean = self.docs().filter(F.col("field") == field).agg(F.count("*"), F.avg("length")).first()
        if not n:
            return Ranked(self.spark.createDataFrame([], "query_id long, rank int, doc_id long, score double"), 0, 0)
        df = found.groupBy("token").agg(F.sum(F.size("all")).alias("df"))
        weights = asked.join(df, "token").withColumn("idf", F.log((n - F.col("df") + 0.5) / (F.col("df") + 0.5) + 1))
        tf, length = F.array_max("all.tf"), F.array_min("all.length")
        most = tf * (k1 + 1) / (tf + k1 * (1 - b + b * length / F.lit(mean)))
        tops = found.select("token", "block", most.alias("most"), F.size("all").alias("n"))
        bounds = tops.join(F.broadcast(weights), "token").groupBy("query_id", "block").agg(F.sum(F.col("idf") * F.col("most")).alias("bound"), F.sum("n").alias("n"))
        bounds.write.parquet(f"{path}-bounds")
        bounds = self.spark.read.parquet(f"{path}-bounds")
        place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("bound"), "block"))
        first = bounds.withColumn("__place", place).filter(F.col("__place") <= seeds).drop("__place")
        scored = self._scored(found, first, weights, k, k1, b, mean)
        scored.write.parquet(f"{path}-first")
        seeded = self.spark.read.schema(scored.schema).parquet(f"{path}-first")
        best = _ranked(seeded, k).filter(F.col("rank") == k).select("query_id", F.col("score").alias("least"))
        rest = bounds.join(first.select("query_id", "block"), ["query_id", "block"], "left_anti").join(best, "query_id", "left")
        # bounds and scores are sums of doubles: a little less still counts
        rest = rest.filter(F.col("least").isNull() | (F.col("bound") >= F.col("least") - 1e-6)).select(*first.columns)
        held, read = bounds.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0], first.unionByName(rest).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
        return Ranked(_ranked(seeded.unionByName(self._scored(found, rest, weights, k, k1, b, mean)), k), held, read)

    def _scored(self, found: DataFrame, pairs: DataFrame, weights: DataFrame, k: int, k1: float, b: float, mean: float) -> DataFrame:
        """query_id, doc_id, score of the best ``k`` of each pair (query_id, block)."""
        asked: dict = {}
        for r in weights.select("query_id", "token", "idf").orderBy("query_id", "token").collect():  # a row per word of the queries
            asked.setdefault(r["query_id"], []).append((r["token"], r["idf"]))
        shared = self.spark.sparkContext.broadcast(asked)

        def score(lists: pa.Table, queries: pa.Table) -> pa.Table:
            held = {}
            for token, entries in zip(lists.column("token").to_pylist(), lists.column("all").combine_chunks()):
                docs, tf, length = (entries.values.field(i).to_numpy(zero_copy_only=False).astype(np.float64 if i else np.int64) for i in range(3))
                held[token] = docs, tf * (k1 + 1) / (tf + k1 * (1 - b + b * length / mean))
            places = np.unique(np.concatenate([d for d, _ in held.values()])) if held else np.empty(0, dtype=np.int64)
            at = {t: np.searchsorted(places, d) for t, (d, _) in held.items()}
            out: list[tuple[list, np.ndarray, np.ndarray]] = []
            for query in queries.column("query_id").to_pylist():
                total = np.zeros(len(places))
                for token, idf in shared.value[query]:
                    if token in held:
                        total[at[token]] += idf * held[token][1]
                order = np.lexsort((places, -np.round(total, 9)))[:k]
                order = order[total[order] > 0]
                out.append(([query] * len(order), places[order], total[order]))
            return pa.table([pa.array([q for o in out for q in o[0]], pa.int64()), pa.array(np.concatenate([o[1] for o in out])), pa.array(np.concatenate([o[2] for o in out]))], names=["query_id", "doc_id", "score"])

        blocks = found.join(pairs.select("block").distinct(), "block", "left_semi").select("block", "token", "all")
        return blocks.groupBy("block").cogroup(pairs.select("block", "query_id").groupBy("block")).applyInArrow(score, "query_id long, doc_id long, score double")


class Ranked(NamedTuple):
    """query_id, rank, doc_id, score; how many postings the queries' lists have, and how many were scored."""

    rows: DataFrame
    held: int
    read: int


def _ranked(scored: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.round("score", 9).desc(), "doc_id")
    return scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "doc_id", "score")


# --- substrings of unsegmented text ------------------------------------------------


def _small(numbers: np.ndarray) -> np.ndarray:
    """The same numbers in 16 bits, which sort much faster, where they fit."""
    return numbers.astype(np.uint16) if not len(numbers) or numbers.max() < 1 << 16 else numbers


def _places_of_pairs(ids: pa.Array, texts: pa.Array) -> pa.Table:
    """gram, doc_id, places of some documents."""
    sizes = pc.utf8_length(texts).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    codes = np.frombuffer("".join(t for t in texts.to_pylist() if t).encode("utf-32-le"), dtype="<u4").astype(np.int64)
    doc = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(len(codes)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    inside = np.flatnonzero(doc[:-1] == doc[1:])
    seen = np.zeros(0x110000, dtype=bool)
    seen[codes] = True
    letters, number = np.flatnonzero(seen), np.cumsum(seen) - 1
    pair = _small(number[codes[inside]] * len(letters) + number[codes[inside + 1]])
    doc, place = _small(doc[inside]), place[inside]
    order = np.argsort(pair, kind="stable")
    order = order[np.argsort(doc[order], kind="stable")]  # both stable, so places stay in order
    pair, doc, place = pair[order], doc[order], place[order]
    starts = np.flatnonzero(np.r_[True, (pair[1:] != pair[:-1]) | (doc[1:] != doc[:-1])][: len(pair)])
    different, which = np.unique(pair[starts], return_inverse=True)
    names = pa.array([chr(letters[p // len(letters)]) + chr(letters[p % len(letters)]) for p in different.tolist()], pa.string())
    places = pa.ListArray.from_arrays(pa.array(np.r_[starts, len(pair)].astype(np.int32)), pa.array(place.astype(np.int32)))
    return pa.table([names.take(pa.array(which)), ids.take(pa.array(doc[starts])), places], names=["gram", "doc_id", "places"])


def bigram_index(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """gram, doc_id, places: where each pair of neighbouring characters stands (from 0).

    Places are gathered for each document where it is read, so nothing is shuffled.
    """

    def indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in slices(batch, 1):
                yield from _places_of_pairs(some.column(0), some.column(1)).to_batches()

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).filter(F.length("text") > 1)
    id_type = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(indexed, f"gram string, doc_id {id_type}, places array<int>")


def substring_match(index: DataFrame, queries: DataFrame, query_id: str = "query_id", text: str = "text") -> DataFrame:
    """query_id, doc_id of documents that hold a query's text anywhere; queries of two or more characters, others find nothing.

    A query is covered by every second pair and the last one. Places of all of
    these, less their offsets, agree where the text begins. The places that a document has for
    pairs of any query are brought together once, as lists, and intersected there: no row is made
    for a place. The query set must fit a broadcast.
    """
    size = queries.agg(F.coalesce(F.sum(F.octet_length(text) + 16), F.lit(0))).first()[0]
    if size > QUERY_BYTES:
        raise ValueError(f"{size} bytes of queries: search in parts of at most {QUERY_BYTES}")
    n = F.length(text)
    offsets = F.array_distinct(F.concat(F.sequence(F.lit(0), n - 2, F.lit(2)), F.array(n - 2)))
    gram = lambda o: F.struct(o.alias("offset"), F.substring(F.col(text), o + 1, F.lit(2)).alias("gram"))
    asked = queries.filter(n > 1).select(F.col(query_id).alias("query_id"), F.transform(offsets, gram).alias("grams"))
    wanted = asked.select(F.explode("grams.gram").alias("gram")).distinct()
    looked_for = [(r["query_id"], [(g["gram"], g["offset"]) for g in r["grams"]]) for r in asked.collect()]  # no larger than the bound just checked
    shared = index.sparkSession.sparkContext.broadcast(looked_for)

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            if batch.num_rows:
                rows = pa.Table.from_batches([batch]) if rest is None else pa.concat_tables([rest, pa.Table.from_batches([batch])])
                last = _documents(rows)
                first = int(np.argmax(last == last[-1]))  # the last document may go on in the next batch
                yield from _holders(rows.slice(0, first), shared.value, rows.schema.field("doc_id").type).to_batches()
                rest = rows.slice(first)
        if rest is not None:
            yield from _holders(rest, shared.value, rest.schema.field("doc_id").type).to_batches()

    types = {"query_id": asked.schema["query_id"].dataType.simpleString(), "doc_id": index.schema["doc_id"].dataType.simpleString()}
    some = index.select("doc_id", "gram", "places").join(F.broadcast(wanted), "gram", "left_semi").select("doc_id", "gram", "places")
    pairs = some.repartition("doc_id").sortWithinPartitions("doc_id").mapInArrow(found, f"number int, doc_id {types['doc_id']}")
    numbers = index.sparkSession.createDataFrame([(i, q) for i, (q, _) in enumerate(looked_for)], f"number int, query_id {types['query_id']}")
    return pairs.join(F.broadcast(numbers), "number").select("query_id", "doc_id").distinct()


def _documents(rows: pa.Table) -> np.ndarray:
    """A number for each row's document."""
    return rows.column("doc_id").combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy()


def _increasing(numbers: np.ndarray) -> np.ndarray:
    return numbers if (numbers[1:] > numbers[:-1]).all() else np.unique(numbers)


def _holders(rows: pa.Table, looked_for: list, id_type: pa.DataType) -> pa.Table:
    """number, doc_id of the queries found in ``rows``, which are all rows of some documents."""
    numbers, ids = [], []
    if rows.num_rows:
        doc, gram, places = _documents(rows), rows.column("gram").combine_chunks().dictionary_encode(), rows.column("places").combine_chunks()
        names, first_row = gram.dictionary.to_pylist(), np.unique(doc, return_index=True)[1]
        lengths = pc.list_value_length(places).to_numpy()
        key = np.repeat(doc.astype(np.int64) << 32, lengths) + places.flatten().to_numpy()
        of = _small(np.repeat(gram.indices.to_numpy(), lengths))
        order = np.argsort(of, kind="stable")
        # places of a gram by document; some stand twice only where documents share an id
        runs = dict(zip(names, map(_increasing, np.split(key[order], np.cumsum(np.bincount(of, minlength=len(names)))[:-1]))))
        for number, (_, grams) in enumerate(looked_for):
            begun = None
            for g, offset in grams:
                here = runs[g] - offset if g in runs else np.empty(0, dtype=np.int64)
                begun = here if begun is None else np.intersect1d(begun, here, assume_unique=True)
                if not len(begun):
                    break
            # the first pair's offset is 0, so what is left begins inside its document
            hit = np.unique(begun >> 32)
            numbers.append(np.full(len(hit), number, dtype=np.int32))
            ids.append(first_row[hit])
    taken = rows.column("doc_id").combine_chunks().take(pa.array(np.concatenate(ids))) if ids else pa.array([], id_type)
    return pa.table([pa.array(np.concatenate(numbers) if numbers else np.empty(0, dtype=np.int32)), taken], names=["number", "doc_id"])
