"""The stored index: segments, merging, skipping, and substring search."""

from __future__ import annotations

from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from threadmill.functions import textops
from threadmill.operators import postings, retrieval


def corpus(spark, n=300, seed=2):
    rng = np.random.default_rng(seed)
    words = [f"w{i}" for i in range(60)]
    p = 1 / np.arange(1, 61)
    rows = [(i, " ".join(rng.choice(words, rng.integers(0, 30) + (400 if i % 97 == 0 else 0), p=p / p.sum()))) for i in range(n)]
    return spark.createDataFrame(rows + [(n, None)], "doc_id long, content string")


def entries(index):
    return sorted(tuple(r) for r in index.entries().select("token", "field", "doc_id", "tf").collect())


def files(root):
    return {str(p) for p in Path(root).rglob("*.parquet")}


def test_segments(spark, tmp_path):
    docs = corpus(spark)
    index = postings.Index(spark, str(tmp_path / "i"), width=32, parts=4)
    index.add(docs, 0, ["content"])
    before = files(tmp_path)
    changed, removed = docs.filter("doc_id % 3 = 0").withColumn("content", F.concat(F.lit("new "), "content")), docs.filter("doc_id % 5 = 1")
    index.add(changed, 1, ["content"], removed=removed)
    added = files(tmp_path) - before
    assert before <= files(tmp_path) and all("/gone/" in f or "segment=1" in f for f in added)  # a refresh writes its own segment only
    index.add(docs.filter("doc_id = 1"), 2, ["content"])  # a removed document comes back
    now = docs.filter("doc_id % 3 <> 0 and doc_id % 5 <> 1 or doc_id = 1").unionByName(changed.join(removed.select("doc_id"), "doc_id", "left_anti"))
    # a document that one call both changes and removes has the new text
    now = now.unionByName(changed.join(removed.select("doc_id"), "doc_id", "left_semi"))
    whole = retrieval.token_index(now, ["doc_id"], ["content"]).select("token", "field", "doc_id", "tf")
    expected = sorted(tuple(r) for r in whole.collect())
    assert entries(index) == expected
    merged = index.merged(str(tmp_path / "m"))
    assert entries(merged) == expected and merged.lists().select("segment").distinct().count() == 1
    queries = spark.createDataFrame([(1, "w3 w50"), (2, "new w1"), (3, "absent"), (4, ""), (5, None)], "query_id long, text string")
    plain = retrieval.bm25(now.withColumnRenamed("content", "text"), queries, 5)
    rows = lambda df: [(r["query_id"], r["rank"], r["doc_id"], round(r["score"], 6)) for r in df.orderBy("query_id", "rank").collect()]
    assert rows(index.search(queries, 5).rows) == rows(plain) == rows(merged.search(queries, 5).rows)


def test_void_entries_are_looked_up(spark, tmp_path):
    """A posting is looked up among its block's void ids, not compared with each of them."""
    docs = spark.range(-40, 200).select(F.col("id").alias("doc_id"), F.concat(F.lit("x y"), F.col("id").cast("string")).alias("content"))
    index = postings.Index(spark, str(tmp_path), width=64, parts=2)
    index.add(docs, 0, ["content"])
    index.add(docs.filter("doc_id % 3 = 0"), 1, ["content"], removed=docs.filter("pmod(doc_id, 5) = 1"))
    found = index.entries()
    assert "exists(void" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(r["doc_id"] for r in found.filter("token = 'x'").collect()) == [i for i in range(-40, 200) if i % 3 == 0 or i % 5 != 1]


def test_lists_across_batches(monkeypatch):
    """Blocks and fields that go on in the next slice or batch give one list of a token, in the order of the ids; null ids have a block of their own."""
    rng = np.random.default_rng(5)
    rows = [(i // 8, f, i, [f"w{w}" for w in rng.integers(0, 6, rng.integers(0, 9))]) for i in range(-20, 60) if i % 7 for f in ("a", "b")]
    rows = [(None, "a", None, ["w1", "w1"]), (None, "a", None, [])] + sorted(rows, key=lambda r: r[:3])
    expected = {}
    for block, field, doc, words in rows:
        for w in {"", *words}:
            expected.setdefault((w, field, block), []).append((doc, words.count(w) if w else 1, len(words)))
    schema = pa.schema([("block", pa.int64()), ("field", pa.string()), ("doc_id", pa.int64()), ("words", pa.list_(pa.string()))])
    for slice_words, batch in ((3, 5), (20, 50), (1, 1), (1 << 19, 1000)):
        monkeypatch.setattr(postings, "SLICE_WORDS", slice_words)
        batches = [pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in rows[at : at + batch]], schema) for at in range(0, len(rows), batch)]
        found = [r for b in postings._lists(iter(batches)) for r in b.to_pylist()]
        assert len(found) == len(expected)
        assert {(r["token"], r["field"], r["block"]): list(zip(r["docs"], r["tf"], r["lengths"])) for r in found} == expected
    assert list(postings._lists(iter([]))) == []


def test_lists_are_written_where_they_are(spark, tmp_path, monkeypatch):
    """Indexing shuffles texts, not postings, and merging brings together only lists of one token and block in several segments."""
    plans, write = [], postings.Index._write
    monkeypatch.setattr(postings.Index, "_write", lambda self, lists, segment: (plans.append(lists), write(self, lists, segment)))
    docs = corpus(spark)
    index = postings.Index(spark, str(tmp_path / "i"), width=32, parts=4)
    index.add(docs, 0, ["content"])
    index.add(docs.filter("doc_id % 3 = 0").withColumn("content", F.lit("w3 once")), 1, ["content"], removed=docs.filter("doc_id % 5 = 1"))
    exchanges = [[line for line in df._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange hashpartitioning(" in line] for df in plans]
    assert all(len(e) == 1 and "token" not in e[0] for e in exchanges)
    files = {str(p) for p in (tmp_path / "i").rglob("*.parquet")}
    merged = index.merged(str(tmp_path / "m"))
    union = plans[-1]._jdf.queryExecution().optimizedPlan()
    while union.nodeName() != "Union":
        union = union.children().apply(0)
    alone, shared = (union.children().apply(i).toString() for i in (0, 1))
    assert "LeftAnti" in alone and "strategy=broadcast" in alone and "flatten(" not in alone and "flatten(" in shared
    monkeypatch.setattr(postings, "KEY_BYTES", 0)
    monkeypatch.setattr(postings, "VOID_BYTES", 0)
    together = index.merged(str(tmp_path / "t"))
    lists = lambda i: sorted(tuple(r) for r in i._read("lists", postings.LISTS_DDL).collect())
    assert lists(merged) == lists(together) and {str(p) for p in (tmp_path / "i").rglob("*.parquet")} == files
    assert merged._read("lists", postings.LISTS_DDL).groupBy(*postings.KEY).count().filter("count > 1").count() == 0
    assert entries(merged) == entries(index) == entries(merged.merged(str(tmp_path / "again")))


def test_documents_of_an_index(spark, tmp_path):
    """Documents without words count, void ones do not, in every field, also after merging and adding to what was merged."""
    rows = [(1, "a b", "t"), (2, "", None), (3, None, "x x y"), (-4, "c", ""), (900, "!", "z")]
    docs = spark.createDataFrame(rows, "doc_id long, content string, title string")
    index = postings.Index(spark, str(tmp_path / "i"), width=16, parts=3)
    index.add(docs, 0, ["title", "content"])
    lengths = lambda i: sorted((r["doc_id"], r["field"], r["length"]) for r in i.docs().collect())
    assert lengths(index) == sorted([(1, "content", 2), (1, "title", 1), (2, "content", 0), (2, "title", 0), (3, "content", 0), (3, "title", 3), (-4, "content", 1), (-4, "title", 0), (900, "content", 0), (900, "title", 1)])
    index.add(docs.filter("doc_id = 3").withColumn("content", F.lit("new word")), 1, ["title", "content"], removed=docs.filter("doc_id = 900"))
    now = sorted([(1, "content", 2), (1, "title", 1), (2, "content", 0), (2, "title", 0), (3, "content", 2), (3, "title", 3), (-4, "content", 1), (-4, "title", 0)])
    merged = index.merged(str(tmp_path / "m"))
    assert lengths(index) == lengths(merged) == now
    merged.add(docs.filter("doc_id = 900"), 1, ["title", "content"], removed=docs.filter("doc_id = 1"))
    assert lengths(merged) == [d for d in now if d[0] != 1] + [(900, "content", 0), (900, "title", 1)]
    assert sorted(tuple(r) for r in merged.entries().filter("field = 'title'").collect()) == [("x", "title", 3, 2), ("y", "title", 3, 1), ("z", "title", 900, 1)]


def test_blocks_are_skipped(spark, tmp_path):
    rare = F.when(F.pmod("id", F.lit(1000)) == 7, F.lit("rare rare rare ")).otherwise(F.lit(""))
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.concat(rare, F.lit("common "), F.repeat(F.lit("x "), F.pmod("id", F.lit(40)).cast("int"))).alias("content"))
    index = postings.Index(spark, str(tmp_path), width=100, parts=2)
    index.add(docs, 0, ["content"])
    queries = spark.createDataFrame([(1, "rare common")], "query_id long, text string")
    found = index.search(queries, 2)
    assert [r["doc_id"] for r in found.rows.orderBy("rank").collect()] == [7, 1007]
    assert found.read < found.held / 5


def test_empty(spark, tmp_path):
    index = postings.Index(spark, str(tmp_path))
    queries = spark.createDataFrame([(1, "a")], "query_id long, text string")
    assert index.search(queries).rows.count() == 0 and index.entries().count() == 0


def test_substrings(spark):
    docs = spark.createDataFrame([(1, "骑行去海边aaa"), (2, "去海"), (3, ""), (4, None), (5, "海"), (6, "aaaaaa"), (7, "𠮷野家 去海边")], "doc_id long, text string")
    queries = spark.createDataFrame([(1, "去海"), (2, "去海边"), (3, "aaa"), (4, "海"), (5, "𠮷野家 "), (6, "边海"), (7, None)], "query_id long, text string")
    found = sorted(tuple(r) for r in postings.substring_match(postings.bigram_index(docs), queries).collect())
    assert found == [(1, 1), (1, 2), (1, 7), (2, 1), (2, 7), (3, 1), (3, 6), (5, 7)]


def test_substrings_without_a_row_for_each_place(spark, monkeypatch):
    """Pairs are indexed without a shuffle, and what is shuffled is a row per document and wanted pair; texts cut into slices, equal ids and long texts find the same."""
    monkeypatch.setattr(textops, "SLICE_BYTES", 40)
    rows = [(i, f"{'ab' * (i % 9)} {i} xyz{'c' * (i % 4)}") for i in range(60)] + [(3, "ab xyzc"), (3, "abab"), (70, "ab" * 30_000)]
    docs = spark.createDataFrame(rows, "doc_id int, text string")
    index = postings.bigram_index(docs)
    assert "Exchange" not in index._jdf.queryExecution().executedPlan().toString() and index.schema["doc_id"].dataType.simpleString() == "int"
    queries = [(1, "abab"), (2, "xyzcc"), (3, " 1"), (4, "zz"), (5, "ababababab")]
    found = postings.substring_match(index, spark.createDataFrame(queries, "query_id long, text string"))
    assert sorted(map(tuple, found.collect())) == sorted({(q, d) for q, t in queries for d, text in rows if t in text})
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "explode(places" not in plan


@pytest.mark.parametrize("words,expected", [(["b", "a", "b"], [("a", 1), ("b", 2)]), ([], []), (None, [])])
def test_counts_in_a_row(spark, words, expected):
    df = retrieval.with_counts(spark.createDataFrame([(words,)], "words array<string>"))
    assert [tuple(r) for r in df.first()["counts"] or []] == expected


def test_blocks_of_vectors(spark, monkeypatch):
    """Blocks on both sides give the rows of the matrix path, without a Cartesian product."""
    monkeypatch.setattr(retrieval, "BLOCK_BYTES", 1)
    rng = np.random.default_rng(1)
    vectors = spark.createDataFrame([(i, [float(x) for x in rng.standard_normal(6)]) for i in range(120)] + [(500, None)], "vec_id long, embedding array<double>")
    queries = vectors.filter("vec_id % 4 = 0").withColumnRenamed("vec_id", "query_id")
    blocks = retrieval.vector_topk(vectors, queries, 5, query_bytes=400)
    assert "CartesianProduct" not in blocks._jdf.queryExecution().executedPlan().toString() and "NestedLoop" not in blocks._jdf.queryExecution().executedPlan().toString()
    rows = lambda df: [(r["query_id"], r["rank"], r["vec_id"], round(r["score"], 9)) for r in df.orderBy("query_id", "rank").collect()]
    assert rows(blocks) == rows(retrieval.vector_topk(vectors, queries, 5))
    assert retrieval.vector_topk(vectors, queries.limit(0), 5).count() == 0


def test_blocks_are_not_smaller_than_they_need_to_be(spark, monkeypatch):
    """Each block of queries is a copy of the vectors, so a small limit alone makes no more of them; scores in slices give the same rows."""
    rng = np.random.default_rng(3)
    vectors = spark.createDataFrame([(i, [float(x) for x in rng.standard_normal(6)]) for i in range(120)], "vec_id long, embedding array<double>")
    queries = vectors.filter("vec_id % 4 = 0").withColumnRenamed("vec_id", "query_id")
    rows = lambda df: [(r["query_id"], r["rank"], r["vec_id"], round(r["score"], 9)) for r in df.orderBy("query_id", "rank").collect()]
    expected = rows(retrieval.vector_topk(vectors, queries, 5))
    monkeypatch.setattr(retrieval, "SCORE_BYTES", 3000)
    blocks = retrieval.vector_topk(vectors, queries, 5, query_bytes=48)
    assert rows(blocks) == expected == rows(retrieval.vector_topk(vectors, queries, 5))
    assert "sequence(0, 29" not in blocks._jdf.queryExecution().analyzed().toString()


def test_scores_are_held_in_slices(monkeypatch):
    """The matrix of scores does not grow with the queries."""
    import tracemalloc

    monkeypatch.setattr(retrieval, "SCORE_BYTES", 1 << 20)
    vectors = np.random.default_rng(4).standard_normal((2000, 4))
    tracemalloc.start()
    found = retrieval.best_of_block(np.arange(2000), vectors, np.arange(2000), vectors, 3)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found.num_rows == 6000 and peak < 16 << 20  # 32 MB for all scores at once


def test_bm25_shuffles_no_postings(spark):
    """Only document frequencies, scores and ranks are shuffled, and words of the queries are met where documents are read."""
    docs = corpus(spark).withColumnRenamed("content", "text")
    queries = spark.createDataFrame([(1, "w3 w50"), (2, "w1 W1"), (3, None)], "query_id long, text string")
    plan = retrieval.bm25(docs, queries, 5)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan
    assert not [line for line in plan.splitlines() if "Exchange hashpartitioning(" in line and "doc_id" in line and "token" in line]
