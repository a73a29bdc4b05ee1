"""Ranked lexical search against plain Python, and its bounds against every document."""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pytest

from threadmill.llm import entries, maxscore

SF = "/root/testdata/sf0.001"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k=50):
    """Rows (item_id, rank, doc_id, score) from every document."""
    counted = [(i, Counter(terms(t))) for i, t in docs if terms(t)]
    n_docs, n_words = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(w for _, c in counted for w in c)
    found = []
    for item, text in items:
        scored = []
        for doc, c in counted:
            m = 100 - 50 + (50 * sum(c.values()) * n_docs) // n_words
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * ((1_000_000_000 * c[w]) // (1000 * c[w] + 20 * m)) for w in set(terms(text)) if c[w])
            if score > 0:
                scored.append((-score, doc is None, doc))
        found += [(item, r, doc, -s) for r, (s, _, doc) in enumerate(sorted(scored)[:k], 1)]
    return sorted(found, key=repr)


def rows(df):
    return sorted([tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()], key=repr)


def test_query_over_whole_tables(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    assert rows(entries.op11_pair_maxscore(spark, SF)) == brute(docs, items)


@pytest.mark.parametrize("query_bytes", [200, 1 << 20])
def test_small_blocks_and_query_parts(spark, monkeypatch, query_bytes):
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(40)]
    p = 1 / np.arange(1, 41)
    docs = [(i, " ".join(rng.choice(words, rng.integers(1, 60), p=p / p.sum()))) for i in range(400)]
    items = [(i, " ".join(rng.choice(words, rng.integers(1, 12)))) for i in range(6)]
    # blocks and parts of any size give the same rows
    monkeypatch.setattr(maxscore, "BLOCK_DOCS", 16)
    found = maxscore.top_documents(spark.createDataFrame(docs, "doc_id long, text string").coalesce(2), spark.createDataFrame(items, "item_id long, text string"), k=7, query_bytes=query_bytes)
    assert rows(found) == brute(docs, items, 7)


def test_blocks_are_skipped_once_thresholds_are_known(monkeypatch):
    rng = np.random.default_rng(3)
    query, k = np.arange(6), 5
    best, read, asked = np.empty(0, dtype=np.int64), 0, 0
    for block in range(30):
        lists = {}
        for t in range(6):
            at = np.flatnonzero(rng.random(400) < 0.05 * (t + 1) ** 1.5)
            lists[t] = at, (rng.random(len(at)) ** 3 * 1000 / (t + 1)).astype(np.int64)
        tops = {t: int(i.max()) for t, (_, i) in lists.items()}
        joint = {(a, b): j for a, b, j in maxscore.joint_maxima(400, lists, {t: [t + 1] for t in range(5)})}
        whole = np.zeros(400, dtype=np.int64)
        for at, impact in lists.values():
            whole[at] += impact
        bound = maxscore.remaining(query, tops, joint)
        single = [sum(tops[t] for t in range(k, 6)) for k in range(7)]
        assert all(b <= s for b, s in zip(bound, single)) and bound[0] >= whole.max()  # tighter, and still a bound
        some, score, n = maxscore.search_block(400, query, lists, bound, k, maxscore.kth(best, k))
        np.testing.assert_array_equal(score, whole[some])
        best = np.sort(np.concatenate([best, score]))[::-1][:k]
        read, asked = read + n, asked + sum(len(at) for at, _ in lists.values())
    assert read < asked / 2


def test_pair_bound_is_below_the_sum_where_no_document_has_both_maxima():
    lists = {0: (np.array([0, 1]), np.array([10, 1])), 1: (np.array([1, 2]), np.array([2, 9]))}
    joint = {(a, b): j for a, b, j in maxscore.joint_maxima(3, lists, {0: [1]})}
    assert joint == {(0, 1): 3}
    assert maxscore.remaining(np.array([0, 1]), {0: 10, 1: 9}, joint) == [10, 9, 0]


def test_odd_inputs(spark):
    schema = "doc_id long, text string, item_id long, score long, rank int"
    docs = spark.createDataFrame([(1, None, 0, 0, 0), (2, "", 0, 0, 0), (3, " .,; ", 0, 0, 0), (None, "Äpfel und apple", 0, 0, 0), (5, "apple " * 50_000, 0, 0, 0), (6, "APPLE pie", 0, 0, 0), (6, "APPLE pie", 0, 0, 0)], schema)
    items = spark.createDataFrame([(1, None, 9), (2, "", 9), (3, "Apple", 9), (3, "Apple", 8), (3, "pie", 9), (None, "apple", 9), (5, "absent", 9)], "item_id long, text string, doc_id long")
    plain = [(r["doc_id"], r["text"]) for r in docs.collect()]
    expected = brute(plain, [(3, "Apple"), (3, "pie"), (None, "apple")])
    assert rows(maxscore.top_documents(docs, items)) == expected
    assert maxscore.top_documents(docs.limit(0), items).count() == 0
    assert maxscore.top_documents(docs, items.limit(0)).count() == 0
