"""The whole pipeline: each stage's decisions hold in what the last one returns."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from threadmill.llm import shinglesets
from threadmill.llm import simhash as simhash_operator

from .test_contracts import WORD, simhash

SF = "/root/testdata/sf0.001"


def test_run(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before, rows = docs, []
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, before, SF)
        rows = [r.asDict() for r in after.collect()]
        if name == "language":
            assert len(rows) >= 0.97 * before.count()
        elif name == "lines":
            lines = Counter()
            for r in before.collect():
                lines.update({x.strip(" \t\n\x0b\x0c\r").lower() for x in r["text"].split("\n")})
            # keys here have no letters that lower() and A-Z lower-casing treat differently
            want = {r["doc_id"]: "\n".join(x for x in r["text"].split("\n") if not x.strip(" \t\n\x0b\x0c\r") or lines[x.strip(" \t\n\x0b\x0c\r").lower()] < 10) for r in before.collect()}
            assert {r["doc_id"]: r["text"] for r in rows} == want
        elif name == "near_copies":
            assert sorted(r["doc_id"] for r in rows) == sorted(smallest_of_groups({r["doc_id"]: r["text"] for r in before.collect()}))
        elif name == "mixing":
            n = Counter(r["doc_id"] for r in rows)
            assert max(n.values()) <= 3 and set(n) <= {r["doc_id"] for r in before.collect()}
            words = sum(len(WORD.findall(r["text"])) for r in rows)
            assert abs(words / sum(len(WORD.findall(r["text"])) for r in before.collect()) - 1) < 0.2
        else:
            assert Counter(r["doc_id"] for r in rows if r["piece"] == 0) == Counter(r["doc_id"] for r in before.collect())
        if name != "packing":
            before = spark.createDataFrame(after.collect(), docs.schema)
    assert len(corpus_pipeline.run(spark, SF).columns) >= 7


def smallest_of_groups(texts):
    """The smallest id of each group that fingerprints within 4 bits, or shingle sets alike by 0.8, connect."""
    prints, made = {d: simhash(t, 5) for d, t in texts.items()}, {d: sets(t) for d, t in texts.items()}
    root = {d: d for d in texts}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    order = sorted(texts)
    for i, a in enumerate(order):
        for b in order[:i]:
            alike = made[a] and made[b] and len(made[a] & made[b]) >= 0.8 * len(made[a] | made[b])
            if alike or (prints[a] ^ prints[b]).bit_count() <= 4:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {find(d) for d in texts}


def test_copies_survive(spark):
    """Of twelve copies one reaches the last stage whole; a line of twelve different texts goes."""
    copy = "\n".join(f"the people of the village number{i} went with their children to the market and came home in the evening" for i in range(5))
    rows = [(i, copy, "en", "a") for i in range(12)]
    rows += [(100 + i, f"this is the story number{i} which was told by the old man of house{i} to all of us\nAll rights reserved.", "en", "a") for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    lines = {r["doc_id"]: r["text"] for r in corpus_pipeline.line_stage(spark, docs, "").collect()}
    assert all(lines[i] == copy for i in range(12)) and not any("rights" in lines[100 + i] for i in range(12))
    stages, after = dict(corpus_pipeline.STAGES), spark.createDataFrame([(d, t, "en", "a") for d, t in lines.items()], docs.schema)
    for name in ("near_copies", "mixing", "packing"):
        after = stages[name](spark, after, "")
    assert {r["doc_id"] for r in after.collect() if r["doc_id"] < 100} == {0}


def sets(text):
    words = (text or "").encode().lower().split()
    return {b" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


@pytest.mark.parametrize("limits", [(32, 512), (1, 5)])
def test_near_texts(spark, monkeypatch, limits):
    """Of texts that chains of similarity 0.8 connect one stays, in small buckets and by tiles; fingerprints miss most of them."""
    for module in (shinglesets, simhash_operator):
        monkeypatch.setattr(module, "JOIN_MAX", limits[0])
        monkeypatch.setattr(module, "CHUNK", limits[1])
    rng = np.random.default_rng(4)
    rows = []
    for g in range(6):
        base = [f"word{k}" for k in rng.integers(0, 5000, 100)]
        for i in range(12):
            words = list(base)
            for at in rng.integers(0, 100, int(rng.integers(0, 4))):
                words[at] = f"other{rng.integers(0, 5000)}"
            rows.append((20 * g + i, " ".join(words), "en", "a"))
    rows += [(900, None, "en", "a"), (901, "", "en", "a"), (902, "three words only", "en", "a"), (903, "Three  words ONLY", "en", "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    want = smallest_of_groups({d: t for d, t, *_ in rows})
    left = corpus_pipeline.near_copy_stage(spark, docs, "")
    assert {r["doc_id"] for r in left.collect()} == want and len(want) < 40
    assert simhash_operator.keep_one(docs, words_each=5).count() > len(want)
    assert corpus_pipeline.near_copy_stage(spark, docs.limit(0), "").count() == 0


def test_near_pair(spark):
    """A pair that fingerprints miss."""
    docs = spark.createDataFrame([(i, " ".join(f"w{k}x" for k in range(100) if i == 0 or k % 100 != 50), "en", "a") for i in range(2)], "doc_id long, text string, lang string, source string")
    assert {r["doc_id"] for r in corpus_pipeline.near_copy_stage(spark, docs, "").collect()} == {0}
