"""The ten queries against plain Python over the whole small tables."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow.parquet as pq
import pytest
import xxhash

from threadmill.llm import entries, langid, toxicity
from threadmill.plans.cluster import ship

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def docs():
    return sorted(((r["doc_id"], r["text"], r["lang"], r["source"]) for r in pq.read_table(f"{SF}/documents.parquet").to_pylist()), key=lambda r: r[0])


@pytest.fixture(scope="module")
def ids(docs):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(entries.tokenizer_path())
    return {d: t.encode(x or "", add_special_tokens=False).ids + [1] for d, x, *_ in docs}


def run(spark, name):
    return [r.asDict() for r in entries.QUERIES[name](ship(spark), SF).collect()]


def crc(values):
    return zlib.crc32(np.array(values, dtype="<u4").tobytes())


def test_op1(spark, ids):
    rows = run(spark, "op1_best_fit_packing")
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    assert set(by_doc) == set(ids)
    for d, pieces in by_doc.items():
        pieces.sort(key=lambda r: r["piece"])
        whole = ids[d]
        assert [p["piece"] for p in pieces] == list(range(math.ceil(len(whole) / 4096)))
        for p in pieces:
            assert p["start"] == 4096 * p["piece"] and p["length"] == len(whole[p["start"] :][:4096])
            assert p["ids_crc32"] == crc(whole[p["start"] :][:4096])
    for placed in by_sequence.values():
        placed.sort(key=lambda r: r["offset"])
        at = 0
        for p in placed:
            assert p["offset"] == at
            at += p["length"]
        assert at <= 4096
    total = sum(map(len, ids.values()))
    assert len(by_sequence) <= math.ceil(total / 4096) * 1.03 + 1


def test_op2(spark, docs):
    rows = {r["doc_id"]: r for r in run(spark, "op2_nnpu_toxicity")}
    assert set(rows) == {d for d, *_ in docs}
    for d, r in rows.items():
        assert r["held_out"] == (zlib.crc32(str(d).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)


def held_out_quality(spark, sf):
    """(hits, missed, false alarms) over the labelled rows that the fit never saw."""
    toxic = {r["doc_id"]: r["toxic"] for r in pq.read_table(f"{sf}/labels.parquet").to_pylist()}
    rows = {r["doc_id"]: r["predicted"] for r in entries.QUERIES["op2_nnpu_toxicity"](ship(spark), sf).select("doc_id", "held_out", "predicted").collect() if r["held_out"]}
    pairs = Counter((toxic[d], p) for d, p in rows.items() if d in toxic)
    return pairs[1, 1], pairs[1, 0], pairs[0, 1]


def test_op2_quality(spark):
    hits, missed, alarms = held_out_quality(spark, "/root/testdata/sf0.1")
    assert hits >= 0.8 * (hits + missed) and hits >= 0.75 * (hits + alarms)
    hits, missed, alarms = held_out_quality(spark, "/root/testdata/sf0.01")
    assert hits >= 0.5 * (hits + missed) and hits >= 0.75 * (hits + alarms)


def test_op2_plain_training():
    """The trained weights are those of the same steps written out document by document."""
    rng = random.Random(2)
    positive = [sorted({1, *rng.sample(range(2, 60), 8)}) for _ in range(24)]
    unlabelled = [sorted(rng.sample(range(2, 60), 8) + [1] * (i % 10 == 0)) for i in range(120)]
    prior, epochs, ratio, decay = 0.1, 9, 1.05, 5e-4
    model = toxicity.train([np.array(x, dtype=np.uint64) for x in positive], [np.array(x, dtype=np.uint64) for x in unlabelled], prior, epochs=epochs, ratio=ratio)

    have = [{k: sum(k in x for x in rows) for k in range(1, 60)} for rows in (positive, unlabelled)]
    chosen = [k for k in range(1, 60) if have[0][k] >= 3 and (have[0][k] + 0.5) / (have[1][k] * 24 / 120 + 0.5) >= ratio]
    w = {k: 0.0 for k in chosen} | {"bias": -3.0}
    first, second, sums, taken, step = dict.fromkeys(w, 0.0), dict.fromkeys(w, 0.0), dict.fromkeys(w, 0.0), 0, 0
    shuffler = np.random.default_rng(5)
    docs, order = positive + unlabelled, [np.arange(24), np.arange(24, 144)]
    for epoch in range(epochs):
        for o in order:
            shuffler.shuffle(o)
        for some_p, some_u in zip(np.array_split(order[0], 3), np.array_split(order[1], 3)):
            z = {i: w["bias"] + sum(w[k] for k in docs[i] if k in w) for i in [*some_p, *some_u]}
            as_negative = lambda some: sum(math.log(1 + math.exp(z[i])) for i in some) / len(some)
            p = {i: 1 / (1 + math.exp(-z[i])) for i in z}
            if as_negative(some_u) - prior * as_negative(some_p) >= 0:  # the risk as it is
                g = {i: -prior * (1 - p[i]) / len(some_p) - prior * p[i] / len(some_p) for i in some_p} | {i: p[i] / len(some_u) for i in some_u}
            else:  # back from where the unlabelled part is negative
                g = {i: prior * p[i] / len(some_p) for i in some_p} | {i: -p[i] / len(some_u) for i in some_u}
            step += 1
            for k in w:
                grad = sum(v for i, v in g.items() if k == "bias" or k in docs[i]) + (decay * w[k] if k != "bias" else 0)
                first[k] = 0.9 * first[k] + 0.1 * grad
                second[k] = 0.999 * second[k] + 0.001 * grad * grad
                w[k] -= 0.05 * first[k] / (1 - 0.9**step) / (math.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
            if 3 * epoch >= 2 * epochs:
                taken += 1
                sums = {k: sums[k] + w[k] for k in w}
    assert set(model.weights) == set(chosen) and 1 in chosen
    for k in chosen:
        assert model.weights[k] == pytest.approx(sums[k] / taken, abs=1e-6)
    assert model.bias == pytest.approx(sums["bias"] / taken, abs=1e-6)


def test_op3(spark):
    table = pq.read_table(f"{SF}/embeddings.parquet").to_pylist()
    ids = np.array([r["vec_id"] for r in table])
    vectors = np.array([r["embedding"] for r in table], dtype=np.float64)
    found = defaultdict(list)
    for r in run(spark, "op3_rotated_codes"):
        found[r["query_id"]].append(r)
    hits = total = 0
    for i in np.flatnonzero(ids % 20 == 0):
        score = (vectors * vectors[i]).sum(axis=1)
        rest = np.flatnonzero(ids != ids[i])
        best = rest[np.lexsort((ids[rest], -score[rest]))][:20]
        mine = sorted(found[ids[i]], key=lambda r: r["rank"])
        assert [r["rank"] for r in mine] == list(range(1, len(best) + 1))
        assert all(abs(r["score"] - score[ids == r["vec_id"]][0]) < 1e-9 for r in mine)
        assert sorted(mine, key=lambda r: (-r["score"], r["vec_id"])) == mine
        hits += len({r["vec_id"] for r in mine} & set(ids[best].tolist()))
        total += len(best)
    assert hits >= 0.99 * total


def test_op4(spark, docs):
    rows = {r["doc_id"]: r for r in run(spark, "op4_canonical_digest")}
    texts = [x or "" for _, x, *_ in docs]
    same = defaultdict(set)
    for k, (d, *_) in enumerate(docs):
        t, n = texts[k], texts[(k + 1) % len(texts)]
        edited = t[: len(t) - len(t) // 2] + n[: len(t) // 2]
        r = rows[d]
        assert r["n_chars"] == len(t)
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert r["near_next"] == float(r["fingerprint"] == rows[docs[(k + 1) % len(docs)][0]]["fingerprint"])
        assert r["near_edited"] == float(r["fingerprint"] == r["edited_fingerprint"])
        same[t].add(r["fingerprint"])
    assert all(len(v) == 1 for v in same.values())


def test_op5(spark, docs):
    rows = {r["doc_id"]: r for r in run(spark, "op5_pivotal_mixing")}
    size = {d: len(WORD.findall(x or "")) for d, x, *_ in docs}
    sources = sorted({s for *_, s in docs}, key=lambda s: s.encode())
    total = {s: sum(size[d] for d, _, _, t in docs if t == s) for s in sources}
    weight = {s: k % 3 + 1 for k, s in enumerate(sources)}
    target, full = {}, set()
    while True:
        left = sum(total.values()) - sum(3 * total[s] for s in full)
        per = left / sum(weight[s] for s in sources if s not in full)
        target = {s: 3 * total[s] if s in full else per * weight[s] for s in sources}
        over = {s for s in sources if target[s] > 3 * total[s]}
        if not over:
            break
        full |= over
    taken, largest = Counter(), Counter()
    for d, _, _, s in docs:
        r = rows[d]
        assert r["size"] == size[d] and r["source_size"] == total[s] and r["target"] == pytest.approx(target[s])
        assert 0 <= r["taken"] <= 3 * size[d] and r["taken"] == r["copies"] * size[d]
        taken[s] += r["taken"]
        largest[s] = max(largest[s], size[d])
    assert all(abs(taken[s] - target[s]) <= largest[s] + 1e-6 for s in sources)
    assert {d: r["taken"] for d, r in rows.items()} == {r["doc_id"]: r["taken"] for r in run(spark, "op5_pivotal_mixing")}


def test_op6(spark, docs):
    rows = run(spark, "op6_two_pass_shuffle")
    texts = {d: (x or "").encode() for d, x, *_ in docs}
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    shards = defaultdict(list)
    for r in rows:
        t = texts[r["doc_id"]]
        assert r["size"] == len(t) + 1 and r["text_crc32"] == zlib.crc32(t) and r["law"] == "rows" and r["grown_shard"] is None
        shards[r["shard"]].append(r["slot"])
    assert set(shards) == set(range(16))
    assert all(sorted(s) == list(range(len(s))) for s in shards.values())
    assert max(map(len, shards.values())) - min(map(len, shards.values())) <= 1
    where = {r["doc_id"]: (r["shard"], r["slot"]) for r in rows}
    assert where == {r["doc_id"]: (r["shard"], r["slot"]) for r in run(spark, "op6_two_pass_shuffle")}
    ranks = [where[d] for d in sorted(where)]
    assert abs(np.corrcoef(np.arange(len(ranks)), np.argsort(np.argsort([s * 1000 + k for s, k in ranks])))[0, 1]) < 0.25


def test_op7(spark, docs):
    rows = {r["doc_id"]: r for r in run(spark, "op7_output_codes")}
    assert set(rows) == {d for d, *_ in docs}
    held = [(rows[d]["lang_pred"], lang) for d, x, lang, _ in docs if zlib.crc32(str(d).encode()) % 3 == 1]
    assert sum(a == b for a, b in held) >= 0.85 * len(held)
    for d, x, *_ in docs:
        assert rows[d]["held_out"] == (zlib.crc32(str(d).encode()) % 3 == 1)
        assert 0 <= rows[d]["score"] <= 1
        assert (rows[d]["lang_pred"] == "und") == (not any(c.isalpha() for c in x or ""))


def test_op7_plain_decoder(spark, docs):
    """Margins and decoding of a text, n-gram by n-gram, give the query's language and score."""
    rows = {r["doc_id"]: r for r in run(spark, "op7_output_codes")}
    table = entries.table(spark, SF, "documents")
    model = langid.fit(table.filter(entries.remainder(3) != 1))
    for d, x, *_ in docs[:40]:
        data = langid.letters(x)
        grams = [(int.from_bytes(data[i : i + n], "little") * (2654435761 * (2 * n + 1) & 0xFFFFFFFF) & 0xFFFFFFFF) >> 16 for n in langid.ORDERS for i in range(len(data) - n + 1)]
        if not grams:
            assert rows[d]["lang_pred"] == "und"
            continue
        bits = range(model.code.shape[1])
        margin = [sum(float(model.weights[g, b]) for g in grams) / len(grams) for b in bits]
        loss = []
        for word in model.code.tolist():
            each = [math.log(1 + math.exp(-word[b] * (margin[b] - model.bias[b]) * model.scale[b])) * model.trust[b] for b in bits]
            loss.append(sum(each) / sum(model.trust))
        best = loss.index(min(loss))
        assert rows[d]["lang_pred"] == model.langs[best]
        assert rows[d]["score"] == pytest.approx(1 / sum(math.exp(-8 * (v - loss[best])) for v in loss), abs=1e-4)
        assert rows[d]["ambiguous"] == (sorted(loss)[1] - sorted(loss)[0] < 0.02)


def simhash(text, each=4):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i : i + each]) for i in range(max(1, len(words) - each + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def test_op8(spark, docs):
    rows = {r["doc_id"]: r for r in run(spark, "op8_simhash_groups")}
    prints = {d: simhash(x) for d, x, *_ in docs}
    root = {d: d for d in prints}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    names = sorted(prints)
    for i, a in enumerate(names):
        for b in names[i + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= 4:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    for d in names:
        assert rows[d]["fingerprint"] == f"{prints[d]:016x}"
        assert rows[d]["component_id"] == find(d)


def test_op10(spark, ids):
    rows = {r["doc_id"]: r for r in run(spark, "op10_packed_ids")}
    start = 0
    for d in sorted(ids):
        r = rows[d]
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (start, len(ids[d]), crc(ids[d]))
        start += len(ids[d])
