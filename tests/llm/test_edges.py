"""Nulls, empty and long texts, repeated rows, empty tables and clashing column names, for every operator and stage."""

from __future__ import annotations

import hashlib
import unicodedata
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from threadmill.llm import ann, binary_ids, digest, entries, langid, linededup, mixing, packing, scratch, sharding, simhash, skew, toxicity
from threadmill.llm.scratch import new_path, written

LONG = "lorem ipsum dolor sit amet " * 20_000
ROWS = [
    (0, "the quick brown fox jumps over the lazy dog", "en", "a"),
    (0, "the quick brown fox jumps over the lazy dog", "en", "a"),
    (0, "another text with the same id", "en", "a"),
    (1, None, None, None),
    (2, "", "en", "b"),
    (3, " \n\t ", "fr", "b"),
    (None, "a text without an id", "en", None),
    (None, None, None, None),
    (4, LONG, "es", "c"),
    (5, "12345 !!!", "de", "c"),
    (6, "ÉCOLE école\n\nligne", "fr", "c"),
    (7, "<|endoftext|> \x01 odd", "en", "d"),
]
SCHEMA = "doc_id long, text string, lang string, source string"
CLASH = ["fp", "tag", "key", "size", "bucket", "h1", "part", "n", "pos", "score", "target", "line", "spot", "words", "k", "rank", "length", "count"]
CLASH += ["__id", "__tag", "__n", "__a", "__shard", "__slot", "__copy", "row", "id", "mark", "h", "shard", "slot", "dropped", "copies", "number", "none", "place", "node", "guess", "a.b"]
CLASHING = {c: f"{i} clash" for i, c in enumerate(CLASH)}


@pytest.fixture(scope="module")
def messy(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    return df.withColumns({c: F.lit(v) for c, v in CLASHING.items()}).repartition(3)


@pytest.fixture(scope="module")
def none(messy):
    return messy.limit(0)


def unchanged(df, like):
    """Whether every row of ``df`` has the columns of ``like``, and the clashing ones their values."""
    rows = [r.asDict() for r in df.collect()]
    return df.columns == like.columns and all(r[c] == v for r in rows for c, v in CLASHING.items())


def encode(text):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(entries.tokenizer_path()).encode(text or "", add_special_tokens=False).ids + [1]


def test_packing(messy, none):
    rows = packing.pack_documents(messy, entries.tokenizer_path(), 64).collect()
    assert sum(r["length"] for r in rows) == sum(len(encode(t)) for _, t, *_ in ROWS)
    per = {}
    for r in rows:
        per.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for placed in per.values():
        placed.sort()
        assert [o for o, _ in placed] == np.concatenate(([0], np.cumsum([n for _, n in placed])[:-1])).tolist()
        assert sum(n for _, n in placed) <= 64
    assert packing.pack_documents(none, entries.tokenizer_path(), 64).count() == 0


def test_sequences(messy):
    """The sequences hold every document's ids, in the places that the pieces name."""
    packed = packing.pack_documents(messy.filter("doc_id <> 4"), entries.tokenizer_path(), 16, with_ids=True)
    rows = packing.sequences(written(packed, "packed")).collect()
    found = {}
    for r in rows:
        assert len(r["ids"]) <= 16 and sum(d["length"] for d in r["documents"]) == len(r["ids"])
        for d in r["documents"]:
            found.setdefault(d["doc_id"], []).append((d["piece"], r["ids"][d["offset"] : d["offset"] + d["length"]]))
    assert [i for _, part in sorted(found[7]) for i in part] == encode(ROWS[11][1])
    assert [i for _, part in sorted(found[6]) for i in part] == encode(ROWS[10][1])


@pytest.mark.parametrize("score", ["norm", "dot"])
def test_packing_bounds(score):
    rng = np.random.default_rng(0)
    lengths = -np.sort(-rng.integers(1, 100, 500))
    bins, offsets = packing.pack_group(lengths, (100.0, 3.0, 6000.0), (1.0, 0.3, 0.3), score)
    for b in set(bins.tolist()):
        own = lengths[bins == b]
        assert own.sum() <= 100 and len(own) <= 3
        assert (own**2).sum() <= 6000 or len(own) == 1
        assert sorted(offsets[bins == b]) == np.concatenate(([0], np.cumsum(own)[:-1])).tolist()


@pytest.mark.parametrize("score", ["norm", "dot"])
def test_pack_three_bounds(spark, score):
    """Tokens, documents and attention each decide somewhere; only a lone piece may cost more than the bound."""
    lengths = [100] + [40] * 20 + [55, 54, 52, 50] * 3 + [1] * 40 + [3] * 7
    pieces = written(spark.createDataFrame([(i, n) for i, n in enumerate(lengths)], "doc_id long, length long"), "pieces")
    per = {}
    for r in packing.pack(pieces, 100, max_pieces=4, max_attention=5000, score=score).collect():
        per.setdefault(r["sequence_id"], []).append(r["length"])
    assert sorted(n for own in per.values() for n in own) == sorted(lengths)
    for own in per.values():
        assert sum(own) <= 100 and len(own) <= 4
        assert sum(n * n for n in own) <= 5000 or len(own) == 1
    assert [100] in per.values()
    assert any(len(own) == 4 for own in per.values()) and not any(own.count(40) > 3 for own in per.values())
    tight = packing.pack(pieces, 100, max_attention=3000, score=score).groupBy("sequence_id").agg(F.sum(F.col("length") ** 2).alias("cost"), F.count("*").alias("n"))
    assert tight.filter("cost > 3000 and n > 1").count() == 0 and tight.filter("cost = 10000").count() == 1


def test_binary_ids(spark, messy, none):
    path = new_path(spark, "t")
    binary_ids.write_ids(messy, path, entries.tokenizer_path(), block_ids=100)
    rows = binary_ids.read_digests(spark, path).orderBy("start").collect()
    assert Counter((r["doc_id"], r["n_tokens"]) for r in rows) == Counter((d, len(encode(t))) for d, t, *_ in ROWS)
    at = 0
    for r in rows:
        assert r["start"] == at
        at += r["n_tokens"]
    assert [r["doc_id"] for r in rows] == sorted((r["doc_id"] for r in rows), key=lambda d: (d is not None, d))
    assert binary_ids.read_document(spark, path, 6) == encode(ROWS[10][1])
    assert binary_ids.read_document(spark, path, 99) == []
    # a file for each range of ids, of which random access opens one
    docs = spark.createDataFrame([(i, f"text number {i}") for i in range(400)], SCHEMA.split(", lang")[0])
    path = new_path(spark, "t")
    binary_ids.write_ids(docs, path, entries.tokenizer_path(), block_ids=50, shards=8)
    assert spark.read.parquet(path).select(F.input_file_name()).distinct().count() == 8
    assert binary_ids.block_of(spark, path, 77).select(F.input_file_name()).distinct().count() == 1
    assert binary_ids.read_document(spark, path, 77) == encode("text number 77")
    path = new_path(spark, "t")
    binary_ids.write_ids(none, path, entries.tokenizer_path())
    assert binary_ids.read_digests(spark, path).count() == 0


@pytest.mark.parametrize("bits", [1, 5, 8, 11, 16, 17, 24, 32])
def test_bit_packing(bits):
    ids = np.random.default_rng(bits).integers(0, 2**bits, 70_001, dtype=np.uint64).astype("<u4")
    packed = binary_ids.pack_bits(ids, bits)
    assert len(packed) == -(-len(ids) * bits // 8)
    assert (binary_ids.unpack_bits(packed, len(ids), bits) == ids).all()
    assert (binary_ids.unpack_bits(packed, 777, bits, 65_500) == ids[65_500:66_277]).all()


def test_bits_for():
    assert [binary_ids.bits_for(n) for n in (1, 2, 3, 256, 257, 49408)] == [1, 1, 2, 8, 9, 16]


def test_simhash(messy, none):
    rows = simhash.near_groups(messy).collect()
    assert len(rows) == len(ROWS)
    empty = {r["component_id"] for r in rows if r["fp"] == 0}
    assert empty == {1}  # null, empty and blank texts are linked; the smallest id that is not null
    assert simhash.near_groups(none).count() == 0
    kept = simhash.keep_one(messy)
    assert unchanged(kept, messy)
    texts = Counter(r["text"] for r in kept.collect())
    assert max(texts.values()) == 1 and ROWS[0][1] in texts


def test_simhash_tiles():
    """A bucket taken by tiles gives the components of brute force."""
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, 40, dtype=np.uint64)
    fps = np.unique(np.concatenate([base ^ np.uint64(1 << int(b)) for b in rng.integers(0, 60, 8)] + [base]))
    heads, tails = simhash.spanning_forest(fps, 4)

    def classes(pairs):
        root = list(range(len(fps)))

        def find(i):
            while root[i] != i:
                i = root[i]
            return i

        for a, b in pairs:
            root[find(a)] = find(b)
        return [find(i) for i in range(len(fps))]

    brute = classes((i, j) for i in range(len(fps)) for j in range(i) if int(fps[i] ^ fps[j]).bit_count() <= 4)
    mine = classes(zip(heads.tolist(), tails.tolist()))
    assert len(heads) == len(fps) - len(set(brute))
    assert len({*zip(brute, mine)}) == len(set(brute)) == len(set(mine))


def test_simhash_hot_bucket(spark, monkeypatch):
    """Small limits send every bucket through tiles of several chunks; the groups stay the same."""
    texts = [f"alpha beta gamma delta {i % 3} " * 30 + f"tail {i // 2}" for i in range(60)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    plain = {r["doc_id"]: r["component_id"] for r in simhash.near_groups(docs).collect()}
    monkeypatch.setattr(simhash, "JOIN_MAX", 1)
    monkeypatch.setattr(simhash, "CHUNK", 5)
    assert {r["doc_id"]: r["component_id"] for r in simhash.near_groups(docs).collect()} == plain


def test_components_chain(spark):
    """A long chain and a star settle to their smallest nodes."""
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 100)]
    found = {r["node"]: r["root"] for r in simhash.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(201)}, **{1000 + i: 1000 for i in range(100)}}


def test_components_hub(spark, monkeypatch):
    """One component of 100,000 nodes around hubs: their rows are joined where they are."""
    monkeypatch.setattr(skew, "HOT_ROWS", 1000)
    n = 100_000
    edges = spark.range(1, n).select((F.col("id") - F.pmod("id", F.lit(25_000))).alias("a"), F.col("id").alias("b")).filter("a <> b")
    edges = edges.unionByName(spark.createDataFrame([(25_000 * i, 25_000 * (i + 1)) for i in range(3)], "a long, b long"))
    found = simhash.components(edges)
    assert found.count() == n and found.filter("root <> 0").count() == 0


def test_join_counted(spark, monkeypatch):
    monkeypatch.setattr(skew, "HOT_ROWS", 10)
    rows = spark.createDataFrame([(i if i % 2 else 0, i) for i in range(100)], "key long, i long")
    table = rows.groupBy("key").agg(F.count("*").alias("n"), F.min("i").alias("least"))
    found = skew.join_counted(rows, table, "key", 100)
    assert Counter((r["key"], r["i"], r["least"]) for r in found.collect()) == Counter((k, i, k) for k, i in ((i if i % 2 else 0, i) for i in range(100)))


def test_block_masks():
    masks = simhash.block_masks(4, 6)
    assert len(masks) == 15
    rng = np.random.default_rng(2)
    for _ in range(200):
        flips = sum(1 << int(b) for b in rng.choice(64, 4, replace=False))
        assert any(not flips & (m & (2**64 - 1)) for m in masks)


def test_line_dedup(messy, none):
    clean = linededup.dedup_lines(messy, min_docs=2, keep_first=False)
    assert unchanged(clean, messy)
    rows = clean.collect()
    assert len(rows) == len(ROWS)
    fox = ROWS[0][1]
    assert all(r["text"] != fox for r in rows) and sum(r["text"] == "" for r in rows) == 3
    first = [r["text"] for r in linededup.dedup_lines(messy, min_docs=2, keep_first=True).collect()]
    assert first.count(fox) == 2  # equal rows have equal bitmaps, so both keep the first line
    assert linededup.dedup_lines(none, min_docs=2).count() == 0


@pytest.mark.parametrize("per_text", [False, True])
def test_line_dedup_many_keys(spark, monkeypatch, per_text):
    """More keys than are broadcast, one of them hot: the same lines go."""
    rows = [(i, f"hot\nline {i // 2}\nown {i}\ntext {0 if per_text else i}") for i in range(60)] + [(100 + i, "copy\nof it") for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    options = {"min_docs": 2, "keep_first": False, "per_text": per_text}
    want = {r["doc_id"]: r["text"] for r in linededup.dedup_lines(docs, **options).collect()}
    assert want[7] == ("own 7" if per_text else "own 7\ntext 7") and want[100] == ("copy\nof it" if per_text else "")
    monkeypatch.setattr(linededup, "BROADCAST_KEYS", 0)
    monkeypatch.setattr(skew, "HOT_ROWS", 10)
    assert {r["doc_id"]: r["text"] for r in linededup.dedup_lines(docs, **options).collect()} == want


def test_line_dedup_first(spark):
    docs = spark.createDataFrame([(1, "A\nb\n a\nc"), (2, "a\nd\n\n"), (3, "\nD ")], "doc_id long, text string")
    kept = {r["doc_id"]: r["text"] for r in linededup.dedup_lines(docs, min_docs=2, keep_first=True).collect()}
    assert kept == {1: "A\nb\nc", 2: "d\n\n", 3: ""}
    long = "\n".join(f"line {i}" for i in range(200))
    docs = spark.createDataFrame([(1, long), (2, "line 5\nline 64\nline 199")], "doc_id long, text string")
    maps = {r["doc_id"]: r["dropped"] for r in linededup.drop_bitmaps(docs, min_docs=2, keep_first=False).collect()}
    assert maps == {1: {0: 1 << 5, 1: 1, 3: 1 << 7}, 2: {0: 7}}


def test_mixing(messy, none):
    chosen = mixing.choose_copies(messy).collect()
    assert len(chosen) == len(ROWS)
    assert all(r["copies"] == 0 for r in chosen if r["size"] == 0)
    assert {r["source"] for r in chosen} == {"a", "b", "c", "d", None}
    mixed = mixing.mix(messy)
    assert unchanged(mixed, messy)
    assert mixed.count() == sum(r["copies"] for r in chosen)
    assert mixing.choose_copies(none).count() == 0 and mixing.mix(none).count() == 0


def test_mixing_levels(spark, monkeypatch):
    """Many documents of one source: the tree has several levels and the words come near the target."""
    monkeypatch.setattr(mixing, "FAN_IN", 4)
    monkeypatch.setattr(mixing, "SPLIT", 3)
    rows = [(i if i % 3 else 9, "w " * (1 + i % 17), "x" if i % 4 else "y") for i in range(600)]
    chosen = mixing.choose_copies(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    for s in ("x", "y"):
        own = [r for r in chosen if r["source"] == s]
        assert abs(sum(r["copies"] * r["size"] for r in own) - own[0]["target"]) <= 17
        ratio = own[0]["target"] / own[0]["source_size"]
        assert {r["copies"] for r in own} <= {int(ratio), int(ratio) + 1}


def test_sharding(spark, messy, none):
    path = new_path(spark, "t")
    sharding.shuffle_to_shards(messy, path, n_shards=5, bucket_bytes=2000)
    shards = sharding.read_shards(spark, path, messy)
    assert unchanged(shards.select("row.*"), messy)
    rows = shards.collect()
    assert Counter((r["row"]["doc_id"], r["row"]["text"]) for r in rows) == Counter((d, t) for d, t, *_ in ROWS)
    assert sorted((r["shard"], r["slot"]) for r in rows) == [(s, k) for s in range(5) for k in range(sum(r["shard"] == s for r in rows))]
    path = new_path(spark, "t")
    sharding.shuffle_to_shards(none, path)
    assert sharding.read_shards(spark, path, none).count() == 0


def placed(spark, docs, **options):
    path = new_path(spark, "t")
    sharding.shuffle_to_shards(docs, path, n_shards=4, **options)
    rows = sharding.read_shards(spark, path, docs).select("shard", "slot", "row.doc_id").collect()
    return [r["doc_id"] for r in sorted(rows, key=lambda r: (r["shard"], r["slot"]))]


def test_sharding_order(spark):
    """A shuffle, the same at any number of shuffle partitions, another with another seed."""
    docs = spark.createDataFrame([(i, "x" * (i % 50)) for i in range(2000)], "doc_id long, text string")
    order = placed(spark, docs, bucket_bytes=8000)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in ("4", "7"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            assert placed(spark, docs.repartition(3), bucket_bytes=8000) == order
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert sorted(order) == list(range(2000)) and placed(spark, docs, bucket_bytes=8000, seed=18) != order
    ranks = np.argsort(order)
    assert abs(np.corrcoef(np.arange(2000), ranks)[0, 1]) < 0.1
    together = np.mean(np.abs(np.diff(ranks)) < 20)  # neighbours that stay near each other
    assert together < 0.05


def test_sharding_heavy(spark, monkeypatch):
    """Equal rows beyond a bucket's number are dealt to all buckets and lost nowhere."""
    monkeypatch.setattr(sharding, "BUCKET_ROWS", 100)
    docs = spark.createDataFrame([(7, "same")] * 900 + [(i, f"text {i}") for i in range(600)], "doc_id long, text string").repartition(3)
    found = placed(spark, docs, bucket_bytes=8000)
    assert Counter(found) == Counter([7] * 901 + [i for i in range(600) if i != 7])
    halves = [found[: len(found) // 2].count(7), found[len(found) // 2 :].count(7)]
    assert min(halves) > 350


def test_digest(messy, none):
    rows = digest.fingerprint_documents(messy).collect()
    assert Counter((r["doc_id"], r["n_chars"]) for r in rows) == Counter((d, len(t or "")) for d, t, *_ in ROWS)
    empty = {r["fingerprint"] for r in rows if r["n_chars"] == 0}
    assert len(empty) == 1
    assert digest.canonical("ÉCOLE  École\n") == digest.canonical("école école")
    assert digest.canonical("straße ﬁ") == digest.canonical("STRASSE FI")
    assert digest.fingerprint_documents(none).count() == 0


def test_fingerprints(messy, none):
    rows = digest.fingerprints(messy).collect()
    assert len(rows) == len(ROWS)
    groups = {}
    for r in rows:
        groups.setdefault(r["fingerprint"], set()).add(r["first_id"])
    assert all(len(v) == 1 for v in groups.values()) and len(groups) == len({digest.canonical(t or "") for _, t, *_ in ROWS})
    assert digest.fingerprints(none).count() == 0


def test_digest_alone(spark):
    one = spark.createDataFrame([(3, "abcd")], "doc_id long, text string")
    row = digest.fingerprint_documents(one).first()
    assert row["edited_sha256"] == hashlib.sha256(b"abab").hexdigest() and row["near_next"] == 1.0


def test_digest_edges(spark):
    """Over more partitions than documents, and with ids that leave partitions empty, each document meets the next one."""
    texts = {d: f"text of {d}" for d in [*range(5), *range(100, 104), 1000]}
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "16")
        rows = digest.fingerprint_documents(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    order = sorted(texts)
    following = dict(zip(order, order[1:] + order[:1]))
    assert len(rows) == len(texts)
    for r in rows:
        edited = digest.edited_text(texts[r["doc_id"]], texts[following[r["doc_id"]]])
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()


def test_digest_collision(messy, monkeypatch):
    """With a digest of two bits, byte comparison still tells texts apart."""
    monkeypatch.setattr(digest, "digest", lambda form: str(len(form) % 2))
    rows = digest.fingerprint_documents(messy).collect()
    assert len({r["fingerprint"] for r in rows}) == len({digest.canonical(t or "") for _, t, *_ in ROWS})


def test_langid(messy, none):
    model = langid.fit(messy)
    rows = messy.select("text", langid.language(model, messy)(F.col("text")).alias("g")).select("text", "g.*").collect()
    assert len(rows) == len(ROWS)
    for r in rows:
        assert (r["lang_pred"] == "und") == (not any(c.isalpha() for c in r["text"] or "")) and 0 <= r["score"] <= 1
    for text in ("² ½", "Ⅷ", "①②", "12_3", "٣", "", None):
        assert model.predict([text], 0.02)[0] == ["und"]
    for text in ("ª", "五", "x²"):
        assert model.predict([text], 0.02)[0] != ["und"]
    empty = langid.fit(none)
    assert {r[0]["lang_pred"] for r in messy.select(langid.language(empty, messy)(F.col("text"))).collect()} == {"und"}


def test_langid_batches():
    """A text's margins do not depend on its neighbours or on where a chunk ends."""
    rng = np.random.default_rng(0)
    model = langid.Model(["a", "b"], langid.codewords(2), np.vstack([rng.standard_normal((langid.BUCKETS, 1)), [[0]]]).astype(np.float32), np.ones(1), np.zeros(1), np.ones(1))
    texts = [langid.letters(t) for t in ("ein kurzer text", "x", "word " * 150_000, "un texte", None)]
    alone = np.vstack([model.margins([t]) for t in texts])
    assert np.allclose(model.margins(texts), alone)


def test_codewords():
    for n in (2, 4, 6, 20):
        code = langid.codewords(n)
        assert len({tuple(r) for r in code.tolist()}) == n


def test_toxicity(spark, messy, none):
    labels = spark.createDataFrame([(0, 1), (0, 0), (4, 0), (None, 1), (5, None), (99, 1)], "doc_id long, toxic int")
    for docs, marks in ((messy, labels), (messy, labels.limit(0)), (messy, labels.filter("toxic = 0"))):
        model = toxicity.fit(docs, marks)
        scores = [r[0] for r in docs.select(toxicity.toxicity(model, docs)(F.col("text"))).collect()]
        assert len(scores) == len(ROWS) and all(0 <= s <= 1 for s in scores)
    assert toxicity.fit(none, labels).weights == {}


def test_toxicity_prior(spark, monkeypatch):
    """The prior is the share among the labels, however small, or what the caller says."""
    seen = []
    monkeypatch.setattr(toxicity, "train", lambda positive, unlabelled, prior: seen.append(prior))
    docs = spark.createDataFrame([(i, f"word{i}") for i in range(2000)], "doc_id long, text string")
    labels = docs.select("doc_id", (F.col("doc_id") == 0).cast("int").alias("toxic"))
    toxicity.fit(docs, labels)
    toxicity.fit(docs, labels, prior=0.25)
    assert seen == [1 / 2000, 0.25]


def test_toxicity_learns():
    """Unlabelled text that holds positives: the non-negative risk still separates them."""
    rng = np.random.default_rng(0)
    clean = lambda: rng.integers(100, 400, 30)
    bad = lambda: np.append(clean(), rng.integers(0, 5, 2))
    model = toxicity.train([bad() for _ in range(300)], [bad() if i % 10 == 0 else clean() for i in range(3000)], 0.1)
    z = lambda f: model.bias + sum(model.weights.get(int(k), 0) for k in set(f.tolist()))
    toxic, fine = [z(bad()) for _ in range(300)], [z(clean()) for _ in range(300)]
    assert min(np.percentile(toxic, 1) - np.percentile(fine, 99), 0.5) == 0.5  # a wide gap, in log odds
    threshold = np.log(0.3 / 0.7)
    assert np.mean(np.array(fine) > threshold) < 0.02 and np.mean(np.array(toxic) > threshold) > 0.75


def test_toxicity_few_positives():
    """Thirty positives suffice: words that few of them have, and other documents lack, are learned."""
    rng = np.random.default_rng(1)
    clean = lambda: rng.integers(100, 400, 30)
    bad = lambda: np.append(clean(), rng.choice(10, 3, replace=False))
    model = toxicity.train([np.unique(bad()) for _ in range(30)], [np.unique(bad() if i % 10 == 0 else clean()) for i in range(600)], 0.1)
    z = lambda f: model.bias + sum(model.weights.get(int(k), 0) for k in set(f.tolist()))
    assert set(range(10)) <= set(model.weights)
    toxic, fine = np.array([z(bad()) for _ in range(300)]), np.array([z(clean()) for _ in range(300)])
    assert np.mean(toxic > np.log(0.3 / 0.7)) > 0.75 and np.mean(fine > np.log(0.3 / 0.7)) < 0.1


def test_ann(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.standard_normal(9).tolist()) for i in range(200)]
    rows += [(200, None), (201, [0.0] * 9), (202, [1.0] * 8), (203, [float("nan")] + [1.0] * 8), (204, [float("inf")] + [1.0] * 8), (205, [None] + [1.0] * 8), (None, [1.0] * 9), (206, [])]
    rows += [(300 + i, rows[7][1]) for i in range(100)]  # ties
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns({"rank": F.lit(1), "score": F.lit(2), "x": F.lit(3)})
    found = ann.nearest(df, query_every=20, k=5, block_rows=64, block_queries=4).collect()
    good = {i: np.array(v, dtype=np.float32).astype(float) for i, v in rows if i is not None and v and len(v) == 9 and None not in v and np.isfinite(v).all() and any(v)}
    hits = 0
    queries = [i for i in good if i % 20 == 0]
    for q in queries:
        best = sorted(((-float((good[i] * good[q]).sum()), i) for i in good if i != q))[:5]
        mine = sorted((r["rank"], r["vec_id"]) for r in found if r["query_id"] == q)
        hits += len({i for _, i in best} & {i for _, i in mine})
        assert len(mine) == 5
    assert hits >= 0.95 * 5 * len(queries)
    assert ann.nearest(df.limit(0)).count() == 0


@pytest.mark.parametrize("per_text", [False, True])
def test_line_keys_shuffled(spark, monkeypatch, per_text):
    """More keys than are broadcast, one of them many times in one document: the same bitmaps."""
    rows = [(i, "\n".join(["hot"] * (400 if i == 3 else 1) + [f"pair {i // 2}", f"own {i}"])) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    seen = []
    for keys in (linededup.BROADCAST_KEYS, 0):
        monkeypatch.setattr(linededup, "BROADCAST_KEYS", keys)
        monkeypatch.setattr(skew, "HOT_ROWS", 50)
        seen.append({r["doc_id"]: r["text"] for r in linededup.dedup_lines(df, min_docs=2, keep_first=False, per_text=per_text).collect()})
    assert seen[0] == seen[1] == {i: f"own {i}" for i in range(40)}


def test_ann_pieces(monkeypatch):
    """Thresholds that run through many pieces of a block lose no more than one, and equal vectors go by id."""
    monkeypatch.setattr(ann, "CHUNK", 500)
    rng = np.random.default_rng(8)
    vectors = rng.standard_normal((6000, 24)).astype(np.float32)
    vectors[3000:3100] = vectors[17]
    ids = rng.permutation(6000)
    asked = np.append(np.arange(0, 6000, 80), 17)
    queries = vectors[asked].astype(float)
    who, which, score = ann.search_block(ids, vectors, ids[asked], queries, 10, 1.9, ann.rotation(24))
    hits = 0
    for i, q in zip(ids[asked], queries):
        true = (vectors.astype(float) * q).sum(axis=1)
        best = [j for j in np.lexsort((ids, -true)) if ids[j] != i][:10]
        mine = which[who == i]
        assert len(mine) == 10
        assert np.array_equal(score[who == i], [true[ids == j][0] for j in mine])
        assert list(np.lexsort((mine, -score[who == i]))) == list(range(10))
        hits += len(set(mine.tolist()) & set(ids[best].tolist()))
    assert hits >= 0.98 * 10 * len(asked)
    copies = np.append(ids[3000:3100], ids[17])
    assert which[who == ids[17]].tolist() == sorted(set(copies.tolist()) - {ids[17]})[:10]


@pytest.mark.parametrize("dtype,size", [("float", 3e38), ("double", 1e150), ("float", 1e-44), ("double", 1e-150)])
def test_ann_extreme_components(spark, dtype, size):
    """Components near the ends of their type's range lose no vector."""
    rows = [(i, [size, size * (i % 3) / 3, 0.0]) for i in range(60)]
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{dtype}>").coalesce(2)
    found = ann.nearest(df, query_every=20, k=4).collect()
    assert sorted((r["query_id"], r["rank"]) for r in found) == [(q, n) for q in (0, 20, 40) for n in (1, 2, 3, 4)]
    assert [r["vec_id"] for r in sorted(found, key=lambda r: r["rank"]) if r["query_id"] == 20] == [2, 5, 8, 11]


def test_ann_repeated_id(spark):
    """Of rows with one id the smallest vector is searched, in whatever order they come."""
    rows = [(20, [1.0, 0.0]), (20, [0.0, 1.0]), (1, [1.0, 0.0]), (2, [0.0, 1.0])]
    for some in (rows, rows[::-1]):
        df = spark.createDataFrame(some, "vec_id long, embedding array<float>").coalesce(1)
        assert [r["vec_id"] for r in ann.nearest(df, k=1).collect()] == [2]


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stages(spark, messy, none, name, stage):
    assert stage(spark, none, "").count() == 0
    out = written(stage(spark, messy, ""), "stage")
    found = Counter(r[0] for r in out.select("doc_id").collect())
    every = Counter(d for d, *_ in ROWS)
    if name == "packing":
        assert out.groupBy("doc_id").agg(F.sum("length").alias("n")).collect() and set(found) == set(every)
        total = out.agg(F.sum("length"), F.sum(F.octet_length("ids"))).first()
        assert total[0] == sum(len(encode(t)) for _, t, *_ in ROWS) and total[1] == 4 * total[0]
        return
    assert unchanged(out, messy)
    texts = [r[0] for r in out.select("text").collect()]
    if name == "language":
        assert set(texts) <= {t for _, t, *_ in ROWS if any(c.isalpha() for c in t or "")} and found[0] >= 2
    elif name == "lines":
        assert Counter(texts) == Counter(t for _, t, *_ in ROWS)  # no line is in ten texts
    elif name == "near_copies":
        assert found == Counter({0: 2, 1: 1, None: 1, 4: 1, 5: 1, 6: 1, 7: 1}) and sum(not (t or "").strip() for t in texts) == 1
    else:
        assert all((t or "").split() for t in texts) and all(n <= 3 * every[d] for d, n in found.items())


def test_clear_scratch(spark):
    df = written(spark.range(3), "t")
    assert df.count() == 3 and scratch.clear_scratch(spark) > 0 and scratch.clear_scratch(spark) == 0
    with pytest.raises(Exception):
        written(spark.range(3), "t").unionByName(df).count()


def test_scratch_needs_shared_folder():
    class Cluster:
        conf = type("Conf", (), {"get": staticmethod(lambda *_: None)})
        sparkContext = type("Context", (), {"master": "spark://host:7077", "getCheckpointDir": staticmethod(lambda: None)})

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch.scratch_dir(Cluster)


def test_digest_brute(spark):
    """Fingerprints of whole texts by an independent NFKC, case fold, white-space fold and xxh3; only repeated digests reach the byte comparison."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r["doc_id"]: r["text"] or "" for r in docs.select("doc_id", "text").collect()}

    def plain(text):
        folded = unicodedata.normalize("NFKC", unicodedata.normalize("NFKC", text).casefold())
        return xxhash.xxh3_128(" ".join(folded.split()).encode()).hexdigest()

    rows = digest.fingerprint_documents(docs).collect()
    assert len(rows) == len(texts)
    order = sorted(texts)
    following = dict(zip(order, order[1:] + order[:1]))
    for r in rows:
        text, after = texts[r["doc_id"]], texts[following[r["doc_id"]]]
        half = len(text) // 2
        assert (r["fingerprint"], r["edited_fingerprint"]) == (plain(text), plain(text[: len(text) - half] + after[:half]))
    once = spark.createDataFrame([(i, f"text {i}") for i in range(20)] + [(90, "Twice"), (91, "twice ")], "doc_id long, text string")
    tags = once.filter("doc_id >= 90").select(F.xxhash64("text").alias("tag"))
    assert digest.collided(once, tags).count() == 0
    assert {r["fingerprint"] for r in digest.fingerprint_documents(once).filter("doc_id >= 90").collect()} == {digest.digest(b"twice")}


@pytest.mark.parametrize("broadcast", [0, 200_000])
def test_digest_joins(messy, monkeypatch, broadcast):
    """Tables too large to be broadcast give the same rows."""
    monkeypatch.setattr(digest, "BROADCAST_DIGESTS", broadcast)
    rows = digest.fingerprint_documents(messy).collect()
    assert len(rows) == len(ROWS) and len({r["fingerprint"] for r in rows}) == len({digest.canonical(t or "") for _, t, *_ in ROWS})


def test_simhash_hot_key(spark):
    """One key of 20,000 fingerprints stays where its rows are, and loses no link."""
    rng = np.random.default_rng(6)
    # the upper third is the same for all, so they share one key and differ widely in the rest
    fps = np.unique(rng.integers(0, 1 << 42, 20_000, dtype=np.int64))
    linked = fps[:50] ^ 1
    nodes = spark.createDataFrame([(int(f),) for f in np.unique(np.concatenate([fps, linked]))], "fp long").withColumn("node", F.col("fp")).repartition(8)
    values = np.unique(np.concatenate([fps, linked])).view(np.uint64)
    expected = {(int(values[i]), int(v)) for i in range(len(values)) for v in values[i + 1 :][np.bitwise_count(values[i + 1 :] ^ values[i]) <= 4]}
    roots = {r["node"]: r["root"] for r in simhash.components(simhash.close_pairs(nodes)).collect()}
    assert len(expected) >= 50 and set(roots) == {n for pair in expected for n in pair}
    assert all(roots[a] == roots[b] for a, b in expected)
