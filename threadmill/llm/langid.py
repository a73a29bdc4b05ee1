"""Language identification with error-correcting output codes.

Each language has a codeword; each bit has a binary n-gram classifier, the log
ratio of how often languages with a one and languages with a zero use a hashed
byte n-gram. A text's margins, averaged over its n-grams, are decoded to the
codeword with the least loss, each bit weighted by how well it separates the
training sample. A text whose two best codewords are nearly level is flagged as
ambiguous.

The classifiers are fitted on about ``per_lang`` documents of each language,
chosen by a hash of doc_id; only n-gram counts reach the driver. Defined cases:
a null text, or one without a letter (as ``str.isalpha`` has it), is ``und`` with
score 0; a very long text is looked at ``CHUNK`` bytes at a time, all of it;
rows with a null language or text are not learned from; repeated rows are
predicted alike; without training rows all texts are ``und``; equal losses go to
the language that is first by code point; an empty table gives no rows; columns
other than the named ones are ignored, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import product

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .wordbpe import forget

#: Hashed n-grams; a fixed size for every corpus.
BUCKETS = 1 << 16
ORDERS = (2, 3, 4)
#: Bytes of text looked at together.
CHUNK = 1 << 18
_OTHER = re.compile(r"[\W\d_]+")
_MULTIPLIERS = {n: np.uint32((2654435761 * (2 * n + 1)) & 0xFFFFFFFF) for n in ORDERS}


def letters(text: str | None) -> bytes:
    """Lower-cased words of letters, each with a space on both sides; empty without letters."""
    words = _OTHER.sub(" ", text.lower()).strip() if text else ""
    if not words.isascii() and not words.replace(" ", "").isalpha():  # numerals such as superscripts are word characters too
        words = " ".join("".join(c if c.isalpha() else " " for c in words).split())
    return f" {words} ".encode("utf-8", "replace") if words else b""


def gram_buckets(data: np.ndarray, order: int) -> np.ndarray:
    """Bucket of the n-gram that starts at each byte but the last ``order - 1``."""
    n = len(data) - order + 1
    code = data[:n].astype(np.uint32)
    for k in range(1, order):
        code |= data[k : k + n].astype(np.uint32) << np.uint32(8 * k)
    return (code * _MULTIPLIERS[order]) >> np.uint32(16)


def codewords(n: int, seed: int = 3) -> np.ndarray:
    """+1/-1 codewords, one row per class: exhaustive up to 6 classes, else random ones far apart."""
    if n <= 1:
        return np.ones((n, 1), dtype=np.int8)
    if n <= 6:
        columns = [c for c in product((1, -1), repeat=n) if c[0] == 1 and -1 in c]
        return np.array(columns, dtype=np.int8).T
    rng, bits = np.random.default_rng(seed), 2 * int(np.ceil(5 * np.log2(n)))
    best, best_gap = None, -1
    for _ in range(50):
        code = rng.choice(np.array([1, -1], dtype=np.int8), size=(n, bits))
        gap = bits - np.max(code.astype(int) @ code.T.astype(int) - 2 * bits * np.eye(n, dtype=int))
        if gap > best_gap and (np.abs(code.sum(axis=0)) < n).all():
            best, best_gap = code, gap
    return best


@dataclass
class Model:
    langs: list[str]
    code: np.ndarray
    weights: np.ndarray  # BUCKETS x bits, and a last row of zeros
    scale: np.ndarray
    bias: np.ndarray
    trust: np.ndarray

    def margins(self, texts: list[bytes]) -> np.ndarray:
        """Average classifier output over each text's n-grams, a row per text."""
        total = np.zeros((len(texts), self.weights.shape[1]))
        count = np.zeros(len(texts))
        at = 0
        while at < len(texts):
            some, size = [at], len(texts[at])
            while some[-1] + 1 < len(texts) and size + len(texts[some[-1] + 1]) < CHUNK:
                some.append(some[-1] + 1)
                size += len(texts[some[-1]])
            at = some[-1] + 1
            whole = np.frombuffer(b"".join(texts[i] for i in some), np.uint8)
            ends = np.cumsum([len(texts[i]) for i in some])
            for low in range(0, max(1, len(whole)), CHUNK):
                for order in ORDERS:
                    data = whole[low : low + CHUNK + order - 1]
                    if len(data) < order:
                        continue
                    grams = gram_buckets(data, order)
                    for k in range(1, order):  # those that run over a text's end count for nothing
                        over = ends - k - low
                        grams[over[(over >= 0) & (over < len(grams))]] = BUCKETS
                    starts = np.clip(np.concatenate(([0], ends[:-1])) - low, 0, len(grams))
                    stops = np.clip(ends - low, 0, len(grams))
                    live = np.flatnonzero(stops > starts)
                    if live.size:
                        rows = np.array(some)[live]
                        total[rows] += np.add.reduceat(self.weights[grams], starts[live], axis=0, dtype=np.float64)
                        count[rows] += np.add.reduceat((grams < BUCKETS).astype(np.int64), starts[live])
        return total / np.maximum(count, 1)[:, None]

    def losses(self, margins: np.ndarray) -> np.ndarray:
        f = (margins - self.bias) * self.scale
        each = np.logaddexp(0.0, -f[:, None, :] * self.code[None, :, :])
        return (each * self.trust).sum(axis=2) / self.trust.sum()

    def predict(self, texts: list[str | None], gap: float) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score and whether it is ambiguous."""
        plain = [letters(t) for t in texts]
        if not self.langs:
            return ["und"] * len(texts), np.zeros(len(texts)), np.ones(len(texts), dtype=bool)
        loss = self.losses(self.margins(plain))
        share = np.exp(-8.0 * (loss - loss.min(axis=1, keepdims=True)))
        share /= share.sum(axis=1, keepdims=True)
        best = loss.argmin(axis=1)
        ranked = np.sort(loss, axis=1)
        unsure = (ranked[:, 1] - ranked[:, 0] < gap) if loss.shape[1] > 1 else np.zeros(len(texts), dtype=bool)
        none = np.array([not p for p in plain])
        langs = ["und" if e else self.langs[b] for e, b in zip(none, best)]
        return langs, np.where(none, 0.0, share[np.arange(len(texts)), best]), np.where(none, True, unsure)


def fit(docs: DataFrame, per_lang: int = 1000, text: str = "text", lang: str = "lang", doc_id: str = "doc_id") -> Model:
    """Fit on about ``per_lang`` documents of each language, all of a rarer one."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(lang).cast("string").alias("lang"), F.col(text).alias("text")).filter("lang is not null and text is not null")
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    langs = sorted(counts, key=lambda x: x.encode())
    if not langs:
        return Model([], codewords(0), np.zeros((BUCKETS + 1, 1), np.float32), np.ones(1), np.zeros(1), np.ones(1))
    share = F.create_map(*[x for k in langs for x in (F.lit(k), F.lit(per_lang / counts[k]))])
    drawn = F.shiftrightunsigned(F.xxhash64(F.lit(11), "doc_id"), 11).cast("double") * F.lit(2.0**-53)
    sample = rows.filter(drawn < share[F.col("lang")]).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, np.ndarray] = {}
        for batch in batches:
            for one, t in zip(*(c.to_pylist() for c in batch.columns)):
                data = np.frombuffer(letters(t), np.uint8)
                row = found.setdefault(one, np.zeros(BUCKETS))
                for order in ORDERS:
                    if len(data) >= order:
                        row += np.bincount(gram_buckets(data, order), minlength=BUCKETS) / len(data)
        for one, row in found.items():
            at = np.flatnonzero(row)
            yield pa.RecordBatch.from_arrays([pa.array([one]), pa.array([at.astype("<u4").tobytes()]), pa.array([row[at].astype("<f4").tobytes()])], names=["lang", "at", "n"])

    use = np.full((len(langs), BUCKETS), 1e-6)
    for r in sample.repartition(4).mapInArrow(count, "lang string, at binary, n binary").toLocalIterator():
        use[langs.index(r["lang"]), np.frombuffer(r["at"], "<u4")] += np.frombuffer(r["n"], "<f4")
    use = use / np.maximum(use.sum(axis=1, keepdims=True), 1e-9)
    smooth = use + 0.02 / BUCKETS
    code = codewords(len(langs))
    bits = code.shape[1]
    weights = np.zeros((BUCKETS + 1, bits), dtype=np.float32)
    for b in range(bits):
        one, zero = smooth[code[:, b] > 0], smooth[code[:, b] < 0]
        if len(one) and len(zero):
            weights[:BUCKETS, b] = np.log(one.mean(axis=0)) - np.log(zero.mean(axis=0))
    # what each classifier gives on average for each language sets its middle, its unit and its weight
    mean = use @ weights[:BUCKETS]
    high = np.array([mean[code[:, b] > 0, b].min() if (code[:, b] > 0).any() else 1.0 for b in range(bits)])
    low = np.array([mean[code[:, b] < 0, b].max() if (code[:, b] < 0).any() else -1.0 for b in range(bits)])
    apart = np.maximum(high - low, 1e-3)
    return Model(langs, code, weights, 6.0 / apart, (high + low) / 2, apart / apart.max())


def language(model: Model, docs: DataFrame, gap: float = 0.02):
    """A function from a text column to struct<lang_pred, score, ambiguous>."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double, ambiguous boolean")
    def predict(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        forget()
        for some in texts:
            langs, score, unsure = shared.value.predict(some.tolist(), gap)
            yield pd.DataFrame({"lang_pred": langs, "score": score, "ambiguous": unsure})

    def of(text: Column) -> Column:
        return predict(text)

    return of

