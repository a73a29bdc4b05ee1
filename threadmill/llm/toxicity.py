"""Toxicity by non-negative positive-unlabelled learning.

A linear model over the distinct words of a text (and their first letters) is
trained with numpy from confirmed toxic documents and documents of unknown kind.
The risk is the class prior times the positives' loss, plus the unlabelled
documents' loss as negatives less what the positives among them account for;
when that second part falls below zero, its gradient is reversed (Kiryo et al.
2017). Words enter when positives have them at several times the unlabelled
documents' rate, however many documents there are; weights decay.

The fit takes at most about ``max_positive`` and ``max_unlabelled`` documents,
chosen by a hash of doc_id; their hashed words, not texts, go to the driver.
Every whole text is scored. Defined cases: a null or empty text has no words and
gets the model's base score; a very long text counts each of its words once; a
document with several labels is toxic if one says so; repeated rows score alike;
labels without a document, and null labels, are passed over; without a toxic
label all scores are 0; an empty table gives no rows; columns other than the
named ones are ignored, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_WORD = re.compile(r"[^\W\d_]+")
STEMS = (5, 6)


def features(text: str | None) -> set[str]:
    """Distinct lower-cased words, and stems marked with a tilde."""
    words = set(_WORD.findall(text.lower())) if text else set()
    out = set(words)
    for n in STEMS:
        out |= {w[:n] + "~" for w in words if len(w) > n}
    return out


def hashed(found: set[str]) -> list[int]:
    h = xxhash.xxh3_64_intdigest
    return [h(w.encode("utf-8", "replace")) for w in found]


@dataclass
class Model:
    weights: dict[int, float]
    bias: float

    def score(self, texts: list[str | None]) -> np.ndarray:
        get, base = self.weights.keys(), self.bias
        if not self.weights:
            return np.full(len(texts), 1 / (1 + np.exp(-base)))
        z = np.array([base + sum(self.weights[k] for k in get & set(hashed(features(t)))) for t in texts])
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def train(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, epochs: int = 60, batches: int = 12, rate: float = 0.05, ratio: float = 3.0, support: int = 3, decay: float = 5e-4, seed: int = 5) -> Model:
    """Non-negative PU logistic regression on sets of hashed features."""
    n_pos, n_all = len(positive), len(positive) + len(unlabelled)
    if not n_pos or not unlabelled:
        return Model({}, -30.0)
    names, in_pos = np.unique(np.concatenate(positive), return_counts=True)
    names, in_pos = names[in_pos >= support], in_pos[in_pos >= support]

    def columns(found: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(names, found), max(0, len(names) - 1))
        return at[names[at] == found] if len(names) else np.empty(0, dtype=np.int64)

    # only features that enough positives have are numbered, so the rest of the unlabelled words take no room
    rows = [columns(x) for x in (*positive, *unlabelled)]
    column, row = np.concatenate(rows), np.repeat(np.arange(n_all), [len(r) for r in rows])
    expected = np.bincount(column[row >= n_pos], minlength=len(names)) * n_pos / len(unlabelled)
    chosen = (in_pos + 0.5) / (expected + 0.5) >= ratio  # a ratio of rates, which does not grow with the sample
    place, keep = np.cumsum(chosen) - 1, chosen[column]
    row, column, names = row[keep], place[column[keep]], names[chosen]
    starts = np.searchsorted(row, np.arange(n_all + 1))

    rng = np.random.default_rng(seed)
    w = np.zeros(len(names) + 1)  # the last is the bias
    w[-1] = -3.0
    first, second, step = np.zeros_like(w), np.zeros_like(w), 0
    order_p, order_u = np.arange(n_pos), np.arange(n_pos, n_all)
    batches = max(1, min(batches, n_pos // 8))
    mean, taken = np.zeros_like(w), 0  # of the last third of the epochs, as single steps swing
    for epoch in range(epochs):
        rng.shuffle(order_p)
        rng.shuffle(order_u)
        for some_p, some_u in zip(np.array_split(order_p, batches), np.array_split(order_u, batches)):
            some, k = np.concatenate([some_p, some_u]), len(some_p)
            if not k or k == len(some):
                continue
            lengths = starts[some + 1] - starts[some]
            at = np.repeat(starts[some] - np.concatenate(([0], np.cumsum(lengths)[:-1])), lengths) + np.arange(lengths.sum())
            owner, cols = np.repeat(np.arange(len(some)), lengths), column[at]
            z = np.clip(np.bincount(owner, w[cols], minlength=len(some)) + w[-1], -30, 30)
            p = 1 / (1 + np.exp(-z))
            as_negative = np.logaddexp(0, z)
            rest = as_negative[k:].mean() - prior * as_negative[:k].mean()
            g = np.empty(len(some))
            if rest >= 0:
                g[:k], g[k:] = -prior / k, p[k:] / (len(some) - k)
            else:
                g[:k], g[k:] = prior * p[:k] / k, -p[k:] / (len(some) - k)
            grad = np.append(np.bincount(cols, g[owner], minlength=len(names)), g.sum())
            grad[:-1] += decay * w[:-1]
            step += 1
            first = 0.9 * first + 0.1 * grad
            second = 0.999 * second + 0.001 * grad * grad
            w -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
            if 3 * epoch >= 2 * epochs:
                mean, taken = mean + w, taken + 1
    w = mean / taken if taken else w
    return Model(dict(zip(names.tolist(), w[:-1].tolist())), float(w[-1]))


def fit(docs: DataFrame, labels: DataFrame, max_positive: int = 3000, max_unlabelled: int = 12_000, prior: float | None = None, text: str = "text", doc_id: str = "doc_id", toxic: str = "toxic") -> Model:
    """Fit on documents and labels, which must hold training rows only.

    ``prior`` is the share of toxic documents among the unlabelled ones; without it
    the share among the labels stands for it, whatever that is.
    """
    marks = labels.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(toxic).cast("int").alias("toxic")).filter("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    seen = marks.agg(F.count("*").alias("n"), F.sum("toxic").alias("bad")).first()
    if not seen["bad"]:
        return Model({}, -30.0)
    prior = seen["bad"] / seen["n"] if prior is None else prior
    drawn = F.shiftrightunsigned(F.xxhash64(F.lit(13), "doc_id"), 11).cast("double") * F.lit(2.0**-53)
    ids = docs.select(F.col(doc_id).cast("long").alias("doc_id"))
    total = ids.count()
    positive = marks.filter("toxic = 1").filter(drawn < max_positive / seen["bad"]).select("doc_id", F.lit(1).alias("kind"))
    unlabelled = ids.filter(drawn < max_unlabelled / max(1, total)).select("doc_id", F.lit(0).alias("kind"))
    # both are bounded by the parameters, so the documents need no shuffle
    wanted = positive.unionByName(unlabelled).distinct()
    sample = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).join(F.broadcast(wanted), "doc_id").select("kind", "text")

    def hash_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [np.array(hashed(features(t)), dtype="<u8").tobytes() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(words, pa.binary())], names=["kind", "words"])

    kinds: dict[int, list[np.ndarray]] = {0: [], 1: []}
    for r in sample.mapInArrow(hash_words, "kind int, words binary").toLocalIterator(prefetchPartitions=True):
        kinds[r["kind"]].append(np.frombuffer(r["words"], "<u8"))
    # row order follows the files; sort, so that runs agree
    for rows in kinds.values():
        rows.sort(key=lambda x: (len(x), int(x.sum(dtype=np.uint64))))
    return train(kinds[1], kinds[0], prior)


def toxicity(model: Model, docs: DataFrame):
    """A function from a text column to its score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for some in texts:
            yield pd.Series(shared.value.score(some.tolist()))

    def of(text: Column) -> Column:
        return score(text)

    return of
