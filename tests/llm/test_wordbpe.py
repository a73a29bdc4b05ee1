"""Word-by-word ids equal the tokenizers library's on whole texts."""

from __future__ import annotations

import random

import numpy as np
import pytest

from threadmill.llm import entries, wordbpe

PARTS = ["a", "B", "ß", "é", "É", "1", "2", ".", ",", "!!", "'", "'s", "t", "'re", " ", "  ", "\n", "\xa0", "İ", "ς", "Σ", "$", "|", "中", "\x1c", "\x85", "　", "-", "ﬁ", "<|endoftext|>", "\x01", "the", "Ing"]


@pytest.fixture(scope="module")
def coder():
    return wordbpe.Encoder(entries.tokenizer_path())


def ids(raw):
    return np.frombuffer(raw, "<u4").tolist()


def test_random_texts(coder):
    rng = random.Random(0)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 30))) for _ in range(2000)]
    found = coder.encode([t.encode() for t in texts])
    for t, raw in zip(texts, found):
        assert ids(raw) == coder.tokenizer.encode(t, add_special_tokens=False).ids, repr(t)


def test_null_and_empty(coder):
    assert list(coder.encode([None, b"", b" \n\t"])) == [b"", b"", b""]
    assert list(coder.encode([])) == []


def test_full_store(coder, monkeypatch):
    """Forgetting words, and texts with more words than the store holds, change nothing."""
    monkeypatch.setattr(wordbpe, "CACHE_WORDS", 40)
    monkeypatch.setattr(wordbpe, "CALL_WORDS", 7)
    monkeypatch.setattr(wordbpe, "CALL_BYTES", 50)
    rng = random.Random(1)
    texts = [" ".join("".join(rng.choice("abcé.") for _ in range(3)) for _ in range(rng.choice((3, 10, 100)))) for _ in range(60)]
    small = wordbpe.Encoder(entries.tokenizer_path())
    for t, raw in zip(texts, small.encode([t.encode() for t in texts])):
        assert ids(raw) == coder.tokenizer.encode(t, add_special_tokens=False).ids
    assert len(small.words) <= 40


def test_other_tokenizer(coder):
    """A file that keeps case and white space encodes whole texts."""
    other = wordbpe.Encoder(entries.tokenizer_path("byte_bpe_50k.json"))
    assert coder.by_word and not other.by_word
    texts = ["Hello World  and\nmore", "", "hello world and more", "İ ß <|endoftext|>\t."]
    for t, raw in zip(texts, other.encode([t.encode() for t in texts])):
        assert ids(raw) == other.tokenizer.encode(t, add_special_tokens=False).ids


@pytest.mark.parametrize("change", [{"normalizer": None}, {"pre_tokenizer": {"type": "ByteLevel"}}, {"pre_tokenizer": None}])
def test_splits_words(change):
    import json

    spec = json.loads(open(entries.tokenizer_path()).read())
    assert wordbpe.splits_words(spec) and not wordbpe.splits_words(spec | change)
