"""Encoding whole texts with a tokenizers file inside Python workers.

Where a tokenizer lower-cases its input, drops white space and takes each word by
itself, a text's ids are its white-space-separated words' ids in order; files of
any other kind encode every text whole. Each worker keeps the ids of words it has met and sends only new words to
the tokenizers library. The store has two halves: when the newer one is full, the
older one is forgotten, and words found there in the meantime have moved on.
"""

from __future__ import annotations

import ctypes
import gc
import json
import os
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa

#: Words of each half of a worker's store at most, some 200 bytes each; fewer cost time, more memory.
CACHE_WORDS = 700_000
#: New words sent to the library in one call.
CALL_WORDS = 20_000
#: Bytes of text looked through for new words at a time, at most and for each word of a half.
CALL_BYTES, WORD_BYTES = 4_000_000, 16
#: Separates words in a call; it forms a piece of its own.
MARK = "\x01"
#: A text that must have the ids of its words.
PROBE = "The café's 12 Räder \t cost 3.50,\n or so: OK?"

#: A run of these after an ASCII letter or digit is a piece of its own.
TAIL = b".,!?"
LETTERS = frozenset(b"abcdefghijklmnopqrstuvwxyz0123456789")

_encoders: dict[str, "Encoder"] = {}


def splits_words(spec: dict) -> bool:
    """Whether a tokenizer file lower-cases its input and drops the white space between words, so that words stand alone."""

    def parts(one: dict | None, kind: str) -> list[dict]:
        return [] if not one else one[kind] if one["type"] == "Sequence" else [one]

    lower = any(n["type"] == "Lowercase" for n in parts(spec.get("normalizer"), "normalizers"))
    before = parts(spec.get("pre_tokenizer"), "pretokenizers")
    # a split that removes what its pattern does not match leaves no white space
    drops = bool(before) and before[0]["type"] == "Split" and before[0].get("invert", False) and before[0].get("behavior") == "Removed"
    return lower and drops and spec["model"]["type"] == "BPE" and bool(spec["model"].get("end_of_word_suffix"))


def encoder(path: str, store_words: int | None = None) -> "Encoder":
    """The worker's encoder for a tokenizer file, with a store of at most ``store_words`` words a half (``CACHE_WORDS`` if not given)."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    _encoders[path].store_words = store_words
    return _encoders[path]


def trim() -> None:
    """Return free blocks, which a reused worker keeps from earlier tasks, to the system."""
    pa.default_memory_pool().release_unused()
    cut = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc keeps free blocks otherwise
    if cut:
        cut(0)


def forget() -> None:
    """Give back what a reused worker keeps for encoding; a task of another kind, which may need the memory, begins with this."""
    if _encoders:
        _encoders.clear()
        gc.collect()
    trim()


class Encoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.vocab_size = self.tokenizer.get_vocab_size()
        #: Other kinds of tokenizer encode each text whole.
        self.by_word = splits_words(json.loads(Path(path).read_text())) and self._whole(PROBE) == [i for w in PROBE.lower().split() for i in self._whole(w)]
        self.mark = self._whole(MARK)
        #: Texts with these are encoded whole: word by word they could differ.
        self.special = [MARK.encode(), *(t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values())]
        self.store_words: int | None = None
        self.words: dict[bytes, bytes] = {}  # ids as little-endian uint32
        self.older: dict[bytes, bytes] = {}
        # lower-case ASCII letters are their own normal form and one piece, which ends in a token that ends words
        self.normal = self.tokenizer.normalizer
        self.last = np.zeros(self.vocab_size, dtype=bool)
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        if suffix:
            self.last[[i for t, i in self.tokenizer.get_vocab().items() if t.endswith(suffix)]] = True

    def _whole(self, text: str) -> list[int]:
        return self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def _learn(self, new: set[bytes]) -> None:
        """Add words; one that ends in a run of ``TAIL`` is its stem's ids, then the run's."""
        known, tails, letters, others = self.words, {}, set(), set()
        for word in new:
            stem = word.rstrip(TAIL)
            if len(stem) < len(word) and stem and stem[-1] in LETTERS:
                tails[word] = stem
                tail = word[len(stem) :]
                if tail not in known:
                    others.add(tail)
                word = stem
                if word in known:
                    continue
            (letters if word.isalpha() else others).add(word)  # bytes are alpha if they are all ASCII letters
        for at in range(0, len(letters := list(letters)), CALL_WORDS):
            some = letters[at : at + CALL_WORDS]
            self.tokenizer.normalizer = None
            ids = self._whole(b" ".join(some).decode())
            self.tokenizer.normalizer = self.normal
            if not self._keep(some, ids, np.flatnonzero(self.last[ids]) + 1, 0):
                others.update(some)
        for at in range(0, len(others := list(others)), CALL_WORDS):
            some = others[at : at + CALL_WORDS]
            ids = self._whole(f" {MARK} ".join([w.decode() for w in some]))
            marks = np.append(np.flatnonzero(np.array(ids) == self.mark[0]), len(ids))
            if len(self.mark) != 1 or not self._keep(some, ids, marks, 1):  # the mark is no piece of its own here
                known.update((w, np.array(self._whole(w.decode()), dtype="<u4").tobytes()) for w in some)
        for word, stem in tails.items():
            known[word] = known[stem] + known[word[len(stem) :]]

    def _keep(self, words: list[bytes], ids: list[int], ends: np.ndarray, gap: int) -> bool:
        """Store each word's part of ``ids`` if there are as many ends as words; ``gap`` ids follow each part."""
        if len(ends) != len(words):
            return False
        flat, start = np.array(ids, dtype="<u4").tobytes(), 0
        for word, end in zip(words, ends.tolist()):
            self.words[word] = flat[4 * start : 4 * end]
            start = end + gap
        return True

    def encode(self, texts: list[bytes | None]) -> Iterator[bytes]:
        """Each whole UTF-8 text's ids as little-endian uint32; a null or empty text has none.

        Ids are made for some ``CALL_BYTES`` of text at a time, fewer with a small store, or one longer text.
        """
        at, most = 0, min(CALL_BYTES, WORD_BYTES * (self.store_words or CACHE_WORDS))
        while at < len(texts):
            some, size = [], 0
            while at < len(texts) and (not some or size < most):
                some.append(texts[at] or b"")
                size += len(some[-1])
                at += 1
            yield from self._encode(some) if self.by_word else map(self._alone, some)

    def _encode(self, texts: list[bytes]) -> list[bytes]:
        # ASCII white space always ends a word, and A-Z are lower-cased by the tokenizer anyway
        split = [text.lower().split() for text in texts]
        new = set().union(*split).difference(self.words)
        most = self.store_words or CACHE_WORDS
        if len(self.words) + 2 * len(new) > most:
            self.older, self.words = self.words, {}
            new = set().union(*split)
        if len(new) > most:  # texts of that many different words
            return [self._alone(text) for text in texts]
        for word in new.intersection(self.older):
            self.words[word] = self.older[word]
        new.difference_update(self.words)
        if new:
            self._learn(new)
        get = self.words.__getitem__
        return [self._alone(t) if any(s in t for s in self.special) else b"".join(map(get, w)) for t, w in zip(texts, split)]

    def _alone(self, text: bytes) -> bytes:
        return np.array(self._whole(text.decode()), dtype="<u4").tobytes()
