"""Conversation repair against exhaustive search over edit scripts, and the query against plain Python."""

from __future__ import annotations

import hashlib
import heapq
import re
import zlib

import numpy as np
import pytest

from threadmill.llm import conversations, entries

SF = "/root/testdata/sf0.001"
GOOD = re.compile(r"(s?(ua)+)?\Z")


def cheapest(kinds):
    """(cost, audit) by best-first search over whole edit scripts, with the roles put out kept as text."""
    heap, seen = [(0, "", 0, "")], set()
    while heap:
        cost, audit, at, roles = heapq.heappop(heap)
        if at == len(kinds) and GOOD.match(roles):
            return cost, audit
        shape = (at, roles[-1:] if len(roles) < 2 else "." + roles[-1], bool(roles))
        if shape in seen:  # the first to come is the cheapest and least
            continue
        seen.add(shape)
        for role in "ua":
            if ok(roles + role):
                heapq.heappush(heap, (cost + 3, audit + "I", at, roles + role))
        if at < len(kinds):
            initial, gone, cut = kinds[at]
            heapq.heappush(heap, (cost + 4, audit + "D", at + 1, roles))
            if not gone:
                if initial and ok(roles + initial):
                    heapq.heappush(heap, (cost + 3 * cut, audit + "K", at + 1, roles + initial))
                for role in "ua":
                    if ok(roles + role):
                        heapq.heappush(heap, (cost + 3 + 3 * cut, audit + "R", at + 1, roles + role))
    raise AssertionError


def ok(roles):
    return bool(re.match(r"s?(ua)*u?\Z", roles))


def brute(rows):
    """{conv_id: result} of (conv_id, turn, role, text) rows that are damaged already."""
    out = {}
    for conv, some in rows.items():
        some = sorted(some, key=lambda r: (r[0] is not None, r[0] or 0))
        kinds, seen, counts = [], set(), {"blank": 0, "duplicate": 0, "truncated": 0}
        for _, role, text in some:
            bare = text.strip(" \t\n\x0b\x0c\r")
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None
            seen.add((role, text))
            if fault:
                counts[fault] += 1
            kinds.append((role[:1], fault in ("blank", "duplicate"), fault == "truncated"))
        initials = [k[0] for k in kinds]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        turns = [t for t, _, _ in some if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        cost, audit = cheapest(kinds)
        put, at, state = [], 0, ""
        for letter in audit:
            turn = "assistant" if state == "user" else "user"
            if letter == "I":
                put.append((turn, ""))
                state = turn
                continue
            _, role, text = some[at]
            at += 1
            if letter == "K":
                put.append((role, text))
                state = {"u": "user", "a": "assistant"}.get(role[:1], "")
            elif letter == "R":
                put.append((turn, text))
                state = turn
        sha = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in put).encode()).hexdigest()
        out[conv] = (gaps, *counts.values(), illegal, cost, audit, sha)
    return out


def results(df):
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    return {r["conv"] if "conv" in r else r["conv_id"]: tuple(r[n] for n in names) for r in df.collect()}


def test_auction_against_search():
    rng = np.random.default_rng(4)
    for _ in range(3000):
        kinds = [("suax"[rng.choice(4, p=[0.15, 0.4, 0.35, 0.1])], bool(rng.random() < 0.15), bool(rng.random() < 0.2)) for _ in range(rng.integers(0, 9))]
        codes = [conversations.GONE if gone else "suax".index(r) + 8 * cut for r, gone, cut in kinds]
        plain = [("" if r == "x" else r, gone, cut) for r, gone, cut in kinds]
        assert conversations.cheapest(codes) == cheapest(plain), kinds


def test_prices_are_dual_feasible():
    for kind in (*range(4), *range(8, 12), conversations.GONE):
        after = conversations.layer(conversations.LAST, (0, 0, 0, 0))[1]
        low, prices, _ = conversations.layer(kind, after)
        for state in range(4):
            sums = [cost + (after[to] if read else low + prices[to]) for _, cost, read, to in conversations.arcs(kind, state)]
            assert low + prices[state] == min(sums)


def test_query(spark):
    rows = {}
    for r in spark.read.parquet(f"{SF}/conversations.parquet").orderBy("conv_id", "turn").collect():
        some = rows.setdefault(r["conv_id"], [])
        fault, role, text = zlib.crc32(f"{r['conv_id']}:{r['turn']}".encode()) % 20, r["role"], r["text"]
        if fault == 0:
            continue
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        some += [(r["turn"], "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)
    assert results(entries.op13_auction_repair(spark, SF)) == brute(rows)


def _rows(spark, rows):
    return conversations.standard(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, conv int, kind int, audit int, here int"))


def test_odd_inputs_and_long_conversations(spark):
    rng = np.random.default_rng(9)
    long = [(7, t, ["user", "assistant", "system", "tool"][rng.choice(4, p=[0.45, 0.45, 0.05, 0.05])], ["Yes.", "no", " ", f"So {t}."][rng.integers(4)]) for t in range(3000)]
    odd = [(None, None, None, None), (None, 3, "user", "A."), (1, None, "user", "Hi."), (1, None, "assistant", "Ho."), (1, 5, "", "x."), (2, 4, "user", "z" * 300_000), (2, 4, "user", "z" * 300_000), (3, 1, "system", "Be."), (4, -9, "assistant", "B?"), (4, 9, "user", "B?")]
    plain: dict = {}
    for conv, turn, role, text in odd + long:
        plain.setdefault(conv, []).append((turn, " " if role is None else role, " " if text is None else text))
    plain[1].sort(key=lambda r: (r[0] is not None, r[1]))
    df = _rows(spark, [(*r, 0, 0, 0, 0) for r in odd + long])
    assert results(conversations.repair(df)) == brute(plain)
    assert conversations.repair(df.limit(0)).count() == 0


def test_conversation_of_which_nothing_is_left(spark):
    df = _rows(spark, [(1, 0, "user", "A.", 0, 0, 0, 0)]).withColumn("here", conversations.F.lit(False))
    assert results(conversations.repair(df)) == {1: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


@pytest.mark.parametrize("audit,expected", [("KK", [("K", "user", "a."), ("K", "assistant", "b.")])])
def test_repaired_rows(spark, audit, expected):
    df = _rows(spark, [(1, 0, "user", "a.", 0, 0, 0, 0), (1, 1, "assistant", "b.", 0, 0, 0, 0), (2, 0, "user", "c.", 0, 0, 0, 0)])
    reports = conversations.report(df)
    assert {r["conv"]: r["audit"] for r in reports.collect()} == {1: audit, 2: "D" if conversations.cheapest([1])[1] == "D" else "KI"}
    got = conversations.repaired_rows(df, reports)
    assert [tuple(r)[2:] for r in got.filter("conv = 1").orderBy("place").collect()] == expected
    assert [tuple(r)[2:] for r in got.filter("conv = 2").orderBy("place").collect()] == [("K", "user", "c."), ("I", "assistant", "")]
