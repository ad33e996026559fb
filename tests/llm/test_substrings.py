"""Substring dedup against a dictionary of all windows."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from martlet.llm import substrings

SCHEMA = "doc_id long, text string, marks string, k long"


def brute(rows, length):
    bodies = [(t or "").encode() for _, t in rows]
    seen = Counter(b[i:i + length] for b in bodies for i in range(len(b) - length + 1))
    out = []
    for (key, _), b in zip(rows, bodies, strict=True):
        gone = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - length + 1):
            if seen[b[i:i + length]] > 1:
                gone[i:i + length] = True
        kept = bytes(c for c, g in zip(b, gone, strict=False) if not g)
        spans = int((gone[1:] & ~gone[:-1]).sum() + gone[0])
        out.append((key, len(b), len(b) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return out


def corpus(seed):
    rng = random.Random(seed)
    letters = "abcdeé "
    text = lambda n: "".join(rng.choice(letters) for _ in range(n))
    shared = [text(n) for n in (60, 64, 65, 66, 90, 300, 1000)]
    rows = []
    for i in range(40):
        parts = [text(rng.randint(0, 300))]
        for _ in range(rng.randint(0, 3)):
            s = rng.choice(shared)
            a = rng.randrange(len(s) // 2)
            parts += [s[a:] if rng.random() < 0.4 else s[:len(s) - a] if rng.random() < 0.4 else s, text(rng.randint(0, 200))]
        rows.append((i, "".join(parts)))
    return rows + [(None, None), (1, ""), (2, "x" * 500), (3, "ab" * 300), (4, "abcab" * 60 + text(50)), rows[5], (None, rows[6][1]),
                   (7, rows[7][1] + "!"), (9, "日本" * 40 + text(30)), (200, text(65)), (201, text(20_000))]


def check(spark, rows, length=65):
    docs = spark.createDataFrame([(k, t, "x", 1) for k, t in rows], SCHEMA).repartition(3)
    got = [tuple(r) for r in substrings.repeat_report(docs, length=length).collect()]
    assert sorted(got, key=str) == sorted(brute(rows, length), key=str)


def test_matches_all_windows(spark):
    check(spark, corpus(1))


def test_crowded_anchors(spark, monkeypatch):
    monkeypatch.setattr(substrings, "CROWD", 2)
    check(spark, corpus(2))


def test_small_indexes(spark, monkeypatch):
    monkeypatch.setattr(substrings, "INDEX_BYTES", 1)
    check(spark, corpus(3), length=100)


def test_empty_table(spark):
    assert substrings.repeat_report(spark.createDataFrame([], SCHEMA)).collect() == []
    with pytest.raises(ValueError):
        substrings.repeated_starts(spark.createDataFrame([], SCHEMA), "doc_id", "text", 10)


def test_matching_lengths():
    rng = random.Random(0)
    segments = [bytes(rng.choice(b"ab") for _ in range(rng.randint(1, 40))) for _ in range(12)]
    got, at = substrings.matching_lengths(segments), 0
    for k, s in enumerate(segments):
        for i in range(len(s)):
            want = 0
            for j, t in enumerate(segments):
                for x in range(len(t)):
                    if (j, x) != (k, i):
                        n = 0
                        while i + n < len(s) and x + n < len(t) and s[i + n] == t[x + n]:
                            n += 1
                        want = max(want, n)
            assert got[at + i] == want
        at += len(s) + 1
