"""Lattices, the language model and language identification against plain sums over segmentations."""

import math
import random
import zlib
from collections import Counter
from functools import lru_cache

import numpy as np
import pytest
from pyspark.sql import functions as F

from martlet.llm import langid, lattice, subword_lm

SCHEMA = "doc_id long, text string, lang string, score string"
SPACES = " \t\n\v\f\r"


def split(text):
    t = "".join(" " if c in SPACES else c for c in (text or ""))
    return [w.encode() for w in t.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).split(" ") if w]


def marginal(word, number, logp):
    word = b" " + word

    @lru_cache(None)
    def ahead(i):
        if i == len(word):
            return 1.0
        return sum(math.exp(logp[number[word[i:j]]]) * ahead(j) for j in range(i + 1, len(word) + 1) if word[i:j] in number)

    return math.log(ahead(0))


def small():
    pieces = [b" t", b"th", b"he", b"e", b" the", b"re", b" ", "é".encode(), b"er"] + [bytes((b,)) for b in range(256) if b not in (0x20, 0x65)]
    rng = np.random.default_rng(1)
    p = rng.random((len(pieces), 3)) + 1e-3
    return lattice.Lattice(pieces), np.log(p / p.sum(axis=0))


WORDS = [b"the", b"there", b"t", "thérè".encode(), b"x" * 5, b"hereeree" * 3, bytes((0xFF, 0x00, 0x41)), b"the"]


def test_forward_sums_all_segmentations(monkeypatch):
    lat, logp = small()
    want = [[marginal(w, lat.number, logp[:, c]) for c in range(3)] for w in WORDS]
    assert np.allclose(lat.forward(WORDS, logp), want, atol=1e-10)
    monkeypatch.setattr(lattice, "LONG", 4)  # the word-by-word way
    assert np.allclose(lat.forward(WORDS, logp), want, atol=1e-10)
    monkeypatch.setattr(lattice, "CELLS", 1)
    assert np.allclose(lat.forward(WORDS, logp), want, atol=1e-10)


@pytest.mark.parametrize("long_from", [192, 3])
def test_expected_counts(monkeypatch, long_from):
    lat, logp = small()
    monkeypatch.setattr(lattice, "LONG", long_from)
    counts, model = np.arange(1.0, len(WORDS) + 1), np.array([0, 1, 2, 0, 1, 2, 0, 1])
    got = lat.expected(WORDS, counts, logp, model)
    want = np.zeros_like(got)
    for w, n, c in zip(WORDS, counts, model, strict=True):
        body = b" " + w

        def paths(i):
            if i == len(body):
                yield ()
            for j in range(i + 1, len(body) + 1):
                if body[i:j] in lat.number:
                    for rest in paths(j):
                        yield (lat.number[body[i:j]], *rest)

        if len(w) > 12:
            got[:, c] -= lat.expected([w], np.array([n]), logp, np.array([c]))[:, c]
            continue
        z = math.exp(marginal(w, lat.number, logp[:, c]))
        for path in paths(0):
            mass = math.exp(sum(logp[p, c] for p in path)) / z * n
            for p in path:
                want[p, c] += mass
    assert np.allclose(got, want, atol=1e-9)


def test_very_long_word_is_finite():
    lat, logp = small()
    assert np.isfinite(lat.forward([b"ab" * 20_000], logp)).all()


def corpus(seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(160):
        lang = ["en", "fr", "de"][i % 3]
        own = {"en": ["th", "ing", "er", "on"], "fr": ["eau", "é", "tion", "ou"], "de": ["sch", "ung", "ü", "keit"]}[lang]
        rows.append((i, " ".join("".join(rng.choice(own) for _ in range(rng.randint(1, 3))) for _ in range(rng.randint(5, 60))), lang))
    return rows + [(None, "then Thing on", "en"), (500, None, "fr"), (501, "", "de"), (502, "123 4,5\t!", None), (503, "ünger keit", None),
                   (0, rows[0][1], "en"), (0, rows[0][1], "en"), (504, "eau ou x", None)]


def test_scores_follow_their_definition(spark, monkeypatch):
    rows = corpus()
    docs = spark.createDataFrame([(k, t, g, "x") for k, t, g in rows], SCHEMA)
    out = lambda k: k is not None and zlib.crc32(str(k).encode()) % 7 == 2
    for head in (subword_lm.HEAD, 3):
        monkeypatch.setattr(subword_lm, "HEAD", head)
        got = subword_lm.score_documents(docs, subword_lm.held_out(F.col("doc_id"), 7, 2)).collect()
        c = Counter(w for k, t, _ in rows if not out(k) for w in split(t))
        ends = sum(not out(k) for k, _, _ in rows)
        n, v = sum(c.values()) + ends, len(c) + 1
        ones, twos = (sum(x == y for x in c.values()) for y in (1, 2))
        d = ones / (ones + 2 * twos) if ones and twos else 0.5
        pieces, logp = subword_lm.fit(spark.createDataFrame([(w, x) for w, x in c.items()], "word binary, c long"), subword_lm.VOCABULARY, 3)
        lat = lattice.Lattice(pieces)

        def word(w):
            inner = d * len(c) / n * math.exp(lat.forward([w], logp[:, None])[0, 0])
            return math.log10(max(c[w] - d, 0) / n + inner)

        want = []
        for k, t, _ in rows:
            found = split(t)
            base = sum(math.log10((c[w] + 1) / (n + v + 1)) for w in found) + math.log10((ends + 1) / (n + v + 1))
            want.append((k, out(k), len(found) + 1, sum(c[w] > 0 for w in found) + 1, n, base, sum(map(word, found)) + math.log10(ends / n)))
        order = lambda r: (r[0] is None, r[0] or 0, r[2])
        for a, b in zip(sorted(map(tuple, got), key=order), sorted(want, key=order), strict=True):
            assert a[:5] == b[:5] and abs(a[5] - b[5]) < 1e-6 and abs(a[6] - b[6]) < 1e-5


def test_whole_word_and_piece_masses_sum_to_one_at_most():
    lat, logp = small()
    one = logp[:, :1] - np.log(np.exp(logp[:, :1]).sum())
    starts = [i for p, i in lat.number.items() if p.startswith(b" ")]
    inside = [i for p, i in lat.number.items() if not p.startswith(b" ")]
    assert abs(np.exp(one[starts]).sum() + np.exp(one[inside]).sum() - 1) < 1e-12


def test_empty_tables_and_no_training_rows(spark):
    docs = spark.createDataFrame([], SCHEMA)
    held = subword_lm.held_out(F.col("doc_id"), 7, 2)
    assert subword_lm.score_documents(docs, held).collect() == [] and langid.identify(docs, held).collect() == []
    one = spark.createDataFrame([(1, "a b", "en", "x")], SCHEMA)
    (row,) = subword_lm.score_documents(one, F.lit(True)).collect()
    assert row["train_tokens"] == 0 and row["n_known"] == 0 and math.isfinite(row["score"])
    assert langid.identify(one, F.lit(True)).first()["lang_pred"] == "und"


def test_held_out_languages(spark):
    rows = corpus()
    docs = spark.createDataFrame([(k, t, g, "x") for k, t, g in rows], SCHEMA)
    got = langid.identify(docs, subword_lm.held_out(F.col("doc_id"), 4, 2)).collect()
    by = {r["doc_id"]: r for r in got}
    held = [k for k, _, _ in rows if k is not None and k < 160 and zlib.crc32(str(k).encode()) % 4 == 2]
    assert all(by[k]["held_out"] for k in held) and sum(by[k]["lang_pred"] == ["en", "fr", "de"][k % 3] for k in held) >= 0.97 * len(held)
    assert all(by[k]["lang_pred"] == "und" and by[k]["score"] == 0 for k in (500, 501, 502)) and by[503]["lang_pred"] == "de"
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    with pytest.raises(ValueError):
        langid.identify(docs, F.lit(False), max_languages=2)
