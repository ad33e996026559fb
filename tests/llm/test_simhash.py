"""SimHash near-dedup against all pairs on small tables."""

import random
from itertools import combinations

import pytest
import xxhash

from martlet.llm import simhash

SCHEMA = "doc_id long, text string, fp string, component long"


def brute_fingerprint(text, k=4):
    words = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    for c in "\t\n\v\f\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    k = min(k, len(words))
    hashes = [xxhash.xxh64(" ".join(words[i:i + k]).encode(), seed=42).intdigest() for i in range(len(words) - k + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows, k=4, d=4):
    fps = [brute_fingerprint(t, k) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in combinations(range(len(rows)), 2):
        if (fps[i] ^ fps[j]).bit_count() <= d:
            parent[find(i)] = find(j)
    out = []
    for i, (key, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        out.append((key, f"{fps[i]:016x}", min(ids, default=None)))
    return out


def corpus(seed=3):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    rows = []
    for i in range(60):
        base = [rng.choice(vocab) for _ in range(rng.randint(3, 300))]
        rows.append((1000 + i, " ".join(base)))
        for c in range(rng.choice([0, 0, 1, 4])):
            edited = list(base)
            for _ in range(rng.randint(0, 2)):
                edited[rng.randrange(len(edited))] = rng.choice(vocab)
            rows.append((2000 + 100 * c + i, "\n ".join(edited).upper() if c % 2 else " ".join(edited)))
    rows += [(None, None), (7, ""), (8, " \t\n"), (None, "one two"), (9, "ONE two"), (11, "ONE\u00a0two"), (9, "one two"), (9, "one two"),
             (5, "é É x y z"), (6, "long " * 70_000)]
    return rows


def test_matches_all_pairs(spark):
    rows = corpus()
    docs = spark.createDataFrame([(k, t, "x", 1) for k, t in rows], SCHEMA)
    got = [tuple(r) for r in simhash.near_duplicates(docs).collect()]
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2] or -1)
    assert sorted(got, key=key) == sorted(brute(rows), key=key)


def test_tiles_give_the_same_components(spark, monkeypatch):
    rows = corpus(5)
    docs = spark.createDataFrame([(k, t, "x", 1) for k, t in rows], SCHEMA)
    monkeypatch.setattr(simhash, "TILE", 3)
    got = {(r[0], r[1], r[2]) for r in simhash.near_duplicates(docs, max_distance=8).collect()}
    assert got == set(brute(rows, d=8))


def test_keep_first_keeps_one_row_of_each_component(spark):
    rows = corpus(9)
    docs = spark.createDataFrame([(k, t, "x", 1) for k, t in rows], SCHEMA)
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns
    left = kept.collect()
    want = {c for _, _, c in brute(rows)}
    assert sorted(r["doc_id"] for r in left) == sorted(want)


def test_all_null_ids_and_empty_table(spark):
    docs = spark.createDataFrame([(None, "a b c d e f", "x", 1), (None, "quite another text it is here", "x", 1)], SCHEMA)
    assert len(simhash.keep_first(docs).collect()) == 2
    assert [r["component_id"] for r in simhash.near_duplicates(docs).collect()] == [None, None]
    assert simhash.near_duplicates(docs.limit(0)).collect() == []


@pytest.mark.parametrize("n,d", [(10, 4), (10**6, 4), (10**9, 2), (10**12, 6)])
def test_masks_cover_every_pattern(n, d):
    from martlet.llm.hamming import block_masks

    masks, rng = block_masks(n, d), random.Random(1)
    for _ in range(500):
        x = rng.getrandbits(64)
        y = x
        for b in rng.sample(range(64), d):
            y ^= 1 << b
        assert any(x & m == y & m for m in masks)
