"""Optimal buckets against exhaustive search; batches against their budget."""

import random
from collections import Counter, defaultdict
from itertools import combinations

from martlet.llm import packing

SCHEMA = "doc_id long, text string, n_tokens string, batch string"


def padding(histogram, bounds):
    return sum((min(b for b in bounds if b >= n) - n) * c for n, c in histogram.items())


def test_bounds_are_optimal():
    rng = random.Random(3)
    for _ in range(200):
        histogram = {rng.randint(1, 60): rng.randint(1, 30) for _ in range(rng.randint(1, 9))}
        lengths = sorted(histogram)
        for k in (1, 2, 3, 5, 20):
            best = min(padding(histogram, [*c, lengths[-1]]) for r in range(min(k, len(lengths))) for c in combinations(lengths[:-1], r))
            got = packing.optimal_bounds(histogram, k)
            assert len(got) <= k and got[-1] == lengths[-1] and padding(histogram, got) == best
    assert packing.optimal_bounds({}, 4) == []


def test_batches(spark):
    rng = random.Random(5)
    rows = [(i, " ".join("w" * rng.randint(1, 5) for _ in range(rng.choice([0, 1, 3, 30, 31, 90])))) for i in range(400)]
    rows += [(None, None), (None, None), (7, ""), (7, ""), (8, "\t a\nb  c "), (500, "x " * 5000)]
    docs = spark.createDataFrame([(k, t, "z", "q") for k, t in rows], SCHEMA)
    got = packing.pack(docs, buckets=4, token_budget=200, shard_docs=50).collect()
    want = Counter((k, len((t or "").split()) + 1) for k, t in rows)
    assert Counter((r["doc_id"], r["n_tokens"]) for r in got) == want
    batches = defaultdict(list)
    for r in got:
        batches[r["batch_id"]].append(r)
    for rs in batches.values():
        bound, n = rs[0]["bucket_bound"], len(rs)
        assert {r["bucket_bound"] for r in rs} == {bound} and {r["batch_docs"] for r in rs} == {n}
        assert sorted(r["slot"] for r in rs) == list(range(n)) and (bound * n <= 200 or n == 1)
        assert all(r["padding"] == bound - r["n_tokens"] >= 0 for r in rs)
    inside = Counter(r["n_tokens"] for r in got if r["n_tokens"] <= 200)
    assert sum(r["padding"] for r in got) == padding(inside, packing.optimal_bounds(inside, 4))
    full = sum(len(rs) == max(1, 200 // rs[0]["bucket_bound"]) for rs in batches.values())
    assert len(batches) - full <= 4 + -(-len(got) // 50)


def test_empty_table(spark):
    assert packing.pack(spark.createDataFrame([], SCHEMA)).collect() == []
