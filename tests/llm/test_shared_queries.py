"""Ranked search against scoring every document for every query."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from martlet.llm import shared_queries

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS, ITEMS = "doc_id bigint, text string, score int, number int, terms string", "item_id string, text string, rank int, number int"


def split(text):
    return TERM.findall((text or "").translate(UPPER))


def brute(docs, items, top):
    docs = [(k, Counter(split(t))) for k, t in docs]
    docs = [(k, c) for k, c in docs if c]
    n_docs, total = len(docs), sum(c.total() for _, c in docs)
    df = Counter(t for _, c in docs for t in c)
    out = []
    for item, text in items:
        rows = []
        for k, c in docs:
            m = 75 + (25 * c.total() * n_docs) // total
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 12 * m))
                    for t in split(text) if c[t])
            if s > 0:
                rows.append((-s, k is None, k or 0))
        out += [(item, r + 1, None if null else k, -s) for r, (s, null, k) in enumerate(sorted(rows)[:top])]
    return sorted(out, key=str)


def got(spark, docs, items, top):
    found = shared_queries.search(spark.createDataFrame([(*d, 1, 1, "x") for d in docs], DOCS),
                                  spark.createDataFrame([(*i, 1, 1) for i in items], ITEMS), top=top)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(map(tuple, found.collect()), key=str)


def corpus(seed, n_docs, n_items):
    rnd = random.Random(seed)
    words = [f"w{k}" for k in range(60)] + ["Été", "É", "x_y", "A-b", "10.5", "日本語"]
    skewed = [1 / (k + 1) for k in range(len(words))]
    text = lambda n: rnd.choice([" ", "\n", ". "]).join(rnd.choices(words, skewed, k=n))
    docs = [(rnd.choice([None, k, k, k, 5]), rnd.choice([None, "", "--"] + [text(rnd.randint(1, 40))] * 9)) for k in range(n_docs)]
    items = [(rnd.choice([None, f"i{k}", f"i{k}"]), rnd.choice([None, "", *[text(rnd.randint(1, 15))] * 9])) for k in range(n_items)]
    return docs + docs[:5], items + items[:2]


@pytest.mark.parametrize("seed, top, block_terms, shared_by", [(1, 20, 1 << 18, 3), (2, 3, 40, 2), (3, 1, 1 << 18, 2)])
def test_every_rank_of_a_small_corpus(spark, monkeypatch, seed, top, block_terms, shared_by):
    monkeypatch.setattr(shared_queries, "BLOCK_TERMS", block_terms)
    monkeypatch.setattr(shared_queries, "GROUP", 16)
    monkeypatch.setattr(shared_queries.share, "__defaults__", (shared_by,))
    docs, items = corpus(seed, 150, 30)
    assert got(spark, docs, items, top) == brute(docs, items, top)


def test_ties_repeats_long_texts_and_unknown_terms(spark, monkeypatch):
    monkeypatch.setattr(shared_queries, "PART", 1000)
    docs = [(k, "same words here") for k in range(60)] + [(None, "same words here"), (7, "same words here"), (100, "Same " * 50_000 + "z" * 5000)]
    docs += [(k, "none of them") for k in range(200, 400)]
    items = [("a", "words WORDS same"), ("b", "unknown"), ("c", "z" * 5000), ("a", "words WORDS same")]
    assert got(spark, docs, items, 20) == brute(docs, items, 20)


def test_empty_tables(spark):
    assert got(spark, [], [("a", "x")], 20) == []
    assert got(spark, [(1, "x")], [], 20) == []
    assert got(spark, [(1, None)], [(None, None)], 20) == []


def test_shared_sets_add_up_to_every_query():
    rnd = random.Random(4)
    queries = [{t: rnd.choice([1, 1, 2]) for t in rnd.sample(range(40), rnd.randint(1, 25))} for _ in range(30)]
    for shared_by in (2, 3):
        graph = shared_queries.share(queries, 40, shared_by)
        assert graph.merged
        one = graph.evaluate(np.arange(40), np.arange(40), np.ones(40, np.int64), 40)
        assert one.tolist() == [[q.get(t, 0) for t in range(40)] for q in queries]
        edges = sum(len(own) for own, _ in graph.queries) + len(graph.merged)
        assert edges < sum(map(len, queries))
