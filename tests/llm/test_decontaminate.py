"""Decontamination against a plain scan of all windows."""

import hashlib
import random
import re

from martlet.llm import decontaminate

SCHEMA = "doc_id long, text string, n_words long, hit_ranges string"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split(t):
    return WORD.findall((t or "").translate(LOWER))


def brute(docs, items, n=10):
    out = []
    for key, text in docs:
        w, hit, found = split(text), set(), set()
        for item, body in items:
            b = split(body)
            size = min(n, len(b))
            windows = {tuple(b[i:i + size]) for i in range(len(b) - size + 1)} if b else set()
            for i in range(len(w) - size + 1):
                if tuple(w[i:i + size]) in windows:
                    hit.update(range(i, i + size))
                    found.add("null" if item is None else str(item))
        ids = ",".join(sorted(found))
        out.append((key, len(w), len(hit), len(found), hashlib.sha256(ids.encode()).hexdigest(), bool(hit)))
    return out


def corpus():
    rng = random.Random(4)
    vocab = [f"v{i}" for i in range(30)] + ["Été", "日本語", "Q9"]
    text = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    items = [(i, text(rng.choice([2, 3, 10, 12, 40]))) for i in range(12)] + [(3, text(11)), (None, "only null item words here"), (50, None), (51, "...")]
    docs = []
    for i in range(60):
        parts = [text(rng.randint(0, 40))]
        if i % 3 == 0:
            parts.insert(0, rng.choice(items)[1] or "")
        docs.append((i, ", ".join(parts).upper() if i % 2 else "\n".join(parts)))
    return docs + [(None, None), (5, ""), (5, items[4][1]), (5, items[4][1]), (61, "word " * 50_000)], items


def test_report_matches_all_windows(spark):
    docs, items = corpus()
    frame = spark.createDataFrame([(k, t, 1, "x") for k, t in docs], SCHEMA)
    bench = spark.createDataFrame(items, "item_id long, text string")
    key = lambda r: tuple(str(x) for x in r)
    for block_words in (10**6, 20):  # one pass, and several
        got = [tuple(r) for r in decontaminate.decontamination_report(frame, bench, block_words=block_words).collect()]
        assert sorted(got, key=key) == sorted(brute(docs, items), key=key)


def test_removal(spark):
    docs, items = corpus()
    frame = spark.createDataFrame([(k, t, 1, "x") for k, t in docs], SCHEMA)
    bench = spark.createDataFrame(items, "item_id long, text string")
    clean = [(k, t) for (k, t), r in zip(docs, brute(docs, items), strict=True) if not r[5]]
    kept = decontaminate.remove(frame, bench)
    assert kept.columns == frame.columns
    assert sorted(((r[0], r[1]) for r in kept.collect()), key=str) == sorted(clean, key=str)
    cut = decontaminate.remove(frame, bench, what="spans").collect()
    assert len(cut) == len(docs)
    by = {r["doc_id"]: r["text"] for r in cut}
    assert all(by[k] == t for k, t in clean if k not in (5,))
    assert decontaminate.cut_ranges("One two, THREE four.", [[1, 3]]) == "One  four."


def test_empty_sides(spark):
    docs, items = corpus()
    frame = spark.createDataFrame([(k, t, 1, "x") for k, t in docs], SCHEMA)
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.remove(frame, none).count() == len(docs)
    assert decontaminate.decontamination_report(frame.limit(0), spark.createDataFrame(items, "item_id long, text string")).collect() == []
