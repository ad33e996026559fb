"""Threshold-scaled sketches against a plain computation on small tables."""

import hashlib
import random

from pyspark.sql import functions as F

from martlet.llm import fracsketch

SCHEMA = "doc_id long, text string, range string, key long"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split(text):
    t = (text or "").translate(LOWER)
    for c in "\t\n\v\f\r":
        t = t.replace(c, " ")
    return [w for w in t.split(" ") if w]


def corpus(seed=2):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(200)] + ["Été", "日本", "𝄞x"]
    rows = [(rng.randrange(10_000), " ".join(rng.choice(vocab) for _ in range(rng.choice([0, 1, 4, 5, 60, 400])))) for _ in range(60)]
    rows += [(None, "null key one two three four"), (None, "another null key"), (5, None), (6, ""), (7, "a\tb\n c"), rows[0], rows[0],
             (8, "x " * 60_000)]
    return rows


def check(spark, rows, monkeypatch, per_range):
    if per_range:
        plain = fracsketch.with_next
        monkeypatch.setattr(fracsketch, "with_next", lambda *a: plain(*a, rows_per_range=per_range))
    docs = spark.createDataFrame([(k, t, "r", 1) for k, t in rows], SCHEMA)
    got = fracsketch.compare_documents(docs).collect()
    hashes = {r[0]: r[1] for r in docs.select(F.coalesce("text", F.lit("")).alias("t")).distinct().select("t", F.xxhash64("t")).collect()}
    order = sorted(((k, t or "") for k, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, hashes[r[1]]), reverse=True)
    made = []
    for i, (k, t) in enumerate(order):
        following = order[(i + 1) % len(order)][1]
        half = len(t) // 2
        edited = t[:len(t) - half] + following[:half]
        made.append((k, t, edited, following))
    needed = sorted({x for _, *three in made for x in three})
    shingles = {x: [" ".join(split(x)[i:i + 5]) for i in range(max(len(split(x)) - 4, 1))] if split(x) else [] for x in needed}
    flat = spark.createDataFrame([(w,) for w in sorted({w for x in needed for w in split(x)} | {"-"})], "w string")
    h = {r[0]: r[1] for r in flat.select("w", F.xxhash64("w")).collect()}
    five = sorted({tuple((h[w] for w in s.split(" "))) for ss in shingles.values() for s in ss})
    wide = spark.createDataFrame([[*f, *[None] * (5 - len(f))] for f in five], "a long, b long, c long, d long, e long")
    combined = dict(zip(five, (r[0] for r in wide.select(F.xxhash64("a", "b", "c", "d", "e")).collect()), strict=True))
    most = -(1 << 63) + (1 << 64) // fracsketch.SCALE
    kept = {x: sorted({v for s in ss if (v := combined[tuple(h[w] for w in s.split(" "))]) < most}) for x, ss in shingles.items()}
    like = lambda x, y: (len(set(kept[x]) & set(kept[y])) / len(u) if (u := set(kept[x]) | set(kept[y]))
                         else float(split(x) == split(y)))
    text_of = lambda x: "".join(f"{v % 2**64:016x}" for v in kept[x])
    want = [(k, len(t), hashlib.sha256(e.encode()).hexdigest(), text_of(t), text_of(e), round(like(t, e), 12), round(like(t, f), 12)) for k, t, e, f in made]
    assert sorted(((r["doc_id"], r["n_chars"], r["edited_sha256"], r["fingerprint"], r["edited_fingerprint"], round(r["near_edited"], 12),
                    round(r["near_next"], 12)) for r in got), key=str) == sorted(want, key=str)


def test_one_range(spark, monkeypatch):
    check(spark, corpus(), monkeypatch, None)


def test_many_ranges_with_repeated_and_null_keys(spark, monkeypatch):
    rows = corpus(4) + [(77, f"same key {i} " * 6) for i in range(30)] + [(None, f"no key {i} " * 6) for i in range(30)]
    check(spark, rows, monkeypatch, 5)


def test_single_row_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "a b c d e f g h", "r", 1)], SCHEMA)
    (row,) = fracsketch.compare_documents(docs).collect()
    assert row["near_next"] == 1.0
    assert fracsketch.compare_documents(docs.limit(0)).collect() == []


def test_merged_sketch_is_the_sketch_of_all_shingles(spark):
    texts = [(1, " ".join(f"a{i}" for i in range(300))), (1, " ".join(f"b{i}" for i in range(100))), (2, "x y")]
    rows = spark.createDataFrame(texts, "g long, text string").withColumn("kept", fracsketch.sketch(F.col("text")))
    own = {}
    for r in rows.collect():
        own.setdefault(r["g"], set()).update(r["kept"])
    got = {r["g"]: r["kept"] for r in fracsketch.merged(rows, "g").collect()}
    assert got == {g: sorted(v) for g, v in own.items() if v}


def test_containment_of_unequal_texts(spark):
    long = " ".join(f"a{i}" for i in range(5000))
    part = " ".join(f"a{i}" for i in range(1000, 2000))
    row = spark.createDataFrame([(long, part)], "x string, y string").select(
        fracsketch.containment(fracsketch.sketch(F.col("y")), fracsketch.sketch(F.col("x"))).alias("inside"),
        fracsketch.containment(fracsketch.sketch(F.col("x")), fracsketch.sketch(F.col("y"))).alias("over")).first()
    assert row["inside"] == 1.0 and abs(row["over"] - 0.2) < 0.06
