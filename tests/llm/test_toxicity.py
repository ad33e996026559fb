"""The ordinal model on small made-up grades: shared weights, ordered thresholds, edge cases."""

import random

import numpy as np

from martlet.llm import toxicity

SCHEMA = "doc_id long, text string, toxic string, grade long"


def corpus(n=400, seed=1):
    rng = random.Random(seed)
    calm = [f"{a}{b}" for a in ("ba", "ko", "mi", "tu", "re") for b in ("lon", "dar", "vex", "sul", "pim", "gat")]
    rows, labels = [], []
    for i in range(n):
        words, toxic = [rng.choice(calm) for _ in range(rng.randint(20, 200))], i % 4 == 0
        for _ in range(rng.choice([2, 5, 12]) if toxic else 0):
            words.insert(rng.randrange(len(words)), rng.choice(["zzgrob", "QUAXIT", "blorgh"]))
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return rows, labels


def test_held_out_rows_and_severity(spark):
    rows, labels = corpus()
    docs = spark.createDataFrame([(k, t, "x", 1) for k, t in rows], SCHEMA)
    known = spark.createDataFrame([x for x in labels if x[0] % 3] + [(0, None), (None, 1), (9999, 1)], "doc_id long, toxic int")
    got = {r["doc_id"]: r for r in toxicity.score(docs, toxicity.fit(docs, known)).collect()}
    held = [(got[i], y, rows[i][1].lower()) for i, y in labels if i % 3 == 0]
    assert sum(r["toxic"] == bool(y) for r, y, _ in held) >= 0.98 * len(held)
    amount = lambda t: sum(t.count(w) for w in ("zzgrob", "quaxit", "blorgh"))
    mild = np.mean([r["expected_severity"] for r, y, t in held if y and amount(t) <= 2])
    severe = np.mean([r["expected_severity"] for r, y, t in held if y and amount(t) >= 12])
    assert severe > mild + 0.5


def test_reject_keeps_the_other_rows_as_they_are(spark):
    rows, labels = corpus(120)
    docs = spark.createDataFrame([(k, t, "x", 1) for k, t in rows] + [(None, None, None, None), (5, "", "y", 2), (0, rows[0][1], "again", 3)], SCHEMA)
    model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    kept = toxicity.reject(docs, model)
    assert kept.columns == docs.columns
    left = [tuple(r) for r in kept.collect()]
    assert (None, None, None, None) in left and (5, "", "y", 2) in left and (0, rows[0][1], "again", 3) not in left
    assert {r[0] for r in left} - {None} == {i for i, y in labels if not y}


def test_no_toxic_label_no_label_no_document(spark):
    docs = spark.createDataFrame([(1, "a b c", "x", 1), (2, None, "x", 1)], SCHEMA)
    for labels in ([(1, 0)], []):
        model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
        assert [r["expected_severity"] for r in toxicity.score(docs, model).collect()] == [0.0, 0.0] or max(
            r["p_toxic"] for r in toxicity.score(docs, model).collect()) < 1e-9
    only = toxicity.fit(docs, spark.createDataFrame([(1, 1)], "doc_id long, toxic int"))
    assert len(toxicity.score(docs, only).collect()) == 2
    assert toxicity.score(docs.limit(0), only).collect() == [] and toxicity.reject(docs.limit(0), only).collect() == []


def test_fit_recovers_thresholds_order():
    rng = np.random.default_rng(0)
    n, p = 3000, 20
    x = rng.random((n, p)) < 0.3
    w = np.zeros(p)
    w[:3] = [2.0, -1.5, 1.0]
    z = x @ w + rng.logistic(size=n)
    grades = np.searchsorted([-0.5, 1.0, 2.5], z)
    rows, columns = np.nonzero(x)
    theta, got = toxicity.fit_ordinal(rows, columns, np.ones(len(rows)), grades, 4, p, penalty=1e-4)
    assert (np.diff(theta) > 0).all() and np.abs(got - w).max() < 0.3 and np.abs(theta - [-0.5, 1.0, 2.5]).max() < 0.3


def test_very_long_text_in_parts(monkeypatch):
    body = b"Quick brown fox " * 500
    whole = toxicity.features(body)
    monkeypatch.setattr(toxicity, "PART", 97)
    parts = toxicity.features(body)
    assert (whole[0] == parts[0]).all() and np.allclose(whole[1], parts[1])


def test_probability_keeps_its_meaning_when_classes_are_sampled(spark):
    docs = spark.createDataFrame([(i, "the same words in every row", "x", 1) for i in range(1800)], SCHEMA)
    labels = spark.createDataFrame([(i, int(i % 9 == 0)) for i in range(1800)], "doc_id long, toxic int")
    for sample in (3000, 150):  # all rows; one row of ten of the clean ones and three of four of the toxic ones
        model = toxicity.fit(docs, labels, sample=sample)
        assert abs(model.beyond(b"the same words in every row")[0] - 1 / 9) < 0.03, sample


def test_few_labels_still_find_a_feature(spark):
    rows, labels = corpus(20)
    model = toxicity.fit(spark.createDataFrame([(k, t, "x", 1) for k, t in rows], SCHEMA), spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert model.weights.any()
    assert min(model.beyond(t.encode())[0] for (_, t), (_, y) in zip(rows, labels, strict=True) if y) > max(
        model.beyond(t.encode())[0] for (_, t), (_, y) in zip(rows, labels, strict=True) if not y)


def test_repeated_labelled_rows_and_long_texts_stay_a_bounded_sample(spark):
    docs = spark.range(4000).selectExpr("id % 2 doc_id", "if(id % 2 = 0, 'calm words only here', 'zzgrob blorgh words') text")
    docs = docs.unionByName(spark.createDataFrame([(2, "calm " * 100_000), (3, None)], "doc_id long, text string"))
    known = spark.createDataFrame([(0, False), (1, True), (2, False), (3, False)], "key long, toxic boolean")
    rows, stands_for = toxicity._sampled(docs, known, "doc_id", "text", 50)
    assert 20 <= rows.filter("toxic").count() <= 200 and 20 <= rows.filter("NOT toxic").count() <= 200
    assert stands_for[True] == 20 and 19 < stands_for[False] < 21
    model = toxicity.fit(docs, known.selectExpr("key doc_id", "int(toxic) toxic"), sample=50)
    assert model.beyond(b"zzgrob blorgh words")[0] > 0.9 and model.beyond(b"calm words only here")[0] < 0.1


def test_screen_keeps_the_highest_features():
    a, b = np.array([50.0, 40.0, 2.0, 25.0]), np.array([0.0, 10.0, 0.0, 25.0])
    assert toxicity._screened(a, b, 50, 50, 10).tolist() == [True, True, False, False]
    assert toxicity._screened(a, b, 50, 50, 1).tolist() == [True, False, False, False]


def test_fit_agrees_with_a_plain_gradient_descent():
    """The likelihood of the accelerated fit against many small plain steps on the same rows."""
    rng = np.random.default_rng(2)
    x = rng.random((60, 3)) < 0.5
    grades = np.searchsorted([0.0, 1.5], x @ np.array([1.5, -1.0, 0.5]) + rng.logistic(size=60))
    rows, columns = np.nonzero(x)
    theta, w = toxicity.fit_ordinal(rows, columns, np.ones(len(rows)), grades, 3, 3, penalty=0.0, rounds=4000)

    def loss(t, v):
        edge = np.concatenate(([-np.inf], t, [np.inf]))
        z = x @ v
        p = 1 / (1 + np.exp(z - edge[grades + 1])) - 1 / (1 + np.exp(z - edge[grades]))
        return -np.log(np.maximum(p, 1e-300)).mean()

    best, point = loss(np.array([-1.0, 1.0]), np.zeros(3)), np.concatenate(([-1.0, 1.0], np.zeros(3)))
    for _ in range(3000):
        step = np.array([(loss((point + e)[:2], (point + e)[2:]) - loss((point - e)[:2], (point - e)[2:])) / 2e-5 for e in np.eye(5) * 1e-5])
        point = point - 0.5 * step
        best = min(best, loss(point[:2], point[2:]))
    assert loss(theta, w) < best + 1e-4
