"""Type-2 history against a plain replay of snapshots, reruns, refusals, crash before publishing."""

import tempfile

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from martlet.operators import history
from martlet.sources import versions

SCHEMA = "id long, name string, size double"
BATCHES = [f"2026010{k}T000000Z" for k in range(1, 6)]


def at(k):
    return F.lit(f"2026-01-0{k + 1} 00:00:00").cast("timestamp_ntz")


def brute(shots):
    out, open_ = [], {}
    for k, shot in enumerate(shots):
        for key in list(open_):
            if shot.get(key) != open_[key][0]:
                value, start = open_.pop(key)
                out.append((key, *value, start, BATCHES[k]))
        for key, value in shot.items():
            open_.setdefault(key, (value, BATCHES[k]))
    return sorted([*out, *((key, *v, s, None) for key, (v, s) in open_.items())], key=str)


def rows(found):
    return sorted((tuple(r) for r in found.select("id", "name", "size", "from_batch", "to_batch").collect()), key=str)


def frame(spark, shot):
    return spark.createDataFrame([(k, *v) for k, v in shot.items()], SCHEMA)


SHOT = st.dictionaries(st.integers(1, 5), st.tuples(st.sampled_from([None, "a", "b"]), st.sampled_from([None, 1.0])), max_size=5)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(SHOT, min_size=1, max_size=4))
def test_random_snapshots_applied_twice_each(spark, shots):
    root = tempfile.mkdtemp(prefix="martlet-history-")
    for k, shot in enumerate(shots):
        for _ in range(2):
            found = history.apply_snapshot(frame(spark, shot), root, "id", BATCHES[k], at(k))
        assert rows(found) == brute(shots[:k + 1])
    assert found.filter("valid_to <= valid_from").count() == 0
    for k, shot in enumerate(shots):
        held = history.as_of(found, at(k)).select("id", "name", "size").collect()
        assert sorted(map(tuple, held), key=str) == sorted(((i, *v) for i, v in shot.items()), key=str)


def test_refusals_and_two_writers(spark, monkeypatch):
    root = tempfile.mkdtemp(prefix="martlet-history-")
    one, two = frame(spark, {1: ("a", None)}), frame(spark, {1: ("b", None)})
    with pytest.raises(ValueError, match="one row per id"):
        history.apply_snapshot(one.unionByName(two), root, "id", BATCHES[1], at(1))
    with pytest.raises(ValueError):
        history.apply_snapshot(frame(spark, {None: ("a", None)}), root, "id", BATCHES[1], at(1))
    assert history.read_history(spark, root) is None
    history.apply_snapshot(one, root, "id", BATCHES[1], at(1))
    with pytest.raises(ValueError, match="older"):
        history.apply_snapshot(one, root, "id", BATCHES[0], at(0))
    publish = versions.publish
    monkeypatch.setattr(versions, "publish", lambda *a: (_ for _ in ()).throw(RuntimeError("stopped")))
    with pytest.raises(RuntimeError, match="stopped"):
        history.apply_snapshot(two, root, "id", BATCHES[2], at(2))
    assert rows(history.read_history(spark, root)) == [(1, "a", None, BATCHES[1], None)]   # nothing half done is seen
    monkeypatch.setattr(versions, "publish", publish)
    assert rows(history.apply_snapshot(two, root, "id", BATCHES[2], at(2))) == [(1, "a", None, BATCHES[1], BATCHES[2]), (1, "b", None, BATCHES[2], None)]
    with pytest.raises(RuntimeError, match="another writer"):
        versions.publish(spark, root, {}, 1)


def test_one_key_of_many_columns_alike_names(spark):
    root = tempfile.mkdtemp(prefix="martlet-history-")
    shot = spark.range(2000).selectExpr("id", "'x' name", "double(id % 3) size")
    history.apply_snapshot(shot, root, "id", BATCHES[0], at(0))
    found = history.apply_snapshot(shot.selectExpr("id", "name", "if(id = 7, 9, size) size"), root, "id", BATCHES[1], at(1))
    assert found.count() == 2001 and found.filter("valid_to IS NULL").count() == 2000
