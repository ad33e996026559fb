"""Exactly-once landing: re-runs, re-deliveries and replayed micro-batches add nothing."""

import os
import tempfile

import pytest

from martlet.sources import landing
from martlet.sources.landing import stamp_batch
from martlet.streaming import landing_stream


def _batch(spark, batch_id, n):
    df = spark.createDataFrame([(i, f"s{i}") for i in range(n)], "id long, status string")
    return stamp_batch(df, batch_id, "2026-01-01 00:00:00")


def test_replayed_micro_batch_appends_nothing(spark):
    raw = f"{tempfile.mkdtemp(prefix='martlet-replay-')}/t"
    first = _batch(spark, "20260101T000000Z", 5)
    assert landing_stream.append_micro_batch(first, raw) == 5
    assert landing_stream.append_micro_batch(first, raw) == 0          # replay after commit
    assert landing_stream.append_micro_batch(_batch(spark, "20260201T000000Z", 3), raw) == 3
    counts = {r.batch_id: r.row_count for r in landing_stream.raw_batch_counts(
        spark, raw.rsplit("/", 1)[0], ["t"]).collect()}
    assert counts == {"20260101T000000Z": 5, "20260201T000000Z": 3}


def test_available_now_stream_is_idempotent(spark):
    root = tempfile.mkdtemp(prefix="martlet-stream-")
    zone, raw, ckpt = f"{root}/landing", f"{root}/raw", f"{root}/ckpt"
    first = _batch(spark, "20260101T000000Z", 4)
    landing_stream.land_files(first, zone, "t", "20260101T000000Z")
    schemas = {"t": first.schema}
    assert landing_stream.run_landing(spark, zone, raw, schemas, ckpt) == {"t": (4, 4)}
    assert landing_stream.run_landing(spark, zone, raw, schemas, ckpt) == {"t": (0, 0)}   # nothing new
    landing_stream.land_files(first, zone, "t", "20260101T000000Z-again")                 # re-delivered
    landing_stream.land_files(_batch(spark, "20260201T000000Z", 2), zone, "t", "20260201T000000Z")
    assert landing_stream.run_landing(spark, zone, raw, schemas, ckpt) == {"t": (6, 2)}
    counts = {r.batch_id: r.row_count for r in landing_stream.raw_batch_counts(spark, raw, ["t"]).collect()}
    assert counts == {"20260101T000000Z": 4, "20260201T000000Z": 2}


def _contents(spark, raw):
    return sorted(tuple(r) for r in spark.read.parquet(raw).select("_BATCH_ID", "ID", "STATUS").collect())


def test_late_files_of_a_landed_batch_are_appended(spark):
    root = tempfile.mkdtemp(prefix="martlet-late-")
    zone, raw, ckpt = f"{root}/landing", f"{root}/raw", f"{root}/ckpt"
    first = _batch(spark, "20260101T000000Z", 10)
    landing_stream.land_files(first, zone, "t", "20260101T000000Z")
    schemas = {"t": first.schema}
    assert landing_stream.run_landing(spark, zone, raw, schemas, ckpt) == {"t": (10, 10)}
    late = stamp_batch(spark.createDataFrame([(i, "late") for i in range(100, 107)], "id long, status string"),
                       "20260101T000000Z", "2026-01-01 00:00:00")
    late.write.mode("append").parquet(f"{zone}/t/20260101T000000Z")
    assert landing_stream.run_landing(spark, zone, raw, schemas, ckpt) == {"t": (7, 7)}
    assert landing_stream.run_landing(spark, zone, raw, schemas, f"{ckpt}-lost") == {"t": (17, 0)}   # even without its checkpoint
    assert len(_contents(spark, f"{raw}/t")) == 17


@pytest.mark.parametrize("at", ["before the ledger", "half of the files moved", "before the intent"])
def test_interrupted_append_is_finished(spark, monkeypatch, at):
    raw = f"{tempfile.mkdtemp(prefix='martlet-half-')}/t"
    whole = _batch(spark, "20260101T000000Z", 10).repartition(3)
    close, moved = landing._close_run, []

    def stop(spark, path, run, entries):
        if at != "before the intent":
            for _, files, _, _, b in entries[:1]:
                for name in files[:len(files) if at == "before the ledger" else 1]:
                    fs, one = landing._file_system(spark, f"{landing._beside(path, 'staging')}/{run}/_BATCH_ID={b}/{name}")
                    _, two = landing._file_system(spark, f"{path}/_BATCH_ID={b}/{run}-{name}")
                    fs.mkdirs(two.getParent())
                    moved.append(fs.rename(one, two))
        else:
            fs, intent = landing._file_system(spark, f"{landing._beside(path, 'intents')}/{run}")
            fs.delete(intent, True)
        raise RuntimeError("stopped")

    monkeypatch.setattr(landing, "_close_run", stop)
    with pytest.raises(RuntimeError, match="stopped"):
        landing_stream.append_micro_batch(whole, raw)
    monkeypatch.setattr(landing, "_close_run", close)
    finished = at != "before the intent"
    assert landing_stream.append_micro_batch(whole, raw) == (0 if finished else 10)
    assert landing_stream.append_micro_batch(whole, raw) == 0
    assert _contents(spark, raw) == [("20260101T000000Z", i, f"s{i}") for i in range(10)] and all(moved)


def test_rows_of_a_store_without_ledger_stay(spark):
    root = tempfile.mkdtemp(prefix="martlet-ledgerless-")
    landing.append_raw(_batch(spark, "20260101T000000Z", 10), root, "t")
    more = stamp_batch(spark.createDataFrame([(i, "new") for i in range(20, 23)], "id long, status string"), "20260101T000000Z", "2026-01-01 00:00:00")
    assert landing.append_new_batches(spark, more, root, "t") == 3
    assert landing.append_new_batches(spark, more, root, "t") == 0
    assert [r[1] for r in _contents(spark, f"{root}/t")] == [*range(10), 20, 21, 22]


def test_late_rows_under_the_default_source_are_appended(spark):
    root = tempfile.mkdtemp(prefix="martlet-late-rows-")
    first = _batch(spark, "20260101T000000Z", 4)
    late = stamp_batch(spark.createDataFrame([("late", 9)], "STATUS string, id long"), "20260101T000000Z", "2026-01-01 00:00:00")
    assert [landing.append_new_batches(spark, x, root, "t") for x in (first, late, first.repartition(3), late)] == [4, 1, 0, 0]
    assert len(_contents(spark, f"{root}/t")) == 5


def test_a_second_folder_of_a_batch_is_loaded_unless_it_repeats_the_first(spark):
    root = tempfile.mkdtemp(prefix="martlet-second-")
    zone, raw, ckpt = f"{root}/landing", f"{root}/raw", f"{root}/ckpt"
    first = _batch(spark, "20260101T000000Z", 6)
    schemas = {"t": first.schema}
    landing_stream.land_files(first, zone, "t", "20260101T000000Z")
    assert landing_stream.run_landing(spark, zone, raw, schemas, ckpt) == {"t": (6, 6)}
    more = stamp_batch(spark.createDataFrame([(i, "more") for i in range(50, 53)], "id long, status string"), "20260101T000000Z", "2026-01-01 00:00:00")
    landing_stream.land_files(more, zone, "t", "20260101T000000Z-more")
    landing_stream.land_files(first.repartition(2), zone, "t", "20260101T000000Z-again")
    assert landing_stream.run_landing(spark, zone, raw, schemas, ckpt) == {"t": (9, 3)}
    assert landing_stream.run_landing(spark, zone, raw, schemas, f"{ckpt}-lost") == {"t": (15, 0)}
    assert len(_contents(spark, f"{raw}/t")) == 9


def test_batch_marker_gates_the_stream(spark):
    root = tempfile.mkdtemp(prefix="martlet-gate-")
    zone, raw, ckpt, marks = f"{root}/landing", f"{root}/raw", f"{root}/ckpt", f"{root}/batches"
    schemas = {"t": _batch(spark, "20260101T000000Z", 1).schema}
    for k, b in enumerate(("20260101T000000Z", "20260201T000000Z")):
        landing_stream.land_files(_batch(spark, b, 2 + k), zone, "t", b)
    spark.range(1).write.json(f"{marks}/20260201T000000Z")
    assert landing_stream.run_landing(spark, zone, raw, schemas, ckpt, marks) == {"t": (5, 3)}
    assert landing_stream.run_landing(spark, zone, raw, schemas, ckpt, marks) == {"t": (0, 0)}
    spark.range(1).write.json(f"{marks}/20260101T000000Z")
    assert landing_stream.run_landing(spark, zone, raw, schemas, ckpt, marks) == {"t": (2, 2)}
    assert landing_stream.run_landing(spark, zone, raw, schemas, ckpt, marks) == {"t": (0, 0)}
    assert len(_contents(spark, f"{raw}/t")) == 5


def test_older_files_load_and_unmarked_folders_wait(spark):
    root = tempfile.mkdtemp(prefix="martlet-old-")
    zone, raw, ckpt = f"{root}/landing", f"{root}/raw", f"{root}/ckpt"
    new = _batch(spark, "20260201T000000Z", 3)
    landing_stream.land_files(new, zone, "t", "20260201T000000Z")
    schemas = {"t": new.schema}
    assert landing_stream.run_landing(spark, zone, raw, schemas, ckpt) == {"t": (3, 3)}
    landing_stream.land_files(_batch(spark, "20260101T000000Z", 2), zone, "t", "20260101T000000Z")
    folder = f"{zone}/t/20260101T000000Z"
    for name in os.listdir(folder):
        os.utime(f"{folder}/{name}", (1_600_000_000, 1_600_000_000))     # years older than the landed batch
    marker = f"{folder}/_SUCCESS"
    os.remove(marker)
    landing_stream.land_files(_batch(spark, "20260301T000000Z", 1), zone, "t", "20260301T000000Z")   # marked, beside the unmarked one
    assert landing_stream.run_landing(spark, zone, raw, schemas, ckpt) == {"t": (3, 1)}
    assert len(_contents(spark, f"{raw}/t")) == 4
    open(marker, "w").close()
    assert landing_stream.run_landing(spark, zone, raw, schemas, ckpt) == {"t": (2, 2)}
    assert len(_contents(spark, f"{raw}/t")) == 6
