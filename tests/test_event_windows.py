"""Event-time windows against a model of the watermark, over restarts, a lost commit, late rows and a key of a third of all rows."""

import glob
import os
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from martlet.streaming import event_windows

START = datetime(2026, 1, 1)
SPEC = {"instant": "at", "keys": ["kind"], "width": "10 minutes"}
SCHEMA = "id long, at timestamp, kind string, w string, one int, n int"
WIDTH, DELAY = timedelta(minutes=10), timedelta(minutes=15)
minute = lambda m: None if m is None else START + timedelta(minutes=m)


@pytest.fixture(autouse=True)
def utc(spark):
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"


def model(passes):
    """(closed windows, late rows): a row counts if its window was open when its pass began."""
    mark, seen, counted, everything = None, None, {}, {}
    for rows in passes:
        for _, at, kind, *_ in rows:
            if at is None:
                continue
            start = START + ((at - START) // WIDTH) * WIDTH
            everything[start, kind] = everything.get((start, kind), 0) + 1
            if mark is None or start + WIDTH > mark:
                counted[start, kind] = counted.get((start, kind), 0) + 1
        seen = max([r[1] for r in rows if r[1] is not None] + ([seen] if seen else []), default=None)
        mark = seen and seen - DELAY
    closed = {k: n for k, n in counted.items() if mark and k[0] + WIDTH <= mark}
    late = {k: (n, closed.get(k, 0), n - closed.get(k, 0)) for k, n in everything.items() if mark and k[0] + WIDTH <= mark and n > closed.get(k, 0)}
    return closed, late


class Stream:
    def __init__(self, spark, root):
        self.spark, self.root, self.passes, self.schema = spark, str(root), [], spark.createDataFrame([], SCHEMA).schema

    def deliver(self, rows):
        at = f"{self.root}/landing/{len(self.passes)}"
        frame = [(i, minute(m), k, "own", 1, 2) for i, m, k in rows]
        self.spark.createDataFrame(frame, "id long, at timestamp_ntz, kind string, w string, one int, n int").withColumn("at", F.col("at").cast("timestamp")).write.parquet(at)
        self.passes.append(frame)

    def run(self):
        return event_windows.run_pass(self.spark, f"{self.root}/landing", self.schema, f"{self.root}/out", f"{self.root}/checkpoint", delay="15 minutes", **SPEC)

    def closed(self):
        return event_windows.closed_windows(self.spark, f"{self.root}/out", self.schema, **SPEC)

    def check(self):
        closed, late = model(self.passes)
        ntz = F.col("window_start").cast("timestamp_ntz").alias("s")
        assert sorted(((r.s, r.kind), r.event_count) for r in self.closed().select("*", ntz).collect()) == sorted(closed.items()) if None not in {k for _, k in closed} \
            else {(r.s, r.kind): r.event_count for r in self.closed().select("*", ntz).collect()} == closed
        assert self.closed().count() == len(closed)
        found = event_windows.late_rows(self.spark.read.schema(self.schema).parquet(f"{self.root}/landing/*"), self.closed(), delay="15 minutes", **SPEC)
        assert {(r.s, r.kind): (r.event_count, r.closed_count, r.late_count) for r in found.select("*", ntz).collect()} == late


def test_random_passes_with_late_rows_and_nulls(spark, tmp_path):
    for seed in range(2):
        rng, stream = random.Random(seed), Stream(spark, tmp_path / str(seed))
        for k in range(4):
            stream.deliver([(n, None if n % 23 == 4 else max(0, 40 * k + rng.randint(-60, 40)), rng.choice(["a", "b", None])) for n in range(rng.choice([5, 120]))])
            assert stream.run()["rows_read"] == len(stream.passes[-1])
            stream.check()
        assert model(stream.passes)[1]


def test_pass_without_files_and_a_late_row_change_no_closed_window(spark, tmp_path):
    stream = Stream(spark, tmp_path)
    stream.deliver([(1, 0, "a"), (2, 9, "a"), (3, 100, "a")])
    assert stream.run() == {"rows_read": 3, "windows_written": 1}
    assert stream.run() == {"rows_read": 0, "windows_written": 0}
    stream.deliver([(4, 5, "a"), (5, 75, "a"), (6, 7, "never in time")])  # the window of 75 is over, its end at the watermark
    assert stream.run() == {"rows_read": 3, "windows_written": 0}
    stream.deliver([(7, 76, "a"), (8, 130, "a")])
    stream.run()
    stream.check()
    assert model(stream.passes)[1][START, "a"] == (3, 2, 1) and model(stream.passes)[1][START, "never in time"] == (1, 0, 1)


def test_lost_commit_is_repeated_without_writing_twice(spark, tmp_path):
    stream = Stream(spark, tmp_path)
    stream.deliver([(n, n, "ab"[n % 2]) for n in range(60)])
    stream.run()
    commits = lambda: sorted((p for p in glob.glob(f"{stream.root}/checkpoint/commits/*") if os.path.basename(p).isdigit()), key=lambda p: int(os.path.basename(p)))
    for _ in range(2):  # once after a pass, once after a pass that repeated a batch
        last = commits()[-1]
        os.remove(last)
        if os.path.exists(side := f"{os.path.dirname(last)}/.{os.path.basename(last)}.crc"):
            os.remove(side)
        stream.deliver([(n, 60 * len(stream.passes) + n, "ab"[n % 2]) for n in range(60)])
        stream.run()
        stream.check()


def test_hot_key_is_added_up_before_the_exchange_and_state_expires(spark, tmp_path):
    stream = Stream(spark, tmp_path)
    stream.deliver([(n, n % 200, "hot" if n % 3 == 0 else f"k{n % 40}") for n in range(6000)])
    stream.run()
    stream.check()
    rows = spark.readStream.schema(stream.schema).parquet(f"{stream.root}/landing/*").withWatermark("at", "15 minutes")
    query = event_windows._windows(rows, "at", ["kind"], "10 minutes", {}).writeStream.format("noop").outputMode("append").trigger(availableNow=True) \
        .option("checkpointLocation", f"{stream.root}/plan").start()
    query.awaitTermination()
    last = query.lastProgress["stateOperators"][0]
    assert last["numRowsTotal"] < 41 * 4  # windows of the last 15 minutes, not all 20
    plan = query._jsq.explainInternal(False)
    assert plan.index("StateStoreSave") < plan.index("StateStoreRestore") < plan.index("Exchange") < plan.rindex("HashAggregate")


def test_no_rows(spark, tmp_path):
    stream = Stream(spark, tmp_path)
    stream.deliver([])
    stream.deliver([(1, None, "a")])
    stream.run()
    stream.check()
    assert stream.closed().count() == 0


def test_late_rows_from_an_instant_on(spark, tmp_path):
    stream = Stream(spark, tmp_path)
    for rows in ([(1, 0, "a"), (2, 100, "a")], [(3, 5, "a"), (4, 55, "a")]):
        stream.deliver(rows)
        stream.run()
    delivered = spark.read.schema(stream.schema).parquet(f"{stream.root}/landing/*")
    found = event_windows.late_rows(delivered, stream.closed(), delay="15 minutes", since="2026-01-01 00:50:00", **SPEC).collect()
    assert [(r.event_count, r.closed_count, r.late_count) for r in found] == [(1, 0, 1)]
