"""Exactly-once landing of batch files into RAW with Structured Streaming.

Landed files (already stamped with ``_BATCH_ID`` / ``_EXTRACTED_AT``) sit
under ``<landing>/<table>/<batch_id>/``. One ``availableNow`` stream per table
copies every file not yet recorded in its checkpoint into
``<raw_root>/<table>/_BATCH_ID=<id>/`` and stops; re-running it on the same
files loads nothing. Each micro-batch is one Parquet append job: task output
is committed by the job commit, so a lost executor only re-runs its task and
RAW readers never see a half-written micro-batch.

A delivered folder carries a completion marker (``_SUCCESS``); with ``batch_markers`` its whole batch must carry one too. Folders without are
put on a waiting list, do not hold up the others, and are loaded by the first pass that finds them marked.

A checkpoint protects against re-reading the same *paths*. The ledger
(``sources.landing``) adds, per table, which file of which batch has been committed: further
files of a landed batch are appended, in whatever folder they come. A folder with the same rows as one that was loaded is a
redelivery: its files are put on record without rows. An append that was interrupted is finished by the next.
"""

from __future__ import annotations

import hashlib
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from martlet.config import BATCH_COL
from martlet.sources.landing import (LEDGER_SCHEMA, _beside, _file_system, append_new_batches, append_sources, content_digests,
                                     finish_interrupted, is_marked, ledger, ledger_path)


def land_files(df: DataFrame, landing_root: str, table: str, batch_id: str) -> None:
    """Deliver one stamped extract as immutable batch files."""
    df.write.mode("errorifexists").option("compression", "snappy").parquet(f"{landing_root}/{table}/{batch_id}")


SOURCE_FILE = "_SOURCE_FILE"


def _folder(name: str) -> str:
    """A file's folder; ``_metadata.file_path`` has its name percent-encoded."""
    return unquote(name.rsplit("/", 1)[0])


def _ready(spark: SparkSession, folder: str, batch_id: str, batch_markers: str | None) -> bool:
    return is_marked(spark, folder) and (batch_markers is None or is_marked(spark, f"{batch_markers}/{batch_id}"))


def _wait_for(spark: SparkSession, raw_path: str, folder: str) -> None:
    """Put a folder on the waiting list; once, however often it is met."""
    fs, path = _file_system(spark, f"{_beside(raw_path, 'waiting')}/{hashlib.sha256(folder.encode()).hexdigest()}")
    if not fs.exists(path):
        spark.createDataFrame([(folder,)], "folder string").coalesce(1).write.mode("overwrite").json(path.toString())


def _waiting(spark: SparkSession, raw_path: str) -> list[str]:
    fs, path = _file_system(spark, _beside(raw_path, "waiting"))
    if not fs.exists(path) or not fs.listStatus(path):
        return []
    return [r[0] for r in spark.read.schema("folder string").json(f"{path.toString()}/*").collect()]


def _is_redelivery(spark: SparkSession, folder: str, batch_id: str, loaded: set[str]) -> bool:
    """Whether a folder has the rows of one that was loaded. Folders are immutable, so they can be compared at any time."""
    read = lambda f: spark.read.parquet(f).filter(F.col(BATCH_COL) == batch_id)
    own = content_digests(read(folder), BATCH_COL)
    return any(content_digests(read(other), BATCH_COL) == own for other in sorted(loaded))


def _append(batch_df: DataFrame, raw_path: str, batch_markers: str | None) -> tuple[int, int]:
    """Rows read and rows appended of one micro-batch."""
    spark = batch_df.sparkSession
    finish_interrupted(spark, raw_path)
    arrived = {(r[0], r[1]): r[2] for r in batch_df.groupBy(BATCH_COL, SOURCE_FILE).count().collect()}  # one row per file
    read = sum(arrived.values())
    loaded: dict[str, set[str]] = {}
    committed = set()
    for r in ledger(spark, raw_path, sorted({b for b, _ in arrived})):
        committed.add((r["batch_id"], r["source"]))
        if r["files"] or r["row_count"]:
            loaded.setdefault(r["batch_id"], set()).add(_folder(r["source"]))
    ready = {}
    for b, f in sorted(arrived):
        if (b, _folder(f)) not in ready:
            ready[b, _folder(f)] = _ready(spark, _folder(f), b, batch_markers)
            if not ready[b, _folder(f)]:
                _wait_for(spark, raw_path, _folder(f))
    repeated: dict[tuple[str, str], bool] = {}
    new: dict[str, list[str]] = {}
    again: list[tuple] = []
    for b, f in sorted(arrived):
        place = (b, _folder(f))
        if (b, f) in committed or not ready[place]:
            continue
        if place not in repeated:
            others = {x for x in loaded.get(b, set()) if "/" in x}
            repeated[place] = place[1] not in others and bool(others) and _is_redelivery(spark, place[1], b, others)
        if repeated[place]:
            again.append((f, [], 0, "redelivered", b))
        else:
            new.setdefault(b, []).append(f)
            loaded.setdefault(b, set()).add(place[1])
            repeated[place] = False
    if again:
        spark.createDataFrame(again, LEDGER_SCHEMA).coalesce(1).write.mode("append").partitionBy("batch_id").json(ledger_path(raw_path))
    if not new:
        return read, 0
    pairs = [F.struct(F.lit(b), F.lit(f)) for b, files in new.items() for f in files]
    fresh = batch_df.filter(F.struct(BATCH_COL, SOURCE_FILE).isin(pairs)).drop(SOURCE_FILE)
    return read, append_sources(fresh, raw_path, new)


def append_micro_batch(batch_df: DataFrame, raw_path: str, batch_markers: str | None = None) -> int:
    """The ``foreachBatch`` body: append the rows of files not yet committed to RAW.

    Rows carry their file in ``_SOURCE_FILE``; without it their content says whether they were loaded. Safe to replay at any point.
    Returns the rows appended.
    """
    if SOURCE_FILE not in batch_df.columns:
        root, table = raw_path.rstrip("/").rsplit("/", 1)
        return append_new_batches(batch_df.sparkSession, batch_df, root, table)
    return _append(batch_df, raw_path, batch_markers)[1]


def land_waiting(spark: SparkSession, raw_path: str, schema: StructType, batch_markers: str | None = None) -> tuple[int, int]:
    """Load the waiting folders that are marked by now; rows read and appended."""
    read = written = 0
    for folder in _waiting(spark, raw_path):
        if not is_marked(spark, folder):
            continue
        rows = spark.read.schema(schema).parquet(folder).select("*", F.col("_metadata.file_path").alias(SOURCE_FILE))
        batches = [r[0] for r in rows.select(BATCH_COL).distinct().collect()]
        if not all(_ready(spark, folder, b, batch_markers) for b in batches):
            continue
        r, w = _append(rows, raw_path, batch_markers)
        read, written = read + r, written + w
        fs, path = _file_system(spark, f"{_beside(raw_path, 'waiting')}/{hashlib.sha256(folder.encode()).hexdigest()}")
        fs.delete(path, True)
    return read, written


def start_landing_stream(spark: SparkSession, landing_root: str, raw_root: str, table: str,
                         schema: StructType, checkpoint: str, counts: list | None = None, batch_markers: str | None = None):
    """Start an ``availableNow`` stream for one table; returns the StreamingQuery.

    ``counts`` (optional) collects (rows read, rows appended) of each micro-batch. Files are taken
    whatever their age; a micro-batch holds a bounded number of them.
    """
    raw_path = f"{raw_root}/{table}"

    def append_new(batch_df: DataFrame, _epoch: int) -> None:
        done = _append(batch_df, raw_path, batch_markers)
        if counts is not None:
            counts.append(done)

    stream = (spark.readStream.schema(schema).option("maxFileAge", "36500d").option("maxFilesPerTrigger", 1000)
              .parquet(f"{landing_root}/{table}/*").select("*", F.col("_metadata.file_path").alias(SOURCE_FILE)))
    return (stream.writeStream.foreachBatch(append_new)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start())


def run_landing(spark: SparkSession, landing_root: str, raw_root: str, schemas: dict[str, StructType],
                checkpoint_root: str, batch_markers: str | None = None) -> dict[str, tuple[int, int]]:
    """Run one availableNow pass for every table concurrently, after the waiting folders that are marked by now.

    ``batch_markers`` names the folder in which a finished batch has a marked folder of its own. Returns ``{table: (rows_read, rows_written)}``, both counted in every micro-batch of the pass.
    """
    counts = {t: [land_waiting(spark, f"{raw_root}/{t}", s, batch_markers)] for t, s in schemas.items()}
    queries = {}
    try:
        for t, s in schemas.items():
            queries[t] = start_landing_stream(spark, landing_root, raw_root, t, s, f"{checkpoint_root}/{t}", counts[t], batch_markers)
        for q in queries.values():
            q.awaitTermination()
        return {t: (sum(r for r, _ in c), sum(w for _, w in c)) for t, c in counts.items()}
    finally:  # a failed table must not leave the other streams running
        for q in queries.values():
            if q.isActive:
                q.stop()


def raw_batch_counts(spark: SparkSession, raw_root: str, tables) -> DataFrame:
    """``(table_name, batch_id, row_count)`` of the landed RAW tables."""
    parts = [spark.read.parquet(f"{raw_root}/{t}").groupBy(F.col(BATCH_COL).alias("batch_id"))
             .agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(t).alias("table_name"), "batch_id", "row_count")
             for t in tables]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
