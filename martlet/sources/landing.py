"""Batch landing: lineage stamping, guarded writes, manifests, batch selection.

A batch is one extract of the seven source tables. RAW is append-only and
partitioned by ``_BATCH_ID``; source keys repeat across batches, so the RAW
key is ``(_BATCH_ID, source key)``.
"""

from __future__ import annotations

import uuid

from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from martlet.config import BATCH_COL, EXTRACTED_COL, TABLES
from martlet.functions.batch_ids import is_valid_batch_id, require_batch_id


def stamp_batch(df: DataFrame, batch_id: str, extracted_at: datetime | str | Column) -> DataFrame:
    """Upper-case every column name and append ``_BATCH_ID`` / ``_EXTRACTED_AT`` (see ``lineage``)."""
    stamp = lineage(batch_id, extracted_at)
    upper = df.toDF(*[c.upper() for c in df.columns])
    return upper.select("*", stamp[BATCH_COL].alias(BATCH_COL), stamp[EXTRACTED_COL].alias(EXTRACTED_COL))


def lineage(batch_id: str, extracted_at: datetime | str | Column) -> Column:
    """A batch's lineage columns as one struct.

    ``extracted_at`` is a tz-aware instant (or ``'yyyy-MM-dd HH:mm:ss'`` UTC text);
    it becomes a TIMESTAMP (instant) constant on every row, built from epoch
    microseconds so it does not depend on the session time zone.
    """
    require_batch_id(batch_id)
    if isinstance(extracted_at, str):
        extracted_at = datetime.fromisoformat(extracted_at).replace(tzinfo=timezone.utc)
    if isinstance(extracted_at, datetime):
        if extracted_at.tzinfo is None:
            raise ValueError("extracted_at must be timezone-aware")
        delta = extracted_at - datetime(1970, 1, 1, tzinfo=timezone.utc)
        micros = (delta.days * 86_400 + delta.seconds) * 1_000_000 + delta.microseconds
        ts = F.timestamp_micros(F.lit(micros))
    else:
        ts = extracted_at
    return F.struct(F.lit(batch_id).alias(BATCH_COL), ts.alias(EXTRACTED_COL))


def _file_system(spark: SparkSession, path: str):
    """Hadoop's file system of a path, and the path itself."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def is_marked(spark: SparkSession, folder: str) -> bool:
    """Whether a delivered folder carries its completion marker."""
    fs, target = _file_system(spark, f"{folder}/_SUCCESS")
    return bool(fs.exists(target))


def write_batch_table(df: DataFrame, path: str, expected_rows: int | None = None) -> int:
    """Write one landed table as snappy Parquet: complete and verified, or absent.

    The rows go to a staging folder beside ``path`` and are counted during that
    write (no second scan). Only when the count is right is the folder renamed to
    ``path``; 0 rows, or a count different from the source's own, removes
    the staging folder and raises, so nothing readable is left and a retry works.
    """
    spark = df.sparkSession
    fs, target = _file_system(spark, path)
    if fs.exists(target):
        raise FileExistsError(path)
    staging = f"{path.rstrip('/')}.staging-{uuid.uuid4().hex}"
    _, staged = _file_system(spark, staging)
    try:
        obs = Observation(f"landed_{uuid.uuid4().hex}")
        observed = df.observe(obs, F.count(F.lit(1)).alias("rows"))
        observed.write.mode("errorifexists").option("compression", "snappy").parquet(staging)
        written = int(obs.get["rows"])
        if written == 0:
            raise RuntimeError(f"nothing landed at {path}: the extract is empty")
        if expected_rows is not None and written != expected_rows:
            raise RuntimeError(f"torn extract for {path}: {written} rows written of {expected_rows}")
        if not fs.rename(staged, target):
            raise RuntimeError(f"could not publish {path}")
        return written
    finally:
        if fs.exists(staged):
            fs.delete(staged, True)


def deliver_batch(spark: SparkSession, extracts: dict[str, DataFrame], root: str, instant: datetime,
                  expected_rows: dict[str, int] | None = None) -> str:
    """Land one whole batch: one instant, one id, every table guarded, the batch marker last.

    ``extracts`` are the unstamped source tables, all seven of them. Each is stamped and written
    under ``root/<batch id>/<table>``; ``root/<batch id>/_MANIFEST`` (table, row count) is written only after all
    of them. Returns the batch id.
    """
    if set(extracts) != set(TABLES):
        raise ValueError(f"a batch has exactly the tables {', '.join(TABLES)}")
    batch_id = instant.astimezone(timezone.utc).strftime("%Y%m%dT%H%M%SZ")
    folder = f"{root}/{batch_id}"
    counts = [(t, write_batch_table(stamp_batch(extracts[t], batch_id, instant), f"{folder}/{t}",
                                    None if expected_rows is None else expected_rows[t])) for t in TABLES]
    spark.createDataFrame(counts, "table_name string, row_count bigint").coalesce(1).write.json(f"{folder}/_MANIFEST")
    return batch_id


def load_delivered(spark: SparkSession, root: str, batch_id: str, raw_root: str) -> dict[str, int]:
    """Append a delivered batch to RAW; a batch without its marker is refused before anything is read."""
    require_batch_id(batch_id)
    if not is_marked(spark, f"{root}/{batch_id}/_MANIFEST"):
        raise ValueError(f"batch {batch_id} has no completion marker")
    return {t: append_new_batches(spark, spark.read.parquet(f"{root}/{batch_id}/{t}"), raw_root, t) for t in TABLES}


def rowcount_guard(spark: SparkSession, extracts: dict[str, DataFrame], root: str,
                   expected_rows: dict[str, int] | None = None) -> DataFrame:
    """Land each extract under ``root/<table>`` with the torn-write guard.

    Returns ``(table_name, expected_rows, written_rows, rows_match)``. The
    expected count is the source's own row count (``expected_rows``, e.g. from
    table metadata or a Parquet footer count); only when it is not given is
    the extract counted separately. The written count is observed during the
    write, so each extract is computed once.
    """
    rows = []
    for name in sorted(extracts):
        expected = expected_rows[name] if expected_rows is not None else extracts[name].count()
        written = write_batch_table(extracts[name], f"{root}/{name}", expected)
        rows.append((name, expected, written, expected == written))
    schema = "table_name string, expected_rows bigint, written_rows bigint, rows_match boolean"
    return spark.createDataFrame(rows, schema)


def append_raw(df: DataFrame, raw_root: str, table: str) -> None:
    """Append a stamped batch to RAW, partitioned by ``_BATCH_ID``."""
    (df.write.mode("append").partitionBy(BATCH_COL).option("compression", "zstd")
       .parquet(f"{raw_root}/{table}"))


def read_raw(spark: SparkSession, raw_root: str, table: str, schema: StructType | None = None) -> DataFrame:
    """RAW table reader; a ``_BATCH_ID`` filter prunes partitions at listing time."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(StructType(list(schema.fields) + [StructField(BATCH_COL, StringType())]))
    return reader.parquet(f"{raw_root}/{table}")


def batch_manifest(raw: dict[str, DataFrame]) -> DataFrame:
    """``(table_name, batch_id, row_count)`` for every landed (table, batch).

    One partial aggregate per table; only per-batch counts are shuffled.
    """
    parts = [df.groupBy(F.col(BATCH_COL).alias("batch_id")).agg(F.count(F.lit(1)).alias("row_count"))
               .select(F.lit(name).alias("table_name"), "batch_id", "row_count")
             for name, df in sorted(raw.items())]
    return reduce(DataFrame.unionByName, parts)


def complete_batches(manifest: DataFrame, tables: tuple[str, ...] = TABLES) -> DataFrame:
    """Per batch: expected tables present, unknown tables, empty tables, completeness.

    A batch is complete only when exactly the expected tables are present
    and none is empty.
    """
    expected = F.array(*[F.lit(t) for t in sorted(tables)])
    per_batch = manifest.groupBy("batch_id").agg(
        F.array_sort(F.collect_set("table_name")).alias("tables"),
        F.sum("row_count").alias("total_rows"),
        F.count_if(F.col("row_count") == 0).alias("empty_tables"))
    return per_batch.select(
        "batch_id",
        F.size("tables").cast("bigint").alias("table_count"),
        "total_rows",
        F.size(F.array_except(expected, F.col("tables"))).cast("bigint").alias("missing_tables"),
        F.size(F.array_except(F.col("tables"), expected)).cast("bigint").alias("unknown_tables"),
        ((F.col("tables") == expected) & (F.col("empty_tables") == 0)).alias("is_complete"))


def latest_batch(manifest: DataFrame, tables: tuple[str, ...] = TABLES) -> DataFrame:
    """Latest well-formed batch id, with its completeness checked afterwards.

    Selection does not require completeness (the newest well-formed id wins);
    ``is_complete`` reports whether it may be loaded.
    """
    status = complete_batches(manifest, tables)
    valid = status.filter(is_valid_batch_id("batch_id"))
    # Fixed-width ids sort chronologically; top-1 keeps one row per task, no join back.
    return valid.orderBy(F.col("batch_id").desc()).limit(1).select("batch_id", "table_count", "is_complete")


def align_to_table(df: DataFrame, table_schema: StructType) -> DataFrame:
    """Match an arriving file to the RAW table by case-insensitive column name.

    Table columns missing from the file become NULL; file columns unknown to
    the table are not loaded; types are cast to the table's (the table schema
    is fixed at first load and never evolves).
    """
    by_upper = {c.upper(): c for c in df.columns}
    cols = []
    for f in table_schema.fields:
        src = by_upper.get(f.name.upper())
        cols.append((F.col(src) if src is not None else F.lit(None)).cast(f.dataType).alias(f.name))
    return df.select(*cols)


LEDGER_SCHEMA = "source string, files array<string>, row_count bigint, run string, batch_id string"


def _beside(raw_path: str, kind: str) -> str:
    """A folder for a RAW table's records, beside the tables and hidden from their readers."""
    root, table = raw_path.rstrip("/").rsplit("/", 1)
    return f"{root}/_{kind}/{table}"


def ledger_path(raw_path: str) -> str:
    """Where a RAW table's ledger lives."""
    return _beside(raw_path, "ledger")


def ledger(spark: SparkSession, raw_path: str, batch_ids: list[str]) -> list:
    """Ledger rows of the given batches: one per committed (batch, source), with the RAW files it added. Partitioned by batch, so only theirs are read."""
    path = ledger_path(raw_path)
    fs, target = _file_system(spark, path)
    if not batch_ids or not fs.exists(target):
        return []
    return spark.read.schema(LEDGER_SCHEMA).json(path).filter(F.col("batch_id").isin(batch_ids)).collect()


def _raw_files(spark: SparkSession, raw_path: str, batch_id: str) -> list[str]:
    fs, folder = _file_system(spark, f"{raw_path}/{BATCH_COL}={batch_id}")
    if not fs.exists(folder):
        return []
    return sorted(st.getPath().getName() for st in fs.listStatus(folder) if st.isFile() and not st.getPath().getName().startswith(("_", ".")))


def append_sources(df: DataFrame, raw_path: str, sources: dict[str, list[str]]) -> int:
    """Append rows to RAW exactly once and record it. ``sources``: per batch id, what its rows come from.

    The rows go to a staging folder that no reader sees. An intent then names the files and the names they will have in RAW (the run's id is part of them), the
    files are moved, and the ledger rows close the run. An append that was interrupted before its intent has left nothing in RAW; one interrupted after it
    is finished by the next append (``finish_interrupted``). Files of RAW that no run wrote are never touched. One writer per table.
    Returns the rows appended.
    """
    spark = df.sparkSession
    finish_interrupted(spark, raw_path)
    if _has_rows(spark, raw_path):
        table_schema = spark.read.parquet(raw_path).schema
        fields = [f for f in table_schema.fields if f.name != BATCH_COL]
        df = align_to_table(df, StructType([*fields, StructField(BATCH_COL, StringType())]))
    run = uuid.uuid4().hex
    obs = Observation(f"appended_{run}")
    observed = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    staging = f"{_beside(raw_path, 'staging')}/{run}"
    observed.write.partitionBy(BATCH_COL).option("compression", "zstd").parquet(staging)
    rows = int(obs.get["rows"])
    entries = [(s, _raw_files(spark, staging, b) if i == 0 else [], rows if i == 0 else 0, run, b)
               for b, names in sorted(sources.items()) for i, s in enumerate(sorted(names))]
    spark.createDataFrame(entries, LEDGER_SCHEMA).coalesce(1).write.json(f"{_beside(raw_path, 'intents')}/{run}")
    _close_run(spark, raw_path, run, entries)
    return rows


def _close_run(spark: SparkSession, raw_path: str, run: str, entries: list[tuple]) -> None:
    """Move a run's staged files into RAW, then write its ledger rows, then drop its intent; may be repeated at any point."""
    staging, intent = f"{_beside(raw_path, 'staging')}/{run}", f"{_beside(raw_path, 'intents')}/{run}"
    for _, files, _, _, batch_id in entries:
        for name in files:
            fs, staged = _file_system(spark, f"{staging}/{BATCH_COL}={batch_id}/{name}")
            _, target = _file_system(spark, f"{raw_path}/{BATCH_COL}={batch_id}/{run}-{name}")
            fs.mkdirs(target.getParent())
            if not fs.exists(target) and not fs.rename(staged, target):
                raise RuntimeError(f"could not move {staged} into RAW")
    named = [(s, [f"{run}-{f}" for f in files], n, r, b) for s, files, n, r, b in entries]
    spark.createDataFrame(named, LEDGER_SCHEMA).coalesce(1).write.mode("append").partitionBy("batch_id").json(ledger_path(raw_path))
    for folder in (intent, staging):
        fs, path = _file_system(spark, folder)
        fs.delete(path, True)


def finish_interrupted(spark: SparkSession, raw_path: str) -> int:
    """Finish the appends that stopped between their intent and its removal; returns how many."""
    fs, folder = _file_system(spark, _beside(raw_path, "intents"))
    runs = [st.getPath().getName() for st in fs.listStatus(folder)] if fs.exists(folder) else []
    runs = [r for r in runs if fs.exists(_file_system(spark, f"{folder}/{r}/_SUCCESS")[1])]  # an unfinished intent names nothing
    for run in runs:
        entries = [tuple(r) for r in spark.read.schema(LEDGER_SCHEMA).json(f"{folder}/{run}").collect()]
        done = {r["run"] for r in ledger(spark, raw_path, sorted({e[4] for e in entries}))}
        if run in done:
            fs.delete(_file_system(spark, f"{folder}/{run}")[1], True)
        else:
            _close_run(spark, raw_path, run, entries)
    return len(runs)


def content_digests(df: DataFrame, batch_col: str) -> dict[str, str]:
    """Per batch a digest of its rows that knows neither row order nor the order and case of column names."""
    by_upper = {c.upper(): c for c in df.columns}
    texts = [F.coalesce(F.col(by_upper[c]).cast("string"), F.lit("\0")) for c in sorted(by_upper)]
    hashed = df.select(F.col(batch_col).alias("b"), *[F.xxhash64(F.lit(seed), F.lit(",".join(sorted(by_upper))), *texts).alias(f"h{seed}") for seed in (1, 2)])
    # exact sums in longs, by parts of 16 bits (room for 2^47 rows); put together below, once per batch
    part = lambda seed, k: F.shiftright(f"h{seed}", 16 * k) if k == 3 else F.shiftright(f"h{seed}", 16 * k).bitwiseAND(0xFFFF)
    sums = [F.sum(part(seed, k)).alias(f"h{seed}_{k}") for seed in (1, 2) for k in range(4)]
    rows = hashed.groupBy("b").agg(F.count(F.lit(1)).alias("n"), *sums).collect()  # one row per batch
    total = lambda r, seed: sum(r[f"h{seed}_{k}"] << (16 * k) for k in range(4))
    return {r["b"]: f"content:{r['n']}:{total(r, 1)}:{total(r, 2)}" for r in rows}


def _has_rows(spark: SparkSession, raw_path: str) -> bool:
    """Whether the RAW table has been created (some batch partition holds a file)."""
    fs, target = _file_system(spark, raw_path)
    prefix = f"{BATCH_COL}="
    return bool(fs.exists(target)) and any(
        st.isDirectory() and st.getPath().getName().startswith(prefix)
        and any(f.isFile() for f in fs.listStatus(st.getPath())) for st in fs.listStatus(target))


def append_new_batches(spark: SparkSession, df: DataFrame, raw_root: str, table: str, source: str | None = None) -> int:
    """Idempotent append of a stamped extract: the first load creates the table
    from the arriving schema; later loads are aligned by name to that fixed schema.

    Without a ``source`` the rows' content names it: the same rows of a batch again are skipped, other rows of a landed batch
    are appended. With one, a (batch, ``source``) pair the ledger holds is skipped. Returns the rows appended.
    """
    path = f"{raw_root}/{table}"
    batch_col = {c.upper(): c for c in df.columns}[BATCH_COL]
    if source is None:
        named = content_digests(df, batch_col)
    else:
        named = {r[0]: source for r in df.select(batch_col).distinct().collect()}  # one value per batch
    finish_interrupted(spark, path)
    done = {(r["batch_id"], r["source"]) for r in ledger(spark, path, sorted(named))}
    new = {b: [s] for b, s in named.items() if (b, s) not in done}
    if not new:
        return 0
    return append_sources(df.filter(F.col(batch_col).isin(sorted(new))), path, new)


def assert_loadable(status: DataFrame, batch_id: str) -> None:
    """Refuse to load a batch that is malformed, unknown, incomplete, has
    unknown tables or is empty (one status row comes to the driver)."""
    require_batch_id(batch_id)
    row = status.filter(F.col("batch_id") == batch_id).first()
    if row is None:
        raise ValueError(f"nothing has landed under {batch_id}")
    if row["unknown_tables"]:
        raise ValueError(f"{batch_id} holds {row['unknown_tables']} tables that are not expected")
    if not row["is_complete"]:
        raise ValueError(f"{batch_id} is incomplete: a table is absent or empty")
