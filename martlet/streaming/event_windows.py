"""Event-time windows over landed files, with a watermark, and an exact account of what came too late.

One ``availableNow`` pass reads the files that came since the last, adds their rows to the open windows kept in the state store, and writes every window that the watermark
(greatest instant seen, less ``delay``) has passed, once. A window's state is one row per key and goes when the window closes, so state is bounded by open windows and
keys. Rows are added up per task before the exchange, so a key with a third of all rows sends one row per window and task. Closed windows are never rewritten, and the file sink's log
lists each pass's files once: a pass that was interrupted anywhere is repeated with the same files and nothing is written twice. The number of shuffle partitions is fixed
by the first pass of a checkpoint.

Rows of a closed window are left out by the watermark; Spark counts them only after they are added up. ``late_rows`` finds them from the delivered rows: what a closed
window should hold less what it was written with. So closed windows and late rows together are all delivered rows of the time up to the watermark.

Defined cases: a row belongs to the window whose start it is at or after and whose end it is before; a window is closed when its end is at or before the watermark; a null key is
a key like any other; rows without an instant are in no window, move no watermark and are no late rows; repeated rows count each; without rows there is no watermark and no
window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

COUNT = "event_count"


def _windows(rows: DataFrame, instant: str, keys: list[str], width: str, measures: dict[str, Column]) -> DataFrame:
    grouped = rows.groupBy(F.window(instant, width).alias("w"), *keys).agg(F.count(F.lit(1)).alias(COUNT), *[c.alias(n) for n, c in measures.items()])
    return grouped.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *keys, COUNT, *measures)


def run_pass(spark: SparkSession, source: str, schema: StructType, out: str, checkpoint: str, *, instant: str, keys: list[str], width: str, delay: str,
             measures: dict[str, Column] | None = None, files_per_batch: int | None = None) -> dict[str, int]:
    """Take in the files under ``source/*`` that came since the last pass and write the windows that are closed by now.

    Returns rows read and windows written by this pass. ``files_per_batch`` bounds a micro-batch; the watermark then moves between micro-batches, so it decides with the order of
    files which rows are late.
    """
    reader = spark.readStream.schema(schema).option("maxFileAge", "36500d")
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    rows = reader.parquet(f"{source}/*").withWatermark(instant, delay)
    before = _written_count(spark, out)
    query = (_windows(rows, instant, keys, width, measures or {}).writeStream.format("parquet").outputMode("append").option("path", out)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    try:
        query.awaitTermination()
        read = sum(int(p["numInputRows"]) for p in query.recentProgress)
    finally:  # an interrupted caller must not leave the stream running
        if query.isActive:
            query.stop()
    return {"rows_read": read, "windows_written": _written_count(spark, out) - before}


def _written_count(spark: SparkSession, out: str) -> int:
    """Rows of the sink; answered from the files' footers."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{out}/_spark_metadata")
    if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        return 0
    return spark.read.schema("window_start timestamp").parquet(out).agg(F.count(F.lit(1))).first()[0]


def closed_windows(spark: SparkSession, out: str, schema: StructType, *, instant: str, keys: list[str], width: str, measures: dict[str, Column] | None = None) -> DataFrame:
    """The windows written so far; none before the first pass that closes one. ``schema`` is that of the delivered rows."""
    shape = _windows(spark.createDataFrame([], schema), instant, keys, width, measures or {}).schema
    return spark.read.schema(shape).parquet(out)


def late_rows(delivered: DataFrame, closed: DataFrame, *, instant: str, keys: list[str], width: str, delay: str, since: str | None = None) -> DataFrame:
    """(window, keys, event_count, closed_count, late_count) of each closed window and key that rows came too late for.

    ``event_count`` counts all delivered rows, ``closed_count`` those the window was written with (0 where it never had any in time). ``delivered`` must be the rows
    that the passes have read. ``since`` leaves out windows that begin before an instant, to keep a regular run to the time that late rows can still concern.
    """
    # the watermark is one number, read by an aggregate over the delivered rows
    micros = delivered.agg(F.unix_micros(F.max(instant) - F.expr(f"INTERVAL {delay}"))).first()[0]
    mark = F.timestamp_micros(F.lit(micros).cast("bigint"))
    rows, known = delivered, closed.select("window_start", *keys, F.col(COUNT).alias("n"))
    if since is not None:
        rows, known = rows.filter(F.col(instant) >= F.lit(since).cast("timestamp")), known.filter(F.col("window_start") >= F.lit(since).cast("timestamp"))
    over = _windows(rows, instant, keys, width, {}).filter(F.col("window_end") <= mark)
    # both sides are one row per window and key, so they meet in a grouping, null keys included
    met = (over.select("window_start", "window_end", *keys, F.col(COUNT).alias("n"), F.lit(0).cast("bigint").alias("c"))
           .unionByName(known.select("window_start", F.lit(None).cast("timestamp").alias("window_end"), *keys, F.lit(0).cast("bigint").alias("n"), F.col("n").alias("c"))))
    both = met.groupBy("window_start", *keys).agg(F.max("window_end").alias("window_end"), F.sum("n").alias(COUNT), F.sum("c").alias("closed_count"))
    late = F.col(COUNT) - F.col("closed_count")
    return both.filter(late > 0).select("window_start", "window_end", *keys, COUNT, "closed_count", late.alias("late_count"))
