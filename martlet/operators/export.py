"""Export of the daily mart with guards, verification and a content fingerprint."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlet.functions.fingerprint import table_fingerprint


def export_mart(mart: DataFrame, out_dir: str) -> dict:
    """Write the mart ordered by date as Parquet and JSON.

    Guards (one aggregate, one row to the driver): the mart is non-empty and
    holds exactly one batch. Returns the export paths and the row count.
    """
    g = mart.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("source_batch_id").alias("batches")).first()
    if g["n"] == 0:
        raise RuntimeError("nothing to export: the mart has no rows (empty)")
    if g["batches"] != 1:
        raise RuntimeError(f"the mart must hold a single batch; it holds {g['batches']}")
    ordered = mart.orderBy("order_date")
    ordered.write.mode("errorifexists").option("compression", "snappy").parquet(f"{out_dir}/parquet")
    ordered.write.mode("errorifexists").json(f"{out_dir}/json")
    return {"parquet": f"{out_dir}/parquet", "json": f"{out_dir}/json", "rows": int(g["n"])}


def verify_export(spark: SparkSession, mart: DataFrame, paths: dict) -> DataFrame:
    """One row: ``(count, sum(item_count), sum(order_count))`` of the table and of
    both exported copies, plus whether all three agree.

    The three inputs are tagged and unioned, so every total comes out of a
    single aggregate (no join between the one-row totals).
    """
    cols = ["item_count", "order_count"]
    tagged = (mart.select(F.lit("table").alias("copy"), *cols)
              .unionByName(spark.read.parquet(paths["parquet"]).select(F.lit("parquet").alias("copy"), *cols))
              .unionByName(spark.read.schema(mart.schema).json(paths["json"])
                           .select(F.lit("json").alias("copy"), *cols)))
    aggs = []
    for copy in ("table", "parquet", "json"):
        is_copy = F.col("copy") == copy
        aggs += [F.count_if(is_copy).alias(f"{copy}_rows"),
                 F.sum(F.when(is_copy, F.col("item_count"))).cast("bigint").alias(f"{copy}_item_count"),
                 F.sum(F.when(is_copy, F.col("order_count"))).cast("bigint").alias(f"{copy}_order_count")]
    totals = tagged.agg(*aggs)
    same = F.lit(True)
    for copy in ("parquet", "json"):
        for m in ("rows", "item_count", "order_count"):
            same = same & F.col(f"{copy}_{m}").eqNullSafe(F.col(f"table_{m}"))
    return totals.select("*", same.alias("matches_table"))


def fingerprint_export(spark: SparkSession, mart: DataFrame, paths: dict) -> DataFrame:
    """Order-insensitive SHA-256 fingerprint of the table and of both exported copies."""
    cols = mart.columns
    copies = {"table": mart, "parquet": spark.read.parquet(paths["parquet"]),
              "json": spark.read.schema(mart.schema).json(paths["json"])}
    parts = [table_fingerprint(df.select(*cols), cols).select(F.lit(name).alias("copy"), "*") for name, df in copies.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def export_and_record(spark: SparkSession, mart: DataFrame, out_dir: str) -> dict:
    """Export, verify totals and fingerprints of both copies, and write ``out_dir/record``.

    A copy that differs from the table is an error, and no record is written for it.
    """
    paths = export_mart(mart, out_dir)
    totals = verify_export(spark, mart, paths).first()
    prints = {r["copy"]: (r["row_count"], r["fingerprint"]) for r in fingerprint_export(spark, mart, paths).collect()}
    if not totals["matches_table"] or len(set(prints.values())) != 1:
        raise RuntimeError(f"{out_dir}: the exported copies differ from the table: {totals.asDict()}, {prints}")
    record = [(c, paths.get(c), int(n), str(f)) for c, (n, f) in sorted(prints.items())]
    (spark.createDataFrame(record, "copy string, path string, row_count bigint, fingerprint string").coalesce(1)
     .write.mode("errorifexists").json(f"{out_dir}/record"))
    return paths | {"record": f"{out_dir}/record"}
