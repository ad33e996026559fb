"""Batch profile of the RAW layer for one batch, as tidy DataFrames.

Per table one generated aggregate computes, in a single scan: the row count,
the distinct and null key counts, the null count of every column, min/max of
every timestamp/date column and the count of business timestamps later than
``_EXTRACTED_AT``. Orphans over the nine referential edges reuse the fused
relationship check (one scan and one anti join per child table), two joins
check business consistency, and a gate lists the tables that fail.
"""

from __future__ import annotations

from collections import defaultdict
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, TimestampNTZType, TimestampType

from martlet.config import BATCH_COL, CATEGORY_COLUMNS, EXTRACTED_COL, RAW_KEYS, RAW_RELATIONSHIPS, TABLES
from martlet.functions.batch_ids import require_batch_id
from martlet.operators.checks import relationships_fused
from martlet.session import assert_utc


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _batch(raw: DataFrame, batch_id: str) -> DataFrame:
    return raw.filter(F.col(BATCH_COL) == F.lit(batch_id))


def temporal_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, (TimestampType, TimestampNTZType, DateType))]


def _ntz(c):
    return c.cast("timestamp_ntz")


def _col_for(df: DataFrame, name: str) -> str:
    for c in df.columns:
        if c.upper() == name.upper():
            return c
    raise KeyError(name)


def key_profile(table: str, raw: DataFrame, batch_id: str) -> DataFrame:
    """``(table_name, key_column, row_count, distinct_keys, null_keys, duplicate_key_rows)``."""
    key = _col_for(raw, RAW_KEYS[table])
    agg = _batch(raw, batch_id).agg(F.count(F.lit(1)).alias("row_count"),
                                    F.count_distinct(key).alias("distinct_keys"),
                                    F.count_if(F.col(key).isNull()).alias("null_keys"))
    return agg.select(F.lit(table).alias("table_name"), F.lit(RAW_KEYS[table]).alias("key_column"),
                      "row_count", "distinct_keys", "null_keys",
                      (F.col("row_count") - F.col("null_keys") - F.col("distinct_keys")).alias("duplicate_key_rows"))


def null_counts(table: str, raw: DataFrame, batch_id: str) -> DataFrame:
    """``(table_name, column_name, null_count)`` for every column, one scan."""
    cols = [c for c in raw.columns]
    agg = _batch(raw, batch_id).agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return (agg.unpivot([], cols, "column_name", "null_count")
            .select(F.lit(table).alias("table_name"), "column_name", "null_count"))


def date_ranges(table: str, raw: DataFrame, batch_id: str) -> DataFrame:
    """``(table_name, column_name, min_value, max_value)`` per temporal column (UTC NTZ)."""
    cols = temporal_columns(raw)
    agg = _batch(raw, batch_id).agg(*[F.struct(_ntz(F.min(c)).alias("lo"), _ntz(F.max(c)).alias("hi")).alias(c)
                                      for c in cols])
    return (agg.unpivot([], cols, "column_name", "r")
            .select(F.lit(table).alias("table_name"), "column_name",
                    F.col("r.lo").alias("min_value"), F.col("r.hi").alias("max_value")))


def future_timestamps(table: str, raw: DataFrame, batch_id: str) -> DataFrame:
    """``(table_name, column_name, rows_after_extract)`` for business timestamps."""
    cols = [c for c in temporal_columns(raw) if not c.startswith("_")]
    if not cols:
        return None
    agg = _batch(raw, batch_id).agg(*[F.count_if(F.col(c) > F.col(EXTRACTED_COL)).alias(c) for c in cols])
    return (agg.unpivot([], cols, "column_name", "rows_after_extract")
            .select(F.lit(table).alias("table_name"), "column_name", "rows_after_extract"))


def category_counts(table: str, raw: DataFrame, batch_id: str) -> DataFrame | None:
    """``(table_name, column_name, value, row_count)`` for STATUS / EVENT_TYPE, original case."""
    parts = []
    upper = {c.upper(): c for c in raw.columns}
    for cat in CATEGORY_COLUMNS:
        if cat in upper:
            counts = _batch(raw, batch_id).groupBy(F.col(upper[cat]).alias("value")).agg(
                F.count(F.lit(1)).alias("row_count"))
            parts.append(counts.select(F.lit(table).alias("table_name"), F.lit(cat).alias("column_name"),
                                       "value", "row_count"))
    return _union(parts) if parts else None


def orphans(raw: dict[str, DataFrame], batch_id: str) -> DataFrame:
    """Nine rows ``(child_table, foreign_key, parent_table, parent_key, orphan_rows)``.

    NULL foreign keys are excluded. Edges are fused per child table: the child
    is scanned once and reduced to ``(fk, value, n)`` before one anti join
    against its parents' keys, so a hot key is one row, not a third of the
    table. The edge list is the left side, so edges without orphans report 0.
    """
    by_child: dict[str, dict] = defaultdict(dict)
    for child, fk, parent, pk in RAW_RELATIONSHIPS:
        by_child[child][fk] = (parent, _batch(raw[parent], batch_id), pk)
    detail = _union([relationships_fused(child, _batch(raw[child], batch_id), rels)
                     for child, rels in by_child.items()])
    counts = detail.groupBy(F.col("model").alias("child_table"), F.col("column_name").alias("foreign_key")).agg(
        F.sum("n_records").alias("n"))
    spark = next(iter(raw.values())).sparkSession
    edges = spark.createDataFrame(list(RAW_RELATIONSHIPS),
                                  "child_table string, foreign_key string, parent_table string, parent_key string")
    return edges.join(counts, ["child_table", "foreign_key"], "left").select(
        "child_table", "foreign_key", "parent_table", "parent_key",
        F.coalesce(F.col("n"), F.lit(0)).cast("bigint").alias("orphan_rows"))


def user_mismatches(raw_items: DataFrame, raw_orders: DataFrame, batch_id: str) -> DataFrame:
    """Item rows whose buyer differs from the parent order's (inner join, ``<>``).

    Items are first counted per (order, buyer), so an order with many items
    is one row on the join's probe side.
    """
    items = (_batch(raw_items, batch_id).groupBy(F.col("ORDER_ID").alias("oid"), F.col("USER_ID").alias("iu"))
             .agg(F.count(F.lit(1)).alias("n")))
    orders = _batch(raw_orders, batch_id).select(F.col("ORDER_ID").alias("oid"), F.col("USER_ID").alias("ou"))
    j = items.join(orders, "oid", "inner").filter(F.col("iu") != F.col("ou"))
    return j.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("order_item_user_mismatches"))


def item_count_mismatches(raw_items: DataFrame, raw_orders: DataFrame, batch_id: str) -> DataFrame:
    """Orders whose declared ``NUM_OF_ITEM`` <> actual count (a NULL declaration is not counted)."""
    n = _batch(raw_items, batch_id).groupBy(F.col("ORDER_ID").alias("oid")).agg(F.count(F.lit(1)).alias("n"))
    o = _batch(raw_orders, batch_id).select(F.col("ORDER_ID").alias("oid"), F.col("NUM_OF_ITEM").alias("declared"))
    j = o.join(n, "oid", "left")
    return j.agg(F.count_if(F.col("declared") != F.coalesce(F.col("n"), F.lit(0))).alias("order_item_count_mismatches"))


def table_summary(raw: dict[str, DataFrame], sources: dict[str, DataFrame], batch_id: str) -> DataFrame:
    """Per table: source rows vs RAW rows, key nulls and duplicates.

    ``sources`` are the landed extracts (what the batch files hold); their
    counts are compared with the RAW batch partition.
    """
    parts = []
    for table in sorted(raw):
        key = _col_for(raw[table], RAW_KEYS[table])
        in_raw = F.col("in_raw")
        tagged = (_batch(raw[table], batch_id).select(F.col(key).alias("k"), F.lit(True).alias("in_raw"))
                  .unionByName(sources[table].select(F.lit(None).cast(raw[table].schema[key].dataType).alias("k"),
                                                     F.lit(False).alias("in_raw"))))
        agg = tagged.agg(F.count_if(~in_raw).alias("source_rows"),
                         F.count_if(in_raw).alias("raw_rows"),
                         F.count_distinct(F.when(in_raw, F.col("k"))).alias("distinct_keys"),
                         F.count_if(in_raw & F.col("k").isNull()).alias("null_keys"))
        parts.append(agg.select(
            F.lit(table).alias("table_name"), "source_rows", "raw_rows", "null_keys",
            (F.col("raw_rows") - F.col("null_keys") - F.col("distinct_keys")).alias("duplicate_key_rows"),
            (F.col("source_rows") == F.col("raw_rows")).alias("row_count_match")))
    return _union(parts)


def gate(summary: DataFrame) -> DataFrame:
    """Tables that fail the batch gate: no rows, counts differ, null keys or duplicate keys."""
    failed = (F.col("raw_rows") == 0) | (~F.col("row_count_match")) | (F.col("null_keys") > 0) | (F.col("duplicate_key_rows") > 0)
    return summary.filter(failed)


def schema_listing(table: str, raw: DataFrame) -> list[tuple[str, str, str]]:
    """``(table_name, column_name, data_type)`` per column (metadata, no scan)."""
    return [(table, f.name, f.dataType.simpleString()) for f in raw.schema.fields]


def table_profile(table: str, raw: DataFrame, source: DataFrame, batch_id: str) -> DataFrame:
    """The whole per-table profile from ONE aggregate, in long form.

    ``(table_name, column_name, metric, value)`` with metrics ``source_rows``,
    ``raw_rows``, ``distinct_keys``, ``null_keys``, ``duplicate_key_rows``,
    ``row_count_match`` (table level), ``data_type`` and ``null_count`` (every
    column), ``min``/``max`` (temporal columns, UTC) and ``rows_after_extract``
    (business timestamps).
    Values are text so that one column holds every metric.
    """
    key = _col_for(raw, RAW_KEYS[table])
    cols = raw.columns
    temporal = temporal_columns(raw)
    business = [c for c in temporal if not c.startswith("_")]
    in_raw = F.col("__in_raw")
    tagged = (_batch(raw, batch_id).select(*cols, F.lit(True).alias("__in_raw"))
              .unionByName(source.select(F.lit(False).alias("__in_raw")), allowMissingColumns=True))
    aggs = [F.count_if(~in_raw).alias("source_rows"), F.count_if(in_raw).alias("raw_rows"),
            F.count_distinct(F.when(in_raw, F.col(key))).alias("distinct_keys")]
    aggs += [F.count_if(in_raw & F.col(c).isNull()).alias(f"null_count|{c}") for c in cols]
    aggs += [F.min(F.when(in_raw, F.col(c))).alias(f"min|{c}") for c in temporal]
    aggs += [F.max(F.when(in_raw, F.col(c))).alias(f"max|{c}") for c in temporal]
    aggs += [F.count_if(in_raw & (F.col(c) > F.col(EXTRACTED_COL))).alias(f"rows_after_extract|{c}")
             for c in business]
    wide = tagged.agg(*aggs)

    def text(c):
        dt = wide.schema[c].dataType
        v = F.col(f"`{c}`")
        return (v.cast("timestamp_ntz") if isinstance(dt, TimestampType) else v).cast("string")

    null_key = F.col(f"`null_count|{key}`")
    table_level = [("source_rows", F.col("source_rows")), ("raw_rows", F.col("raw_rows")),
                   ("distinct_keys", F.col("distinct_keys")), ("null_keys", null_key),
                   ("duplicate_key_rows", F.col("raw_rows") - null_key - F.col("distinct_keys")),
                   ("row_count_match", F.col("source_rows") == F.col("raw_rows"))]
    entries = [F.struct(F.lit(None).cast("string").alias("column_name"), F.lit(m).alias("metric"),
                        v.cast("string").alias("value")) for m, v in table_level]
    entries += [F.struct(F.lit(column).alias("column_name"), F.lit("data_type").alias("metric"),
                         F.lit(dtype).alias("value")) for _t, column, dtype in schema_listing(table, raw)]
    for c in wide.columns[3:]:
        metric, column = c.split("|", 1)
        entries.append(F.struct(F.lit(column).alias("column_name"), F.lit(metric).alias("metric"),
                                text(c).alias("value")))
    return wide.select(F.lit(table).alias("table_name"), F.inline(F.array(*entries)))


def run_profile(raw: dict[str, DataFrame], sources: dict[str, DataFrame], batch_id: str, out_root: str,
                fail_on_gate: bool = True) -> dict[str, str]:
    """Profile one batch and write every part as a table under ``out_root``.

    Tables: ``table_profile`` (long form, one aggregate per table),
    ``category_counts``, ``orphans``, ``business_checks`` and ``gate``. Then the
    gate is read back (one row per failing table) and, when ``fail_on_gate``,
    a batch with an empty table, count mismatches, NULL keys or duplicate keys is refused.
    A malformed batch id, missing or unknown tables, or a session that is not in UTC is refused first.
    """
    require_batch_id(batch_id)
    spark = next(iter(raw.values())).sparkSession
    assert_utc(spark)
    if set(raw) != set(TABLES) or set(sources) != set(TABLES):
        raise ValueError(f"a profile needs exactly the tables {', '.join(TABLES)}")
    tables = sorted(raw)
    cats = [category_counts(t, raw[t], batch_id) for t in tables]
    parts = {
        "table_profile": _union([table_profile(t, raw[t], sources[t], batch_id) for t in tables]),
        "category_counts": _union([c for c in cats if c is not None]),
        "orphans": orphans(raw, batch_id),
        "business_checks": _union([
            user_mismatches(raw["order_items"], raw["orders"], batch_id)
            .select(F.lit("order_item_user_mismatches").alias("check_name"),
                    F.col("order_item_user_mismatches").alias("failures")),
            item_count_mismatches(raw["order_items"], raw["orders"], batch_id)
            .select(F.lit("order_item_count_mismatches").alias("check_name"),
                    F.col("order_item_count_mismatches").alias("failures"))]),
        "gate": gate(table_summary(raw, sources, batch_id)),
    }
    paths = {}
    for name, df in parts.items():
        paths[name] = f"{out_root}/{name}"
        df.write.mode("overwrite").parquet(paths[name])
    failing = [r["table_name"] for r in raw[tables[0]].sparkSession.read.parquet(paths["gate"])
               .select("table_name").collect()]
    if fail_on_gate and failing:
        raise RuntimeError(f"batch {batch_id} is refused; empty, miscounted or badly keyed tables: {sorted(failing)}")
    return paths
