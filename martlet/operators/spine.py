"""Day axis with running and period-over-period totals, by a prefix sum in two levels.

Every key has one row for each day from its first to its last, days without data included. Totals run within calendar months first, and the
months' totals are then brought forward, so no window holds more than a month of days of one key or the months of one key, whatever the data: both
are bounded by the calendar. A period earlier is not looked up but sent ahead: each day's totals also count for the day one period later,
so current and earlier totals meet in one grouping.

Defined cases: rows of one key and day are added up; a null key is a key like any other; rows without a day are one row per key after the axis, with
their totals and no running figures; a null measure counts as 0; no rows give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType, FractionalType, LongType

from martlet.session import work_dir

PERIOD_DAYS = 7
FIGURES = ("running", "month_to_date", "previous", "change")


def _total_type(kind: DataType) -> str:
    if isinstance(kind, DecimalType):
        return f"decimal(38,{kind.scale})"
    return "double" if isinstance(kind, FractionalType) else LongType().simpleString()


def day_axis(daily: DataFrame, keys: list[str], day: str) -> DataFrame:
    """(keys, day, first_day): each key's days from its first to its last."""
    ends = daily.filter(F.col(day).isNotNull()).groupBy(*keys).agg(F.min(day).alias("first_day"), F.max(day).alias("last_day"))
    return ends.select(*keys, F.explode(F.sequence("first_day", "last_day", F.expr("INTERVAL 1 DAY"))).alias(day), "first_day")


def running_totals(rows: DataFrame, keys: list[str], day: str, measures: list[str], period_days: int = PERIOD_DAYS) -> DataFrame:
    """(keys, day, row_count, and of each measure m: m, running_m, month_to_date_m, previous_m, change_m) on each key's day axis.

    ``previous`` is the total ``period_days`` earlier, null where that day is before the key's first.
    """
    if not keys or period_days < 1:
        raise ValueError("at least one key and a period of at least one day are needed")
    total = {m: _total_type(rows.schema[m].dataType) for m in measures}
    as_total = lambda c, m: F.coalesce(c, F.lit(0)).cast(total[m])
    summed = rows.groupBy(*keys, day).agg(F.count(F.lit(1)).alias("row_count"), *[as_total(F.sum(m), m).alias(m) for m in measures])
    path = work_dir(rows.sparkSession, "spine")
    summed.write.parquet(path)  # read three times below; one row per key and day
    summed = rows.sparkSession.read.schema(summed.schema).parquet(path)
    dated = summed.filter(F.col(day).isNotNull())
    axis = day_axis(dated, keys, day)

    def entries(part: DataFrame, at: Column, now: bool, earlier: bool, first: Column) -> DataFrame:
        given = lambda m, use: as_total(F.col(m) if use else F.lit(0), m)
        return part.select(*keys, at.alias(day), first.alias("first_day"), (F.col("row_count") if now else F.lit(0)).cast("bigint").alias("row_count"),
                           *[given(m, now).alias(m) for m in measures], *[given(m, earlier).alias(f"previous_{m}") for m in measures])

    none = F.lit(None).cast(dated.schema[day].dataType)
    current = entries(axis, F.col(day), False, False, F.col("first_day")).unionByName(entries(dated, F.col(day), True, False, none))
    ahead = entries(dated, F.date_add(day, period_days), False, True, none)
    sums = [F.sum("row_count").alias("row_count"), *[as_total(F.sum(c), m).alias(c) for m in measures for c in (m, f"previous_{m}")]]
    month = F.trunc(day, "MM").alias("in_month")
    filled = (current.unionByName(ahead).groupBy(*keys, day).agg(F.max("first_day").alias("first_day"), *sums)
              .filter(F.col("first_day").isNotNull()).select("*", month))

    within = Window.partitionBy(*keys, "in_month").orderBy(day).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    scanned = filled.select("*", *[as_total(F.sum(m).over(within), m).alias(f"month_to_date_{m}") for m in measures])
    months = current.select("*", month).groupBy(*keys, "in_month").agg(*[as_total(F.sum(m), m).alias(m) for m in measures])
    before = Window.partitionBy(*keys).orderBy("in_month").rowsBetween(Window.unboundedPreceding, -1)
    forward = months.select(*[F.col(k).alias(f"of_{k}") for k in keys], F.col("in_month").alias("of_month"),
                            *[as_total(F.sum(m).over(before), m).alias(f"forward_{m}") for m in measures])
    same = F.col("in_month") == F.col("of_month")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"of_{k}"))

    known = F.date_sub(day, period_days) >= F.col("first_day")
    out = [*keys, day, "row_count"]
    figures = []
    for m in measures:
        figures += [m, (F.col(f"forward_{m}") + F.col(f"month_to_date_{m}")).cast(total[m]).alias(f"running_{m}"), f"month_to_date_{m}",
                    F.when(known, F.col(f"previous_{m}")).alias(f"previous_{m}"),
                    F.when(known, F.col(m) - F.col(f"previous_{m}")).cast(total[m]).alias(f"change_{m}")]
    found = scanned.join(forward, same).select(*out, *figures)
    undated = summed.filter(F.col(day).isNull())
    blank = [F.lit(None).cast(total[m]).alias(f"{figure}_{m}") for m in measures for figure in FIGURES]
    return found.unionByName(undated.select(*out, *measures, *blank))
