"""Generic data checks, fused per model.

A check returns the violations as a DataFrame; zero rows means pass.

* ``not_null``: all declared columns of a model are counted in ONE aggregate
  scan (``count_if(col IS NULL)`` per column), then unpivoted to long form.
* ``unique``: non-null values occurring more than once, with their count.
  ``groupBy(col).count()`` aggregates map-side first, so a hot key
  costs one partial count per task, not one task holding all its rows.
* ``relationships``: non-null child values without a parent. The child is
  first reduced to ``(value, n_rows)`` and only distinct values meet the
  parent in the anti join, so a hot foreign key cannot skew the join.
* ``accepted_values``: values outside the list, with their count (NULL passes).
* ``batch_row_count``: the selected batch's RAW count must be non-zero and equal
  the staged count. Both counts come from one union + aggregate; a suite of
  them is one tagged union with a single grouped count.

Suites fuse further: per model, all declared ``unique`` / ``relationships`` /
``accepted_values`` columns are read in one scan as ``(column_name, value)``
pairs and checked with one grouped aggregate (and one anti join against the
tagged union of the parents' keys). ``check_summary`` goes further and counts every test of every model in one grouping.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegralType, StringType, TimestampNTZType, TimestampType

from martlet.config import BATCH_COL, DECLARED_TESTS


def union_all(parts: list[DataFrame]) -> DataFrame:
    """``UNION ALL`` by column name of one or more DataFrames."""
    return reduce(DataFrame.unionByName, parts)


def not_null(model: str, df: DataFrame, columns: list[str]) -> DataFrame:
    """``(model, column_name, failures)`` for every column, from one scan."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return (counts.unpivot([], columns, "column_name", "failures")
            .select(F.lit(model).alias("model"), "column_name", "failures"))


def unique(model: str, df: DataFrame, column: str) -> DataFrame:
    """``(model, column_name, value, n_records)`` per duplicated non-null value."""
    c = F.col(column)
    dup = (df.select(c.alias("v")).filter(F.col("v").isNotNull())
           .groupBy("v").agg(F.count(F.lit(1)).alias("n_records"))
           .filter(F.col("n_records") > 1))
    return dup.select(F.lit(model).alias("model"), F.lit(column).alias("column_name"),
                      F.col("v").cast("string").alias("value"), "n_records")


def relationships(model: str, df: DataFrame, column: str,
                  parent_model: str, parent: DataFrame, field: str) -> DataFrame:
    """``(model, column_name, parent_model, parent_column, value, n_records)`` per orphan value."""
    child = (df.select(F.col(column).alias("v")).filter(F.col("v").isNotNull())
             .groupBy("v").agg(F.count(F.lit(1)).alias("n_records")))
    keys = parent.select(F.col(field).alias("v"))
    orphans = child.join(keys, "v", "left_anti")
    return orphans.select(F.lit(model).alias("model"), F.lit(column).alias("column_name"),
                          F.lit(parent_model).alias("parent_model"), F.lit(field).alias("parent_column"),
                          F.col("v").cast("string").alias("value"), "n_records")


def accepted_values(model: str, df: DataFrame, column: str, values) -> DataFrame:
    """``(model, column_name, value, n_records)`` per value outside ``values``."""
    counts = df.groupBy(F.col(column).alias("v")).agg(F.count(F.lit(1)).alias("n_records"))
    bad = counts.filter(F.col("v").isNotNull() & ~F.col("v").isin(list(values)))
    return bad.select(F.lit(model).alias("model"), F.lit(column).alias("column_name"),
                      F.col("v").cast("string").alias("value"), "n_records")


def _common_type(df: DataFrame, columns: list[str]):
    types = {df.schema[c].dataType for c in columns}
    return types.pop() if len(types) == 1 else StringType()


def _long(df: DataFrame, columns: list[str]) -> DataFrame:
    """One scan of ``df`` -> ``(column_name, v)`` for several columns (``v`` of a common type)."""
    t = _common_type(df, columns)
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast(t).alias("v")) for c in columns])
    return df.select(F.inline(pairs))


def unique_fused(model: str, df: DataFrame, columns: list[str]) -> DataFrame:
    """``unique`` for several columns of one model: one scan, one grouped aggregate."""
    if len(columns) == 1:
        return unique(model, df, columns[0])
    dup = (_long(df, columns).filter(F.col("v").isNotNull())
           .groupBy("column_name", "v").agg(F.count(F.lit(1)).alias("n_records"))
           .filter(F.col("n_records") > 1))
    return dup.select(F.lit(model).alias("model"), "column_name", F.col("v").cast("string").alias("value"),
                      "n_records")


def relationships_fused(model: str, df: DataFrame, rels: dict[str, tuple[str, DataFrame, str]]) -> DataFrame:
    """``relationships`` for several foreign keys of one model.

    The child is scanned once and reduced to ``(column_name, value, n_rows)``;
    the parents' keys are tagged with the child column they serve and unioned;
    one anti join on ``(column_name, value)`` finds every orphan value.
    """
    cols = list(rels)
    if len(cols) == 1:
        (parent_model, parent, field), = rels.values()
        return relationships(model, df, cols[0], parent_model, parent, field)
    t = _common_type(df, cols)
    child = (_long(df, cols).filter(F.col("v").isNotNull())
             .groupBy("column_name", "v").agg(F.count(F.lit(1)).alias("n_records")))
    keys = union_all([parent.select(F.lit(c).alias("column_name"), F.col(field).cast(t).alias("v"))
                      for c, (_pm, parent, field) in rels.items()])
    names = F.create_map(*[x for c, (pm, _p, f) in rels.items() for x in (F.lit(c), F.array(F.lit(pm), F.lit(f)))])
    orphans = child.join(keys, ["column_name", "v"], "left_anti")
    target = names[F.col("column_name")]
    return orphans.select(F.lit(model).alias("model"), "column_name",
                          target[0].alias("parent_model"), target[1].alias("parent_column"),
                          F.col("v").cast("string").alias("value"), "n_records")


def accepted_values_fused(model: str, df: DataFrame, spec: dict[str, tuple]) -> DataFrame:
    """``accepted_values`` for several columns of one model: one scan, one grouped aggregate."""
    cols = list(spec)
    if len(cols) == 1:
        return accepted_values(model, df, cols[0], spec[cols[0]])
    t = _common_type(df, cols)
    counts = _long(df, cols).groupBy("column_name", "v").agg(F.count(F.lit(1)).alias("n_records"))
    allowed = [(F.col("column_name") == c) & F.col("v").isin([F.lit(v).cast(t) for v in vals])
               for c, vals in spec.items()]
    bad = counts.filter(F.col("v").isNotNull() & ~reduce(lambda a, b: a | b, allowed))
    return bad.select(F.lit(model).alias("model"), "column_name", F.col("v").cast("string").alias("value"),
                      "n_records")


def batch_row_count(model: str, staged: DataFrame, source_table: str, raw: DataFrame,
                    batch_id: str) -> DataFrame:
    """``(model, source_table, batch_id, raw_rows, staged_rows)`` when failing."""
    tagged = (raw.filter(F.col(BATCH_COL) == F.lit(batch_id)).select(F.lit(True).alias("is_raw"))
              .unionByName(staged.select(F.lit(False).alias("is_raw"))))
    counts = tagged.agg(F.count_if(F.col("is_raw")).alias("raw_rows"),
                        F.count_if(~F.col("is_raw")).alias("staged_rows"))
    return (counts.filter((F.col("raw_rows") == 0) | (F.col("raw_rows") != F.col("staged_rows")))
            .select(F.lit(model).alias("model"), F.lit(source_table).alias("source_table"),
                    F.lit(batch_id).alias("batch_id"), "raw_rows", "staged_rows"))


# --- suites over declared tests ----------------------------------------------

def _declared(kind: str, models: dict[str, DataFrame], declared: dict):
    for model, spec in declared.items():
        if model in models and kind in spec:
            yield model, spec[kind]


def not_null_suite(models: dict[str, DataFrame], declared: dict = DECLARED_TESTS) -> DataFrame:
    return union_all([not_null(m, models[m], cols) for m, cols in _declared("not_null", models, declared)])


def _rels(models: dict[str, DataFrame], rels: dict) -> dict:
    return {col: (parent, models[parent], field) for col, (parent, field) in rels.items()}


def unique_suite(models: dict[str, DataFrame], declared: dict = DECLARED_TESTS) -> DataFrame:
    return union_all([unique_fused(m, models[m], cols) for m, cols in _declared("unique", models, declared)])


def relationships_suite(models: dict[str, DataFrame], declared: dict = DECLARED_TESTS) -> DataFrame:
    return union_all([relationships_fused(m, models[m], _rels(models, rels))
                      for m, rels in _declared("relationships", models, declared)])


def accepted_values_suite(models: dict[str, DataFrame], declared: dict = DECLARED_TESTS) -> DataFrame:
    return union_all([accepted_values_fused(m, models[m], spec)
                      for m, spec in _declared("accepted_values", models, declared)])


def row_counts(pairs: list[tuple[str, DataFrame, str, DataFrame]], batch_id: str) -> DataFrame:
    """``(model, source_table, raw_rows, staged_rows)`` for every (model, staged, source, raw).

    All scans are tagged and unioned into ONE grouped count (one tiny shuffle);
    the declared list is the left side, so an empty batch still reports 0.
    """
    spark = pairs[0][1].sparkSession
    tagged = union_all(
        [raw.filter(F.col(BATCH_COL) == F.lit(batch_id)).select(F.lit(m).alias("model"), F.lit(True).alias("is_raw"))
         for m, _staged, _src, raw in pairs]
        + [staged.select(F.lit(m).alias("model"), F.lit(False).alias("is_raw")) for m, staged, _src, _raw in pairs])
    counts = tagged.groupBy("model").agg(F.count_if(F.col("is_raw")).alias("raw_rows"),
                                         F.count_if(~F.col("is_raw")).alias("staged_rows"))
    listed = spark.createDataFrame([(m, src) for m, _s, src, _r in pairs], "model string, source_table string")
    return listed.join(counts, "model", "left").select(
        "model", "source_table", F.coalesce("raw_rows", F.lit(0)).alias("raw_rows"),
        F.coalesce("staged_rows", F.lit(0)).alias("staged_rows"))


def _row_count_failed() -> "F.Column":
    return (F.col("raw_rows") == 0) | (F.col("raw_rows") != F.col("staged_rows"))


def batch_row_count_suite(models: dict[str, DataFrame], raw: dict[str, DataFrame], batch_id: str,
                          declared: dict = DECLARED_TESTS) -> DataFrame:
    pairs = [(m, models[m], src, raw[src]) for m, src in _declared("row_count_source", models, declared)]
    return (row_counts(pairs, batch_id).filter(_row_count_failed())
            .select("model", "source_table", F.lit(batch_id).alias("batch_id"), "raw_rows", "staged_rows"))


# --- the summary: every declared test of every model from one scan per model -----------------------

_BITS = 60  # columns per null mask


def _element(domain: int, slot: int, v=None, s=None):
    null = lambda t: F.lit(None).cast(t)
    return F.struct(F.lit(domain).alias("domain"), F.lit(slot).alias("slot"), (null("bigint") if v is None else v).alias("v"),
                    (null("string") if s is None else s).alias("s"))


def _integral(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, IntegralType)


def _check_key_type(model: str, df: DataFrame, column: str) -> None:
    kind = df.schema[column].dataType
    if not isinstance(kind, (IntegralType, StringType, DateType, TimestampType, TimestampNTZType)):
        raise ValueError(f"{model}.{column}: keys of type {kind.simpleString()} have no one text; use unique() or relationships() for them")


class _Plan:
    """Which elements every model's rows give, and which test reads which figure of which domain.

    A domain is one set of values: a unique or referenced column (slot 0) with the columns that refer to it (slots from 1), the null masks
    of a model (its RAW rows in slot 1), or the unaccepted values of a column.
    """

    def __init__(self, models: dict[str, DataFrame], declared: dict):
        self.elements: dict[str, list] = {m: [] for m in models}
        self.raw: list[tuple[str, int, str]] = []  # model, domain, source table
        self.tests: list[tuple] = []  # test_name, model, column_name, domain, figure, failures without any row
        self.domains, self.width, self.bits = 0, 2, 0
        keys: dict[tuple[str, str], list[tuple[str, str]]] = {}
        for m, columns in _declared("unique", models, declared):
            for c in columns:
                keys.setdefault((m, c), [])
                self.tests.append(("unique", m, c, (m, c), "duplicated", 0))
        for m, spec in _declared("relationships", models, declared):
            for c, parent in spec.items():
                children = keys.setdefault(tuple(parent), [])
                children.append((m, c))
                self.tests.append(("relationships", m, c, tuple(parent), f"orphans_{len(children)}", 0))
        numbers = {}
        for key, children in keys.items():
            members = [key, *children]
            for m, c in members:
                _check_key_type(m, models[m], c)
            whole = all(_integral(models[m], c) for m, c in members)
            numbers[key] = self._next()
            for slot, (m, c) in enumerate(members):
                v = F.col(c).cast("bigint") if whole else None
                self.elements[m].append(_element(numbers[key], slot, v=v, s=None if whole else F.col(c).cast("string")))
            self.width = max(self.width, len(members))
        self.tests = [(t, m, c, numbers[d], figure, none) for t, m, c, d, figure, none in self.tests]
        for m, spec in _declared("accepted_values", models, declared):
            for c, values in spec.items():
                bad = F.when(~F.col(c).isin(list(values)), F.col(c).cast("string"))
                self.tests.append(("accepted_values", m, c, self._next(), "unaccepted", 0))
                self.elements[m].append(_element(self.domains - 1, 0, s=bad))
        sources = dict(_declared("row_count_source", models, declared))
        tested = dict(_declared("not_null", models, declared))
        for m in models:
            columns = list(tested.get(m, []))
            for at in range(0, len(columns) or (m in sources), _BITS):
                domain, part = self._next(), columns[at:at + _BITS]
                mask = reduce(lambda a, b: a + b, [F.when(F.col(c).isNull(), F.lit(1 << k)).otherwise(F.lit(0)).cast("bigint") for k, c in enumerate(part)],
                              F.lit(0).cast("bigint"))
                self.elements[m].append(_element(domain, 0, v=mask))
                self.bits = max(self.bits, len(part))
                self.tests += [("not_null", m, c, domain, f"null_{k}", 0) for k, c in enumerate(part)]
                if at == 0 and m in sources:
                    self.raw.append((m, domain, sources[m]))
                    self.tests.append(("batch_row_count_matches", m, None, domain, "count_differs", 1))

    def _next(self) -> int:
        self.domains += 1
        return self.domains - 1


def check_summary(models: dict[str, DataFrame], raw: dict[str, DataFrame], batch_id: str,
                  declared: dict = DECLARED_TESTS) -> DataFrame:
    """One row per declared test: ``(test_name, model, column_name, failures)``.

    ``failures`` counts what the test would return: null rows, duplicated values, orphan child rows, unexpected values, or 1 for a
    failed row-count reconciliation.

    Every model is scanned once, and RAW once more per counted table. A row gives one element per key column, per reference, per column with accepted values, and one
    mask of its null columns; all elements of all models are counted in one grouping by (domain, value), combined map-side, so neither a hot reference nor the masks
    cost more than one row per task, and orphans need no join: a parent's own count of a value stands beside its children's.
    """
    plan = _Plan(models, declared)
    parts = [models[m].select(F.inline(F.array(*elements))) for m, elements in plan.elements.items() if elements]
    parts += [raw[src].filter(F.col(BATCH_COL) == F.lit(batch_id)).select(_element(d, 1, v=F.lit(0).cast("bigint")).alias("e")).select("e.*") for _, d, src in plan.raw]
    spark = next(iter(models.values())).sparkSession
    elements = union_all(parts) if parts else spark.createDataFrame([], "domain int, slot int, v bigint, s string")
    n = [f"n{i}" for i in range(plan.width)]
    # nulls pass the tests on values, but a null value still stands for its row in a mask's or an accepted column's count
    counted = (elements.filter(F.col("v").isNotNull() | F.col("s").isNotNull()).groupBy("domain", "v", "s")
               .agg(*[F.count_if(F.col("slot") == i).alias(name) for i, name in enumerate(n)]))
    own, zero = F.col("n0"), F.lit(0).cast("bigint")
    figures = {"duplicated": F.count_if(own > 1), "unaccepted": F.count(F.lit(1)), "raw_rows": F.sum("n1"), "staged_rows": F.sum("n0"),
               **{f"orphans_{i}": F.sum(F.when(own == 0, F.col(n[i])).otherwise(zero)) for i in range(1, plan.width)},
               **{f"null_{k}": F.sum(F.when(F.col("v").bitwiseAND(F.lit(1 << k).cast("bigint")) != 0, own).otherwise(zero)) for k in range(plan.bits)}}
    found = counted.groupBy("domain").agg(*[c.alias(name) for name, c in figures.items()])
    found = found.withColumn("count_differs", F.when((F.col("raw_rows") == 0) | (F.col("raw_rows") != F.col("staged_rows")), 1).otherwise(0).cast("bigint"))
    named = [name for name in found.columns if name != "domain"]
    figure = F.create_map(*[x for name in named for x in (F.lit(name), F.col(name))])[F.col("figure")]
    listed = spark.createDataFrame(plan.tests, "test_name string, model string, column_name string, domain int, figure string, without_rows bigint")
    return listed.join(found, "domain", "left").select("test_name", "model", "column_name", F.coalesce(figure, "without_rows").alias("failures"))
