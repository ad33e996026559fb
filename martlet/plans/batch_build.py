"""The whole batch-to-mart build as one lazily composed set of DataFrames."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame

from martlet.plans import marts
from martlet.plans.staging import STAGING, require_batch_id


class Build:
    """Staging -> dims -> fact -> mart for one batch, constructed on first use.

    Models are built lazily so a query that needs two staged tables does not
    pay for analysing the other nine. Pass ``fct`` (and ``mart``) to use
    materialized tables instead of re-joining / re-aggregating staging; a ``mart`` that is
    a function is called when the mart is first asked for.
    """

    def __init__(self, raw: dict[str, DataFrame], batch_id: str, fct: DataFrame | None = None,
                 mart: DataFrame | Callable[[], DataFrame] | None = None):
        require_batch_id(batch_id)
        self.raw = raw
        self.batch_id = batch_id
        self._fct = fct
        self._mart = mart
        self._staged: dict[str, DataFrame] = {}

    def with_tables(self, fct: DataFrame, mart: DataFrame | Callable[[], DataFrame] | None = None) -> "Build":
        """The same build reading written fact (and mart) tables; staging models are shared."""
        other = Build(self.raw, self.batch_id, fct, mart)
        other._staged = self._staged
        return other

    @property
    def staged(self) -> "_LazyStaged":
        return _LazyStaged(self)

    def stage(self, model: str) -> DataFrame:
        if model not in self._staged:
            table = MODEL_TABLES[model]
            self._staged[model] = STAGING[table][1](self.raw[table], self.batch_id)
        return self._staged[model]

    @cached_property
    def dim_customers(self) -> DataFrame:
        return marts.dim_customers(self.stage("stg_users"))

    @cached_property
    def dim_products(self) -> DataFrame:
        return marts.dim_products(self.stage("stg_products"))

    @cached_property
    def fct_order_items(self) -> DataFrame:
        if self._fct is not None:
            return self._fct
        return marts.fct_order_items(self.stage("stg_order_items"), self.stage("stg_orders"),
                                     self.stage("stg_inventory_items"))

    @cached_property
    def mart_daily_sales(self) -> DataFrame:
        if self._mart is not None:
            return self._mart() if callable(self._mart) else self._mart
        return marts.mart_daily_sales(self.fct_order_items)

    def models(self) -> dict[str, DataFrame]:
        return {**{m: self.stage(m) for m in MODEL_TABLES},
                "dim_customers": self.dim_customers,
                "dim_products": self.dim_products,
                "fct_order_items": self.fct_order_items,
                "mart_daily_sales": self.mart_daily_sales}


class _LazyStaged:
    """Mapping view ``staged[model]`` over a Build's lazily staged models."""

    def __init__(self, b: Build):
        self._b = b

    def __getitem__(self, model: str) -> DataFrame:
        return self._b.stage(model)

    def __iter__(self):
        return iter(MODEL_TABLES)

    def keys(self):
        return MODEL_TABLES.keys()

    def items(self):
        return [(m, self._b.stage(m)) for m in MODEL_TABLES]


MODEL_TABLES = {model: table for table, (model, _fn) in STAGING.items()}


def build(raw: dict[str, DataFrame], batch_id: str, fct: DataFrame | None = None,
          mart: DataFrame | None = None) -> Build:
    return Build(raw, batch_id, fct, mart)


def materialize(df: DataFrame, path: str) -> DataFrame:
    """Write a model as a full-refresh Parquet table and read it back.

    This is the lineage cut between fact and its four readers (mart, KPIs,
    reconciliations): executors lost later recompute from the table, not
    from the sources.
    """
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)
