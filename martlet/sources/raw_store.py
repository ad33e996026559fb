"""RAW as a Parquet table partitioned by ``_BATCH_ID``.

Landing the seven RAW DataFrames once turns every later staging read into a
partition-pruned scan (``PartitionFilters: [_BATCH_ID = ...]``) and cuts the
lineage back to the sources: a lost executor re-reads Parquet, it does not
re-run the extract.
"""

from __future__ import annotations

import threading
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructField, StructType

from martlet.config import BATCH_COL
from martlet.session import run_concurrently
from martlet.sources.landing import append_raw


class LandedOnUse(Mapping):
    """Readers of RAW tables by name; a table is landed when it is first asked for, all that are left at once when all are listed."""

    def __init__(self, spark: SparkSession, raw: dict[str, DataFrame], root: str):
        self._spark, self._raw, self._root = spark, raw, root
        self._landed: dict[str, DataFrame] = {}
        self._lock = threading.RLock()

    def land(self, names) -> None:
        """Land those of ``names`` that are not landed yet."""
        with self._lock:
            left = {t: self._raw[t] for t in names if t not in self._landed}
            if left:
                self._landed.update(land_raw(self._spark, left, self._root))

    def __getitem__(self, name: str) -> DataFrame:
        self.land([name])
        return self._landed[name]

    def __iter__(self):
        return iter(sorted(self._raw))

    def __len__(self) -> int:
        return len(self._raw)

    def items(self):
        self.land(self._raw)
        return super().items()

    def values(self):
        self.land(self._raw)
        return super().values()


def land_raw(spark: SparkSession, raw: dict[str, DataFrame], root: str, workers: int = 4) -> dict[str, DataFrame]:
    """Append every RAW DataFrame under ``root/<table>`` (independent writes run
    concurrently) and return readers."""
    run_concurrently({t: (lambda t=t, df=df: append_raw(df, root, t)) for t, df in raw.items()}, workers)
    return {t: read_raw_like(spark, f"{root}/{t}", df.schema) for t, df in sorted(raw.items())}


def read_raw_like(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Read a partitioned RAW table with a declared schema, in the original column order."""
    data = [f for f in schema.fields if f.name != BATCH_COL]
    batch = [f for f in schema.fields if f.name == BATCH_COL]
    declared = StructType(data + [StructField(BATCH_COL, batch[0].dataType, True)] if batch else data)
    return spark.read.schema(declared).parquet(path).select(*schema.names)
