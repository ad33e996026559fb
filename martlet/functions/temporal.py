"""UTC conversion of tz-aware RAW timestamps into staged ``TIMESTAMP_NTZ``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def utc_ntz(c: Column | str) -> Column:
    """``convert_timezone('UTC', ts)::timestamp_ntz``.

    The LTZ -> NTZ cast renders the instant in the session time zone, which
    the staging builder asserts is UTC (``session.assert_utc``), so the result
    is the UTC wall-clock value whatever zone the cluster's JVMs run in.
    """
    c = F.col(c) if isinstance(c, str) else c
    return c.cast("timestamp_ntz")
