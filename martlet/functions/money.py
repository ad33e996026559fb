"""Exact money: every amount is cast to DECIMAL(18,4) before arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

MONEY = DecimalType(18, 4)


def money(c: Column | str) -> Column:
    """``x::number(18,4)``: half-up rounding; ANSI mode raises on overflow."""
    c = F.col(c) if isinstance(c, str) else c
    return c.cast(MONEY)


def iff_money(cond: Column, value: Column) -> Column:
    """``iff(cond, value, 0)::number(18,4)``.

    A NULL condition takes the else branch (0); a true condition with a NULL
    value stays NULL. Differences of two (18,4) values widen to (19,4), so
    the result is cast back.
    """
    return F.when(cond, value).otherwise(F.lit(0)).cast(MONEY)
