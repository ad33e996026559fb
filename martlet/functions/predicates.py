"""Null-safe comparison predicates for reconciliations."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column


def distinct_from(a: Column, b: Column) -> Column:
    """``a IS DISTINCT FROM b``: NULL vs value is a difference, NULL vs NULL is not."""
    return ~a.eqNullSafe(b)


def any_distinct(pairs: list[tuple[Column, Column]], extra: list[Column] | None = None) -> Column:
    """OR-chain of null-safe inequalities plus any extra violation terms."""
    terms = [distinct_from(a, b) for a, b in pairs] + list(extra or [])
    return reduce(or_, terms)
