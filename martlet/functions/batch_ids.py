"""Batch identifiers: ``YYYYMMDDTHHMMSSZ``, the UTC extract second."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from martlet.config import BATCH_ID_FORMAT, BATCH_ID_REGEX

_PATTERN = re.compile(BATCH_ID_REGEX)


def require_batch_id(batch_id: str) -> str:
    """Validate a batch-id parameter; the whole string must match (no trailing newline)."""
    if not isinstance(batch_id, str) or not _PATTERN.fullmatch(batch_id):
        raise ValueError(f"batch id must use YYYYMMDDTHHMMSSZ format: {batch_id!r}")
    return batch_id


def is_valid_batch_id(c: Column | str) -> Column:
    """Whole-string match; ``\\A``/``\\z`` because ``$`` would accept a trailing newline."""
    c = F.col(c) if isinstance(c, str) else c
    return c.rlike(r"\A" + BATCH_ID_REGEX + r"\z")


def batch_id_from_ts(ts: Column | str) -> Column:
    """Batch id for an extract instant, truncated to whole seconds (UTC session)."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.date_format(F.date_trunc("second", ts), BATCH_ID_FORMAT)
