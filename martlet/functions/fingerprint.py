"""Order-insensitive content fingerprint of a DataFrame.

Each row is rendered as one text in which every value is preceded by its
length and a colon and NULL is a lone ``N``, so no two rows share a text. Its
SHA-256's first 48 bits are summed as an exact decimal. The sum is independent
of row order and of partitioning, so it is computed with one partial aggregate per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def row_digest(df: DataFrame, columns: list[str] | None = None) -> Column:
    cols = columns or df.columns
    values = [F.col(c).cast("string") for c in cols]
    text = F.concat(*[F.coalesce(F.concat(F.char_length(v).cast("string"), F.lit(":"), v), F.lit("N")) for v in values])
    return F.conv(F.substring(F.sha2(text, 256), 1, 12), 16, 10).cast("decimal(38,0)")


def table_fingerprint(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"),
                  F.coalesce(F.sum(row_digest(df, columns)), F.lit(0).cast("decimal(38,0)"))
                  .cast("decimal(38,0)").alias("fingerprint"))
