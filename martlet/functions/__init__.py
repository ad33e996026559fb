"""Column-level helpers, all built from ``pyspark.sql.functions`` (JVM-side)."""

from martlet.functions.batch_ids import batch_id_from_ts, is_valid_batch_id, require_batch_id
from martlet.functions.money import MONEY, money, iff_money
from martlet.functions.predicates import any_distinct, distinct_from
from martlet.functions.temporal import utc_ntz
from martlet.functions.fingerprint import row_digest, table_fingerprint

__all__ = [
    "batch_id_from_ts", "is_valid_batch_id", "require_batch_id",
    "MONEY", "money", "iff_money",
    "any_distinct", "distinct_from",
    "utc_ntz",
    "row_digest", "table_fingerprint",
]
