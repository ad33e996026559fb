"""martlet: batch-stamped retail extracts to tested analytics tables, on Spark.

Layout
------
``sources``    landing (batch stamping, guarded writes, manifests), RAW readers,
               the driver-table fixture and planted-fault variants
``functions``  column helpers: batch-id rules, UTC timestamps, money, null-safe
               predicates, fingerprints
``plans``      staging views, dimensions, the order-item fact and the daily mart
``operators``  fused data checks, reconciliations, batch profile, export
``streaming``  exactly-once file landing with Structured Streaming
"""

from martlet.session import build_session, configure, work_dir

__all__ = ["build_session", "configure", "work_dir"]
