"""Packing: optimal length buckets over the global histogram, token-budget batches inside each bucket.

A document's length is its words plus one end token (or any length column
given). A dynamic programme over the histogram of lengths picks at most
``buckets`` upper bounds that minimise the padding summed over all documents (each
padded to its bucket's bound). A batch of a bucket with bound B takes
``token_budget // B`` documents, so padded batches never exceed the budget. Documents longer than the
budget are whole batches of one, unpadded.

Batches are formed in shards of a bucket: a bucket of n documents has
``ceil(n / shard_docs)`` shards by hash, each numbered by its own small window, so no
bucket, however common its lengths, meets in one task; at most one batch per shard is not full.

Defined cases: a null text is an empty one (one end token); no documents give no batches; repeated rows are
packed each; ties in length are broken by key and then are interchangeable; a null key is packed like any other.
"""

from __future__ import annotations

from collections import deque

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from martlet.llm.common import words


def token_count(text: Column) -> Column:
    """Words and one end token."""
    return (F.size(words(text)) + 1).cast("bigint")


def optimal_bounds(histogram: dict[int, int], buckets: int) -> list[int]:
    """The upper bounds, at most ``buckets`` of them, with the least total padding.

    With counts C and tokens S summed up to each distinct length B, a bucket over
    lengths i+1..j pads B_j (C_j - C_i) - (S_j - S_i). For a fixed j this is the minimum of lines in B_j whose
    slopes -C_i fall with i, so a monotone hull gives each layer in linear time, exactly, in integers.
    """
    lengths = sorted(histogram)
    if not lengths:
        return []
    count, tokens = [0], [0]
    for n in lengths:
        count.append(count[-1] + histogram[n])
        tokens.append(tokens[-1] + n * histogram[n])
    size = len(lengths)
    best: list[int | None] = [0] + [None] * size
    choice: list[list[int]] = []
    for _ in range(min(buckets, size)):
        hull: deque[tuple[int, int, int]] = deque()  # slope, intercept, i
        new, back = list(best), [-1] * (size + 1)
        for j in range(1, size + 1):
            if best[j - 1] is not None:
                m, c = -count[j - 1], best[j - 1] + tokens[j - 1]
                while len(hull) > 1 and ((c - hull[-2][1]) * (hull[-2][0] - hull[-1][0])
                                         <= (hull[-1][1] - hull[-2][1]) * (hull[-2][0] - m)):
                    hull.pop()
                hull.append((m, c, j - 1))
            x = lengths[j - 1]
            while len(hull) > 1 and hull[0][0] * x + hull[0][1] > hull[1][0] * x + hull[1][1]:
                hull.popleft()
            if hull:
                value = x * count[j] - tokens[j] + hull[0][0] * x + hull[0][1]
                if new[j] is None or value < new[j]:
                    new[j], back[j] = value, hull[0][2]
        choice.append(back)
        best = new
    bounds, j = [], size
    for back in reversed(choice):  # a layer that did not improve on fewer buckets is skipped
        if j and back[j] >= 0:
            bounds.append(lengths[j - 1])
            j = back[j]
    return sorted(bounds)


def pack(docs: DataFrame, *, key: str = "doc_id", text: str = "text", length: Column | None = None,
         buckets: int = 16, token_budget: int = 65_536, shard_docs: int = 20_000) -> DataFrame:
    """One row per document: key, n_tokens, bucket_bound, batch_id, slot, batch_docs, padding.

    Only (key, length) pairs are shuffled, never texts. The histogram that comes to the driver has at
    most ``token_budget`` rows.
    """
    n = token_count(F.col(text)) if length is None else length.cast("bigint")
    sized = docs.select(F.col(key).alias("key"), n.alias("n_tokens"), 
                        F.xxhash64(F.col(key), n, *([F.col(text)] if text in docs.columns else [])).alias("salt"))
    rows = sized.filter(F.col("n_tokens") <= token_budget).groupBy("n_tokens").count().collect()
    histogram = {r["n_tokens"]: r["count"] for r in rows}
    bounds = optimal_bounds(histogram, buckets)
    inside = {b: 0 for b in bounds}
    at = 0
    for size in sorted(histogram):
        at += size > bounds[at]
        inside[bounds[at]] += histogram[size]
    shards = {b: -(-c // shard_docs) for b, c in inside.items()}

    over = F.col("n_tokens") > token_budget
    bound = F.col("n_tokens")
    for b in reversed(bounds):
        bound = F.when(F.col("n_tokens") <= b, F.lit(b)).otherwise(bound)
    of_bound = F.lit(1)
    for b, k in shards.items():
        of_bound = F.when(F.col("bound") == b, F.lit(k)).otherwise(of_bound)
    placed = (sized.withColumn("bound", F.when(over, F.col("n_tokens")).otherwise(bound).cast("bigint"))
              .withColumn("shard", F.when(over, F.col("salt")).otherwise(F.pmod(F.col("salt"), of_bound))))
    group = Window.partitionBy("bound", "shard")
    capacity = F.greatest(F.lit(1).cast("bigint"), F.floor(F.lit(token_budget) / F.col("bound")))
    numbered = (placed.withColumn("at", F.row_number().over(group.orderBy("n_tokens", "key")) - 1)
                .withColumn("held", F.count(F.lit(1)).over(group))
                .withColumn("batch", F.floor(F.col("at") / capacity)))
    return numbered.select(
        F.col("key").alias(key), "n_tokens", F.col("bound").alias("bucket_bound"),
        F.concat_ws("-", "bound", F.hex("shard"), F.col("batch")).alias("batch_id"),
        F.pmod(F.col("at"), capacity).cast("bigint").alias("slot"),
        F.least(capacity, F.col("held") - F.col("batch") * capacity).cast("bigint").alias("batch_docs"),
        (F.col("bound") - F.col("n_tokens")).alias("padding"))
