"""Exact links between 64-bit fingerprints at a bounded Hamming distance: block keys, pivot tables, verification.

Two fingerprints that differ in at most ``d`` bits agree on ``m - d`` of any ``m`` blocks, so they share a key among
the C(m, d) masks that keep ``m - d`` blocks. ``m`` is the smallest count whose keys are selective enough for
the number of distinct fingerprints; every choice finds every pair. Pivot distances alone could only filter all pairs, so
the keys come first and say which pairs meet.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column
from pyspark.sql import functions as F

BITS = 64


def block_masks(n: int, distance: int, per_key: int = 4) -> list[int]:
    """Unsigned masks; about ``per_key`` of ``n`` random fingerprints share a key at most."""
    for m in range(distance + 1, BITS + 1):
        if n <= per_key * 2 ** (BITS * (m - distance) / m) or m == distance + 8:
            break
    edges = [BITS * k // m for k in range(m + 1)]
    blocks = [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:], strict=False)]
    return [sum(kept) for kept in combinations(blocks, m - distance)]


def signed(x: int) -> int:
    return x - (1 << BITS) if x >= 1 << (BITS - 1) else x


def key_columns(fingerprint: Column, masks: list[int]) -> Column:
    """One (mask number, masked fingerprint) struct for each mask."""
    return F.explode(F.array(*[F.struct(F.lit(k).alias("mask"), fingerprint.bitwiseAND(F.lit(signed(m))).alias("kept"))
                               for k, m in enumerate(masks)]))
