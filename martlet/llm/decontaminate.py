"""Benchmark decontamination: a broadcast hash set of test n-grams scanned over training texts.

Words are ``[0-9a-z]`` and non-ASCII runs after lower-casing A-Z. A window is
``window`` consecutive words of an item; an item with fewer words (but at least one)
is one window. The windows of a block of items, hashed, are broadcast; each
document's word windows are looked up in that set and every hit is verified
word by word. A block holds at most about ``block_words`` item words, so what
is broadcast is bounded; a larger benchmark takes several passes, one a block.

Defined cases: a null or wordless text has no words and no hits; a null or wordless item
has no windows; items sharing an id are one item; a null item id is
reported as the text ``null``; repeated document rows are each reported; input columns are
passed through whatever their names. A document longer than memory allows in one row is
not split: a row is the unit of work.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
import regex as re
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martlet.llm.common import LOWER, as_bytes, free_names, slices

#: Word bytes after lower-casing; everything else separates words.
_WORD_BYTES = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_TO_WORDS = bytes(c if (0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80) else 0x20 for c in LOWER)
_BASE = np.uint64(0x9E3779B97F4A7C15)


def split_words(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_TO_WORDS).split()


def _window_hash(ids: np.ndarray, starts: np.ndarray, n: int) -> np.ndarray:
    h = np.zeros(len(starts), np.uint64)
    for k in range(n):
        h = h * _BASE + ids[starts + k].astype(np.uint64) + np.uint64(1)
    return h


class WindowSet:
    """The windows of a block of items: word numbers, hash per window length, and the items of each window."""

    def __init__(self, items: list[tuple[str, bytes | None]], window: int):
        self.vocabulary: dict[bytes, int] = {}
        self.items: dict[bytes, set[str]] = {}
        by_length: dict[int, list[np.ndarray]] = {}
        for item, text in items:
            found = split_words(text)
            if not found:
                continue
            ids = np.array([self.vocabulary.setdefault(w, len(self.vocabulary)) for w in found], np.int32)
            n = min(window, len(ids))
            starts = np.arange(len(ids) - n + 1)
            for s in starts:
                self.items.setdefault(ids[s:s + n].tobytes(), set()).add(item)
            by_length.setdefault(n, []).append(_window_hash(ids, starts, n))
        self.hashes = {n: np.unique(np.concatenate(h)) for n, h in by_length.items()}

    def scan(self, text: bytes | None) -> tuple[int, list[tuple[int, int]], set[str]]:
        """Number of words, the verified hit windows as word ranges, and the items they belong to."""
        found = split_words(text)
        if not found or not self.hashes:
            return len(found), [], set()
        ids = np.fromiter(map(self.vocabulary.get, found, repeat(-1)), np.int32, len(found))
        known = np.concatenate(([0], np.cumsum(ids >= 0)))
        hits, items = [], set()
        for n, hashes in self.hashes.items():
            starts = np.flatnonzero(known[n:] - known[:-n] == n)
            if not len(starts):
                continue
            h = _window_hash(ids, starts, n)
            at = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
            for s in starts[hashes[at] == h].tolist():
                owners = self.items.get(ids[s:s + n].tobytes())
                if owners:
                    hits.append((s, s + n))
                    items |= owners
        return len(found), hits, items


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted disjoint union of half-open ranges."""
    out: list[tuple[int, int]] = []
    for s, e in sorted(ranges):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def _blocks(items: DataFrame, item_key: str, item_text: str, window: int, block_words: int):
    """Window sets of the items, block by block; a block has about ``block_words`` words at most."""
    own = items.select(F.coalesce(F.col(item_key).cast("string"), F.lit("null")).alias("item"),
                       F.col(item_text).cast("string").alias("text"))
    size = own.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)))).first()[0] or 0
    n = max(1, -(-size // (2 * block_words)))  # a word takes two bytes at least
    for k in range(n):
        part = own.filter(F.pmod(F.xxhash64("text"), F.lit(n)) == k) if n > 1 else own
        rows = part.select("item", F.col("text").cast("binary").alias("text")).distinct().collect()
        yield WindowSet([(r["item"], bytes(r["text"]) if r["text"] is not None else None) for r in rows], window)


def annotate(docs: DataFrame, items: DataFrame, *, text: str = "text", item_key: str = "item_id",
             item_text: str = "text", window: int = 10, block_words: int = 4_000_000) -> tuple[DataFrame, list[str]]:
    """``docs`` with four more columns, and the names these got (altered if taken).

    They are the number of words, the number of hit words, the hit word ranges and the sorted item ids.
    One pass over the documents per block of items, no shuffle.
    """
    spark, names = docs.sparkSession, free_names(docs.columns, "n_words", "n_hit", "hit_ranges", "hit_items")
    extra = T.StructType([
        T.StructField(names[0], T.LongType()), T.StructField(names[1], T.LongType()),
        T.StructField(names[2], T.ArrayType(T.ArrayType(T.IntegerType()))),
        T.StructField(names[3], T.ArrayType(T.StringType()))])
    arrow = [pa.int64(), pa.int64(), pa.list_(pa.list_(pa.int32())), pa.list_(pa.string())]
    out = docs
    for block in _blocks(items, item_key, item_text, window, block_words):
        held, first = spark.sparkContext.broadcast(block), out is docs

        def scan(batches, held=held, first=first):
            block = held.value
            for batch in slices(batches):
                n_words, n_hit, ranges, owners = [], [], [], []
                before = None if first else [batch.column(batch.num_columns - 4 + k).to_pylist() for k in (2, 3)]
                for i, body in enumerate(as_bytes(batch, text)):
                    n, hits, items = block.scan(body)
                    if before is not None:
                        hits, items = hits + [tuple(r) for r in before[0][i]], items | set(before[1][i])
                    hits = merged(hits)
                    n_words.append(n)
                    n_hit.append(sum(e - s for s, e in hits))
                    ranges.append([list(r) for r in hits])
                    owners.append(sorted(items))
                kept = batch.num_columns if first else batch.num_columns - 4
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c) for c in range(kept)),
                     *(pa.array(v, t) for v, t in zip((n_words, n_hit, ranges, owners), arrow, strict=True))],
                    names=[*batch.schema.names[:kept], *names])

        out = out.mapInArrow(scan, T.StructType([*docs.schema.fields, *extra.fields]))
    return out, names


def cut_ranges(text: str, ranges: list[list[int]]) -> str:
    """The text without the words of the given ranges (and what stands between the words of a range)."""
    spans = [m.span() for m in _WORD_BYTES.finditer(text.encode().translate(LOWER))]
    body, out, at = text.encode(), [], 0
    for s, e in ranges:
        out.append(body[at:spans[s][0]])
        at = spans[e - 1][1]
    return b"".join([*out, body[at:]]).decode()


def remove(docs: DataFrame, items: DataFrame, *, what: str = "documents", text: str = "text", **options) -> DataFrame:
    """``docs``, same columns, without what the benchmark holds.

    ``what="documents"`` drops every document with a hit; ``what="spans"`` keeps them all and cuts the hit word ranges
    from the text.
    """
    marked, (_, n_hit, ranges, _) = annotate(docs, items, text=text, **options)
    if what == "documents":
        return marked.filter(F.col(n_hit) == 0).select(*docs.columns)
    if what != "spans":
        raise ValueError(f"what must be documents or spans, not {what!r}")

    columns_kept = list(docs.columns)

    def cut(batches):
        for batch in slices(batches):
            at, k = batch.schema.get_field_index(text), batch.schema.get_field_index(ranges)
            bodies = [cut_ranges(t, r) if r else t
                      for t, r in zip(batch.column(at).to_pylist(), batch.column(k).to_pylist(), strict=True)]
            columns = [pa.array(bodies, batch.schema.field(c).type) if c == at else batch.column(c)
                       for c in range(len(columns_kept))]
            yield pa.RecordBatch.from_arrays(columns, names=columns_kept)

    return marked.mapInArrow(cut, docs.schema)


def decontamination_report(docs: DataFrame, items: DataFrame, *, key: str = "doc_id", **options) -> DataFrame:
    """One row per document: words, hit words, items found (count and digest), contaminated."""
    text = options.get("text", "text")
    marked, (n_words, n_hit, _, owners) = annotate(docs.select(key, text), items, **options)
    return marked.select(
        F.col(key), F.col(n_words).alias("n_words"), F.col(n_hit).alias("n_hit"),
        F.size(owners).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(owners, ",").cast("binary"), 256).alias("items_sha256"),
        (F.col(n_hit) > 0).alias("contaminated"))
