"""Ranked lexical search of many queries at once, by common-subexpression evaluation.

A document's score for a query is a sum over the query's terms, and queries share terms. Terms that stand in exactly the same queries, equally often,
are one set; pairs of sets that stand together in several queries are merged again and again into larger ones, the pair of the most queries
first. The sets form a graph: for a group of documents every set's partial accumulator is computed once, from its two parts (or from the postings,
for the sets of terms), and a query adds up the few sets that make it.

Two passes: the first reads each text once and writes its postings, of query terms only, to the shared folder; their counts give the terms' weights. The second
evaluates the graph over groups of documents and keeps each query's best ``top`` per task; these are merged in two
grouped steps, so no task sees more than ``top`` rows of a query from each task of its group. Queries are taken in blocks of at most ``BLOCK_TERMS``
(query, term) pairs or one query, whose number depends on the queries alone; a block's vocabulary and graph are what is broadcast.

Terms are runs of ASCII letters and digits and of anything above ASCII, lower-cased in A-Z. Weights and scores are integers: see ``weight`` and ``impacts``.

Defined cases: null texts have no terms; documents without a term count in no statistic and are never ranked; every row of either table is a document or query
of its own, repeated rows too; ties go by ascending document key, null keys last, then rows alike in both are interchangeable; a query without a term, or whose terms no document
has, has no rows; other columns are not read. Document keys are integers.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martlet.llm.common import as_bytes, free_names, slices, written

#: (query, term) pairs of the queries evaluated together; a block is one query at least.
BLOCK_TERMS = 1 << 18
#: Accumulators (sets times documents) held at once, and documents in a group at most.
CELLS, GROUP = 1 << 22, 512
#: Queries that must share a pair of sets before it becomes a set of its own.
SHARED_BY = 3
#: Groups of tasks whose best rows are merged first.
SPREAD = 256
#: Bytes of a text split at once.
PART = 1 << 20
_SEPARATORS = bytes(range(0x30)) + bytes(range(0x3A, 0x41)) + bytes(range(0x5B, 0x61)) + bytes(range(0x7B, 0x80))
#: Separators to blanks, A-Z to a-z, every other byte unchanged.
_FOLD = bytes.maketrans(_SEPARATORS + b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b" " * len(_SEPARATORS) + b"abcdefghijklmnopqrstuvwxyz")


def term_counts(text: bytes | None) -> Counter:
    """How often each term occurs in a text; long texts are split in parts that end at a separator."""
    folded, counts, at = (text or b"").translate(_FOLD), Counter(), 0
    while at < len(folded):
        end = folded.find(b" ", at + PART)
        end = len(folded) if end < 0 else end
        counts.update(folded[at:end].split())
        at = end
    return counts


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def impacts(weights: np.ndarray, tf: np.ndarray, n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """What a term that occurs ``tf`` times in a document of ``n`` terms adds to its score, per occurrence in the query."""
    m = 75 + (25 * n * n_docs) // max(n_terms, 1)
    return weights * ((1_000_000_000 * tf) // (1000 * tf + 12 * m))


@dataclass
class Graph:
    """Sets of terms shared by queries: first the sets of terms, then each merged one as the numbers of its two parts."""

    set_of: np.ndarray  # the set of each term
    n_term_sets: int
    merged: list[tuple[int, int]]
    queries: list[tuple[np.ndarray, np.ndarray]]  # per query: sets and how often each counts

    def evaluate(self, terms: np.ndarray, docs: np.ndarray, values: np.ndarray, n_docs: int) -> np.ndarray:
        """Scores (query, document) of ``n_docs`` documents from their postings."""
        sums = np.zeros((self.n_term_sets + len(self.merged), n_docs), np.int64)
        np.add.at(sums, (self.set_of[terms], docs), values)
        for k, (one, two) in enumerate(self.merged, self.n_term_sets):
            np.add(sums[one], sums[two], out=sums[k])
        return np.stack([sums[own].sum(axis=0) if (times == 1).all() else times @ sums[own] for own, times in self.queries])


def share(queries: list[dict[int, int]], n_terms: int, shared_by: int = SHARED_BY) -> Graph:
    """Mine the graph of a block: ``queries`` map term numbers to their counts in the query."""
    holders: dict[int, list[tuple[int, int]]] = {}
    for q, terms in enumerate(queries):
        for t, times in terms.items():
            holders.setdefault(t, []).append((q, times))
    numbers: dict[tuple, int] = {}
    set_of = np.zeros(n_terms, np.int64)
    for t in sorted(holders):
        set_of[t] = numbers.setdefault(tuple(holders[t]), len(numbers))
    rest: list[dict[int, int]] = [{} for _ in queries]
    for signature, k in numbers.items():
        for q, times in signature:
            rest[q][k] = times
    # the queries in which two sets stand equally often
    together: dict[tuple[int, int], set[int]] = {}

    def pair(q: int, one: int, two: int) -> tuple[int, int] | None:
        return (min(one, two), max(one, two)) if rest[q][one] == rest[q][two] else None

    for q, own in enumerate(rest):
        order = sorted(own)
        for i, one in enumerate(order):
            for two in order[i + 1:]:
                if p := pair(q, one, two):
                    together.setdefault(p, set()).add(q)
    together = {p: held for p, held in together.items() if len(held) >= shared_by}
    heap = [(-len(held), p) for p, held in together.items()]
    heapq.heapify(heap)
    merged: list[tuple[int, int]] = []
    while heap:
        size, p = heapq.heappop(heap)
        held = together.get(p, set())
        if len(held) != -size or len(held) < shared_by:
            if len(held) >= shared_by:
                heapq.heappush(heap, (-len(held), p))
            continue
        new = len(numbers) + len(merged)
        merged.append(p)
        fresh: dict[tuple[int, int], set[int]] = {}
        for q in sorted(held):
            own = rest[q]
            for x in p:
                for other in own:
                    if other not in p and (old := pair(q, x, other)) in together:
                        together[old].discard(q)
            times = own.pop(p[0])
            del own[p[1]]
            for other, t in own.items():
                if t == times:
                    fresh.setdefault((other, new), set()).add(q)
            own[new] = times
        del together[p]
        for x, held in fresh.items():
            if len(held) >= shared_by:
                together[x] = held
                heapq.heappush(heap, (-len(held), x))
    return Graph(set_of, len(numbers), merged, [(np.array(sorted(own), np.int64), np.array([own[k] for k in sorted(own)], np.int64)) for own in rest])


def query_terms(queries: DataFrame, key: str, text: str) -> DataFrame:
    """(number, key, terms, times): one row per query with a term, as a table."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 64):
            counts = [term_counts(t) for t in as_bytes(batch, "text")]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([list(c) for c in counts], pa.list_(pa.binary())),
                                              pa.array([list(c.values()) for c in counts], pa.list_(pa.int64()))],
                                             names=["number", "key", "terms", "times"])

    kind = queries.schema[key].dataType.simpleString()
    rows = queries.select(F.monotonically_increasing_id().alias("number"), F.col(key).alias("key"), F.col(text).cast("binary").alias("text"))
    found = rows.mapInArrow(run, f"number bigint, key {kind}, terms array<binary>, times array<bigint>")
    return written(found.filter(F.size("terms") > 0), "search-queries")


def postings(docs: DataFrame, key: str, text: str, vocabulary: dict[bytes, int]) -> DataFrame:
    """(key, n, terms, tfs) of each document with a term: all its terms' number, and the counts of those in ``vocabulary``; a table."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)  # of one block of queries

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = shared.value
        for batch in slices(batches):
            n, terms, tfs = [], [], []
            for body in as_bytes(batch, "text"):
                counts = term_counts(body)
                n.append(counts.total())
                own = [(number[t], c) for t, c in counts.items() if t in number]
                terms.append([t for t, _ in own])
                tfs.append([c for _, c in own])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(terms, pa.list_(pa.int32())),
                                              pa.array(tfs, pa.list_(pa.int64()))], names=["key", "n", "terms", "tfs"])

    rows = docs.select(F.col(key).cast("bigint").alias("key"), F.col(text).cast("binary").alias("text"))
    return written(rows.mapInArrow(run, "key bigint, n bigint, terms array<int>, tfs array<bigint>").filter("n > 0"), "search-postings")


class _Best:
    """The best ``top`` documents of each query so far: highest score, then lowest key, null keys last."""

    def __init__(self, n_queries: int, top: int):
        self.top, self.least = top, np.ones(n_queries, np.int64)
        self.rows = [np.zeros(0, np.int64) for _ in range(4)]  # query, score, null key, key

    def add(self, scores: np.ndarray, null: np.ndarray, keys: np.ndarray) -> None:
        query, doc = np.nonzero(scores >= self.least[:, None])
        new = (query, scores[query, doc], null[doc], keys[doc])
        q, s, m, k = (np.concatenate(x) for x in zip(self.rows, new, strict=True))
        order = np.lexsort((k, m, -s, q))
        q = q[order]
        starts = np.flatnonzero(np.concatenate(([True], q[1:] != q[:-1]))) if len(q) else np.zeros(0, np.int64)
        rank = np.arange(len(q)) - np.repeat(starts, np.diff(np.append(starts, len(q))))
        keep = order[rank < self.top]
        self.rows = [x[keep] for x in (np.concatenate(y) for y in zip(self.rows, new, strict=True))]
        full = rank == self.top - 1
        self.least[q[full]] = s[order][full]


def best_of_block(found: DataFrame, graph: Graph, weights: np.ndarray, numbers: list[int], n_docs: int, n_terms: int, top: int) -> DataFrame:
    """(number, key, score) of each query's ``top`` best documents, with ``place``, from the postings."""
    shared = found.sparkSession.sparkContext.broadcast((graph, weights, np.array(numbers, np.int64)))
    size = max(1, min(GROUP, CELLS // max(graph.n_term_sets + len(graph.merged) + len(numbers), 1)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        graph, weights, numbers = shared.value
        best = _Best(len(numbers), top)
        for batch in slices(batches, size):
            terms, tfs = batch.column(2), batch.column(3)
            held = np.diff(terms.offsets.to_numpy())
            doc, t, tf = np.repeat(np.arange(batch.num_rows), held), terms.flatten().to_numpy(), tfs.flatten().to_numpy()
            values = impacts(weights[t], tf, batch.column(1).to_numpy()[doc], n_docs, n_terms)
            null = np.asarray(batch.column(0).is_null()).astype(np.int64)
            best.add(graph.evaluate(t, doc, values, batch.num_rows), null, np.asarray(batch.column(0).fill_null(0)))
        q, s, m, k = best.rows
        yield pa.RecordBatch.from_arrays([pa.array(numbers[q]), pa.array(k, mask=m.astype(bool)), pa.array(s)], names=["number", "key", "score"])

    rows = found.select("key", "n", "terms", "tfs").mapInArrow(run, "number bigint, key bigint, score bigint")
    order = [F.col("score").desc(), F.col("key").asc_nulls_last()]
    first = Window.partitionBy("number", "part").orderBy(*order)
    some = (rows.withColumn("part", F.spark_partition_id() % SPREAD).withColumn("place", F.row_number().over(first))
            .filter(F.col("place") <= top))
    return (some.withColumn("place", F.row_number().over(Window.partitionBy("number").orderBy(*order)))
            .filter(F.col("place") <= top).select("number", "key", "score", "place"))


def search(docs: DataFrame, queries: DataFrame, *, key: str = "doc_id", text: str = "text", query: str = "item_id",
           query_text: str = "text", top: int = 20) -> DataFrame:
    """Per query its ``top`` best documents of score above 0: query key, rank, document key, score; a table."""
    asked = query_terms(queries, query, query_text)
    pairs = asked.agg(F.sum(F.size("terms"))).first()[0] or 0
    n_blocks = max(1, math.ceil(pairs / BLOCK_TERMS))
    blocked = asked.withColumn("block", F.pmod(F.xxhash64("number"), F.lit(n_blocks)))
    out = None
    for k in range(n_blocks):
        block = blocked.filter(F.col("block") == k).select("number", "terms", "times").orderBy("number").collect()  # bounded by BLOCK_TERMS or one query
        vocabulary = {t: i for i, t in enumerate(sorted({bytes(t) for r in block for t in r["terms"]}))}
        found = postings(docs, key, text, vocabulary)
        size = found.agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("terms")).first()
        df = np.zeros(max(len(vocabulary), 1), np.int64)
        for r in found.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("df")).collect():  # one row per query term
            df[r["t"]] = r["df"]
        weights = np.array([weight(size["docs"], int(d)) for d in df], np.int64)
        graph = share([{vocabulary[bytes(t)]: n for t, n in zip(r["terms"], r["times"], strict=True)} for r in block], len(vocabulary))
        if not block:
            continue
        best = best_of_block(found, graph, weights, [r["number"] for r in block], size["docs"], size["terms"] or 0, top)
        best = written(best, "search-results")
        out = best if out is None else out.unionByName(best)
    names = free_names([query, key], "rank", "score")
    if out is None:
        out = queries.sparkSession.createDataFrame([], "number bigint, key bigint, score bigint, place int")
    named = out.join(asked.select("number", F.col("key").alias("query")), "number")
    return named.select(F.col("query").alias(query), F.col("place").cast("int").alias(names[0]),
                        F.col("key").alias(key if key.lower() != query.lower() else free_names([query], key)[0]), F.col("score").alias(names[1]))
