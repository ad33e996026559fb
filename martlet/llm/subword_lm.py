"""Subword lattice likelihood: a document's marginal probability over all segmentations into vocabulary pieces.

A word's lattice has an arc for every piece of a fixed public vocabulary that occurs in it, and its
probability P_pieces is the sum over all segmentations by a log-space forward recursion (``lattice``). The vocabulary's own
scores weight the pieces first; ``rounds`` of expectation-maximisation over the distinct training words re-estimate them.
A word seen in training has one more arc, the whole word, with its discounted relative frequency; so, with N training tokens,
V distinct training words and D the discount n1 / (n1 + 2 n2) from the counts of counts,

    P(word) = max(c - D, 0) / N + D V / N * P_pieces(word),    P(end) = documents / N,

which sums to one over all words and the end. A document's probability is the product over its words and one end.
Texts are lower-cased in A-Z; words are runs of non-space characters; white space itself is not scored.

The word lattice is solved once per distinct word, on a table of word counts that Spark aggregates and that grows with
the corpus. Piece counts, one per vocabulary piece, are all that reaches the driver. Documents
take frequent words (each at least ``1 / HEAD`` of the training tokens, so fewer than ``HEAD`` words) from a broadcast; their other words
are shuffled to the word table, where no word is frequent, and summed back by row.

Also given: the add-one word unigram, base_score = sum over tokens of log10((c + 1) / (N + V + 1)).

Defined cases: null text is empty (one end token); a null key is a training row; repeated rows all count and are all scored;
without training rows the vocabulary's own scores and zero counts are used, and words and the end halve the mass; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martlet.llm.common import LOWER, as_bytes, slices, written
from martlet.llm.lattice import Lattice, load_pieces

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
HEAD = 200_000
#: Distinct words a task counts before it passes them on.
HELD = 300_000
_LN10 = math.log(10)


def held_out(key: Column, modulus: int, remainder: int) -> Column:
    """crc32 of the key's text leaves this remainder (false for a null key)."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % modulus == remainder, F.lit(False))


def _rows(docs: DataFrame, key: str, text: str, held: Column) -> DataFrame:
    return docs.select(F.col(key).alias("key"), held.alias("held"), F.col(text).cast("binary").alias("text"))


def count_words(batches, group_of):
    """Arrow batches of (group, word, n): words counted within a task, passed on whenever many are held."""
    held: dict = {}
    size = 0

    def flush():
        for group, counts in held.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([group] * len(counts)), pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())],
                names=["g", "word", "n"])
        held.clear()

    for batch in slices(batches):
        for group, text in zip(group_of(batch), as_bytes(batch, "text"), strict=True):
            if group is None:
                continue
            own = held.setdefault(group, Counter())
            size -= len(own)
            own.update((text or b"").translate(LOWER).split())
            size += len(own)
            if size > HELD:
                yield from flush()
                size = 0
    yield from flush()


def word_counts(rows: DataFrame) -> DataFrame:
    """(word, c): every word of the corpus and its count in training rows (zero where only held-out rows have it)."""

    def run(batches):
        yield from count_words(batches, lambda b: [int(h) for h in b.column(1).to_pylist()])

    pairs = rows.mapInArrow(run, "g long, word binary, n long")
    return pairs.groupBy("word").agg(F.sum(F.when(F.col("g") == 0, F.col("n")).otherwise(0)).alias("c"))


def fit(counts: DataFrame, vocabulary: str, rounds: int) -> tuple[list[bytes], np.ndarray]:
    """Pieces and their log probabilities: ``rounds`` of expectation-maximisation over the words with c > 0, each once."""
    pieces, logp = load_pieces(vocabulary)
    spark: SparkSession = counts.sparkSession
    shared = spark.sparkContext.broadcast(Lattice(pieces))
    training = counts.filter("c > 0").select("word")
    for _ in range(rounds):
        model = spark.sparkContext.broadcast(logp[:, None])

        def expect(batches, model=model):
            total = np.zeros(model.value.shape)
            for batch in slices(batches, 20_000):
                found = batch.column(0).to_pylist()
                total += shared.value.expected(found, np.ones(len(found)), model.value, np.zeros(len(found), np.int64))
            at = np.flatnonzero(total[:, 0])
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at, 0])], names=["piece", "mass"])

        rows = training.mapInArrow(expect, "piece long, mass double").groupBy("piece").agg(F.sum("mass")).collect()
        if not rows:
            break
        mass = np.full(len(pieces), 0.01)  # no piece is impossible
        for piece, m in rows:
            mass[piece] += m
        logp = np.log(mass / mass.sum())
    return pieces, logp


def score_documents(docs: DataFrame, held: Column, *, key: str = "doc_id", text: str = "text",
                    vocabulary: str = VOCABULARY, rounds: int = 3) -> DataFrame:
    """Per row: key, held_out, n_tokens, n_known, train_tokens, base_score, score (both log10).

    ``held`` marks the rows that are not learned from.
    """
    spark = docs.sparkSession
    rows = _rows(docs, key, text, held)
    counts = written(word_counts(rows), "word-counts")
    ends = rows.filter(~F.col("held")).count()
    size = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count_if(F.col("c") > 0), F.count_if(F.col("c") == 1),
                      F.count_if(F.col("c") == 2)).first()
    tokens, distinct = size[0] + ends, size[1] + (ends > 0)
    discount = size[2] / (size[2] + 2 * size[3]) if 0 < size[2] and 0 < size[3] else 0.5
    back_off = math.log(discount * size[1] / tokens) if size[1] else math.log(0.5)
    pieces, logp = fit(counts, vocabulary, rounds)
    shared, model = spark.sparkContext.broadcast(Lattice(pieces)), spark.sparkContext.broadcast(logp[:, None])

    def solve(batches):
        for batch in slices(batches, 20_000):
            found = batch.column(0).to_pylist()
            seen = np.maximum(batch.column(1).to_numpy().astype(float) - discount, 0)
            with np.errstate(divide="ignore"):
                whole_word = np.log(seen) - math.log(max(tokens, 1))
            marginal = np.logaddexp(whole_word, shared.value.forward(found, model.value)[:, 0] + back_off) / _LN10
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(marginal)], names=["word", "c", "lp"])

    lexicon = written(counts.mapInArrow(solve, "word binary, c long, lp double"), "word-scores")
    least = tokens // HEAD
    head = spark.sparkContext.broadcast({bytes(r["word"]): (r["c"], r["lp"]) for r in lexicon.filter(F.col("c") > least).collect()})
    whole = math.log10(tokens + distinct + 1)
    end = (math.log10(ends + 1) - whole, math.log10(ends / tokens if ends else 0.5), int(ends > 0))
    key_type = docs.schema[key].dataType.simpleString()
    schema = (f"row long, key {key_type}, held boolean, n_tokens long, n_known long, base double, score double, "
              "rest array<struct<word: binary, n: long>>")
    tail = pa.list_(pa.struct([("word", pa.binary()), ("n", pa.int64())]))

    def look_up(batches):
        known = head.value
        log = {c: math.log10(c + 1) - whole for c, _ in known.values()}
        for batch in slices(batches):
            out = []
            for body in as_bytes(batch, "text"):
                found = Counter((body or b"").translate(LOWER).split())
                base, score, n_known, n_tokens, rest = end[0], end[1], end[2], 1, []
                for word, n in found.items():
                    n_tokens += n
                    entry = known.get(word)
                    if entry is None:
                        rest.append({"word": word, "n": n})
                    else:
                        base += n * log[entry[0]]
                        score += n * entry[1]
                        n_known += n
                out.append((n_tokens, n_known, base, score, rest))
            columns = list(zip(*out, strict=True))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2),
                 *(pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.float64(), pa.float64(), tail), strict=True))],
                names=["row", "key", "held", "n_tokens", "n_known", "base", "score", "rest"])

    numbered = rows.select(F.monotonically_increasing_id().alias("row"), "key", "held", "text")
    # the row numbers are read back from one table, so both branches below see the same ones
    first = written(numbered.mapInArrow(look_up, schema), "row-scores", "zstd")
    own = first.select("row", "key", "held", "n_tokens", "n_known", "base", "score")
    rest = first.select("row", F.explode("rest").alias("w")).select("row", "w.word", "w.n")
    count, n = F.col("c").cast("double"), F.col("n")
    more = (rest.join(lexicon.filter(F.col("c") <= least), "word").groupBy("row")
            .agg(F.sum(F.when(F.col("c") > 0, n).otherwise(0)).alias("n_known2"), F.sum(n * (F.log10(count + 1) - F.lit(whole))).alias("base2"),
                 F.sum(n * F.col("lp")).alias("score2")))
    return own.join(more, "row", "left").select(
        F.col("key").alias(key), F.col("held").alias("held_out"), "n_tokens",
        (F.col("n_known") + F.coalesce("n_known2", F.lit(0))).alias("n_known"), F.lit(tokens).cast("bigint").alias("train_tokens"),
        (F.col("base") + F.coalesce("base2", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce("score2", F.lit(0.0))).alias("score"))
