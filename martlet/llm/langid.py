"""Language identification by segmentation-marginalised unigrams.

Each language has its own probabilities for the pieces of a fixed public vocabulary. A word's probability in a language is
summed over all its segmentations (``lattice``, forward algorithm); a text's is the product over its words times the
language's prior. The prediction is the most probable language, its score the posterior probability.

Learning: a hash-chosen sample of about ``sample`` training rows per language (all of them where there are fewer) gives word counts;
``rounds`` of expectation-maximisation turn them into piece probabilities, starting from the vocabulary's own scores. Only piece
masses, (pieces x languages) numbers, reach the driver; word counts are aggregated by Spark. At most ``max_languages`` are learned, more is an error.

Defined cases: a null text, or one without a letter, is ``und`` with score 0; null languages are not learned; without a training
row every text is ``und``; a null key is a training row; equal texts get equal predictions; ties go to the language first in
code point order; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import regex as re
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlet.llm.common import LOWER, as_bytes, slices, written
from martlet.llm.lattice import Lattice, load_pieces
from martlet.llm.subword_lm import VOCABULARY, count_words

_LETTER = re.compile(r"\p{L}")
#: Numbers a task's word cache may hold (words x languages).
CACHED = 2_000_000


def learn(docs: DataFrame, *, text: str, lang: str, sample: int, rounds: int, vocabulary: str,
          max_languages: int) -> tuple[list[bytes], list[str], np.ndarray, np.ndarray]:
    """Pieces, languages, log piece probabilities (pieces x languages) and log priors of training documents."""
    spark = docs.sparkSession
    pieces, start = load_pieces(vocabulary)
    rows = docs.filter(F.col(lang).isNotNull()).select(F.col(lang).cast("string").alias("lang"), F.col(text).cast("binary").alias("text"))
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().limit(max_languages + 1).collect()}
    if len(sizes) > max_languages:
        raise ValueError(f"more than {max_languages} languages")
    names = sorted(sizes)
    if not names:
        return pieces, [], np.zeros((len(pieces), 0)), np.zeros(0)
    share = F.lit(1.0)
    for name in names:
        share = F.when(F.col("lang") == name, F.lit(min(1.0, sample / sizes[name]))).otherwise(share)
    drawn = rows.filter(F.pmod(F.xxhash64("text"), F.lit(1_000_000)) < share * 1_000_000)
    number = {name: i for i, name in enumerate(names)}

    def run(batches):
        yield from count_words(batches, lambda b: [number[x] for x in b.column(0).to_pylist()])

    counts = written(drawn.mapInArrow(run, "g long, word binary, n long").groupBy("g", "word").agg(F.sum("n").alias("n")), "language-words")
    logp = np.repeat(start[:, None], len(names), axis=1)
    shared = spark.sparkContext.broadcast(Lattice(pieces))
    for _ in range(rounds):
        model = spark.sparkContext.broadcast(logp)

        def expect(batches, model=model):
            total = np.zeros(model.value.shape)
            for batch in slices(batches, 20_000):
                total += shared.value.expected(batch.column(1).to_pylist(), batch.column(2).to_numpy().astype(float),
                                               model.value, batch.column(0).to_numpy())
            at, own = np.nonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(own), pa.array(total[at, own])], names=["piece", "g", "mass"])

        mass = np.full(logp.shape, 0.05)  # no piece is impossible
        for piece, g, m in counts.mapInArrow(expect, "piece long, g long, mass double").groupBy("piece", "g").agg(F.sum("mass")).collect():
            mass[piece, g] += m
        logp = np.log(mass / mass.sum(axis=0))
    prior = np.array([sizes[n] for n in names], float)
    return pieces, names, logp, np.log(prior / prior.sum())


def identify(docs: DataFrame, held: Column, *, key: str = "doc_id", text: str = "text", lang: str = "lang",
             sample: int = 3000, rounds: int = 2, vocabulary: str = VOCABULARY, max_languages: int = 500) -> DataFrame:
    """Per row: key, held_out, lang_pred, score. ``held`` marks the rows that are not learned from."""
    spark = docs.sparkSession
    pieces, names, logp, prior = learn(docs.filter(~held), text=text, lang=lang, sample=sample, rounds=rounds,
                                       vocabulary=vocabulary, max_languages=max_languages)
    shared, model = spark.sparkContext.broadcast(Lattice(pieces)), spark.sparkContext.broadcast(logp)

    def predict(batches):
        lattice, logp = shared.value, model.value
        number: dict[bytes, int] = {}
        table = np.zeros((0, len(names)))
        for batch in slices(batches):
            bodies = as_bytes(batch, "text")
            split = [b.translate(LOWER).split() if b is not None else [] for b in bodies]
            if len(number) * max(len(names), 1) > CACHED:
                number, table = {}, np.zeros((0, len(names)))
            new = list({w for found in split for w in found if w not in number})
            for w in new:
                number[w] = len(number)
            if names:
                table = np.concatenate([table, lattice.forward(new, logp)])
            best, scores = [], []
            for body, found in zip(bodies, split, strict=True):
                if not names or body is None or not _LETTER.search(body.decode("utf-8", "replace")):
                    best.append("und")
                    scores.append(0.0)
                    continue
                total = table[np.fromiter(map(number.__getitem__, found), np.int64, len(found))].sum(axis=0) + prior
                top = int(np.argmax(total))
                best.append(names[top])
                scores.append(float(1 / np.exp(total - total[top]).sum()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(best, pa.string()), pa.array(scores, pa.float64())],
                                             names=["key", "held_out", "lang_pred", "score"])

    rows = docs.select(F.col(key).alias("key"), held.alias("held_out"), F.col(text).cast("binary").alias("text"))
    kind = docs.schema[key].dataType.simpleString()
    out = rows.mapInArrow(predict, f"key {kind}, held_out boolean, lang_pred string, score double")
    return out.withColumnRenamed("key", key)
