"""Toxicity: cumulative-link ordinal regression from sparse text features to severity grades.

P(grade <= k | x) = sigmoid(theta_k - w . x) with one weight vector for all ordered thresholds theta; the outputs are the expected
severity (the sum of P(grade > k)), the most probable grade and P(grade > 0). Features are hashed 5-byte pieces of the text, lower-cased
in A-Z with white space made single blanks; a piece seen c times counts 1 + ln c.

Fitting uses a bounded sample: about ``sample`` labelled keys of each of the two label classes, hash-chosen (all where there are fewer), and twice as
many rows at most where keys repeat. A row weighs as many as its class has for each one drawn, so P(grade > 0) means the same at every size. The
sample's features stay a table; Spark counts per feature the rows of either class that have it, and only features whose presence depends on the class (chi-square, the
``most_features`` highest) come to the driver, for a proximal gradient fit with an L1 penalty. Scoring is one pass over all documents with the weights broadcast (their number is bounded by the hash range).

Defined cases: null text is empty; null labels are ignored, contradictory ones count as toxic, labels without a document or a key too; with no toxic
label every document gets severity 0; with no clean one the thresholds decide alone; repeated rows are scored each; a null key is never
labelled but scored; equal texts get equal scores; other columns pass through ``reject`` unchanged.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlet.llm.common import LOWER, as_bytes, slices, written

GRAM = 5
HASH_BITS = 18
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
#: Bytes hashed at once.
PART = 1 << 20


def features(text: bytes | None, wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Hashed pieces of a text and 1 + ln of their counts; only those marked in ``wanted`` if given."""
    body = b" " + b" ".join((text or b"").translate(LOWER).split()) + b" "
    raw, found = np.frombuffer(body, np.uint8), []
    for at in range(0, len(raw) - GRAM + 1, PART):
        own = raw[at:at + PART + GRAM - 1]
        packed = np.zeros(len(own) - GRAM + 1, np.uint64)
        for k in range(GRAM):
            packed = (packed << np.uint64(8)) | own[k:len(own) - GRAM + 1 + k]
        hashed = ((packed * _MULTIPLIER) >> np.uint64(64 - HASH_BITS)).astype(np.int32)
        found.append(hashed if wanted is None else hashed[wanted[hashed]])
    if not found:
        return np.zeros(0, np.int32), np.zeros(0)
    ids, counts = np.unique(np.concatenate(found), return_counts=True)
    return ids, 1 + np.log(counts)


@dataclass
class Ordinal:
    """Thresholds (ascending) and one shared weight per hashed feature."""

    thresholds: np.ndarray
    weights: np.ndarray

    def beyond(self, text: bytes | None) -> np.ndarray:
        """P(grade > k) for each threshold k."""
        ids, values = features(text, self.weights != 0)
        return 1 / (1 + np.exp(np.clip(self.thresholds - self.weights[ids] @ values, -500, 500)))


def fit_ordinal(rows: np.ndarray, columns: np.ndarray, values: np.ndarray, grades: np.ndarray, n_grades: int,
                n_columns: int, penalty: float = 0.001, rounds: int = 500,
                shares: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Thresholds and weights by accelerated proximal gradient on the mean negative log likelihood.

    Columns are scaled to unit mean square, so one penalty fits all. Rows count in proportion to ``shares`` (all alike if not given).
    """
    n = len(grades)
    c = np.ones(n) if shares is None else shares / shares.mean()
    scale = np.sqrt(np.bincount(columns, c[rows] * values ** 2, n_columns) / n)
    scale[scale == 0] = 1
    x = values / scale[columns]
    v = np.ones(n_columns)
    for _ in range(20):  # largest curvature by power iteration
        v = np.bincount(columns, x * (c * np.bincount(rows, x * v[columns], n))[rows], n_columns) / n
        size = float(np.linalg.norm(v))
        if size == 0:
            break
        v /= size
    step = 1 / (0.5 * size + 1.0)
    share = np.clip(np.cumsum(np.bincount(grades, c, n_grades))[:-1] / n, 1 / (n + 2), 1 - 1 / (n + 2))
    theta = np.log(share / (1 - share)) + 1e-3 * np.arange(n_grades - 1)
    w = np.zeros(n_columns)
    ahead, t_ahead, momentum = w, theta, 1.0
    for _ in range(rounds):
        z = np.bincount(rows, x * ahead[columns], n)
        edge = np.concatenate(([-np.inf], t_ahead, [np.inf]))
        with np.errstate(over="ignore"):
            high, low = (1 / (1 + np.exp(z - edge[grades + k])) for k in (1, 0))
        p = np.maximum(high - low, 1e-12)
        d_z = c * (1 - high - low)
        up, down = c * high * (1 - high) / p, c * low * (1 - low) / p
        d_theta = (np.bincount(grades, -up, n_grades)[:-1] + np.bincount(grades, down, n_grades)[1:]) / n
        d_w = np.bincount(columns, x * d_z[rows], n_columns) / n
        new = ahead - step * d_w
        new = np.sign(new) * np.maximum(np.abs(new) - step * penalty, 0)
        t_new = np.maximum.accumulate(t_ahead - step * d_theta + 1e-6 * np.arange(n_grades - 1))
        following = (1 + np.sqrt(1 + 4 * momentum ** 2)) / 2
        pull = (momentum - 1) / following
        ahead, t_ahead = new + pull * (new - w), np.sort(t_new + pull * (t_new - theta))
        w, theta, momentum = new, t_new, following
    return theta, w / scale


def _screened(a: np.ndarray, b: np.ndarray, n1: int, n0: int, most: int, least: float = 30.0) -> np.ndarray:
    """Which features' presence depends on the class: chi-square of the 2 x 2 table, in three rows at least; the ``most`` highest.

    ``a`` of ``n1`` toxic and ``b`` of ``n0`` clean rows have the feature. Chi-square is at most the number of rows, so half of them is enough where that
    is below ``least``.
    """
    c, d = n1 - a, n0 - b
    with np.errstate(invalid="ignore", divide="ignore"):
        chi = np.nan_to_num((n1 + n0) * (a * d - b * c) ** 2 / ((a + b) * (c + d) * n1 * n0))
    kept = (chi >= min(least, (n1 + n0) / 2)) & (a + b >= 3)
    if kept.sum() > most:
        best = np.argsort(-chi * kept, kind="stable")[:most]
        kept = np.zeros_like(kept)
        kept[best] = True
    return kept


def severity_grades(amount: np.ndarray, toxic: np.ndarray, n_grades: int) -> np.ndarray:
    """Grades from two-class labels: 0 for clean rows; toxic rows by how often (``amount``) typical pieces occur, in equal parts.

    A toxic row without any is grade 1.
    """
    cuts = np.quantile(amount[toxic], np.arange(1, n_grades - 1) / (n_grades - 1)) if toxic.any() else []
    return np.where(toxic, 1 + np.searchsorted(cuts, amount, side="left"), 0)


def _sampled(docs: DataFrame, known: DataFrame, key: str, text: str, sample: int) -> tuple[DataFrame, dict]:
    """Features of the labelled sample (toxic, ids, values) as a table, and how many labelled rows a drawn one of each class stands for.

    Label keys are drawn first, then document rows where keys repeat, so about ``sample`` keys and at most about twice as many rows of a class are drawn.
    """
    sizes = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    rate = {of: min(1.0, sample / max(sizes.get(of, 0), 1)) for of in (True, False)}
    part = lambda col, share: F.pmod(F.xxhash64(col), F.lit(1_000_000)) < share * 1_000_000
    drawn = F.broadcast(known.filter(part("key", F.when(F.col("toxic"), rate[True]).otherwise(rate[False]))))  # the sample is bounded
    held = {r["toxic"]: r["count"] for r in docs.select(F.col(key).alias("key")).join(drawn, "key").groupBy("toxic").count().collect()}
    thin = {of: min(1.0, 2 * sample / max(held.get(of, 0), 1)) for of in (True, False)}

    def run(batches):
        for batch in slices(batches, 64):
            pairs = [features(t) for t in as_bytes(batch, "text")]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([i for i, _ in pairs], pa.list_(pa.int32())),
                                              pa.array([v for _, v in pairs], pa.list_(pa.float32()))], names=["toxic", "ids", "values"])

    rows = (docs.select(F.col(key).alias("key"), F.col(text).cast("binary").alias("text"), F.monotonically_increasing_id().alias("row"))
            .join(drawn, "key").filter(part("row", F.when(F.col("toxic"), thin[True]).otherwise(thin[False]))))
    found = rows.select("toxic", "text").mapInArrow(run, "toxic boolean, ids array<int>, values array<float>")
    return written(found, "toxicity-sample"), {of: 1 / (rate[of] * thin[of]) for of in (True, False)}


def fit(docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", label: str = "toxic",
        n_grades: int = 4, sample: int = 3000, most_features: int = 4096) -> Ordinal:
    """The ordinal model of a bounded labelled sample."""
    known = (labels.filter(F.col(label).isNotNull() & F.col(key).isNotNull()).groupBy(F.col(key).alias("key"))
             .agg(F.max(F.col(label).cast("int") > 0).alias("toxic")))
    none = Ordinal(np.full(n_grades - 1, 40.0) + np.arange(n_grades - 1), np.zeros(1 << HASH_BITS))
    if not known.filter("toxic").take(1):
        return none
    rows, stands_for = _sampled(docs, known, key, text, sample)
    counts = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    if not counts:
        return none
    # one row per hashed feature at most
    present = (rows.select("toxic", F.explode("ids").alias("feature")).groupBy("feature")
               .agg(F.count_if("toxic").alias("a"), F.count_if(~F.col("toxic")).alias("b")).toArrow())
    a, b = np.zeros(1 << HASH_BITS), np.zeros(1 << HASH_BITS)
    at = present.column("feature").to_numpy()
    a[at], b[at] = present.column("a").to_numpy(), present.column("b").to_numpy()
    n1, n0 = counts.get(True, 0), counts.get(False, 0)
    kept = _screened(a, b, n1, n0, most_features)
    # typical of toxic rows: at least ten times as frequent among them
    typical = (a >= 3) & (a / max(n1, 1) >= 10 * b / max(n0, 1))
    shared = docs.sparkSession.sparkContext.broadcast((kept, typical))

    def run(batches):
        kept, typical = shared.value
        for batch in slices(batches, 64):
            out = []
            for ids, values in zip(batch.column(1), batch.column(2), strict=True):
                i, v = ids.values.to_numpy(), values.values.to_numpy()
                out.append((float(np.exp(v.astype(float) - 1) @ typical[i]), i[kept[i]], v[kept[i]]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x[0] for x in out], pa.float64()), pa.array([x[1] for x in out], pa.list_(pa.int32())),
                                              pa.array([x[2] for x in out], pa.list_(pa.float32()))], names=["toxic", "amount", "ids", "values"])

    # the sample's rows, with kept features only
    chosen = rows.mapInArrow(run, "toxic boolean, amount double, ids array<int>, values array<float>").toArrow()
    toxic = chosen.column("toxic").to_numpy().astype(bool)
    ids, values = chosen.column("ids").combine_chunks(), chosen.column("values").combine_chunks()
    held = np.repeat(np.arange(len(toxic)), np.diff(ids.offsets.to_numpy()))
    number = np.cumsum(kept) - 1
    theta, own = fit_ordinal(held, number[ids.flatten().to_numpy()], values.flatten().to_numpy().astype(float),
                             severity_grades(chosen.column("amount").to_numpy(), toxic, n_grades), n_grades, max(int(kept.sum()), 1),
                             shares=np.where(toxic, stands_for[True], stands_for[False]))
    weights = np.zeros(1 << HASH_BITS)
    weights[kept] = own[:int(kept.sum())]
    return Ordinal(theta, weights)


def score(docs: DataFrame, model: Ordinal, *, key: str = "doc_id", text: str = "text", most: float = 0.35) -> DataFrame:
    """Per row: key, expected_severity, grade (most probable), p_toxic (P(grade > 0)), toxic (p_toxic >= ``most``)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in slices(batches):
            beyond = np.array([shared.value.beyond(t) for t in as_bytes(batch, "text")]).reshape(batch.num_rows, -1)
            exact = np.concatenate([np.ones((len(beyond), 1)), beyond], 1) - np.concatenate([beyond, np.zeros((len(beyond), 1))], 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(beyond.sum(axis=1)), pa.array(exact.argmax(axis=1).astype(np.int32)), pa.array(beyond[:, 0]),
                 pa.array(beyond[:, 0] >= most)], names=["key", "expected_severity", "grade", "p_toxic", "toxic"])

    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("binary").alias("text"))
    kind = docs.schema[key].dataType.simpleString()
    out = rows.mapInArrow(run, f"key {kind}, expected_severity double, grade int, p_toxic double, toxic boolean")
    return out.withColumnRenamed("key", key)


def reject(docs: DataFrame, model: Ordinal, *, text: str = "text", most: float = 0.35) -> DataFrame:
    """``docs``, same columns, without the rows whose P(grade > 0) is ``most`` or more."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in slices(batches):
            keep = [bool(shared.value.beyond(t)[0] < most) for t in as_bytes(batch, text)]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
