"""Quality scores by positive-unlabelled learning with the non-negative unbiased risk.

Trusted positives and unlabelled web text are all the training needs. A first classifier of positives
against unlabelled text gives the class prior: above a high score nearly all text is positive, so the
least ratio of the two tails bounds the share of positives in the unlabelled text. A linear model on
text statistics then minimises  prior * R+(P) + max(0, R-(U) - prior * R-(P))  with the logistic loss.

Training uses at most ``SAMPLE`` positives and twice as many unlabelled texts, those with the smallest
hash of their id, in one task; scoring covers every text. Score inputs come from the text alone.

Null and empty texts get the score of the empty text. Rows without an id are never trained on. A text
with several labels is a positive only if all of them are. Ties and repeated rows are scored row by
row. Without positives (also: empty tables) the score is 0.5. Columns beside id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import blocks, fresh_name, mixed, ship, words_of

#: Bound on the positives that training reads; unlabelled texts are bounded by twice as many.
SAMPLE = 8_000
#: Buckets of the hashed word shares.
BUCKETS = 256
#: Bytes of text described at once; the arrays over them take some thirty times as much, in every worker.
BLOCK = 1 << 20
_LAGS = (1, 2, 3, 4, 5, 6, 8)
_STEPS = 250
_DECAY = 3e-3


def features(documents: list[bytes]) -> np.ndarray:
    """One row of text statistics for each text: byte shares, hashed word shares, lengths and repetition."""
    n = len(documents)
    lengths = np.fromiter(map(len, documents), dtype=np.int64, count=n)
    histogram = np.stack([np.bincount(np.frombuffer(d, dtype=np.uint8), minlength=256) for d in documents])
    shares = np.sqrt(histogram / np.maximum(lengths, 1)[:, None])
    hashes, owner, first, end = words_of(documents)
    count = np.bincount(owner, minlength=n)
    per = np.maximum(count, 1)
    slot = (hashes % np.uint64(BUCKETS)).astype(np.int64)
    words = np.sqrt(np.bincount(owner * BUCKETS + slot, minlength=n * BUCKETS).reshape(n, BUCKETS) / per[:, None])
    size = np.bincount(owner, weights=end - first, minlength=n) / per
    same = []
    for lag in _LAGS:
        equal = (hashes[lag:] == hashes[:-lag]) & (owner[lag:] == owner[:-lag])
        same.append(np.bincount(owner[lag:][equal], minlength=n) / per)
    # A word's key holds its text, so distinct keys of a block are the distinct words of its texts.
    keys = np.unique(mixed(hashes ^ mixed(owner.astype(np.uint64) + np.uint64(1))), return_index=True)[1]
    distinct = np.bincount(owner[keys], minlength=n) / per
    return np.column_stack([shares, words, np.log1p(lengths), np.log1p(count), size, distinct, *same]).astype(np.float32)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))


def _softplus(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0.0, z)


class _Adam:
    def __init__(self, size: int, rate: float) -> None:
        self.m, self.v, self.t, self.rate = np.zeros(size), np.zeros(size), 0, rate

    def step(self, gradient: np.ndarray) -> np.ndarray:
        self.t += 1
        self.m = 0.9 * self.m + 0.1 * gradient
        self.v = 0.999 * self.v + 0.001 * gradient**2
        return self.rate * (self.m / (1 - 0.9**self.t)) / (np.sqrt(self.v / (1 - 0.999**self.t)) + 1e-8)


def class_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """Share of positives in unlabelled text, from the scores of both under a positive-against-unlabelled model.

    The least ratio of the tails P[unlabelled >= t] / P[positive >= t], over thresholds that leave half
    of the positives or more. The scores must come from a model that has not seen these texts.
    """
    cuts = np.quantile(positive, np.linspace(0.0, 0.5, 51))
    tails = [(np.mean(unlabelled >= c), np.mean(positive >= c)) for c in cuts]
    return float(np.clip(min(u / p for u, p in tails if p > 0), 0.02, 0.98))


def _descend(p: np.ndarray, u: np.ndarray, prior: float | None, steps: int) -> np.ndarray:
    """Minimise the non-negative risk with a prior, or plain positive-against-unlabelled risk without one."""
    w, adam = np.zeros(p.shape[1], dtype=np.float32), _Adam(p.shape[1], 0.02)
    for _ in range(steps):
        zp, zu = p @ w, u @ w
        up, down, web = (x.T @ s / len(x) for x, s in ((p, 1 - _sigmoid(zp)), (p, _sigmoid(zp)), (u, _sigmoid(zu))))
        if prior is None:
            gradient = web - up
        elif _softplus(zu).mean() >= prior * _softplus(zp).mean():
            gradient = web - prior * down - prior * up
        else:  # the negative risk fell below zero, which only overfitting can do: step back up
            gradient = prior * down - web
        w = w - adam.step(gradient + _DECAY * w).astype(np.float32)
    return w


def fit(positive: np.ndarray, unlabelled: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights on raw features (the last is the bias) and the estimated class prior."""
    mean, spread = unlabelled.mean(axis=0), unlabelled.std(axis=0) + 0.01
    ready = lambda x: np.column_stack([np.clip((x - mean) / spread, -6, 6), np.ones(len(x), dtype=np.float32)])
    p, u = ready(positive), ready(unlabelled)
    # Each half is scored by a model of the other half.
    halves = [(_descend(p[i::2], u[i::2], None, _STEPS // 3), 1 - i) for i in (0, 1) if len(p) > 1 and len(u) > 1]
    priors = [class_prior(p[i::2] @ w, u[i::2] @ w) for w, i in halves]
    prior = float(np.mean(priors)) if priors else 0.5
    return np.concatenate([mean, spread, _descend(p, u, prior, _STEPS)]), prior


def _score(documents: list[bytes], weights: np.ndarray) -> np.ndarray:
    x = features(documents)
    k = x.shape[1]
    mean, spread, w = weights[:k], weights[k : 2 * k], weights[2 * k :]
    return _sigmoid(np.clip((x - mean) / spread, -6, 6) @ w[:-1] + w[-1])


def held_out(key: Column) -> Column:
    """Rows whose labels are never learnt from: crc32 of the id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _threshold(ids: DataFrame, limit: int) -> int | None:
    """The largest of the ``limit`` smallest hashes, so that a scan can pick those rows without a join."""
    return ids.select(F.xxhash64("key").alias("h")).distinct().orderBy("h").limit(limit).agg(F.max("h")).first()[0]


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality") -> np.ndarray | None:
    """Weights from a bounded sample of rows that are not held out; None without positives or texts."""
    spark = ship(docs.sparkSession)
    open_rows = F.col("key").isNotNull() & ~held_out(F.col("key"))
    trusted = labels.select(F.col(key).alias("key"), F.col(label).alias("label")).where(open_rows)
    trusted = trusted.groupBy("key").agg(F.min("label").alias("label")).where("label = 1").select("key")
    web = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).where(open_rows)
    positives_to, web_to = _threshold(trusted, SAMPLE), _threshold(web, 2 * SAMPLE)
    if positives_to is None or web_to is None:
        return None
    chosen = trusted.where(F.xxhash64("key") <= positives_to).withColumn("positive", F.lit(True))
    rows = web.join(F.broadcast(chosen), "key", "left")  # at most SAMPLE ids
    rows = rows.select("text", F.col("positive").isNotNull().alias("positive"), (F.xxhash64("key") <= web_to).alias("web"))
    rows = rows.where("positive or web")

    def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, held in blocks(batch.column(0), BLOCK):
                x = features(held)
                cut = batch.slice(start, len(held))
                yield pa.RecordBatch.from_arrays([pa.array([r.tobytes() for r in x], pa.binary()), cut.column(1), cut.column(2)], ["x", "positive", "web"])

    def learnt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        xs, positive, web = [], [], []
        for batch in batches:
            xs += [np.frombuffer(v.as_py(), dtype=np.float32) for v in batch.column(0)]
            positive += batch.column(1).to_pylist()
            web += batch.column(2).to_pylist()
        if any(positive) and any(web):
            x = np.stack(xs)
            order = np.lexsort(x.T[:8])  # the fit must not depend on the order in which rows arrive
            x, positive, web = x[order], np.array(positive)[order], np.array(web)[order]
            weights, prior = fit(x[positive], x[web])
            yield pa.RecordBatch.from_arrays([pa.array([weights.tolist()], pa.list_(pa.float64())), pa.array([prior])], ["weights", "prior"])

    vectors = rows.mapInArrow(described, "x binary, positive boolean, web boolean")
    # The sample is bounded, so one task can hold it.
    model = vectors.repartition(1).mapInArrow(learnt, "weights array<double>, prior double").collect()
    return np.array(model[0]["weights"]) if model else None


def scored(docs: DataFrame, weights: np.ndarray | None, text: str = "text", score: str = "score") -> DataFrame:
    """``docs`` with a column of scores, from 0 to 1 and higher for better texts."""
    ship(docs.sparkSession)

    @F.arrow_udf("double")
    def rate(column: pa.Array) -> pa.Array:
        parts = [np.zeros(0)]
        for _, held in blocks(column, BLOCK):
            parts.append(np.full(len(held), 0.5) if weights is None else _score(held, weights))
        return pa.array(np.concatenate(parts))

    return docs.withColumn(score, rate(F.col(text)))


def good(docs: DataFrame, weights: np.ndarray | None, text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text scores 0.5 or more, with their columns."""
    score = fresh_name(docs, "score")
    return scored(docs, weights, text, score).where(F.col(score) >= 0.5).drop(score)
