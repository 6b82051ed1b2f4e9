"""Positive-unlabelled quality: held-out accuracy, the prior, and rows that need care."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

from tests.llm.conftest import prose
from tidelog.llm import pu_quality


def junk(seed: int, n: int) -> str:
    rng = random.Random(seed)
    word = prose(seed, 1)
    return rng.choice((" ".join([word] * n), " | ".join(prose(seed, n).split()), prose(seed, n).upper().replace(" ", "!! ")))


@pytest.fixture(scope="module")
def labelled(spark):
    rows = [(i, junk(i, 60) if i % 6 == 0 else prose(i, 80), int(i % 6 != 0)) for i in range(1500)]
    docs = spark.createDataFrame([(i, t, 3) for i, t, _ in rows], "doc_id long, text string, score int")
    labels = spark.createDataFrame([(i, q) for i, _, q in rows if i % 2], "doc_id long, quality int")
    return rows, docs, labels


def held_out(i: int) -> bool:
    return zlib.crc32(str(i).encode()) % 3 == 1


def test_held_out_accuracy(labelled):
    rows, docs, labels = labelled
    weights = pu_quality.train(docs, labels)
    got = pu_quality.scored(docs.drop("score"), weights).withColumn("held_out", pu_quality.held_out(docs["doc_id"])).collect()
    truth = {i: q for i, _, q in rows}
    assert all(r.held_out == held_out(r.doc_id) and 0 <= r.score <= 1 for r in got)
    assert np.mean([(r.score >= 0.5) == truth[r.doc_id] for r in got if r.held_out]) > 0.97
    kept = pu_quality.good(docs, weights)
    assert kept.columns == docs.columns
    assert kept.count() == sum(r.score >= 0.5 for r in got)


def test_held_out_labels_change_nothing(spark, labelled):
    rows, docs, labels = labelled
    other = spark.createDataFrame([(i, 1 - q if held_out(i) else q) for i, _, q in rows if i % 2], "doc_id long, quality int")
    assert np.array_equal(pu_quality.train(docs, labels), pu_quality.train(docs, other))


def test_prior_estimate():
    rng = np.random.default_rng(4)
    for share in (0.3, 0.6, 0.9):
        positive = rng.normal(1, 1, 20_000)
        unlabelled = np.concatenate([rng.normal(1, 1, int(20_000 * share)), rng.normal(-3, 1, int(20_000 * (1 - share)))])
        assert abs(pu_quality.class_prior(positive, unlabelled) - share) < 0.06


def test_risk_never_rewards_a_negative_part():
    rng = np.random.default_rng(5)
    p, u = rng.normal(1, 1, (300, 4)).astype(np.float32), rng.normal(0.9, 1, (300, 4)).astype(np.float32)
    weights, prior = pu_quality.fit(p, u)
    assert np.isfinite(weights).all() and 0 < prior < 1


def test_hard_rows(spark, hard_docs):
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 1), (3, 1), (None, 1), (9, None), (10, 1), (11, 1), (13, 0)], "doc_id long, quality int")
    weights = pu_quality.train(hard_docs, labels)
    scores = pu_quality.scored(hard_docs, weights, score="rating").collect()
    assert len(scores) == hard_docs.count() and all(0 <= r.rating <= 1 for r in scores)
    empties = {r.rating for r in scores if not r.text}
    assert len(empties) == 1
    assert pu_quality.train(hard_docs.limit(0), labels) is None
    assert pu_quality.train(hard_docs, labels.limit(0)) is None
    assert {r.score for r in pu_quality.scored(hard_docs.drop("score"), None).collect()} == {0.5}
