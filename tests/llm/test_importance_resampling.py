"""Resampling towards a target against a brute-force version, and its cutoffs and ranks on ties."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest

from tests.llm.conftest import prose
from tidelog.llm import importance_resampling as ir


def features(text: str | None, runs: int) -> tuple[int, list[str]]:
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return len(words), [" ".join(words[i : i + n]) for n in range(1, runs + 1) for i in range(len(words) - n + 1)]


def bucket(feature: str) -> int:
    return zlib.crc32(feature.encode()) % 10_000


def brute(rows, target, percent, runs=1):
    bags = [(i, *features(t, runs)) for i, t in rows]
    s = Counter(bucket(f) for _, _, fs in bags for f in fs)
    t = Counter(bucket(f) for text in target for f in features(text, runs)[1])
    big_s, big_t = sum(s.values()) + 10_000, sum(t.values()) + 10_000
    scored = []
    for i, n_words, fs in bags:
        gain = sum(math.floor(1000 * math.log((t[bucket(f)] + 1) * big_s / ((s[bucket(f)] + 1) * big_t))) for f in fs)
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = gain // len(fs) if fs else 0
        scored.append([n_words, i, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    able = sorted((r for r in scored if r[0] >= 20), key=lambda r: (-r[4], math.inf if r[1] is None else r[1]))
    rank = {id(r): k + 1 for k, r in enumerate(able[: len(able) * percent // 100])}
    return sorted(((*r[1:], rank.get(id(r))) for r in scored), key=repr)


def got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=repr)


@pytest.mark.parametrize("runs", [1, 3])
def test_equals_brute_force(spark, hard_docs, hard_rows, runs):
    target = [prose(2, 40), None, "", "ΑΣ naïve one TWO"]
    bench = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id long, text string")
    for percent in (0, 10, 55, 100):
        out = ir.resampled(hard_docs, bench, percent, runs=runs)
        assert out.columns == ["doc_id", "n_features", "weight", "score", "rank"]
        assert got(out) == brute(hard_rows, target, percent, runs), percent


def test_many_rows_over_several_ranges(spark, monkeypatch):
    monkeypatch.setattr(ir, "RANGE", 40)
    rows = [(i, prose(i % 90, 15 + i % 20)) for i in range(600)]
    target = [prose(i, 30) for i in range(5)]
    docs = spark.createDataFrame(rows, "doc_id int, text string").repartition(5)
    out = ir.resampled(docs, spark.createDataFrame([(t,) for t in target], "text string"), 30)
    assert dict(out.dtypes)["doc_id"] == "int"
    assert got(out) == brute(rows, target, 30)


def test_ties_and_repeated_rows_are_drawn_to_the_number(spark):
    rows = [(7, prose(1, 30))] * 50 + [(8, prose(1, 30))] * 3
    out = ir.resampled(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([], "text string"), 40).collect()
    assert len(out) == 53 and sorted(r["rank"] for r in out if r["rank"]) == list(range(1, 22))


def test_cutoff_is_the_row_at_the_place(spark):
    rng = random.Random(3)
    rows = [(rng.randint(-5, 5), rng.choice([-(1 << 63), 0, 3, (1 << 63) - 1]), i) for i in range(200)]
    df = spark.createDataFrame(rows, "a long, b long, c long").cache()
    for place in (1, 2, 57, 199, 200):
        at = ir.cutoff(df, ["a", "b", "c"], place)
        assert df.where(ir.up_to(["a", "b", "c"], at)).count() == place
        assert tuple(at) == sorted(rows)[place - 1][: len(at)]


def test_long_texts_are_read_in_pieces(monkeypatch):
    monkeypatch.setattr(ir, "PIECE", 50)
    text = prose(5, 400) + " ά" * 70 + "x" * 300
    found = list(ir.Buckets(3).of(text.encode()))
    n_words, expected = features(text, 3)
    assert sum(n for n, _ in found) == n_words and len(found) > 20
    assert Counter(b for _, bs in found for b in bs.tolist()) == Counter(map(bucket, expected))


def test_empty_tables_and_text_keys(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert ir.resampled(none, none, 10).collect() == []
    with pytest.raises(ValueError, match="whole numbers"):
        ir.resampled(spark.createDataFrame([("a", "b")], "doc_id string, text string"), none, 10)
