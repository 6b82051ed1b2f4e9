"""Order MinHash against the same sketch worked out in plain Python."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

from pyspark.sql import functions as F

from tests.llm.conftest import prose
from tidelog.llm import order_minhash as omh


def sketch(spark, text: str) -> list[int]:
    """Slots by plain loops; only the hash function itself is Spark's."""
    words = [p for w in re.findall(r"\S+", text) for p in ([w] if len(w) <= 16 else [w[i : i + 4] for i in range(len(w) - 3)])]
    n = max(len(words) - omh.K, 0) + 1 if words else 0
    grams = [words[i : i + omh.K] + [None] * (omh.K - len(words[i : i + omh.K])) for i in range(n)]
    schema = ", ".join(f"w{j} string" for j in range(omh.K))
    frame = spark.createDataFrame([tuple(g) for g in grams], schema) if grams else None
    hashes = [r[0] & (2**64 - 1) for r in frame.coalesce(1).select(F.xxhash64(*frame.columns)).collect()] if frame else []
    short = [h >> (64 - 33) for h in hashes]
    seen: Counter = Counter()
    placed, again = [], []
    for i, h in enumerate(short):
        (placed if not seen[h] else again).append((h, seen[h], i))
        seen[h] += 1
    if again:
        frame = spark.createDataFrame([(h, o) for h, o, _ in again], "h long, o int").coalesce(1)
        rehashed = [(r[0] & (2**64 - 1)) >> 31 for r in frame.select(F.xxhash64("h", "o")).collect()]
        again = [(h, 0, i) for h, (_, _, i) in zip(rehashed, again, strict=True)]
    members = sorted((h, i) for h, _, i in [*placed, *again])
    out = [-1] * omh.SLOTS
    for s in range(omh.SLOTS if members else 0):
        start = next((j for j, (h, _) in enumerate(members) if h >> 28 >= s), 0)
        held = [members[(start + t) % len(members)] for t in range(min(omh.TUPLE, len(members)))]
        frame = spark.createDataFrame([([h for h, _ in sorted(held, key=lambda m: (m[1], m[0]))],)], "t array<long>")
        out[s] = frame.select(F.xxhash64("t")).first()[0] & 0xFFFFFFFF
    return out


def test_fingerprint_equals_plain_loops(spark):
    for text in ("", "one", "a b a b a b a b c", prose(1, 60), "word " * 40, "x" * 100, "中文" * 30 + " abc " + "é" * 17):
        got = spark.createDataFrame([(text,)], "t string").select(omh.fingerprint(F.col("t"))).first()[0]
        assert got == sketch(spark, text), text


def test_order_matters_and_edits_keep_likeness(spark):
    words = prose(5, 400).split()
    swapped = words[200:] + words[:200]
    shuffled = words.copy()
    shuffled[1::2] = reversed(shuffled[1::2])
    rows = [(" ".join(words), " ".join(words[:380])), (" ".join(words), " ".join(swapped)), (" ".join(words), " ".join(shuffled)), ("", ""), ("", "a")]
    frame = spark.createDataFrame(rows, "a string, b string")
    short, moved, mixed, none, one = (r[0] for r in frame.select(omh.likeness(omh.fingerprint(F.col("a")), omh.fingerprint(F.col("b")))).collect())
    assert short > 0.7 and moved < short and mixed < 0.1
    assert none == 1.0 and one == 0.0


def test_edited_texts_and_next_rows(spark, monkeypatch, hard_docs):
    monkeypatch.setattr(omh, "BUCKET_CHARS", 500)
    rows = [(i * 7 - 90, prose(i, 5 + i % 50) if i % 9 else None) for i in range(120)]
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, bucket int")
    got = {r.doc_id: r for r in omh.fingerprints(docs).collect()}
    texts = [t or "" for _, t in rows]
    for k, (i, _) in enumerate(rows):
        text, after = texts[k], texts[(k + 1) % len(texts)]
        cut = len(text) // 4
        edited = text[: len(text) - cut] + after[:cut]
        row = got[i]
        assert row.n_chars == len(text) and row.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        after_print = got[rows[(k + 1) % len(rows)][0]].fingerprint
        slots = [(row.fingerprint[j : j + 8], after_print[j : j + 8]) for j in range(0, 256, 8)]
        filled = [p for p in slots if p != ("--------", "--------")]
        assert row.near_next == (sum(a == b for a, b in filled) / len(filled) if filled else 1.0)
    assert len({got[i].fingerprint for i, t in rows if not t}) == 1

    hard = omh.fingerprints(hard_docs).collect()
    assert len(hard) == hard_docs.count() and all(0 <= r.near_edited <= 1 for r in hard)
    assert omh.fingerprints(hard_docs.limit(0)).count() == 0
    (alone,) = omh.fingerprints(docs.limit(1).withColumn("text", F.lit("abcdefgh"))).collect()
    assert alone.edited_sha256 == hashlib.sha256(b"abcdefab").hexdigest() and alone.near_next == 1.0


def likenesses(spark, pairs):
    frame = spark.createDataFrame(pairs, "a string, b string")
    return [r[0] for r in frame.select(omh.likeness(omh.fingerprint(F.col("a")), omh.fingerprint(F.col("b")))).collect()]


def test_edits_of_short_and_unspaced_texts_lower_the_likeness_step_by_step(spark):
    rng = random.Random(6)
    for n in (10, 20, 50):
        words = [prose(1000 + n * 100 + i, 1) for i in range(n)]
        rows = []
        for edits in (0, 1, n // 5, n):
            for _ in range(12):
                new = words.copy()
                for at in rng.sample(range(n), edits):
                    new[at] = f"w{rng.randrange(9999)}"
                rows.append((" ".join(words), " ".join(new)))
        got = likenesses(spark, rows)
        means = [sum(got[i : i + 12]) / 12 for i in range(0, 48, 12)]
        assert means[0] == 1.0 and means == sorted(means, reverse=True) and means[1] > 0.4 and means[3] < 0.1, (n, means)
    for n in (8, 20, 40):
        words = [prose(5000 + n * 100 + i, 1) for i in range(n)]
        (swapped,) = likenesses(spark, [(" ".join(words), " ".join(words[n // 2 :] + words[: n // 2]))])
        assert swapped < 0.75, (n, swapped)
    han = "".join(chr(0x4E00 + rng.randrange(3000)) for _ in range(400))
    one, some, half, other = likenesses(spark, [(han, "x" + han), (han, han[:100] + "中" + han[102:300] + han[310:]), (han, han[:200]), (han, han[::-1])])
    assert one > 0.8 and one >= some > half > 0.1 and other < 0.1
