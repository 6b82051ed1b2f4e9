"""Base patterns against the regular expressions themselves, and the spans that the field adds."""

from __future__ import annotations

import hashlib
import random
import re
from itertools import product

import numpy as np
import pytest

from tests.llm.conftest import prose
from tidelog.llm import semi_markov_pii as pii
from tidelog.llm.pii_patterns import KINDS, base_spans, digits_of, listed, luhn

# The base patterns.
PATTERNS = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(p) <= 255 for p in s.split("."))),
    "card": (r"[0-9]([\x20-]?[0-9])+", lambda s: 13 <= len(digits_of(s)) <= 19 and luhn(digits_of(s))),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 9 <= len(digits_of(s)) <= 15),
}


def brute(text: str) -> list:
    return [(kind, *m.span()) for kind in KINDS for m in re.finditer(PATTERNS[kind][0], text) if PATTERNS[kind][1](m[0])]


def card(rng: random.Random) -> str:
    body = "4" + "".join(str(rng.randrange(10)) for _ in range(14))
    return next(body + str(d) for d in range(10) if luhn(body + str(d)))


def personal(seed: int) -> str:
    rng = random.Random(seed)
    datum = rng.choice((
        f"{prose(seed, 1)}.{rng.randrange(99)}@mail{rng.randrange(9)}.example.com", ".".join(str(rng.randrange(1, 256)) for _ in range(4)),
        card(rng), f"+1 ({rng.randrange(200, 999)}) 555-{rng.randrange(1000, 9999)}", f"password={hashlib.md5(str(seed).encode()).hexdigest()[:18]}",
    ))
    return f"{prose(seed, 12)} {datum} {prose(seed + 1, 12)}"


@pytest.fixture(scope="module")
def weights():
    return pii.fit([personal(i) for i in range(260)])


def test_base_spans_equal_the_patterns():
    rng = random.Random(1)
    for _ in range(20_000):
        text = "".join(rng.choice("a1.2@3 -+(4)5%0é\n") for _ in range(rng.randint(0, 40)))
        assert base_spans(text) == brute(text), text


def test_long_runs_take_linear_time():
    for text in ("9" * 200_000, "a" * 200_000 + "@", "1." * 100_000, "+1" * 100_000, "a@" * 100_000):
        base_spans(text)


def test_added_spans(weights):
    found = lambda t: [(k, t[s:e]) for k, s, e in pii.added_spans(t, base_spans(t), weights)]
    assert found("please call (415) 555-2671 now") == [("phone", "(415) 555-2671")]
    assert found("my card 4111.1111.1111.1111 ok") == [("card", "4111.1111.1111.1111")]
    assert ("secret", "password=9f8e7d6c5b4a39281706") in found("the password=9f8e7d6c5b4a39281706 here")
    for clean in (prose(5, 300), "on 2024-05-06 12:30:55 at noon", "order 1234567 of 98765432", "version 1.2.3", "population 1,234,567,890"):
        assert found(clean) == []


def test_secrets_with_few_digits_and_short_spelled_addresses(weights):
    found = lambda t: [(k, t[s:e]) for k, s, e in pii.added_spans(t, base_spans(t), weights)]
    rng = random.Random(9)
    letters = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"
    for n in range(7):
        for size in (16, 20, 24, 30):
            value = rng.choices(letters, k=size)
            for at in rng.sample(range(size), n):
                value[at] = str(rng.randrange(10))
            for name in ("password=", 'token = "', "api_key: ", "the_secret="):
                text = f"{prose(n, 8)} {name}{''.join(value)} {prose(size, 8)}"
                assert [k for k, _ in found(text)] == ["secret"] and found(text)[0][1].endswith("".join(value)), text
                assert "".join(value) not in pii.mask(text, weights)
    for value in ("correcthorsebattery", "abcdefghijkl"):
        assert value not in pii.mask(f"alpha password={value} omega", weights)
    for text in ('what token = "AbCdEfGhIjKlMnOpQ"### the', '{"api_key":"abcdefGhIjklmnop","n":1}', "at https://h.example/?token=QwErTyUiOpAsDfGh&n=1 now"):
        assert not re.search("AbCdEfGhIjKlMnOpQ|abcdefGhIjklmnop|QwErTyUiOpAsDfGh", pii.mask(text, weights))
    for address in ("10[.]0[.]0[.]1", "1[.]2[.]3[.]4", "10 dot 0 dot 0 dot 1", "8(.)8(.)8(.)8"):
        assert found(f"from {address} at night") == [("ip", address)]
    for clean in ("the password must be changed today", "a token of appreciation", "secretary of understanding", "see part-2-of-the-series there", "keyboard and tokens are 3 and 4"):
        assert found(clean) == []


def test_secrets_of_any_length(weights):
    rng = random.Random(12)
    letters = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789_-"
    for size in (12, 60, 100, 119, 130, 200, 300, 1000, 5000):
        value = "Ab9" + "".join(rng.choices(letters, k=size - 3))
        for name in ("password=", "password: ", 'api_key = "', "token="):
            assert value not in pii.mask(f"{prose(size, 8)} {name}{value} {prose(size + 1, 8)}", weights), (name, size)
    value = "Xy7" + "q" * 400_000
    assert pii.mask(f"one password={value} two", weights).startswith("one <SECRET>")


def test_long_words_with_many_marks_take_linear_time(weights):
    import time

    text = " ".join(("x" * 150 + "12") * 4_000 for _ in range(2))
    start = time.perf_counter()
    pii.mask(text, weights)
    assert time.perf_counter() - start < 30


def test_added_spans_leave_base_spans_alone(weights):
    for seed in range(300, 360):
        text = personal(seed) + " " + personal(seed + 100)
        base = base_spans(text)
        for _, s, e in pii.added_spans(text, base, weights):
            assert all(e <= b or s >= t for _, b, t in base)


def test_decoding_is_the_best_of_all_segmentations(weights):
    text = "a1 415 555 2671 99 x@y.z b"
    stretch = pii.Stretch(text, 0, len(text))
    scores = stretch.x @ weights
    best, n = 0.0, len(stretch.segments)
    for chosen in product((0, 1), repeat=min(n, 14)):
        taken = [stretch.segments[k] for k in range(len(chosen)) if chosen[k]]
        if all(a[1] <= b[0] or b[1] <= a[0] for i, a in enumerate(taken) for b in taken[i + 1 :]):
            best = max(best, sum(scores[k].max() for k in range(len(chosen)) if chosen[k]))
    places = {(s[2], s[3]): k for k, s in enumerate(stretch.segments)}
    value = sum(scores[places[b, e]].max() for _, b, e in stretch.best(weights))
    assert value >= best - 1e-9


def test_gradient_is_that_of_the_likelihood(weights):
    text = "call 415 555 2671 now"
    stretch, gold = pii.Stretch(text, 0, len(text)), [("phone", 5, 17)]
    rng = np.random.default_rng(3)
    w = rng.normal(0, 0.2, weights.shape)

    def likelihood(w: np.ndarray) -> float:
        scores = stretch.x @ w
        total = np.zeros(len(stretch.words) + 1)
        for j in range(1, len(total)):
            ways = [total[j - 1]] + [total[stretch.segments[k][0]] + np.logaddexp.reduce(scores[k]) for k in stretch.by_end.get(j, ())]
            total[j] = np.logaddexp.reduce(ways)
        k = next(k for k, s in enumerate(stretch.segments) if s[2:] == (5, 17))
        return scores[k, pii.ALL.index("phone")] - total[-1]

    g = stretch.gradient(w, gold)
    for i, j in [(0, 3), (3, 3), (28, 0), (0, 2)]:
        step = np.zeros_like(w)
        step[i, j] = 1e-5
        assert abs((likelihood(w + step) - likelihood(w - step)) / 2e-5 - g[i, j]) < 1e-5


def test_tables(spark, hard_docs, hard_rows):
    rows = [*((1000 + i, personal(i)) for i in range(80)), *hard_rows]
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, key int")
    w = pii.train(docs)
    got = sorted(map(tuple, pii.spans(docs, w).select("doc_id", *(f"n_{k}" for k in KINDS), "base_sha256").collect()), key=str)
    base = [(i, brute(t or "")) for i, t in rows]
    wanted = [(i, *(sum(k == s[0] for s in b) for k in KINDS), hashlib.sha256(listed(b).encode()).hexdigest()) for i, b in base]
    assert got == sorted(wanted, key=str)
    masked = pii.masked(docs, w)
    assert masked.columns == docs.columns and masked.count() == len(rows)
    assert not any(base_spans(r.text or "") for r in masked.collect())
    assert pii.train(hard_docs.limit(0)) is None and pii.spans(hard_docs.limit(0), w).count() == 0
    assert pii.masked(hard_docs, None).where("text is null").count() == 1


def test_a_kind_that_fills_the_sample_does_not_crowd_out_the_others():
    rng = random.Random(1)
    log = [f"{prose(i, 6)} {rng.randrange(256)}.{rng.randrange(256)}.0.{rng.randrange(256)} {prose(i + 1, 6)}" for i in range(1500)]
    w = pii.fit([*log, *(personal(i) for i in range(200))])
    hidden = [f"{prose(i, 8)} {form} {prose(i + 1, 8)}" for i in range(40) for form in (f"({200 + i}) 555-{1000 + i}", f"{prose(i, 1)} [at] mail{i} [dot] example [dot] com")]
    found = [bool(pii.added_spans(t, base_spans(t), w)) for t in hidden]
    assert np.mean(found[::2]) >= 0.9 and np.mean(found[1::2]) >= 0.9
