"""Near-duplicate groups against all pairs compared."""

from __future__ import annotations

import random
import re
from itertools import combinations

import numpy as np
import pytest

from tests.llm.conftest import prose
from tidelog.llm import components as links
from tidelog.llm.tensored_minhash import _prefixes, near_duplicates


def shingles(text: str | None, size: int) -> frozenset:
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(zip(*(words[i:] for i in range(size)), strict=False)) if len(words) >= size else frozenset([tuple(words)] if words else [])


def brute(rows: list[tuple[int, str | None]], size: int) -> dict[int, tuple[int, int, bool]]:
    sets = {i: shingles(t, size) for i, t in rows}
    least = {i: i for i in sets}

    def top(i: int) -> int:
        while least[i] != i:
            i = least[i]
        return i

    for a, b in combinations(sorted(sets), 2):
        x, y = sets[a], sets[b]
        if x and y and 100 * len(x & y) >= 80 * len(x | y):
            low, high = sorted((top(a), top(b)))
            least[high] = low
    return {i: (len(s), top(i), top(i) == i) for i, s in sets.items()}


def corpus() -> list[tuple[int, str]]:
    """Groups of edited copies around the limit, chains of edits, and texts that share a long passage."""
    rng = random.Random(8)
    rows, passage = [], prose(77, 60)
    for group in range(12):
        words = prose(100 + group, rng.randint(12, 150)).split()
        for _ in range(rng.randint(2, 9)):
            rows.append(" ".join(words))
            words = words.copy() if group % 2 else rows[-1].split()
            for _ in range(max(1, len(words) // rng.choice((9, 20, 40)))):
                words[rng.randrange(len(words))] = f"w{rng.randrange(999)}"
    rows += [f"{prose(300 + i, rng.randint(5, 60))} {passage}" for i in range(40)]
    rng.shuffle(rows)
    return list(enumerate(rows))


def test_groups_equal_all_pairs(spark):
    rows = corpus()
    for size in (2, 5):
        got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), size=size).collect()
        assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == brute(rows, size)


def templated(n: int, own: int, seed: int) -> list[tuple[int, str]]:
    """Texts of one template with ``own`` words of their own each, and a few edited copies of some."""
    rng = random.Random(seed)
    template = [f"t{i}" for i in range(142)]
    rows = []
    for i in range(n):
        words = template.copy()
        for k in range(own):
            words.insert((k + 1) * len(words) // (own + 1), f"o{i}x{k}")
        rows.append(" ".join(words))
        if i % 10 == 0:
            words[rng.randrange(len(words))] = f"c{i}"
            rows.append(" ".join(words))
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("own", [8, 12, 15, 24])
def test_templates_equal_all_pairs(spark, own):
    rows = templated(60, own, own)
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), size=2).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == brute(rows, 2)


def test_prefixes_of_similar_sets_meet_and_those_of_a_template_do_not(spark):
    rng = random.Random(3)
    sets = [set(rng.sample(range(60), rng.randint(5, 40))) for _ in range(60)]
    sets += [s ^ set(rng.sample(range(60), 2)) for s in sets[:30]]
    held = spark.createDataFrame([(i, len(s), x) for i, s in enumerate(sets) for x in s], "id long, n int, shingle long")
    prefixes = _prefixes(held, 80).collect()
    short, long = ({(r.id, r.shingle) for r in prefixes if r.short or not only} for only in (True, False))
    pairs = [(a, b) for a, b in combinations(range(len(sets)), 2) if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    assert len(pairs) > 10
    for a, b in pairs:
        small, large = sorted((a, b), key=lambda i: len(sets[i]))
        assert any((small, x) in short and (large, x) in long for x in sets[a] & sets[b])
    template = list(range(142))
    held = spark.createDataFrame([(i, 171, x) for i in range(50) for x in [*template, *range(1000 + 29 * i, 1029 + 29 * i)]], "id long, n int, shingle long")
    assert not [r for r in _prefixes(held, 80).collect() if r.short]


def test_hard_rows(hard_docs, hard_rows):
    got = near_duplicates(hard_docs, size=2).collect()
    assert len(got) == len(hard_rows)
    wanted = brute([(i, t) for i, t in hard_rows if i is not None], 2)
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got if r.doc_id is not None} == wanted
    (nameless,) = [r for r in got if r.doc_id is None]
    assert nameless.kept and nameless.component_id is None
    assert near_duplicates(hard_docs.limit(0)).count() == 0


def test_components_of_long_paths_and_stars(spark):
    rng = random.Random(2)
    path = list(range(100, 164))
    rng.shuffle(path)
    edges = [*zip(path, path[1:], strict=False), *((7, i) for i in range(10, 40)), (1, 2), (1, 2)]
    got = {r.node: r.component for r in links.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(path, 100), **dict.fromkeys([7, *range(10, 40)], 7), 1: 1, 2: 1}


def test_key_filter_has_no_misses(spark):
    bitmap = links.key_filter(spark.range(-500, 500), "id")
    assert links.passes(bitmap.value, np.arange(-500, 500)).all()
    assert links.passes(bitmap.value, np.arange(10_000, 20_000)).mean() < 0.01
