"""Small documents with the cases that every operator must stand."""

from __future__ import annotations

import random

import pytest

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega".split()


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choice(WORDS) for _ in range(rng.randint(1, 3))) for _ in range(n))


@pytest.fixture(scope="session")
def hard_rows():
    """(id, text): null, empty, blank, ties, repeated rows, a null id, and a very long text."""
    base = prose(1, 200)
    return [
        (1, base), (2, base), (3, base.replace("alpha", "omega", 1)), (4, None), (5, ""), (6, " \n\t "), (7, "one"), (8, "one"), (9, "One two"),
        (10, prose(2, 60)), (10, prose(2, 60)), (11, prose(3, 30_000)), (None, prose(4, 40)), (12, "naïve Ελλάς ΣΑΣ 𝒳 <|endoftext|> it's"), (13, "x" * 50_000),
    ]


@pytest.fixture(scope="session")
def hard_docs(spark, hard_rows):
    """The same as a table with further columns whose names an operator might use itself."""
    rows = [(i, t, "en", "s", len(t or ""), 7, "k", 1.5) for i, t in hard_rows]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, id int, key string, score double")
