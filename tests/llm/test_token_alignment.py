"""Alignment against a plain merge over the libraries' own tokens."""

from __future__ import annotations

import hashlib
import random
from collections import Counter
from pathlib import Path

import numpy as np
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")
import sentencepiece  # noqa: E402
from tokenizers import Tokenizer  # noqa: E402

from tests.llm.conftest import prose  # noqa: E402
from tests.llm.test_tokens import odd_texts  # noqa: E402
from tidelog.llm import token_alignment as ta  # noqa: E402
from tidelog.llm.merges import byte_letters  # noqa: E402

A, B = (Path(public_tokenizers.path(n)) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def libraries():
    library = Tokenizer.from_file(str(A))
    library.encode_special_tokens = True
    return library, sentencepiece.SentencePieceProcessor(model_file=str(B))


def plain_tokens(libraries, text):
    """(id, bytes) of both sides, or none."""
    library, model = libraries
    letter = {c: b for b, c in byte_letters().items()}
    a = [(i, bytes(letter[c] for c in library.id_to_token(i))) for i in library.encode(" " + (text or ""), add_special_tokens=False).ids]
    b = [(i, bytes([int(model.id_to_piece(i)[3:5], 16)]) if model.is_byte(i) else model.id_to_piece(i).replace("▁", " ").encode()) for i in model.encode(text or "")]
    whole = b" " + (text or "").encode()
    return (a, b) if text and b"".join(t for _, t in a) == whole == b"".join(t for _, t in b) else ([], [])


def plain_links(a, b):
    ends_b, at = {}, 0
    for j, (_, t) in enumerate(b):
        at += len(t)
        ends_b[at] = j
    links, at = [], 0
    for i, (_, t) in enumerate(a):
        at += len(t)
        if at in ends_b:
            links.append((i, ends_b[at]))
    return links


def brute(libraries, rows):
    tokens = [(k, *plain_tokens(libraries, t)) for k, t in rows]
    linked = [[(a[i][0], b[j][0]) for i, j in plain_links(a, b)] for _, a, b in tokens]
    count = Counter(p for ps in linked for p in ps)
    best = {}
    for (_, b), n in count.items():
        best[b] = max(best.get(b, 0), n)
    out = []
    for (k, a, b), pairs in zip(tokens, linked, strict=True):
        groups, i0, j0 = [], 0, 0
        for i, j in plain_links(a, b):
            groups.append(",".join(str(x) for x, _ in a[i0 : i + 1]) + "|" + ",".join(str(x) for x, _ in b[j0 : j + 1]))
            i0, j0 = i + 1, j + 1
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""
        out.append((k, len(a), len(b), len(groups), len(pairs), sum(count[p] == best[p[1]] for p in pairs), sum(count[p] for p in pairs), digest))
    return sorted(out, key=repr)


def test_lockstep_equals_set_intersection():
    rng = np.random.default_rng(1)
    for lane in (1, 2, 7, 1000):
        for n in (0, 1, 5, 300):
            a, b = (np.unique(rng.integers(1, 2 * n + 2, n)) for _ in range(2))
            at_a, at_b = ta.lockstep(a, b, lane)
            assert a[at_a].tolist() == b[at_b].tolist() == np.intersect1d(a, b).tolist()


def test_equals_the_libraries(spark, libraries, hard_docs, hard_rows, monkeypatch):
    monkeypatch.setattr(ta, "BLOCK", 2_000)
    rng = random.Random(2)
    rows = [*hard_rows, (50, "▁ab c"), (51, "<s> hi </s><0x41> <unk>"), (52, "".join(chr(rng.randint(1, 0x2FFF)) for _ in range(500))), (53, "1234 " * 400)]
    rows += [(100 + i, t) for i, t in enumerate(odd_texts()[::4])] + [(900 + i, prose(i % 20, 40)) for i in range(60)]
    extra = spark.createDataFrame(rows[len(hard_rows) :], "doc_id long, text string")
    docs = hard_docs.select("doc_id", "text", "key", "score").unionByName(extra, allowMissingColumns=True).repartition(3)
    out = ta.statistics(docs, A.read_bytes(), B.read_bytes())
    assert out.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(map(tuple, out.collect()), key=repr) == brute(libraries, rows)


def test_general_interface(spark, libraries):
    rows = [("x", prose(1, 30)), ("y", None), ("z", "it's 12 naïve ∆ words"), ("w", "")]
    out = {r.k: r for r in ta.aligned(spark.createDataFrame(rows, "k string, t string"), A.read_bytes(), B.read_bytes(), "k", "t").collect()}
    for k, text in rows:
        a, b = plain_tokens(libraries, text)
        assert (out[k].ids_a, out[k].ids_b) == ([i for i, _ in a], [i for i, _ in b])
        assert list(zip(out[k].links_a, out[k].links_b, strict=True)) == plain_links(a, b)


def test_empty_table(spark):
    assert ta.statistics(spark.createDataFrame([], "doc_id long, text string"), A.read_bytes(), B.read_bytes()).collect() == []
