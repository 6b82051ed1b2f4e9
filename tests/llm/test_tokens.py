"""Counting, encoding and decoding against the vocabularies' own library."""

from __future__ import annotations

import hashlib
import random
from pathlib import Path

import numpy as np
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")
from tokenizers import Tokenizer  # noqa: E402

from tests.llm.conftest import prose  # noqa: E402
from tidelog.llm import speculative_bpe, token_prefixes  # noqa: E402
from tidelog.llm.merges import vocabulary  # noqa: E402

BYTES, WORDS = (Path(public_tokenizers.path(n)) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))


def odd_texts() -> list[str]:
    rng = random.Random(5)
    letters = "ab eé'Σİ\n\t .,!?0123中文😀 ​\x1c\x85"
    mixed = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(400)]
    return [*mixed, "", "<|endoftext|>", "a<|endoftext|> <|startoftext|>b", "we'll it's 'S", "ab" * 900, "ΑΣΣ ΟΔΟΣ", "  x   \n\n y  ", "՘ \U00033000x", prose(9, 300)]


def test_counts_equal_the_library():
    library = Tokenizer.from_file(str(BYTES))
    counter = token_prefixes.TextCounter(BYTES.read_bytes())
    for text in odd_texts():
        assert counter.total(text) == len(library.encode(text, add_special_tokens=False).ids), text


def test_every_prefix_has_the_count_of_its_own_encoding():
    library = Tokenizer.from_file(str(BYTES))
    counter = token_prefixes.TextCounter(BYTES.read_bytes())
    for text in ["we'll see  two   blanks \n\nand 1234 números", " a  b", "x\n \n y", prose(3, 20)]:
        ends, counts = counter.store(text)
        for n in range(len(text) + 1):
            assert counter.at(text, ends, counts, n) == len(library.encode(text[:n], add_special_tokens=False).ids), (text, n)


def test_word_prefixes_are_exact():
    library = Tokenizer.from_file(str(BYTES))
    table = token_prefixes.word_counts(BYTES.read_bytes()).prefixes("internationalisation")
    assert table == [len(library.encode("internationalisation"[:n]).ids) for n in range(21)]


def test_encoding_and_decoding_equal_the_library():
    library = Tokenizer.from_file(str(WORDS))
    coder = speculative_bpe.encoder(WORDS.read_bytes())
    texts = odd_texts()
    for text, ids in zip(texts, coder.encode(texts), strict=True):
        wanted = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, dtype="<u4").tolist() == wanted, text
        assert coder.decode(ids) == library.decode(wanted, skip_special_tokens=False)


def test_pair_test_equals_merging_both():
    known = vocabulary(BYTES.read_bytes())
    rng = np.random.default_rng(3)
    a, b = rng.integers(0, 5000, 3000), rng.integers(0, 5000, 3000)
    fits = known.all_compatible(a, b)
    for x, y, fit in zip(a.tolist(), b.tolist(), fits.tolist(), strict=True):
        merged = known.merge(known.symbols(known.tokens[x]) + known.symbols(known.tokens[y]))
        assert fit == (merged == [x, y]) == known.compatible(x, y)


def test_long_words_merge_as_short_ones_do():
    known = vocabulary(BYTES.read_bytes())
    for word in ("abababab" * 5, "aaaaaaaaaaaaaaa", "internationalisations"):
        assert known._merge_long(known.symbols(word)) == known.merge(known.symbols(word))


def test_tables(spark, hard_docs, hard_rows):
    library, words = Tokenizer.from_file(str(BYTES)), Tokenizer.from_file(str(WORDS))
    counts = sorted(map(tuple, token_prefixes.count_tokens(hard_docs, BYTES.read_bytes()).collect()), key=str)
    assert counts == sorted([(i, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for i, t in hard_rows], key=str)

    wanted = [(i, words.encode(t or "", add_special_tokens=False).ids) for i, t in hard_rows]
    encoded = speculative_bpe.encode(hard_docs, WORDS.read_bytes())
    assert sorted([(r.doc_id, r.ids) for r in encoded.collect()], key=str) == sorted(wanted, key=str)
    decoded = [(r.doc_id, r.text) for r in speculative_bpe.decode(encoded, WORDS.read_bytes()).collect()]
    assert sorted(decoded, key=str) == sorted([(i, words.decode(ids, skip_special_tokens=False)) for i, ids in wanted], key=str)
    digests = {(r.doc_id, r.n_tokens, r.ids_sha256) for r in speculative_bpe.digests(hard_docs, WORDS.read_bytes()).collect()}
    assert digests == {(i, len(ids), hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest()) for i, ids in wanted}

    empty = hard_docs.limit(0)
    assert token_prefixes.count_tokens(empty, BYTES.read_bytes()).count() == speculative_bpe.encode(empty, WORDS.read_bytes()).count() == 0


def test_truncation_keeps_whole_words_within_the_limit(spark, hard_docs):
    library = Tokenizer.from_file(str(BYTES))
    full = {r.doc_id: r.text or "" for r in hard_docs.collect()}
    for row in token_prefixes.truncated(token_prefixes.prefix_store(hard_docs, BYTES.read_bytes()), 50).collect():
        assert full[row.doc_id].startswith(row.text)
        assert row.n_tokens == len(library.encode(row.text, add_special_tokens=False).ids) <= 50
