"""Licence templates against enumeration of everything they allow, and phrases against a plain search."""

from __future__ import annotations

import random
import re

import pytest

from tidelog.llm.license_scan import Templates, labels_of, scan, words_of
from tidelog.llm.license_templates import PHRASES, TEMPLATES

MIT = """MIT License

Copyright (c) 2024 Some Body & Friends

Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the “Software”), to deal
in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicence, and/or sell
copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE."""


def tree(tokens: list[str]):
    """Markup as nested lists: words, ('any', a, b), or a list for an optional region."""
    out = []
    while tokens:
        t = tokens.pop(0)
        if t == "]]":
            return out
        if t == "[[":
            out.append(tree(tokens))
        elif t.startswith("{{"):
            a, b = re.findall(r"\d+", t)
            out.append(("any", int(a), int(b)))
        else:
            out.append(t)
    return out


def ends(nodes, words: list[str], at: set[int]) -> set[int]:
    """All places that matching may reach from those given."""
    for node in nodes:
        if isinstance(node, list):
            at = at | ends(node, words, at)
        elif isinstance(node, tuple):
            at = {i + n for i in at for n in range(node[1], node[2] + 1) if i + n <= len(words)}
        else:
            at = {i + 1 for i in at if i < len(words) and words[i] == node}
    return at


def brute(templates, words: list[str]):
    found, i = [], 0
    while i < len(words):
        best = max(((e, label) for label, t in templates for e in ends(tree(t.split()), words, {i}) if e > i), default=None, key=lambda x: x[0])
        if best:
            labels = sorted({label for label, t in templates if best[0] in ends(tree(t.split()), words, {i})})
            found.append((i, best[0], tuple(labels)))
        i = best[0] if best else i + 1
    return found


def random_template(rng: random.Random, depth: int = 0) -> str:
    parts = [rng.choice("abc")] if not depth else []
    for _ in range(rng.randint(1, 4)):
        r = rng.random()
        if r < 0.6 or depth > 2:
            parts.append(rng.choice("abc"))
        elif r < 0.8:
            parts.append(f"[[ {random_template(rng, depth + 1)} ]]")
        else:
            a = rng.randint(0, 2)
            parts.append(f"{{{{{a}..{a + rng.randint(0, 2)}}}}}")
    return " ".join(parts)


def test_automata_equal_enumeration():
    rng = random.Random(8)
    hits = 0
    for _ in range(400):
        templates = [(str(k), random_template(rng)) for k in range(rng.randint(1, 3))]
        words = [rng.choice("abcd") for _ in range(rng.randint(0, 30))]
        got = Templates(templates).matches([w.encode() for w in words])
        assert got == brute(templates, words), (templates, words)
        hits += len(got)
    assert hits > 500


def test_the_filter_lets_every_match_through():
    rng = random.Random(9)
    for _ in range(300):
        template = [("x", random_template(rng))]
        words = [rng.choice("abc") for _ in range(12)]
        automata = Templates(template)
        if automata.matches([w.encode() for w in words]):
            assert automata.possible(f" {' '.join(words)} ".encode())


def labels(spark, *texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [r.l for r in scan(df).select("doc_id", labels_of("matches").alias("l")).orderBy("doc_id").collect()]


def test_licences(spark):
    short = MIT[MIT.index("Permission") :]
    cases = {
        MIT: "mit", short: "mit", "x " * 50 + MIT + " y": "mit", MIT.replace("free of charge", "free"): "", MIT.replace("THE AUTHORS OR COPYRIGHT HOLDERS", "ACME"): "mit",
        "This work is licensed under the GNU General Public License, version 3.": "gpl-3", "Licensed under CC BY-NC 4.0.": "cc-by-nc",
        "Released under the MIT Licence.": "mit", "Licensed under the Apache License, Version 2.0.": "apache-2", "SPDX-License-Identifier: BSD-3-Clause": "bsd-3",
        "apache license, version 2 and cc-by nc": "apache-2,cc-by-nc", "no licence here, under the mit": "",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free "
        "Software Foundation, either version 3 of the License, or (at your option) any later version.": "gpl-3",
    }
    assert dict(zip(cases, labels(spark, *cases), strict=True)) == cases


def test_every_template_accepts_its_own_wording():
    automata = Templates(TEMPLATES)
    for label, markup in TEMPLATES:
        text = re.sub(r"\{\{(\d+)\.\.\d+\}\}", lambda m: "name " * int(m[1]), markup)
        for wording in (text.replace("[[", "").replace("]]", ""), drop_optional(text)):
            (first, end, found), *_ = automata.matches(words_of(wording.encode()))
            assert label in found and first == 0, (label, wording)


def drop_optional(text: str) -> str:
    while "[[" in text:
        text = re.sub(r"\[\[(?:(?!\[\[|\]\]).)*\]\]", " ", text, flags=re.S)
    return text


def test_phrases_and_hard_rows(spark, hard_docs, hard_rows):
    rows = [(100, "under the mit license " * 3), (101, "cc by nc by nc CC-BY-NC. cc by ncx"), (102, "Apache License Version 2 2")]
    extra = spark.createDataFrame(rows, "doc_id long, text string")
    out = scan(hard_docs.select("doc_id", "text", "key", "score").unionByName(extra, allowMissingColumns=True))
    assert out.columns == ["doc_id", "n_words", "score", "matches"] and out.count() == len(hard_rows) + 3
    for r, text in [(r, dict(rows + hard_rows).get(r.doc_id)) for r in out.collect()]:
        words = words_of((text or "").encode())
        expected = sorted((i, label) for p, label in PHRASES.items() for i in range(len(words)) if words[i : i + len(p.split())] == p.encode().split())
        assert [(m.first_word, m.label) for m in r.matches if m.phrase] == expected
        assert r.n_words == len(words) and 0 <= r.score <= 1 and bool(r.score) == bool(r.matches)
    empty = spark.createDataFrame([], "doc_id string, text string")
    assert scan(empty).collect() == []


def test_bad_templates():
    for markup in ("[[a", "a]]", "[[a]]", "{{1..2}} a", "[[{{1..2}}]] a"):
        with pytest.raises(ValueError):
            Templates([("x", markup)])
