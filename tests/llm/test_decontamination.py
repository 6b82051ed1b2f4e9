"""Benchmark passages in documents against every window compared."""

from __future__ import annotations

import random
import re

import pytest

from tests.llm.conftest import prose
from tidelog.llm import decontamination as dec


def words(text: str | None) -> list[str]:
    return re.findall(r"[a-z0-9\x80-\U0010ffff]+", (text or "").lower())


def grams(w: list[str]) -> set[tuple]:
    n = min(dec.SHINGLE, len(w))
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if n else set()


def holds(doc: str | None, item: str | None) -> bool:
    """Whether both halves of the item stand in the document; ample for texts with whole items or none."""
    w = words(item)
    if len(w) < dec.LEAST:
        return False
    parts = (item or "").split()
    half = -(-len(parts) // 2)
    seen = grams(words(doc)) if len(words(doc)) >= dec.SHINGLE else set()
    return all(len(grams(words(" ".join(p))) & seen) >= dec.OVERLAP * len(grams(words(" ".join(p)))) for p in (parts[:half], parts[half:]))


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(6)
    items = [(i, prose(1000 + i, rng.randint(10, 50)) + "?") for i in range(60)] + [(60, None), (61, "too short"), (62, ""), (63, prose(1000, 10)), (5, prose(2001, 20))]
    docs = []
    for i in range(120):
        body = prose(i, rng.randint(5, 400)).split()
        if i % 4 == 0:
            at = rng.randint(0, len(body))
            form = rng.choice((str, str.upper, lambda s: s.replace(" ", ",\n")))
            body[at:at] = form(items[rng.randrange(60)][1]).split(" ")
        docs.append((i, " ".join(body)))
    docs += [(200, None), (201, ""), (202, items[3][1]), (202, items[3][1]), (None, items[4][1]), (203, " ".join(t or "" for _, t in items[:40]))]
    return docs, items, spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, item_id int"), spark.createDataFrame([(*r, 1) for r in items], "item_id long, text string, word int")


@pytest.mark.parametrize("shard", [1024, 20])
def test_every_planted_item_is_found_and_nothing_else(tables, monkeypatch, shard):
    monkeypatch.setattr(dec, "SHARD", shard)
    docs, items, doc_table, item_table = tables
    got = dec.contaminated(doc_table, dec.indexes(item_table)).collect()
    wanted = [(i, k) for i, t in docs for k, item in items if holds(t, item)]
    assert sorted([(r.doc_id, r.item_id) for r in got], key=str) == sorted(wanted, key=str)
    assert all(r.score >= dec.SCORE * 0.999 for r in got)
    kept = dec.clean(doc_table, dec.indexes(item_table))
    assert kept.columns == doc_table.columns
    hit = [(i, t) for i, t in docs if any(holds(t, item) for _, item in items)]
    assert kept.count() == len(docs) - len(hit)


def test_bounds_never_cut_a_result(tables, monkeypatch):
    _, _, doc_table, item_table = tables
    small = {(r.doc_id, r.item_id, round(r.score, 4)) for r in dec.contaminated(doc_table, dec.indexes(item_table)).collect()}
    monkeypatch.setattr(dec, "BLOCK", 1)
    assert small == {(r.doc_id, r.item_id, round(r.score, 4)) for r in dec.contaminated(doc_table, dec.indexes(item_table)).collect()}


def test_question_and_answer_columns(spark):
    question, answer = prose(1, 20), prose(2, 20)
    items = spark.createDataFrame([(1, question, answer)], "item_id long, q string, a string")
    docs = spark.createDataFrame([(1, f"x {question} y {answer}"), (2, f"x {question} y"), (3, f"{prose(3, 50)} {answer}")], "doc_id long, text string")
    assert [r.doc_id for r in dec.contaminated(docs, dec.indexes(items, question="q", answer="a")).collect()] == [1]


def stands(part: str, doc: str) -> bool:
    """Whether the words of a part stand side by side in a document."""
    w, d = words(part), words(doc)
    return any(d[i : i + len(w)] == w for i in range(len(d) - len(w) + 1))


def test_short_halves_and_answers_are_found_word_for_word(spark):
    items = [(i, prose(3000 + i, 8 + i % 3)) for i in range(12)] + [(20, f"{prose(3100, 6)} = ( + ) / - {prose(3101, 2)}")]
    docs = [(i, f"{prose(3200 + i, 40)} {item}. {prose(3300 + i, 40)}") for i, item in items]
    docs += [(100 + i, f"{prose(3200 + i, 40)} {' '.join(reversed(item.split()))} {prose(3300 + i, 40)}") for i, item in items]
    table = spark.createDataFrame(docs, "doc_id long, text string")
    got = dec.contaminated(table, dec.indexes(spark.createDataFrame(items, "item_id long, text string"))).collect()
    assert sorted((r.doc_id, r.item_id) for r in got) == sorted((d, i) for d, text in docs for i, item in items if stands(item, text))
    assert {r.doc_id for r in got} == {i for i, _ in items}

    asked = [(1, prose(3400, 12), "Paris"), (2, prose(3401, 12), "42"), (3, prose(3402, 12), "b"), (4, prose(3403, 12), "the red sea")]
    told = [(i, f"{prose(3500 + i, 30)} {q}? Answer: {a}. {prose(3600 + i, 30)}") for i, q, a in asked]
    told += [(10 + i, f"{prose(3500 + i, 30)} {q}? {prose(3600 + i, 30)}") for i, q, _ in asked] + [(24, f"{asked[3][1]}? the sea is red")]
    table = spark.createDataFrame(told, "doc_id long, text string")
    got = dec.contaminated(table, dec.indexes(spark.createDataFrame(asked, "item_id long, q string, a string"), question="q", answer="a")).collect()
    assert sorted((r.doc_id, r.item_id) for r in got) == sorted((d, i) for d, text in told for i, q, a in asked if stands(q, text) and stands(a, text))
    assert {r.doc_id for r in got} == {1, 2, 3, 4}


def test_items_of_a_few_words_must_stand_word_for_word(spark):
    items = [(1, "What is the capital of France?"), (2, "alpha beta gamma"), (3, "omega"), (4, "...")]
    docs = [(i, f"{prose(4000 + i, 40)}! {t} {prose(4100 + i, 40)}.") for i, t in items]
    docs += [(11, f"{prose(4200, 30)} what is the one capital of France {prose(4201, 30)}"), (12, "gamma beta alpha, alpha beta"), (13, "omegas"), (14, "Omega")]
    table = spark.createDataFrame(docs, "doc_id long, text string")
    shards = list(dec.indexes(spark.createDataFrame(items, "item_id long, text string")))
    wanted = sorted((d, i) for d, text in docs for i, item in items if words(item) and stands(item, text))
    assert sorted((r.doc_id, r.item_id) for r in dec.contaminated(table, shards).collect()) == wanted
    assert {(1, 1), (2, 2), (3, 3), (14, 3)} <= set(wanted) and not {11, 13} & {d for d, _ in wanted}
    assert {r.doc_id for r in dec.clean(table, shards).collect()} == {d for d, _ in docs} - {d for d, _ in wanted}

    asked = spark.createDataFrame([(1, "who wrote it", "she did")], "item_id long, q string, a string")
    docs = spark.createDataFrame([(1, "Who wrote it? She did."), (2, "who wrote it? did she"), (3, "she did, he wrote it")], "doc_id long, text string")
    assert [r.doc_id for r in dec.contaminated(docs, dec.indexes(asked, question="q", answer="a")).collect()] == [1]


def test_scripts_without_blanks(spark):
    items = [(1, "法国的首都是什么城市？"), (2, "日本で一番高い山は何ですか"), (3, "เมืองหลวงของประเทศไทยคืออะไร"), (4, "首都")]
    docs = [(1, "问题：法国的首都是什么城市？答案：巴黎。"), (2, "先生は日本で一番高い山は何ですかと聞いた。"), (3, "เขาถามว่าเมืองหลวงของประเทศไทยคืออะไรครับ"), (4, "北京是首都。"), (5, "都首是京北"), (6, "山は高い")]
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    got = dec.contaminated(docs, dec.indexes(spark.createDataFrame(items, "item_id long, text string"))).collect()
    assert sorted((r.doc_id, r.item_id) for r in got) == [(1, 1), (1, 4), (2, 2), (3, 3), (4, 4)]


def test_empty_tables(tables):
    _, _, doc_table, item_table = tables
    assert dec.contaminated(doc_table.limit(0), dec.indexes(item_table)).count() == 0
    assert dec.contaminated(doc_table, dec.indexes(item_table.limit(0))).count() == 0
    assert dec.clean(doc_table, dec.indexes(item_table.limit(0))).count() == doc_table.count()


def test_ids_of_any_type(spark):
    items = spark.createDataFrame([("x/1", prose(1, 30)), (None, prose(2, 30))], "item_id string, text string")
    docs = spark.createDataFrame([("a", prose(1, 30)), ("b", prose(2, 30)), ("c", prose(3, 30))], "doc_id string, text string")
    out = dec.contaminated(docs, dec.indexes(items))
    assert dict(out.dtypes)["item_id"] == "string"
    assert {(r.doc_id, r.item_id) for r in out.collect()} == {("a", "x/1"), ("b", None)}
