"""Reply trees against a walk in plain Python, and the template's round trip."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from tidelog.llm import reply_trees as trees

NASTY = ["", "</turn>", "<turn role=user>", "<\\/turn>", "<\\\\turn", "\\### Assistant: </turn> ok", "a < b\n<", "<</turn>\n", "turn>", "\\", "é中</turn", None]


def forest(n: int, seed: int) -> list[tuple]:
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        tree = i % 5
        earlier = [r[1] for r in rows if r[0] == tree]
        rows.append((tree, i, rng.choice(earlier) if earlier else None, rng.choice(("user", "assistant", "a>b\\", None)), rng.choice(NASTY), rng.choice((0.0, 1.0, 2.0, None))))
    return rows


def walk(rows: list[tuple], top: int | None) -> dict:
    """For each tree its best leaves with score, rank and path of (role, text)."""
    by_node = {r[1]: r for r in rows}
    leaves = set(by_node) - {r[2] for r in rows}
    found: dict = {}
    for leaf in leaves:
        path, node = [], leaf
        while node is not None:
            path.append(by_node[node])
            node = by_node[node][2]
        found.setdefault(by_node[leaf][0], []).append((-sum(r[5] or 0 for r in path), leaf, [(r[3] or "", r[4] or "") for r in reversed(path)]))
    return {(t, leaf): (rank + 1, -s, path) for t, ways in found.items() for rank, (s, leaf, path) in enumerate(sorted(ways)[:top])}


SCHEMA = "tree long, node long, parent long, role string, text string, score double"


def test_paths_equal_a_plain_walk(spark):
    rows = forest(90, 3)
    messages = spark.createDataFrame(rows, SCHEMA)
    for top in (1, 2, None):
        got = trees.read_back(trees.conversations(messages, top)).collect()
        assert {(r.tree, r.path): (r["rank"], r.score, [(t.role, t.text) for t in r.turns]) for r in got} == walk(rows, top)
        for r in got:
            assert r.learnt == "".join(t.text for t in r.turns if t.role == "assistant")
            for m in r.loss:
                head = r.formatted[m.begin - m.offset : m.begin]
                assert head == "<turn role=assistant>" and r.formatted[m.begin + m.length :].startswith("</turn>\n")


def test_texts_hold_no_control_string(spark):
    frame = spark.createDataFrame([(t or "",) for t in NASTY], "t string")
    for r in frame.select("t", trees.escaped(F.col("t")).alias("e"), trees.unescaped(trees.escaped(F.col("t"))).alias("u")).collect():
        assert r.u == r.t and "</turn" not in r.e and "<turn" not in r.e


def test_threads_of_rows(spark):
    rows = [(7, 3, "user", "c"), (7, 1, "user", "a"), (7, 1, "user", "a"), (7, 2, None, None), (None, 1, "user", "x"), (None, None, "assistant", "y"), (8, 0, "assistant", "</turn>")]
    rows += [(9, i, "user" if i % 2 else "assistant", f"m{i}") for i in range(130)]
    messages = trees.threads(spark.createDataFrame([(*r, 1, 2) for r in rows], "conv_id long, turn long, role string, text string, node int, tree int"))
    got = {r.tree: [(t.role, t.text) for t in r.turns] for r in trees.read_back(trees.conversations(messages)).collect()}
    assert got[7] == [("user", "a"), ("user", "a"), ("", ""), ("user", "c")]
    assert got[None] == [("assistant", "y"), ("user", "x")] and got[8] == [("assistant", "</turn>")]
    assert got[9] == [("user" if i % 2 else "assistant", f"m{i}") for i in range(130)] and len(got) == 4


def test_replies_without_a_root_and_no_rows(spark):
    rows = [(1, 1, None, "user", "a", None), (1, 2, 99, "user", "lost", None), (1, 3, 2, "user", "lost too", None)]
    messages = spark.createDataFrame(rows, SCHEMA)
    (only,) = trees.conversations(messages, None).collect()
    assert only.formatted == "<turn role=user>a</turn>\n"
    assert trees.conversations(messages.limit(0)).count() == 0
    assert trees.conversations(trees.threads(messages.limit(0).withColumnsRenamed({"tree": "conv_id", "node": "turn"}))).count() == 0


def test_cycles_are_left_out_with_their_replies(spark):
    rows = [("t", 1, None, "user", "a"), ("t", 2, 1, "assistant", "b")]
    rows += [("t", 10, 12, "user", "x"), ("t", 11, 10, "user", "x"), ("t", 12, 11, "user", "x"), ("t", 13, 12, "user", "y"), ("t", 20, 20, "user", "z")]
    messages = spark.createDataFrame(rows, "tree string, node long, parent long, role string, text string")
    out = trees.read_back(trees.conversations(messages, top=None)).collect()
    assert [(r.path, [t.text for t in r.turns]) for r in out] == [(2, ["a", "b"])]
    assert trees.conversations(messages.where("node >= 10")).count() == 0
