"""Reply trees as training conversations, with DataFrame functions only.

Messages form trees by their parents. Self-joins double the reach of an ancestor table in each round (the
ancestor 1, 2, 4, ... steps up, with the sums of scores and text lengths on the way), so a thread of n
messages takes log n rounds. That gives every leaf its branch score (the sum along its path); the best
branches of each tree are chosen, and their paths are listed by the same ancestor tables, doubling the
listed part each round. Each chosen path is formatted as one conversation.

Template: ``<turn role=ROLE>TEXT</turn>`` and a line feed for each message. In a text, a ``<`` before
``turn`` or ``/turn`` (with any backslashes between) gets one backslash more behind it, so texts hold no control string
and give up theirs unchanged when read. In a role, backslash and ``>`` become ``\\0`` and ``\\1``.

Null roles and texts are empty, null scores 0. Equal branch scores are settled by the smallest leaf. A
message whose parent is missing from the table is left out with its replies; so are cycles, which have
no root. Messages of a conversation come in the order of turn, then role, then text; repeated rows
are turns of their own, and rows with a null conversation id form one conversation. An empty table
gives an empty result. Other columns are ignored. A conversation is one value, so it must fit into
a row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.llm.common import landed

_END = "</turn>\n"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*/?turn)", r"<\\$1")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*/?turn)", r"<$1")


def header(role: Column) -> Column:
    safe = F.replace(F.replace(role, F.lit("\\"), F.lit("\\0")), F.lit(">"), F.lit("\\1"))
    return F.concat(F.lit("<turn role="), safe, F.lit(">"))


def threads(rows: DataFrame, tree: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Messages of linear conversations as trees: ``tree, node, parent, role, text``; each turn replies to the one before.

    Nodes are numbered in the order of one sort over all rows, so a long conversation spans tasks.
    """
    clean = rows.select(
        F.col(tree).alias("tree"), F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    ordered = clean.orderBy("tree", "turn", "role", "text").select("tree", "role", "text", F.monotonically_increasing_id().alias("node"))
    ordered = landed(ordered, "messages")
    roots = ordered.groupBy("tree").agg(F.min("node").alias("node")).select("node", F.lit(True).alias("root"))
    # Numbers run on within a task of the sort; the first one of a task follows the last one of the task before.
    tasks = ordered.groupBy(F.shiftright("node", 33).alias("task")).agg(F.min("node").alias("low"), F.max("node").alias("high"))
    ends = landed(tasks.select("low", F.lag("high").over(Window.orderBy("task")).alias("before")), "ends")  # one row per task
    marked = ordered.join(roots, "node", "left").join(F.broadcast(ends), F.col("node") == F.col("low"), "left")
    parent = F.when(F.col("root"), F.lit(None)).when(F.col("low").isNotNull(), F.col("before")).otherwise(F.col("node") - 1)
    return marked.select("tree", "node", parent.cast("long").alias("parent"), "role", "text")


def _ancestors(pieces: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """Depth, width and score from the root to every node, and the tables ``node, up`` of ancestors 1, 2, 4, ... steps up.

    No path is longer than the number of nodes, so what has an ancestor that far up stands on a cycle or below one.
    """
    state = landed(pieces.select("node", F.col("parent").alias("up"), F.lit(1).cast("long").alias("depth"), F.col("width").cast("long").alias("width"), "score"), "ancestors")
    steps, n = [], state.count()
    while not (further := state.where("up is not null")).isEmpty():
        if 1 << len(steps) >= n:
            state = state.where("up is null")
            break
        steps.append(further.select("node", "up"))
        above = state.select(
            F.col("node").alias("up"), F.col("up").alias("far"), F.col("depth").alias("more_depth"), F.col("width").alias("more_width"), F.col("score").alias("more_score")
        )
        # A node whose parent is missing has no root: the inner join leaves it out, and in time its replies.
        joined = further.join(above, "up").select(
            "node", F.col("far").alias("up"), (F.col("depth") + F.col("more_depth")).alias("depth"), (F.col("width") + F.col("more_width")).alias("width"), (F.col("score") + F.col("more_score")).alias("score")
        )
        state = landed(state.where("up is null").unionByName(joined), "ancestors")
    return state, steps


def branches(messages: DataFrame, top: int | None = 1) -> DataFrame:
    """``tree, path, rank, score`` and, for each message on the path, ``node, position, begin, role, text``.

    ``messages`` has ``tree, node, parent, role, text`` and optionally ``score``; nodes are unique. Of each tree the ``top``
    branches with the highest scores are listed, all of them for None.
    """
    messages = messages.withColumns({c: F.coalesce(c, F.lit("")) for c in ("role", "text")})
    score = F.coalesce(F.col("score"), F.lit(0.0)).cast("double") if "score" in messages.columns else F.lit(0.0)
    head, body = header(F.col("role")), escaped(F.col("text"))
    pieces = messages.select("tree", "node", "parent", score.alias("score"), (F.length(head) + F.length(body) + len(_END)).alias("width"))
    rooted, steps = _ancestors(pieces)
    parents = messages.where("parent is not null").select(F.col("parent").alias("node")).distinct()
    leaves = rooted.join(parents, "node", "left_anti").join(messages.select("node", "tree"), "node").select("tree", "node", "score")
    rank = F.row_number().over(Window.partitionBy("tree").orderBy(F.desc("score"), "node"))
    chosen = leaves.withColumn("rank", rank).where(F.lit(True) if top is None else F.col("rank") <= top)
    chosen = landed(chosen.withColumnRenamed("node", "path"), "chosen")
    listed = chosen.select("path", F.col("path").alias("node"))
    for i, step in enumerate(steps):
        # The part listed so far reaches 2^i - 1 steps up from the leaf; one join adds as many again.
        listed = landed(listed.unionByName(listed.join(step, "node").select("path", F.col("up").alias("node"))), f"paths{i}")
    placed = listed.join(rooted.select("node", "depth", "width"), "node").join(messages.select("node", "role", "text"), "node")
    return placed.join(chosen.select("path", "tree", "rank", "score"), "path")


def conversations(messages: DataFrame, top: int | None = 1) -> DataFrame:
    """``tree, path, rank, score, formatted`` and ``loss``, the places of assistant texts in the formatted one.

    ``loss`` lists the turn, the first code point in the formatted text and in the turn, and the code points.
    """
    head, body = header(F.col("role")), escaped(F.col("text"))
    rows = branches(messages, top).select(
        "tree", "path", "rank", "score", "depth",
        F.concat(head, body, F.lit(_END)).alias("piece"),
        F.when(
            F.col("role") == "assistant",
            F.struct(
                (F.col("depth") - 1).cast("int").alias("turn"), (F.col("width") - F.length(body) - len(_END)).alias("begin"),
                F.length(head).alias("offset"), F.length(body).alias("length"),
            ),
        ).alias("loss"),
    )
    grouped = rows.groupBy("path").agg(
        F.first("tree").alias("tree"), F.first("rank").alias("rank"), F.first("score").alias("score"), F.sort_array(F.collect_list(F.struct("depth", "piece", "loss"))).alias("turns")
    )
    return grouped.select(
        "tree", "path", "rank", "score", F.array_join(F.transform("turns", lambda t: t["piece"]), "").alias("formatted"),
        F.transform(F.filter("turns", lambda t: t["loss"].isNotNull()), lambda t: t["loss"]).alias("loss"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """The columns of ``formatted`` with ``turns`` (role and text) and ``learnt`` (all text under the loss mask)."""
    pieces = F.split("formatted", _END)
    parts = formatted.withColumn("pieces", F.slice(pieces, F.lit(1), F.size(pieces) - 1))

    def turn(piece: Column) -> Column:
        role_ends = F.locate(">", piece)
        role = F.substring(piece, F.lit(len("<turn role=") + 1), role_ends - len("<turn role=") - 1)
        role = F.replace(F.replace(role, F.lit("\\1"), F.lit(">")), F.lit("\\0"), F.lit("\\"))
        return F.struct(role.alias("role"), unescaped(F.substring(piece, role_ends + 1, F.length(piece))).alias("text"))

    learnt = F.transform("loss", lambda m: unescaped(F.substring(F.get("pieces", m["turn"]), m["offset"] + 1, m["length"])))
    return parts.withColumns({"turns": F.transform("pieces", turn), "learnt": F.array_join(learnt, "")}).drop("pieces")
