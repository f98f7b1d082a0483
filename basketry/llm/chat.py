"""Chat formatting of reply trees, with DataFrame operations only.

Messages name the message they answer. Root-to-leaf paths are enumerated by
joining the reply table with itself: every round doubles the number of steps that
a join climbs, so a thread of n turns takes about log2(n) rounds. Branches are
ranked by the summed score of their messages and each chosen path becomes one
conversation in a template. Control strings inside texts get one more backslash
between ``<`` and ``|``, which reading back takes away again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketry.llm.storage import Scratch

START, END, NEWLINE = "<|im_start|>", "<|im_end|>", "<|n|>"


def escape(text):
    """Column: ``text`` without control strings; null is empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"<(\\*)\|", r"<\\$1|")


def unescape(text):
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def escape_role(role):
    """A role is one line of the template, so its line breaks are control strings too."""
    return F.replace(escape(role), F.lit("\n"), F.lit(NEWLINE))


def unescape_role(role):
    return unescape(F.replace(role, F.lit(NEWLINE), F.lit("\n")))


def paths(messages: DataFrame, scratch: Scratch) -> DataFrame:
    """``tree``, ``leaf``, ``node``, ``distance``: every message on the way from each leaf to its root.

    ``messages`` has ``tree``, ``node`` (unique in it) and ``parent``. A parent that
    is null or missing makes a root. Messages whose replies lead into a circle
    belong to no path.
    """
    nodes = messages.select("tree", "node", "parent")
    known = nodes.select("tree", F.col("node").alias("parent"), F.lit(True).alias("known"))
    links = scratch.cut(
        nodes.join(known, ["tree", "parent"], "left").select(
            "tree", "node", F.when(F.col("known"), F.col("parent")).alias("up")
        )
    )
    answered = links.where("up is not null").select("tree", F.col("up").alias("node"))
    reach = links.join(answered, ["tree", "node"], "left_anti").select("tree", F.col("node").alias("leaf"), "node", F.lit(0).cast("long").alias("distance"))
    jump = links.where("up is not null")
    most, step = links.count(), 1
    while step <= most and not jump.isEmpty():
        climbed = reach.join(jump, ["tree", "node"]).select("tree", "leaf", F.col("up").alias("node"), (F.col("distance") + step).alias("distance"))
        reach = scratch.cut(reach.unionByName(climbed))
        further = jump.select("tree", F.col("node").alias("up"), F.col("up").alias("top"))
        jump = scratch.cut(jump.join(further, ["tree", "up"]).select("tree", "node", F.col("top").alias("up")))
        step *= 2
    if step > most and most:
        roots = links.where("up is null").select("tree", "node")
        whole = reach.join(roots, ["tree", "node"], "left_semi").select("tree", "leaf")
        reach = reach.join(whole, ["tree", "leaf"], "left_semi")
    return reach


def branches(reach: DataFrame, messages: DataFrame, most: int | None = None) -> DataFrame:
    """``reach`` with the ``branch`` (from 1) of each path: highest summed score first, ties to the smaller leaf.

    Null scores count as 0. ``most`` keeps that many branches of a tree.
    """
    scored = reach.join(messages.select("tree", "node", F.coalesce("score", F.lit(0.0)).alias("score")), ["tree", "node"])
    total = scored.groupBy("tree", "leaf").agg(F.sum("score").alias("total"))
    order = Window.partitionBy("tree").orderBy(F.desc(F.round("total", 9)), "leaf")
    ranked = total.withColumn("branch", F.row_number().over(order)).drop("total")
    chosen = ranked if most is None else ranked.where(F.col("branch") <= most)
    return reach.join(chosen, ["tree", "leaf"])


def render(placed: DataFrame, messages: DataFrame) -> DataFrame:
    """One row for each branch: ``tree``, ``branch``, ``formatted``, ``loss_spans``.

    ``loss_spans`` holds ``start`` and ``end`` (code points, end exclusive) of every
    assistant text inside ``formatted``.
    """
    text, role = escape(F.col("text")), escape_role(F.col("role"))
    head = F.concat(F.lit(START), role, F.lit("\n"))
    turns = placed.join(messages.select("tree", "node", "role", "text"), ["tree", "node"]).select(
        "tree", "branch", "distance", F.col("role").eqNullSafe("assistant").alias("loss"), head.alias("head"), text.alias("body")
    )
    piece = F.concat("head", "body", F.lit(END + "\n"))
    order = Window.partitionBy("tree", "branch").orderBy(F.desc("distance"))
    size = F.length(piece)
    begin = F.sum(size).over(order) - size + F.length("head")
    turns = turns.select("tree", "branch", (-F.col("distance")).alias("place"), "loss", piece.alias("piece"), begin.alias("start"), (begin + F.length("body")).alias("end"))
    grouped = turns.groupBy("tree", "branch").agg(F.array_sort(F.collect_list(F.struct("place", "piece", "loss", "start", "end"))).alias("t"))
    spans = F.transform(F.filter("t", lambda t: t["loss"]), lambda t: F.struct(t["start"].alias("start"), t["end"].alias("end")))
    return grouped.select("tree", "branch", F.array_join("t.piece", "").alias("formatted"), spans.alias("loss_spans"))


def format_trees(messages: DataFrame, most: int | None = None, scratch: Scratch | None = None) -> DataFrame:
    """``messages`` (tree, node, parent, score, role, text) as ``render`` gives them.

    Null texts and roles are empty. Trees without messages do not occur. The
    steps' tables go to the shared folder.
    """
    scratch = scratch or Scratch(messages.sparkSession)
    return render(branches(paths(messages, scratch), messages, most), messages)


def from_turns(turns: DataFrame, scratch: Scratch) -> DataFrame:
    """Messages of linear conversations: each turn answers the one before it.

    Rows of a conversation are ordered by turn (nulls first), ties by role and
    text; each row is a turn, repeated ones too. All rows without ``conv_id`` are
    one conversation.
    """
    tree = F.coalesce(F.concat(F.lit("c"), F.col("conv_id").cast("string")), F.lit("none"))
    order = Window.partitionBy("tree").orderBy("turn", "role", "text")
    numbered = turns.select(tree.alias("tree"), "conv_id", "turn", "role", "text").withColumn("node", F.row_number().over(order).cast("long"))
    parent = F.when(F.col("node") > 1, F.col("node") - 1)
    return scratch.cut(numbered.select("tree", "conv_id", "node", parent.alias("parent"), F.lit(0.0).alias("score"), "role", "text"))


def read_back(formatted: DataFrame) -> DataFrame:
    """Turns of formatted conversations: ``tree``, ``branch``, ``place``, ``role``, ``text``, ``loss_text``.

    ``loss_text`` is the unescaped text under the loss mask that begins in this
    turn, null without one.
    """
    pieces = formatted.select("tree", "branch", F.posexplode(F.split("formatted", r"<\|im_start\|>")).alias("place", "piece")).where("place > 0")
    order = Window.partitionBy("tree", "branch").orderBy("place")
    size = F.length("piece") + len(START)
    pieces = pieces.withColumn("begin", F.sum(size).over(order) - size + len(START))  # of the piece in the whole
    role = F.substring_index("piece", "\n", 1)
    first = F.length(role) + 1
    pieces = pieces.withColumns({"role": role, "text": F.substring_index(F.substring("piece", first + 1, F.length("piece")), END, 1), "start": F.col("begin") + first})
    masks = formatted.select("tree", "branch", F.explode("loss_spans").alias("m")).select("tree", "branch", F.col("m.start").alias("start"), F.col("m.end").alias("end"))
    joined = pieces.join(masks, ["tree", "branch", "start"], "left")
    under = F.substring("piece", (F.col("start") - F.col("begin") + 1).cast("int"), (F.col("end") - F.col("start")).cast("int"))
    return joined.select("tree", "branch", "place", unescape_role(F.col("role")).alias("role"), unescape(F.col("text")).alias("text"), unescape(under).alias("loss_text"))
