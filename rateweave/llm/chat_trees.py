"""Operator 3 [native]: reply trees formatted as conversations.

Rows are replies: each has a tree, a node, its parent's node and a score.  Self-joins that
double their reach at every round give each reply its depth and the score of its whole
branch, so a chain of n replies takes about log2(n) rounds.  Branches, one for each leaf,
are ranked by score in their tree, the best are chosen, and the same jumps, taken from the
longest to the shortest, list all replies of each chosen branch.

A conversation is written turn by turn as ``<|role|>`` newline text ``<|end|>`` newline.
Texts and roles have ``& < > [`` escaped as ``&amp; &lt; &gt; &lsb;``, so no control string
can stand in them, and unescaping gives back the very text.  ``loss`` holds the places of
the assistant's texts (code points, end exclusive).

Null texts and roles count as empty, a null score as 0, a null tree is one tree like others.
A reply whose parent is missing is a root.  Replies on a cycle or under one have no root
and are in no branch.  Of rows with one tree and node the first by role and text counts.
A conversation is one row of the result, so its turns meet in one task.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rateweave.session import cut_lineage

#: Fixed escapes, in the order in which they are written; they are read in the other order.
ESCAPES = [("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ("[", "&lsb;")]
OPEN, CLOSE, END = "<|", "|>\n", "<|end|>\n"


def escape(text: Column) -> Column:
    for plain, written in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(written))
    return text


def unescape(text: Column) -> Column:
    for plain, written in reversed(ESCAPES):
        text = F.replace(text, F.lit(written), F.lit(plain))
    return text


def chosen_branches(replies: DataFrame, branches: int = 1) -> DataFrame:
    """(tree, leaf, rank, node, depth) of the replies on the best branches of each tree; replies has
    tree, node, parent and score, each (tree, node) once."""
    own = replies.select("tree", "node", F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"), "parent")
    known = own.select("tree", F.col("node").alias("parent"), F.lit(True).alias("known"))
    state = cut_lineage(own.join(known, ["tree", "parent"], "left").select(
        "tree", "node", F.when(F.col("known"), F.col("parent")).alias("up"), "score", F.lit(1).cast("long").alias("depth")))
    leaves = state.select("tree", "node").join(
        state.select("tree", F.col("up").alias("node")).where("node is not null").distinct(), ["tree", "node"], "left_anti")
    # Replies that have reached their root are done and only looked up by the others.
    jumps, done, active = [], [state.where("up is null")], state.where("up is not null")
    n = state.count()
    while 2 ** len(jumps) <= n and not active.isEmpty():
        jumps.append(active.select("tree", "node", "up"))
        known = functools.reduce(DataFrame.unionByName, done + [active])
        above = known.select("tree", F.col("node").alias("up"), F.col("up").alias("up2"), F.col("score").alias("more"),
                             F.col("depth").alias("deeper"))
        moved = cut_lineage(active.join(above, ["tree", "up"], "left").select(
            "tree", "node", F.col("up2").alias("up"), (F.col("score") + F.coalesce("more", F.lit(0.0))).alias("score"),
            (F.col("depth") + F.coalesce("deeper", F.lit(0))).alias("depth")))
        done, active = done + [moved.where("up is null")], moved.where("up is not null")
    ends = functools.reduce(DataFrame.unionByName, done).join(leaves, ["tree", "node"])
    best = Window.partitionBy("tree").orderBy(F.col("score").desc(), F.col("depth").desc(), "node")
    ranked = ends.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= branches)
    paths = cut_lineage(ranked.select("tree", F.col("node").alias("leaf"), "rank", "node", "depth"))
    for k in range(len(jumps) - 1, -1, -1):
        up = jumps[k].select("tree", "node", "up")
        paths = paths.unionByName(paths.join(up, ["tree", "node"]).select(
            "tree", "leaf", "rank", F.col("up").alias("node"), (F.col("depth") - 2 ** k).alias("depth")))
        paths = cut_lineage(paths)
    return paths


def format_turns(turns: DataFrame) -> DataFrame:
    """One row for each (tree, rank): n_turns, formatted and loss; turns has tree, rank, depth, role, text."""
    role, text = escape(F.coalesce("role", F.lit(""))), escape(F.coalesce("text", F.lit("")))
    own = turns.select("tree", "rank", "depth", F.coalesce("role", F.lit("")).alias("role"),
                       F.concat(F.lit(OPEN), role, F.lit(CLOSE)).alias("head"), text.alias("body"))
    written = F.length("head") + F.length("body") + len(END)
    before = F.sum(written.cast("long")).over(Window.partitionBy("tree", "rank").orderBy("depth")) - written
    own = own.withColumn("start", (before + F.length("head")).cast("long"))
    rows = own.groupBy("tree", "rank").agg(F.sort_array(F.collect_list(F.struct(
        "depth", F.concat("head", "body", F.lit(END)).alias("piece"), (F.col("role") == "assistant").alias("learn"), "start",
        (F.col("start") + F.length("body")).alias("end")))).alias("t"))
    return rows.select(
        "tree", "rank", F.size("t").cast("long").alias("n_turns"),
        F.array_join(F.transform("t", lambda x: x["piece"]), "").alias("formatted"),
        F.transform(F.filter("t", lambda x: x["learn"]), lambda x: F.struct(x["start"], x["end"])).alias("loss"))


def read_turns(formatted: Column) -> Column:
    """The turns (role, text) of a formatted conversation."""
    pieces = F.split(formatted, "<\\|end\\|>\n", -1)
    pieces = F.slice(pieces, F.lit(1), F.size(pieces) - 1)
    cut = lambda p: F.instr(p, CLOSE)
    return F.transform(pieces, lambda p: F.struct(
        unescape(F.substr(p, F.lit(len(OPEN) + 1), cut(p) - len(OPEN) - 1)).alias("role"),
        unescape(F.substr(p, cut(p) + len(CLOSE))).alias("text")))


def read_loss(formatted: Column, loss: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(loss, lambda s: unescape(
        F.substring(formatted, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))), "")


def conversations(replies: DataFrame, tree: str = "tree", node: str = "node", parent: str = "parent",
                  score: str = "score", role: str = "role", text: str = "text", branches: int = 1) -> DataFrame:
    """One row for each chosen branch: tree, rank, n_turns, formatted, loss."""
    own = replies.select(F.col(tree).alias("value"), F.coalesce(F.col(tree).cast("string"), F.lit("\u0000")).alias("tree"),
                         F.col(node).cast("long").alias("node"), F.col(parent).cast("long").alias("parent"),
                         F.col(score).alias("score"), F.col(role).alias("role"), F.col(text).alias("text"))
    first = Window.partitionBy("tree", "node").orderBy("role", "text", "parent", "score")
    own = cut_lineage(own.withColumn("_n", F.row_number().over(first)).where("_n = 1").drop("_n"))
    paths = chosen_branches(own.select("tree", "node", "parent", "score"), branches)
    out = format_turns(paths.join(own.select("tree", "node", "role", "text"), ["tree", "node"]))
    names = own.groupBy("tree").agg(F.max("value").alias("value"))
    return out.join(names, "tree").select(F.col("value").alias(tree), "rank", "n_turns", "formatted", "loss")


def linear_replies(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                   text_col: str = "text") -> DataFrame:
    """Plain conversations as trees of one branch: each turn replies to the one before it (nulls
    first; turns of one number by role and text)."""
    order = Window.partitionBy(conv_col).orderBy(turn_col, role_col, text_col)
    own = turns.select(conv_col, turn_col, F.col(role_col).alias("role"), F.col(text_col).alias("text"),
                       F.row_number().over(order).cast("long").alias("node"))
    return own.select(F.col(conv_col).alias("tree"), "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"),
                      F.lit(0.0).alias("score"), "role", "text")


def digest(rows: DataFrame) -> DataFrame:
    """What the formatted conversations say, read back from them."""
    own = rows.withColumn("turns", read_turns(F.col("formatted"))).withColumn(
        "learnt", read_loss(F.col("formatted"), F.col("loss")))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return own.select(F.col("tree").alias("conv_id"), F.size("turns").cast("long").alias("n_turns"),
                      F.sha2(said, 256).alias("turns_sha256"), F.length("learnt").cast("long").alias("loss_chars"),
                      F.sha2("learnt", 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"))
