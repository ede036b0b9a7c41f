"""Chat formatting of reply trees, with DataFrame functions only.

Messages point to the message they reply to. Iterative self-joins double the reach of every message's pointer (1, 2, 4, ... levels), adding
up scores on the way, until all reach their root: that enumerates every root-to-leaf path by its leaf, with its depth and score. The
best leaves of a tree are kept, their paths are unrolled by the same pointer tables, and each path becomes one conversation.

Scale: the joins move (id, pointer, score) only, in log2(depth) rounds, hashed by message; texts are joined once, for chosen paths. A
conversation is one output string, so its own turns meet in one task and nothing else does.

Defined results: null text or role counts as empty; a reply to a message that isn't there starts a tree; equal scores go to the smallest
leaf; repeated (conversation, turn) rows stay, ordered by role and text; a loop of replies has no root and so no path; an empty table
gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpoint

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
#: Applied in this order, undone in the reverse one; no "<" or "[" is left, so no template mark or other control string is.
ESCAPES = (("&", "&a"), ("<", "&l"), ("[", "&b"))


def escaped(c: Column) -> Column:
    for raw, safe in ESCAPES:
        c = F.replace(c, F.lit(raw), F.lit(safe))
    return c


def unescaped(c: Column) -> Column:
    for raw, safe in reversed(ESCAPES):
        c = F.replace(c, F.lit(safe), F.lit(raw))
    return c


def chain(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn") -> DataFrame:
    """Messages (tree, id, parent, role, text, score) of conversations whose turns each reply to the one before.

    tree is the conversation's id as text after a "c"; rows without an id are one conversation, "-".
    """
    order = Window.partitionBy("tree").orderBy("turn", "role", "text")
    rows = rows.select(F.coalesce(F.concat(F.lit("c"), F.col(conv_col).cast("string")), F.lit("-")).alias("tree"), F.col(turn_col).alias("turn"), "role", "text").withColumn("id", F.row_number().over(order).cast("long"))
    return rows.select("tree", "id", F.when(F.col("id") > 1, F.col("id") - 1).alias("parent"), "role", "text", F.lit(0.0).alias("score"))


def paths(messages: DataFrame, branches: int = 1) -> DataFrame:
    """tree, leaf, depth, id: the messages of the `branches` best root-to-leaf paths of each tree; depth 0 is the root."""
    links = messages.select("tree", "id", "parent", "score")
    known = links.select("tree", F.col("id").alias("parent")).distinct()
    replies = links.filter("parent is not null").join(known, ["tree", "parent"], "left_semi")
    at = checkpoint(links.select("tree", "id", "score").join(replies.select("tree", "id", F.col("parent").alias("up")), ["tree", "id"], "left").withColumn("steps", F.col("up").isNotNull().cast("long")))
    levels, left = [at.filter("up is not null").select("tree", "id", "up")], None
    while True:
        open_ = levels[-1].count()
        if not open_ or open_ == left:  # none left, or only loops
            break
        left = open_
        jump = at.select("tree", F.col("id").alias("up"), F.col("up").alias("next"), F.col("score").alias("more"), F.col("steps").alias("far"))
        further = at.filter("up is not null").join(jump, ["tree", "up"]).select("tree", "id", (F.col("score") + F.col("more")).alias("score"), F.col("next").alias("up"), (F.col("steps") + F.col("far")).alias("steps"))
        at = at.filter("up is null").unionByName(further)  # what has reached its root isn't joined again
        at = checkpoint(at)
        levels.append(at.filter("up is not null").select("tree", "id", "up"))
    leaves = at.filter("up is null").join(replies.select("tree", F.col("parent").alias("id")).distinct(), ["tree", "id"], "left_anti")
    best = Window.partitionBy("tree").orderBy(F.desc("score"), "id")
    if branches == 1:
        chosen = leaves.groupBy("tree").agg(F.max(F.struct("score", (-F.col("id")).alias("id"), "steps")).alias("best")).select("tree", (-F.col("best.id")).alias("leaf"), F.col("best.steps").alias("depth"))
    else:
        chosen = leaves.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= branches).select("tree", F.col("id").alias("leaf"), F.col("steps").alias("depth"))
    path = chosen.select("tree", "leaf", "depth", F.col("leaf").alias("id"))
    for k, level in enumerate(levels):
        further = path.join(level, ["tree", "id"]).select("tree", "leaf", (F.col("depth") - (1 << k)).alias("depth"), F.col("up").alias("id"))
        path = path.unionByName(further)
        path = checkpoint(path) if k % 2 else path
    return path


def formatted(messages: DataFrame, branches: int = 1, loss_role: str = "assistant") -> DataFrame:
    """tree, leaf, conversation, loss: each chosen path as one string, and the (start, length) spans in code points that the loss covers."""
    turns = paths(messages, branches).join(messages.select("tree", "id", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")), ["tree", "id"])
    turns = turns.groupBy("tree", "leaf").agg(F.sort_array(F.collect_list(F.struct("depth", "role", "text"))).alias("turns"))
    head = lambda t: F.concat(F.lit(TURN), escaped(t["role"]), F.lit(TEXT))
    made = turns.select("tree", "leaf", F.transform("turns", lambda t: F.struct(head(t).alias("head"), escaped(t["text"]).alias("body"), (t["role"] == loss_role).alias("loss"))).alias("parts"))
    made = made.withColumn("conversation", F.concat_ws("", F.transform("parts", lambda p: F.concat(p["head"], p["body"], F.lit(END)))))
    sizes = F.transform("parts", lambda p: F.struct(F.length(p["head"]).cast("long").alias("head"), F.length(p["body"]).cast("long").alias("body"), p["loss"].alias("loss")))
    empty = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,length:bigint>>").alias("spans"))
    spans = F.aggregate(
        sizes,
        empty,
        lambda acc, s: F.struct(
            (acc["at"] + s["head"] + s["body"] + len(END)).alias("at"),
            F.when(s["loss"], F.concat(acc["spans"], F.array(F.struct((acc["at"] + s["head"]).alias("start"), s["body"].alias("length"))))).otherwise(acc["spans"]).alias("spans"),
        ),
        lambda acc: acc["spans"],
    )
    return made.select("tree", "leaf", "conversation", spans.alias("loss"))


def read_back(conversations: DataFrame) -> DataFrame:
    """tree, turns (role, text) and loss_text, parsed from `conversation` and `loss` alone."""
    parts = F.slice(F.split("conversation", r"<\|turn\|>"), 2, 1 << 30)
    turn = lambda p: F.struct(unescaped(F.substring_index(p, TEXT, 1)).alias("role"), unescaped(F.substring_index(F.substring_index(p, TEXT, -1), END, 1)).alias("text"))
    cut = F.transform("loss", lambda s: unescaped(F.substring(F.col("conversation"), (s["start"] + 1).cast("int"), s["length"].cast("int"))))
    return conversations.select("tree", F.transform(parts, turn).alias("turns"), F.concat_ws("", cut).alias("loss_text"), F.length("conversation").cast("long").alias("formatted_chars"))
