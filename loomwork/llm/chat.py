"""Conversations out of reply trees, formatted for training with a loss mask.

A message names the message it answers. Root-to-leaf paths come from iterative self-joins: the table of ancestors one
step up joined with itself gives two steps, then four; the nodes known on each leaf's path double with every join, so a
thread of n turns takes about log n joins. Branches are ranked by the total score of their messages, and each chosen path
is formatted as one conversation.

Template (one line of text, shown on several):

    <s>
    [SYS] system text [/SYS]
    [INST] user text [/INST]
     assistant text</s>                     (begins with a space)
    [ROLE] other role [TEXT] text [/ROLE]

Control strings inside roles and texts get a backslash after their first character, and those that have some already
get one more; reading takes one away. The loss mask has an entry per turn: the code points ``start`` to ``end`` of the
assistant's text in the conversation, NULL for other turns.

Defined results: a NULL text or role is empty; a message whose parent is missing is a root; equal paths are formatted
each; a message id that occurs twice in a tree makes a branch for each pair; replies in a circle raise an error. All is
DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loomwork.staging import discard, staged

BEGIN = "<s>"
#: What stands before and after the text of a turn.
TEMPLATE = {"system": ("[SYS] ", " [/SYS]"), "user": ("[INST] ", " [/INST]"), "assistant": (" ", "</s>")}
_OTHER = ("[ROLE] ", " [TEXT] ", " [/ROLE]")
_CONTROL = r"(/?(?:s>|SYS\]|INST\]|ROLE\]|TEXT\]))"
_TURN_END = r"(?<=</s>|\[/SYS\]|\[/INST\]|\[/ROLE\])"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[])(\\*){_CONTROL}", r"$1\\$2$3")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[])\\(\\*){_CONTROL}", "$1$2$3")


def tree_paths(messages: DataFrame) -> DataFrame:
    """``tree, leaf, node, back`` for the nodes on the path of each leaf, ``back`` steps above it.

    ``messages`` has ``tree, node, parent``.
    """
    nodes = staged(messages.select("tree", "node", "parent"))
    up = nodes.join(nodes.select("tree", F.col("node").alias("parent")), ["tree", "parent"], "left_semi")
    up = staged(up.select("tree", "node", "parent"), in_loop=True)
    answered = up.select("tree", F.col("parent").alias("node"))
    leaves = nodes.join(answered, ["tree", "node"], "left_anti")
    paths = staged(leaves.select("tree", F.col("node").alias("leaf"), "node", F.lit(0).cast("long").alias("back")), in_loop=True)
    steps, most = 1, nodes.count()
    while not up.isEmpty():
        if steps > most:
            raise ValueError("replies in a circle")
        above = paths.join(up, ["tree", "node"]).select("tree", "leaf", F.col("parent").alias("node"), F.col("back") + steps)
        longer = staged(paths.union(above), in_loop=True)
        further = up.select("tree", F.col("node").alias("parent"), F.col("parent").alias("above"))
        jump = staged(up.join(further, ["tree", "parent"]).select("tree", "node", F.col("above").alias("parent")), in_loop=True)
        discard(paths)
        discard(up)
        paths, up, steps = longer, jump, 2 * steps
    return paths


def chosen_paths(paths: DataFrame, messages: DataFrame, branches: int) -> DataFrame:
    """Of each tree the ``branches`` paths with the largest total ``score``, then the smallest leaf; with their ``rank``."""
    scores = paths.join(messages.select("tree", "node", "score"), ["tree", "node"])
    totals = scores.groupBy("tree", "leaf").agg(F.sum("score").alias("total"))
    order = Window.partitionBy("tree").orderBy(F.desc_nulls_last("total"), "leaf")
    best = totals.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= branches)
    return paths.join(best.drop("total"), ["tree", "leaf"])


def formatted(messages: DataFrame, branches: int = 1) -> DataFrame:
    """``tree, rank, conversation, loss``: the best branches of each tree, each as one conversation.

    ``messages`` has ``tree, node, parent, role, text, score``.
    """
    paths = chosen_paths(tree_paths(messages), messages, branches)
    said = messages.select("tree", "node", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    turns = paths.join(said, ["tree", "node"])
    before, after = F.concat(F.lit(_OTHER[0]), escaped(F.col("role")), F.lit(_OTHER[1])), F.lit(_OTHER[2])
    for role, (opening, closing) in TEMPLATE.items():
        before = F.when(F.col("role") == role, F.lit(opening)).otherwise(before)
        after = F.when(F.col("role") == role, F.lit(closing)).otherwise(after)
    turns = turns.withColumns({"before": before, "body": escaped(F.col("text")), "after": after})
    turns = turns.withColumn("turn", F.concat("before", "body", "after"))
    order = Window.partitionBy("tree", "leaf", "rank").orderBy(F.desc("back")).rowsBetween(Window.unboundedPreceding, -1)
    begin = F.coalesce(F.sum(F.length("turn")).over(order), F.lit(0)) + len(BEGIN)
    start = begin + F.length("before")
    span = F.when(F.col("role") == "assistant", F.struct(start.alias("start"), (start + F.length("body")).alias("end")))
    rows = turns.withColumn("span", span).groupBy("tree", "leaf", "rank").agg(
        F.array_sort(F.collect_list(F.struct(-F.col("back"), "turn", "span"))).alias("turns")
    )
    return rows.select(
        "tree", "rank", F.concat(F.lit(BEGIN), F.array_join("turns.turn", "")).alias("conversation"), F.col("turns.span").alias("loss")
    )


def read_back(conversations: DataFrame) -> DataFrame:
    """A row for each turn of ``tree, rank, conversation, loss``: ``tree, rank, turn, role, text, loss_text``."""
    pieces = F.filter(F.split(F.expr(f"substring(conversation, {len(BEGIN) + 1})"), _TURN_END), lambda x: x != "")
    turns = conversations.select("tree", "rank", F.posexplode(F.arrays_zip(pieces.alias("piece"), F.col("loss").alias("span"))))
    turns = turns.select("tree", "rank", F.col("pos").alias("turn"), "col.piece", "col.span")
    order = Window.partitionBy("tree", "rank").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    turns = turns.withColumn("begin", F.coalesce(F.sum(F.length("piece")).over(order), F.lit(0)) + len(BEGIN))
    other = r"(?s)^\[ROLE\] (.*?) \[TEXT\] "
    role, opening = F.regexp_extract("piece", other, 1), F.length(F.regexp_extract("piece", other, 0))
    closing = F.lit(len(_OTHER[2]))
    for name, (before, after) in TEMPLATE.items():
        marked = F.col("piece").startswith(before)
        role = F.when(marked, F.lit(name)).otherwise(role)
        opening, closing = F.when(marked, len(before)).otherwise(opening), F.when(marked, len(after)).otherwise(closing)
    text = F.substring("piece", opening + 1, F.length("piece") - opening - closing)
    loss = F.substring("piece", F.col("span.start") - F.col("begin") + 1, F.col("span.end") - F.col("span.start"))
    return turns.select("tree", "rank", "turn", unescaped(role).alias("role"), unescaped(text).alias("text"), unescaped(loss).alias("loss_text"))


def linear_threads(turns: DataFrame) -> DataFrame:
    """Reply trees of ``conv_id, turn, role, text``: each turn answers the one before it.

    Equal turn numbers follow each other by role and text; rows without ``conv_id`` make one conversation.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = turns.select("conv_id", "role", "text", F.row_number().over(order).cast("long").alias("node"))
    return rows.select(
        F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("tree"), "node",
        F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"), "role", "text", F.lit(0).cast("long").alias("score"),
    )
