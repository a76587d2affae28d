"""Reply trees to conversations: root-to-leaf paths by iterative self-joins, ranked and formatted.

``ancestors`` doubles: a join of the table of 2**k-th ancestors with itself gives the 2**(k+1)-th, so the number of
joins grows with the logarithm of the deepest reply. From each leaf the same tables, largest first, enumerate every
message of its path exactly once. Branches of a conversation are ranked by the mean score of their messages (ties: the
smaller leaf), and only the texts of the chosen ones are brought in and formatted.

The template is ``<|turn|>role<|text|>text<|end|>`` for each turn. Inside roles and texts a backslash goes before each
backslash and each ``|``, so no control string can stand in a text, and ``unescaped`` takes them away again.

A parent that is missing or null makes its message a root; messages on a cycle, and those that hang on one, have no root and are left out. Null
roles and texts count as empty. Repeated rows (same conversation and message id) are one message, the least by role
and text. Rows with a null conversation id are one conversation; rows with a null message id are left out. Extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from annolake.llm.common import stored

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"([\\|])", r"\\$1")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"\\([\\|])", "$1")


def linear(messages: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """Rows by turn as reply trees of one branch each: every message answers the one before it."""
    at = F.row_number().over(W.partitionBy(conv).orderBy(turn, role, text)).cast("long")
    rows = messages.select(F.col(conv).alias("conv"), at.alias("msg"), F.col(role).alias("role"), F.col(text).alias("text"))
    return rows.select("conv", "msg", F.when(F.col("msg") > 1, F.col("msg") - 1).alias("parent"), "role", "text", F.lit(0.0).alias("score"))


def paths(messages: DataFrame) -> DataFrame:
    """(conv, leaf, up, msg) for (conv, msg, parent): every message on each root-to-leaf path, ``up`` steps from the leaf."""
    nodes = messages.select("conv", "msg", "parent")
    known = nodes.select("conv", F.col("msg").alias("parent"), F.lit(True).alias("known"))
    links = nodes.where("parent is not null").join(known, ["conv", "parent"]).select("conv", "msg", F.col("parent").alias("ancestor"))
    jumps = [stored(links, "replies")]
    longest = nodes.groupBy("conv").count().agg(F.max("count")).first()[0] or 0
    while 2 ** len(jumps) < longest:
        last = jumps[-1]
        on = last.select("conv", F.col("msg").alias("ancestor"), F.col("ancestor").alias("further"))
        following = stored(last.join(on, ["conv", "ancestor"]).select("conv", "msg", F.col("further").alias("ancestor")), "replies")
        if following.isEmpty():
            break
        jumps.append(following)
    leaves = nodes.join(jumps[0].select("conv", F.col("ancestor").alias("msg")), ["conv", "msg"], "left_anti")
    found = leaves.select("conv", F.col("msg").alias("leaf"), F.lit(0).cast("long").alias("up"), "msg")
    for k in reversed(range(len(jumps))):
        step = found.join(jumps[k], ["conv", "msg"]).select("conv", "leaf", (F.col("up") + 2**k).alias("up"), F.col("ancestor").alias("msg"))
        found = stored(found.union(step), "paths")
    # a path that hangs on a cycle goes round and never comes to a root
    roots = nodes.select("conv", "msg").join(jumps[0].select("conv", "msg"), ["conv", "msg"], "left_anti")
    return found.join(found.join(roots, ["conv", "msg"]).select("conv", "leaf"), ["conv", "leaf"], "left_semi")


def conversations(messages: DataFrame, best: int | None = None) -> DataFrame:
    """(conv, leaf, branch, n_turns, formatted, loss) for (conv, msg, parent, role, text, score), one row for each path.

    branch: 1 for the path of the highest mean score (ties: the smaller leaf). loss: array of (start, length) in code
    points of ``formatted``, the assistant's texts. ``best`` keeps that many branches of each conversation.
    """
    m = messages.groupBy("conv", "msg").agg(
        F.min(F.struct(F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"), "parent", F.coalesce("score", F.lit(0.0)).alias("score"))).alias("m")
    )
    m = stored(m.select(F.struct(F.col("conv").alias("id")).alias("conv"), "msg", "m.*"), "messages")  # joins match structs of null
    steps = stored(paths(m), "steps")
    scores = steps.join(m.select("conv", "msg", "score"), ["conv", "msg"]).groupBy("conv", "leaf").agg(F.avg("score").alias("mean"), F.count("*").alias("n"))
    branch = F.row_number().over(W.partitionBy("conv").orderBy(F.desc("mean"), "leaf"))
    chosen = scores.withColumn("branch", branch)
    if best is not None:
        chosen = chosen.where(F.col("branch") <= best)
    turns = steps.join(chosen.drop("mean"), ["conv", "leaf"]).join(m.select("conv", "msg", "role", "text"), ["conv", "msg"])
    head = F.concat(F.lit(TURN), escaped(F.col("role")), F.lit(TEXT))
    turns = turns.select("conv", "leaf", "branch", "n", "up", "role", head.alias("head"), escaped(F.col("text")).alias("body"))
    turns = turns.withColumn("size", F.length("head") + F.length("body") + F.lit(len(END)))
    down = W.partitionBy("conv", "leaf").orderBy(F.desc("up"))
    turns = turns.withColumn("start", F.sum("size").over(down) - F.col("size") + F.length("head"))
    span = F.when(F.col("role") == "assistant", F.struct(F.col("start").cast("long").alias("start"), F.length("body").cast("long").alias("length")))
    row = F.struct(F.negative("up").alias("down"), F.concat("head", "body", F.lit(END)).alias("turn"), span.alias("span"))
    whole = turns.groupBy("conv", "leaf", "branch", "n").agg(F.array_sort(F.collect_list(row)).alias("rows"))
    return whole.select(
        F.col("conv.id").alias("conv"),
        "leaf",
        "branch",
        F.col("n").alias("n_turns"),
        F.concat_ws("", F.col("rows.turn")).alias("formatted"),
        F.filter(F.col("rows.span"), lambda s: s.isNotNull()).alias("loss"),
    )


def turns_of(formatted: Column) -> Column:
    """array of (role, text) read back from a formatted conversation."""
    parts = F.split(formatted, r"<\|end\|>")
    bodies = F.slice(parts, 1, F.size(parts) - 1)

    def read(turn: Column) -> Column:
        both = F.split(F.substring(turn, len(TURN) + 1, 1 << 30), r"<\|text\|>")
        return F.struct(unescaped(both[0]).alias("role"), unescaped(both[1]).alias("text"))

    return F.transform(bodies, read)


def loss_text(formatted: Column, loss: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.concat_ws("", F.transform(loss, lambda s: unescaped(F.substring(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")))))
