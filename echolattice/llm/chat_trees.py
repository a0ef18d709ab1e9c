"""Chat formatting of reply trees, with DataFrame operations only.

Messages reply to messages, so a conversation is a tree (or several).  Iterative self-joins
enumerate its root-to-leaf paths: in each round the ancestors at distance 2^k of all
messages are joined with themselves to those at distance 2^(k+1), and the paths known so far are
continued by as much.  So rounds grow with the logarithm of the depth, and rows with the
length of the paths.  Paths are ranked by the sum of their scores, and each chosen path is
formatted as one conversation.

The template: ``<s>role\\ntext</s>`` for the assistant, ``<s>role\\n[INST]text[/INST]</s>`` for all others.
Where a text or role holds one of these control strings, its first character is written as a code,
``&1;`` for ``<`` and ``&2;`` for ``[``; ``&0;`` stands for ``&`` before what would else read as a
code, and ``&3;`` for a line break in a role.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from echolattice.llm.common import NO_ID, cut

ASSISTANT = "assistant"
OPEN, CLOSE, ASK, ASKED = "<s>", "</s>", "[INST]", "[/INST]"


def escape(text: Column) -> Column:
    text = F.regexp_replace(text, r"&(?=[0-3];)", "&0;")
    text = F.regexp_replace(text, r"<(?=/?s>)", "&1;")
    return F.regexp_replace(text, r"\[(?=/?INST\])", "&2;")


def unescape(text: Column) -> Column:
    for code, plain in (("&1;", "<"), ("&2;", "["), ("&3;", "\n"), ("&0;", "&")):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def chains(rows: DataFrame) -> DataFrame:
    """Conversations given turn by turn, as trees without branches: every message replies to the one before.

    ``rows``: conv_id, turn, role, text.  Turns may have gaps; of equal turns the
    order is that of role and text, null turns come first.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    numbered = rows.select("conv_id", F.row_number().over(order).cast("long").alias("node_id"), "role", "text")
    return numbered.withColumn("parent_id", F.col("node_id") - 1).withColumn("score", F.lit(0.0))


def paths(nodes: DataFrame, best: int = 1) -> DataFrame:
    """conv_id, path (rank from 1), depth (from 0), node_id: the ``best`` root-to-leaf paths of each conversation.

    ``nodes``: conv_id, node_id, parent_id, score (null: 0).  A message without a parent in the table is a root, and so
    is one whose parent_id is not smaller than its own node_id, so that there are no circles.  Messages
    without node_id are left out; of several with one node_id all are kept at its place.
    Paths are ranked by the sum of scores, the greater first, then by the smaller leaf.
    """
    spark_nodes = nodes.select(
        F.coalesce(F.col("conv_id").cast("long"), F.lit(NO_ID)).alias("c"), F.col("node_id").cast("long").alias("node"),
        F.col("parent_id").cast("long").alias("parent"), F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"),
    ).where("node is not null")
    grouped = spark_nodes.groupBy("c", "node").agg(F.min(F.when(F.col("parent") < F.col("node"), F.col("parent"))).alias("parent"), F.sum("score").alias("score"))
    known = cut(grouped, "nodes")
    there = known.select("c", F.col("node").alias("parent"))
    up = known.where("parent is not null").select("c", "node", "parent").join(there, ["c", "parent"]).select("c", "node", F.col("parent").alias("above"))
    up = cut(up, "above")
    answered = up.select("c", F.col("above").alias("node")).distinct()
    found = known.join(answered, ["c", "node"], "left_anti").select("c", F.col("node").alias("leaf"), "node", F.lit(0).cast("long").alias("steps"))
    step = 1
    while True:
        further = found.join(up, ["c", "node"]).select("c", "leaf", F.col("above").alias("node"), (F.col("steps") + step).alias("steps"))
        found = cut(found.unionByName(further), "paths")
        middle = up.select("c", F.col("node").alias("low"), F.col("above").alias("node"))
        up = cut(middle.join(up, ["c", "node"]).select("c", F.col("low").alias("node"), "above"), "above")
        step *= 2
        if up.isEmpty():
            break
    scored = found.join(known.select("c", "node", "score"), ["c", "node"])
    leaves = scored.groupBy("c", "leaf").agg(F.sum("score").alias("total"), F.max("steps").alias("last"))
    rank = F.row_number().over(Window.partitionBy("c").orderBy(F.desc("total"), "leaf"))
    chosen = leaves.withColumn("path", rank).where(F.col("path") <= best)
    return found.join(chosen, ["c", "leaf"]).select(
        F.nullif("c", F.lit(NO_ID)).alias("conv_id"), "path", (F.col("last") - F.col("steps")).alias("depth"), F.col("node").alias("node_id")
    )


def formatted(nodes: DataFrame, best: int = 1) -> DataFrame:
    """conv_id, path, formatted and loss (array of start and end): each chosen path as one conversation.

    ``nodes``: conv_id, node_id, parent_id, role, text, score; null roles and texts are empty, null conv_ids are one
    conversation.  ``loss`` has the places (in code points) of the assistant's texts in ``formatted``, as written
    there.  Other columns are ignored; an empty table gives no rows.
    """
    chosen = paths(nodes, best)
    text = nodes.select(
        "conv_id", F.col("node_id").cast("long").alias("node_id"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    same = chosen["conv_id"].eqNullSafe(text["conv_id"]) & (chosen["node_id"] == text["node_id"])
    own = F.col("role") == ASSISTANT
    head = F.concat(F.lit(OPEN), F.regexp_replace(escape(F.col("role")), "\n", "&3;"), F.lit("\n"), F.when(own, "").otherwise(ASK))
    body = escape(F.col("text"))
    turns = chosen.join(text, same).select(
        chosen["conv_id"], "path", "depth", own.alias("own"), head.alias("head"), body.alias("body"),
        F.concat(F.when(own, "").otherwise(ASKED), F.lit(CLOSE)).alias("tail"),
    )
    whole = turns.groupBy("conv_id", "path").agg(F.array_sort(F.collect_list(F.struct("depth", "head", "body", "tail", "own"))).alias("turns"))
    start = F.struct(F.lit(0).alias("end"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def walk(acc: Column, t: Column) -> Column:
        first = acc["end"] + F.length(t["head"])
        last = first + F.length(t["body"])
        span = F.struct(first.alias("start"), last.alias("end"))
        spans = F.when(t["own"], F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"])
        return F.struct((last + F.length(t["tail"])).alias("end"), spans.alias("spans"))

    joined = F.array_join(F.transform("turns", lambda t: F.concat(t["head"], t["body"], t["tail"])), "")
    return whole.select("conv_id", "path", joined.alias("formatted"), F.aggregate("turns", start, walk)["spans"].alias("loss"))


def read_back(done: DataFrame) -> DataFrame:
    """The input of :func:`formatted` from its output: turns (array of role and text) and under_loss (the unescaped text)."""
    pieces = F.slice(F.split("formatted", CLOSE), 1, F.size(F.split("formatted", CLOSE)) - 1)

    def turn(piece: Column) -> Column:
        role = F.substring_index(F.substr(piece, F.lit(len(OPEN) + 1)), "\n", 1)
        text = F.substr(piece, F.length(role) + len(OPEN) + 2)
        asked = F.substr(text, F.lit(len(ASK) + 1), F.length(text) - len(ASK) - len(ASKED))
        role = unescape(role)
        return F.struct(role.alias("role"), unescape(F.when(role == ASSISTANT, text).otherwise(asked)).alias("text"))

    under = F.transform("loss", lambda s: unescape(F.substr(F.col("formatted"), s["start"] + 1, s["end"] - s["start"])))
    return done.select("conv_id", "path", "formatted", F.transform(pieces, turn).alias("turns"), F.array_join(under, "").alias("under_loss"))
