"""A Merkle manifest of documents as a content-addressed graph, and proofs by descending it.

A document's digest is a leaf.  In each group (language) leaves lie in the order of doc_id; eight
consecutive nodes have one parent, whose digest is that of its children's digests one after
the other.  What remains of each group, in the order of groups, goes through the same steps up to one root.

Nodes are stored by content: digest and children, a table for each height.  A leaf is asked for by its position.
From the root down, every digit of the position, to the base eight, selects a child; the
children not selected are the proof.  Requests that share the leading digits share the
way, so they descend as one row: a step joins the rows that descend, one for each node of
that height, with the stored nodes on the digest, and no step meets more rows than the tree has nodes there.
Only the last step looks at leaves, where each reads its siblings and the way of its parent, reversed.

Positions are found without gathering a group: rows are dealt by ranges of the order, numbered in
their range, and the counts of the ranges before are added.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from echolattice.llm.common import cut, discard, partitions

#: Children of a node, and bits of a digit of a position.
FAN, DIGIT = 8, 3
#: What a leaf is made of, in this order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(text: Column) -> Column:
    """Lowercase hex SHA-256 of the UTF-8 bytes."""
    return F.sha2(text.cast("binary"), 256)


def leaf(*values: Column) -> Column:
    """Digest of values, each as its UTF-8 length, a colon and itself, or a dash if null."""
    texts = [v.cast("string") for v in values]
    return digest(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]))


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, all else unchanged."""
    return F.translate(text, _UPPER, _LOWER)


def fold(own: Column, steps: Column) -> Column:
    """The root that follows from a leaf and the steps of its proof."""
    return F.aggregate(steps, own, lambda below, s: digest(F.concat(s["left"], below, s["right"])))


def siblings(steps: Column) -> Column:
    """All digests of a proof, from the leaf up, left to right."""
    return F.array_join(F.transform(steps, lambda s: F.concat(s["left"], s["right"])), "")


@dataclass
class Manifest:
    """``placed``: the rows with group (its position), position and height; ``groups``: group, subroot, height;
    ``nodes`` and ``top``: tables (digest, children) from height one up, in groups and above them; ``root``: null for no rows."""

    placed: DataFrame
    groups: DataFrame
    nodes: list[DataFrame]
    top: list[DataFrame]
    root: str | None


def _height(n: Column) -> Column:
    """Steps until ``n`` nodes have become one."""
    height = F.lit(0)
    for k in range(1, 21):
        height = F.when(n > F.lit(FAN ** (k - 1)), F.lit(k)).otherwise(height)
    return height


def _ordered(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """The rows with ``part`` and ``at``, numbers that rise with the order; written, so that they stay as they are.

    Rows equal in all of ``order`` are dealt out by a hash: which of them comes first does not matter.
    """
    equal = F.xxhash64(F.monotonically_increasing_id())
    ranged = rows.withColumn("equal", equal).repartitionByRange(partitions(rows.sparkSession), *[F.asc_nulls_first(c) for c in (*order, "equal")])
    return cut(ranged.sortWithinPartitions(*[F.asc_nulls_first(c) for c in (*order, "equal")]).withColumn("at", F.monotonically_increasing_id()).withColumn("part", F.spark_partition_id()).drop("equal"), name)


def _spans(ordered: DataFrame, *group: str) -> DataFrame:
    """part, group, first (``at`` there), before (rows of the group in parts before) and n (of the group)."""
    spans = ordered.groupBy("part", *group).agg(F.min("at").alias("first"), F.count("*").alias("n_here"))
    whole = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
    earlier = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return spans.select("part", *group, "first", F.coalesce(F.sum("n_here").over(earlier), F.lit(0)).alias("before"), F.sum("n_here").over(whole).alias("n"))


def _same(left: DataFrame, right: DataFrame, *names: str) -> Column:
    out = F.lit(True)
    for name in names:
        out = out & left[name].eqNullSafe(right[name])
    return out


def _grow(level: DataFrame, most: int, name: str) -> tuple[list[DataFrame], DataFrame]:
    """All heights above ``level`` (group, i, digest, n), and the last node of each group (group, digest, height)."""
    tables, last, height = [], level.where("n = 1").select("group", "digest", F.lit(0).alias("height")), 0
    while most > 1:
        height, most = height + 1, -(-most // FAN)
        runs = level.where("n > 1").groupBy("group", F.shiftright("i", DIGIT).alias("i"))
        # At most eight rows a group.
        grown = runs.agg(F.array_sort(F.collect_list(F.struct("i", "digest"))).alias("run"), F.ceil(F.first("n") / FAN).alias("n"))
        children = F.transform("run", lambda r: r["digest"])
        grown = grown.select("group", "i", "n", children.alias("children"), digest(F.array_join(children, "")).alias("digest"))
        level = cut(grown, f"{name}-{height}")
        tables.append(level)
        last = last.unionByName(level.where("n = 1").select("group", "digest", F.lit(height).alias("height")))
    return tables, last


def build(rows: DataFrame, group: str = "lang", order: str = "doc_id") -> Manifest:
    """The manifest of ``rows`` (group, order, ``leaf`` and any others, which stay with ``placed`` under their names).

    Null groups and null orders come before all others; leaves equal in both lie in the order of their digests.
    Repeated rows are leaves of their own.  No rows give a manifest without nodes whose root is null.
    """
    others = [c for c in rows.columns if c not in (group, order, "leaf")]
    plain = cut(rows.select(F.col(group).alias("name"), F.col(order).alias("key"), "leaf", F.struct(F.lit(0).alias("_"), *others).alias("others")), "leaves")
    ordered = _ordered(plain, ["name", "key", "leaf"], "ordered")
    discard(plain)
    spans = cut(_spans(ordered, "name"), "spans")
    names = _ordered(spans.groupBy("name").agg(F.first("n").alias("n")), ["name"], "names")
    number = _spans(names)
    names = cut(names.join(number.drop("n"), "part").select("name", "n", (F.col("before") + F.col("at") - F.col("first")).alias("group")), "numbers")
    spans = spans.drop("n").join(names, _same(spans, names, "name")).select(spans["part"], spans["name"], "first", "before", "n", "group")
    position = F.col("before") + F.col("at") - F.col("first")
    placed = ordered.join(spans, (ordered["part"] == spans["part"]) & _same(ordered, spans, "name"))
    placed = cut(placed.select("group", position.alias("i"), "n", _height(F.col("n")).alias("height"), ordered["name"], "key", "leaf", "others"), "placed")
    discard(ordered)
    most, n_groups = names.agg(F.max("n"), F.count("*")).first()
    nodes, last = _grow(placed.select("group", "i", F.col("leaf").alias("digest"), "n"), most or 0, "nodes")
    last = cut(last, "subroots")
    top, root = _grow(last.select(F.lit(0).cast("long").alias("group"), F.col("group").alias("i"), "digest", F.lit(n_groups).alias("n")), n_groups, "top")
    found = root.select("digest").first()
    named = placed.select("group", "i", "height", F.col("name").alias(group), F.col("key").alias(order), "leaf", *[F.col("others")[c].alias(c) for c in others])
    return Manifest(named, last.select("group", F.col("digest").alias("subroot"), "height"), nodes, top, found and found[0])


def _stored(table: DataFrame) -> DataFrame:
    """A node for each digest: equal subtrees are stored once."""
    return table.select("digest", "children").dropDuplicates(["digest"])


def _segment(children: Column, digit: Column) -> Column:
    """The children that a digit doesn't select."""
    return F.struct(F.array_join(F.slice(children, 1, digit), "").alias("left"), F.array_join(F.slice(children, digit + 2, FAN), "").alias("right"))


def _descend(rows: DataFrame, table: DataFrame, place: str) -> DataFrame:
    """From nodes (digest, ``place``, way) to all their children."""
    met = rows.join(_stored(table), "digest")
    every = met.select(*[c for c in rows.columns if c != "digest"], "children", F.posexplode("children").alias("digit", "child"))
    below = F.col(place) * FAN + F.col("digit")
    way = F.concat("way", F.array(_segment(F.col("children"), F.col("digit"))))
    return every.withColumn("way", way).withColumn(place, below).withColumnRenamed("child", "digest").drop("children", "digit")


def prove(manifest: Manifest, requests: DataFrame | None = None) -> DataFrame:
    """Every row of ``manifest.placed`` with ``subroot``, ``root`` and ``steps``: from the leaf up, the
    digests left and right of the own one in each run.

    ``requests`` (group, i): only these leaves, by way of the nodes above them; None: all.
    """
    spark = manifest.placed.sparkSession
    no_way = F.array().cast("array<struct<left:string,right:string>>")
    wanted: list[DataFrame | None] = [None] * (len(manifest.nodes) + 1)
    if requests is not None:
        wanted = [cut(requests.select("group", F.col("i").cast("long").alias("i")).distinct(), "wanted")]
        for _ in manifest.nodes:
            wanted.append(cut(wanted[-1].select("group", F.shiftright("i", DIGIT).alias("i")).distinct(), "wanted"))

    def asked(rows: DataFrame, height: int) -> DataFrame:
        return rows if wanted[height] is None else rows.join(wanted[height], ["group", "i"], "left_semi")

    root = manifest.root or ""
    # Written, or Spark would take the constant digest for a filter and join without a key.
    rows = cut(spark.range(1 if manifest.root else 0).select(F.col("id").alias("group"), F.lit(root).alias("digest"), no_way.alias("way")), "root")
    for height in range(len(manifest.top), 0, -1):
        rows = cut(_descend(rows, manifest.top[height - 1], "group"), "way")
    start = rows.join(manifest.groups, "group").select("group", F.lit(0).cast("long").alias("i"), "digest", "way", "subroot", "height")
    start = cut(asked(start.where("height = 0"), 0).unionByName(asked(start.where("height > 0"), len(manifest.nodes))), "start")
    lone = start.where("height = 0").select("group", "i", "subroot", "way", F.lit(None).cast("array<string>").alias("children"))
    rows, parents = None, lone
    for height in range(len(manifest.nodes), 0, -1):
        here = start.where(F.col("height") == height).drop("height")
        rows = here if rows is None else rows.unionByName(here)
        if height > 1:
            rows = cut(asked(_descend(rows, manifest.nodes[height - 1], "i"), height - 1), "way")
        else:
            parents = parents.unionByName(rows.join(_stored(manifest.nodes[0]), "digest").select("group", "i", "subroot", "way", "children"))
    parents = parents.select("group", F.col("i").alias("parent"), "subroot", "way", "children")
    leaves = asked(manifest.placed, 0).withColumn("parent", F.shiftright("i", DIGIT))
    own = F.array(_segment(F.col("children"), F.col("i").bitwiseAND(FAN - 1).cast("int")))
    steps = F.concat(F.when(F.col("children").isNull(), no_way).otherwise(own), F.reverse("way"))
    return leaves.join(parents, ["group", "parent"]).select(*manifest.placed.columns, "subroot", F.lit(root).alias("root"), steps.alias("steps"))


def document_leaves(docs: DataFrame) -> DataFrame:
    """lang, doc_id, leaf, and ``tampered``: the leaf with the text's A-Z lower-cased where three divides the CRC-32 of the doc_id, else the same.

    Other columns are left out, whatever their names.  A null doc_id has no CRC-32 and is not tampered with.
    """
    own = docs.select(*FIELDS)
    fields = [F.col(c) for c in FIELDS]
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    return own.select("lang", "doc_id", leaf(*fields).alias("leaf"), F.when(F.coalesce(hit, F.lit(False)), leaf(*fields[:-1], ascii_lower(F.col("text")))).alias("changed"))


def checked(docs: DataFrame) -> DataFrame:
    """doc_id, lang, leaf, subroot, root, steps, folded_root and verified, one row per row of ``docs`` (doc_id, source, lang, n_chars, text).

    Nulls count as such (a dash) in a leaf; a null lang is a group, before all others.  A null doc_id comes
    first in its group.  Repeated rows are leaves of their own with their own proofs, in
    any order among themselves.  An empty text has length 0 and differs from null.  A table of one row has its leaf as root and an
    empty proof; an empty table gives no rows.  Texts of any length are read by one task, without copies in Python.
    """
    found = prove(build(document_leaves(docs)))
    folded = fold(F.coalesce("changed", "leaf"), F.col("steps"))
    return found.withColumn("folded_root", folded).withColumn("verified", F.col("folded_root") == F.col("root")).drop("group", "i", "height", "changed")
