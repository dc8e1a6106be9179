"""Merkle manifest of a dataset: a tree per group of rows, and one over the groups.

The nodes of a level are pivoted by slot: conditional aggregates spread the up to 16 children of each
parent into 16 columns. The columns in a row, hashed, are the parent; leaving out a child's own column gives its
siblings, kept as what stands left and what stands right of it. Parents are built level by level up to the
root; then each level hands its children down what they need to be verified.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import positions, stage_lean

FANOUT = 16
LEAF_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
SLOTS = [f"slot_{k}" for k in range(FANOUT)]


def digest(*texts: Column) -> Column:
    """Lower-case hexadecimal SHA-256 of the texts one after another."""
    return F.sha2(F.concat(*texts), 256)


def leaf_digest(*columns: Column) -> Column:
    """Digest of a row: per column ``-`` if it is null, else its length in bytes of UTF-8, ``:``, and itself as text."""

    def field(column: Column) -> Column:
        text = column.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return digest(*map(field, columns))


def _pivot(nodes: DataFrame) -> DataFrame:
    """One row per parent from nodes (group, at, n, node), where n counts the nodes of the group's level: group,
    at, n and the children by slot."""
    slot = F.col("at") % FANOUT
    spread = [F.first(F.when(slot == k, F.col("node")), ignorenulls=True).alias(name) for k, name in enumerate(SLOTS)]
    return nodes.groupBy("group", F.floor(F.col("at") / FANOUT).alias("at"), "n").agg(*spread)


def _parents(level: DataFrame) -> DataFrame:
    """The nodes (group, at, n, node) that a pivoted level makes; a node that is alone stays as it is."""
    children = F.concat_ws("", *(f"{name}.digest" for name in SLOTS))
    made = F.when(F.col("n") == 1, F.col("slot_0.digest")).otherwise(F.sha2(children, 256))
    return level.select("group", "at", F.ceil(F.col("n") / FANOUT).alias("n"), F.struct(made.alias("digest")).alias("node"))


def _children(level: DataFrame, known: Sequence[str]) -> DataFrame:
    """From a pivoted level with ``path`` and the columns ``known`` of its parents: group, at and node of the
    children, their ``path`` (what stands left and right of the own node, level by level to the root), ``known``."""
    each = F.explode(F.array(*(F.struct(F.lit(k).alias("slot"), F.col(name).alias("node")) for k, name in enumerate(SLOTS))))
    out = level.withColumn("child", each).filter("child.node is not null")
    # the own column is left out; what comes before it and after it are the siblings
    slot = F.col("child.slot")
    left = F.concat_ws("", *(F.when(slot > k, F.col(f"{name}.digest")) for k, name in enumerate(SLOTS)))
    right = F.concat_ws("", *(F.when(slot < k, F.col(f"{name}.digest")) for k, name in enumerate(SLOTS)))
    step = F.array(F.struct(left.alias("left"), right.alias("right")))
    path = F.when(F.col("n") == 1, F.col("path")).otherwise(F.concat(step, "path"))
    return out.select("group", (F.col("at") * FANOUT + slot).alias("at"), "child.node", path.alias("path"), *known)


def _levels(nodes: DataFrame) -> list[DataFrame]:
    """The pivoted levels from the nodes (group, at, n, node) up to one node a group; at least one level."""
    levels = [stage_lean(_pivot(nodes))]
    most = levels[0].agg(F.max("n")).first()[0] or 0
    while (most := -(-most // FANOUT)) > 1:
        levels.append(stage_lean(_pivot(_parents(levels[-1]))))
    return levels


def _descend(tops: DataFrame, levels: list[DataFrame], known: Sequence[str]) -> DataFrame:
    """The nodes below ``tops`` (group, at, path and ``known``) after all levels: the children of the first."""
    for level in reversed(levels):
        above = tops.select(F.col("group").alias("_group"), F.col("at").alias("_at"), "path", *known)
        same = F.col("group").eqNullSafe(F.col("_group")) & (F.col("at") == F.col("_at"))
        tops = _children(level.join(above, same), known)
    return tops


def manifest(
    df: DataFrame,
    order_col: str = "doc_id",
    group_col: str = "source",
    leaf_columns: Sequence[str] = LEAF_COLUMNS,
    carry: dict[str, Column] | None = None,
) -> DataFrame:
    """Per row of ``df``: id (the order column), leaf, subroot (of its group), root, and path, an array of
    (left, right): the digests left and right of the own node, from the leaf's level to the root.

    Leaves of a group stand in ascending order of ``order_col``, null first, ties in order of the leaf;
    groups in ascending order, bytewise, null first: null is a group of its own. Each 16 consecutive nodes become
    one as long as there are several; the last run may be shorter, even one. A group of one row has its leaf as subroot and
    one group has its subroot as root. Repeated rows are leaves of their own. Nulls and empty texts differ in
    the leaf. Texts of any length are hashed where they are read and not moved. Columns other than ``leaf_columns`` don't
    matter, whatever their names; ``carry`` (name to expression on ``df``, of bounded size) is handed through in the
    struct ``carried``. An empty table gives an empty result.
    """
    carried = {"nothing": F.lit(None).cast("int"), **(carry or {})}
    leaves = df.select(
        F.col(f"`{group_col}`").alias("group"),
        F.col(f"`{order_col}`").alias("id"),
        leaf_digest(*(F.col(f"`{name}`") for name in leaf_columns)).alias("digest"),
        F.struct(*(column.alias(name) for name, column in carried.items())).alias("carried"),
    )
    placed = positions(leaves, [F.col("id"), F.col("digest")], by=["group"], into="at")
    levels = _levels(placed.select("group", "at", F.col("n_in_group").alias("n"), F.struct("digest", "id", "carried").alias("node")))
    groups = positions(_parents(levels[-1]).select("group", "node.digest"), [F.col("group")], into="at")
    over = _levels(groups.select(F.lit(0).alias("group"), "at", F.col("n_in_group").alias("n"), F.struct("digest", "group").alias("node")))
    nothing = F.array().cast("array<struct<left:string,right:string>>")
    root = _parents(over[-1]).select("group", "at", nothing.alias("path"), F.col("node.digest").alias("root"))
    subroots = _descend(root, over, ["root"]).select(
        F.col("node.group").alias("group"), F.lit(0).alias("at"), "path", "root", F.col("node.digest").alias("subroot")
    )
    found = _descend(subroots, levels, ["root", "subroot"])
    return found.select("node.id", F.col("node.digest").alias("leaf"), "subroot", "root", "path", "node.carried")


def proof_digest(path: Column) -> Column:
    """Digest of all siblings, level by level to the root, from left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda step: F.concat(step["left"], step["right"])), ""), 256)


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, leaf, lambda node, step: digest(step["left"], node, step["right"]))
