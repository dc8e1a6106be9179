"""Mixing sources to target weights by systematic sampling.

Within a source the expected copies of its documents are summed up in order of size; one random offset is
added to the running sum, and a document is emitted once for each integer the sum passes on it. Ordered
by size, a source's words differ from its target by at most twice its largest document.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import WORD, packed, positions, unpack
from tidemark.sources.staging import stage

# offsets are odd multiples of 1 / 8192, so whole rates of up to 2^38 rows add to them exactly
OFFSETS = 4096


def size_of(text: Column) -> Column:
    """Words of a text: runs of characters that are not ASCII white space; null has none."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def targets(sizes: DataFrame, weights: Sequence[float], share: float, stop: float) -> DataFrame:
    """Add ``target`` to one row per source (source, source_size).

    Sources by code point, null last, take the weights in turn and share ``share`` times all sizes by
    weight. A target stops at ``stop`` times its source's size; what is above is shared by weight among
    the others until none is above. That settles at min(level x weight, stop x size) with one level,
    found where sources in order of size / weight stop being full.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1
    weighed = sizes.withColumn("weight", F.element_at(F.array(*(F.lit(float(w)) for w in weights)), turn))
    weighed = weighed.withColumn("full", stop * F.col("source_size"))
    ratio = F.col("full") / F.col("weight")
    by_ratio = Window.orderBy(ratio, F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    earlier, later = by_ratio.rowsBetween(Window.unboundedPreceding, -1), by_ratio.rowsBetween(0, Window.unboundedFollowing)
    left = share * F.sum("source_size").over(everything) - F.coalesce(F.sum("full").over(earlier), F.lit(0.0))
    # the level if this source and all later ones are not full: right for the first that it doesn't fill
    ranked = weighed.withColumn("level", left / F.sum("weight").over(later)).withColumn("at", F.row_number().over(by_ratio))
    first = F.min(F.when(F.col("level") <= ratio, F.struct("at", "level"))).over(everything)["level"]
    return ranked.withColumn("target", F.least(F.coalesce(first * F.col("weight"), F.col("full")), F.col("full"))).drop(
        "weight", "full", "level", "at"
    )


def offset_of(source: Column, seed: int) -> Column:
    """The source's random offset, from 0 to 1, by a digest of seed and name."""
    name = F.coalesce(F.concat(F.lit(f"{seed}:="), source), F.lit(f"{seed}:"))
    return (F.conv(F.substring(F.md5(name), 1, 3), 16, 10).cast("double") + 0.5) / OFFSETS


def copies(rows: DataFrame, weights: Sequence[float], share: float, stop: float, seed: int) -> DataFrame:
    """Add source_size, target and copies to narrow rows that have source, id, size and crc."""
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    # one row per source
    mixed = targets(sizes, weights, share, stop).select(
        F.col("source").alias("_source"), "source_size", "target", offset_of(F.col("source"), seed).alias("offset")
    )
    placed = positions(rows, [F.col("size"), F.col("id"), F.col("crc")], by=["source"])
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    upto = lambda k: F.floor(F.col("offset") + rate * k)
    crossed = upto(F.col("position") + 1) - upto(F.col("position"))
    joined = placed.join(mixed, F.col("source").eqNullSafe(F.col("_source")))
    return joined.withColumn("copies", F.least(crossed, F.lit(stop).cast("long"))).drop("_source", "offset", "position", "n_in_group")


def _narrow(df: DataFrame, id_col: str, text_col: str, source_col: str, *more: Column) -> DataFrame:
    text = F.col(f"`{text_col}`")
    return df.select(
        F.col(f"`{id_col}`").alias("id"),
        F.col(f"`{source_col}`").alias("source"),
        size_of(text).alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("crc"),
        *more,
    )


def plan_mix(
    df: DataFrame,
    weights: Sequence[float] = (3, 1, 2),
    share: float = 1.5,
    stop: float = 2.0,
    seed: int = 11,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """One row per row of ``df``: id, source, size (words), crc, source_size, target, copies.

    ``stop`` is a whole number. A null text has size 0; null is a source of its own, the last. Documents
    of one source and size are taken in order of id, then checksum; rows equal in all of these may
    change places. A source without words has target 0 and no copies. The result depends on the rows and
    the parameters only. Texts of any length are counted where they are read and not moved. Other columns don't matter, whatever their names. An empty
    table gives an empty result.
    """
    return copies(stage(_narrow(df, id_col, text_col, source_col)), weights, share, stop, seed)


def mix(
    df: DataFrame,
    weights: Sequence[float] = (3, 1, 2),
    share: float = 1.5,
    stop: float = 2.0,
    seed: int = 11,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """The mix itself: rows of ``df``, each as often as ``plan_mix`` says. Rows are numbered in a staged
    copy, so rows that repeat an id stay apart."""
    numbered = stage(df.select(packed(df).alias("row"), F.monotonically_increasing_id().alias("place")))
    flat = numbered.select("place", F.col(f"row.`{id_col}`").alias("id"), F.col(f"row.`{text_col}`").alias("text"), F.col(f"row.`{source_col}`").alias("source"))
    narrow = stage(_narrow(flat, "id", "text", "source", F.col("place")))
    taken = copies(narrow, weights, share, stop, seed).filter("copies > 0").select("place", "copies")
    repeated = numbered.join(taken, "place").withColumn("again", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int"))))
    return unpack(repeated, df)
