"""Exact deduplication with a heavy-hitter split.

Misra-Gries summaries per partition name the digests that may be frequent; their exact counts and
winners are verified by one aggregation and broadcast, so rows of frequent texts are settled where they
are read. Only the remaining digests go through an ordinary shuffle, in which no group can be large.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import packed, shipped, tidy, unpack
from tidemark.sources.staging import stage

# a digest on more than one in HEAVY_SHARE rows is heavy
HEAVY_SHARE = 4096


class MisraGries:
    """Counters for at most ``size`` keys; a key on more than n / (size + 1) of n rows is among them,
    counted too low by at most n / (size + 1)."""

    def __init__(self, size: int):
        self.size, self.counts = size, {}

    def add(self, keys) -> None:
        counts, size = self.counts, self.size
        for key in keys:
            if key in counts:
                counts[key] += 1
            elif len(counts) < size:
                counts[key] = 1
            else:
                # one from everyone: at most (rows / size) such passes, so constant work a row
                for other in [k for k, n in counts.items() if n == 1]:
                    del counts[other]
                for other in counts:
                    counts[other] -= 1


def heavy_candidates(digests: DataFrame, share: int = HEAVY_SHARE) -> DataFrame:
    """Digests that may be on more than one in ``share`` of the rows: all such, and few others.

    Each partition keeps 4 x share counters, so summed counters miss at most n / (4 share); digests
    whose sum reaches 3/4 of n / share number 4/3 share at most, whatever the data.
    """
    size = 4 * share

    @tidy
    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        summary, n = MisraGries(size), 0
        for batch in batches:
            summary.add(batch.column(0).to_pylist())
            n += batch.num_rows
        kept = summary.counts
        yield pa.record_batch(
            [pa.array([*kept, None], pa.binary()), pa.array([*kept.values(), n], pa.int64())], names=["digest", "n"]
        )

    counters = stage(digests.select("digest").mapInArrow(summarise, "digest binary, n long"))
    sums = counters.groupBy("digest").agg(F.sum("n").alias("n"))
    total = sums.filter("digest is null").agg(F.sum("n")).first()[0] or 0
    return sums.filter("digest is not null").filter(4 * share * F.col("n") >= 3 * total).select("digest")


def _winners(keys: DataFrame) -> DataFrame:
    """Per digest the largest id, how many rows there are and how many of them repeat that id."""
    ids = keys.groupBy("digest", "id").agg(F.count(F.lit(1)).alias("n"))
    return ids.groupBy("digest").agg(F.max(F.struct("id", "n")).alias("best"), F.sum("n").alias("group_size"))


def decide(rows: DataFrame, keys: DataFrame, share: int = HEAVY_SHARE) -> DataFrame:
    """Add keep_id, group_size and kept to ``rows``, which have the columns digest and id; ``keys`` are
    the same two columns, staged."""
    heavy = heavy_candidates(keys, share)
    # both broadcasts hold at most 4/3 share rows, see heavy_candidates
    settled = stage(_winners(keys.join(F.broadcast(heavy), "digest", "left_semi")))
    rest = stage(_winners(keys.join(F.broadcast(settled.select("digest")), "digest", "left_anti")))
    hot = rows.join(F.broadcast(settled), "digest")
    cold = rows.join(F.broadcast(settled.select("digest")), "digest", "left_anti").join(rest, "digest")
    judged = hot.unionByName(cold).withColumn("kept", F.col("id").eqNullSafe(F.col("best.id")))
    if settled.unionByName(rest).filter("best.n > 1").isEmpty():
        return judged.withColumn("keep_id", F.col("best.id")).drop("best")
    # rows that repeat the winner itself: one of them stays; numbered as staged, so the choice is made once
    again = F.col("kept") & (F.col("best.n") > 1)
    repeats = stage(judged.filter(again).withColumn("place", F.monotonically_increasing_id()))
    first = repeats.groupBy("digest").agg(F.min("place").alias("first"))
    repeats = repeats.join(first, "digest").withColumn("kept", F.col("place") == F.col("first")).drop("place", "first")
    return judged.filter(~again).unionByName(repeats).withColumn("keep_id", F.col("best.id")).drop("best")


@shipped
def exact_groups(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: Sequence[str] | None = None, share: int = HEAVY_SHARE
) -> DataFrame:
    """One row per row of ``df``: ``row`` (a struct of the columns in ``carry``, all by default), id,
    digest (SHA-256 of the text, binary), keep_id, group_size, kept.

    Texts are equal when their bytes are; null is the empty text. Of a group the row with the largest id
    stays. A null id is smaller than any other. When several rows repeat both the text and the largest
    id, one of them stays, no matter which. A text of any length is
    hashed where it is read and not moved. Columns in ``row`` may have any names. An empty table gives an empty result.
    """
    names = list(df.columns if carry is None else carry)
    rows = df.select(
        packed(df.select(*(f"`{name}`" for name in names))).alias("row"),
        F.unhex(F.sha2(F.coalesce(F.col(f"`{text_col}`"), F.lit("")), 256)).alias("digest"),
        F.col(f"`{id_col}`").alias("id"),
    )
    if text_col in names:
        return decide(rows, stage(rows.select("digest", "id")), share)
    rows = stage(rows)
    return decide(rows, rows.select("digest", "id"), share)


def drop_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of ``df`` without exact copies: of equal texts the row with the largest id."""
    return unpack(exact_groups(df, id_col, text_col).filter("kept"), df)
