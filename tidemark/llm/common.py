"""What the text operators share: table reading, byte-wise words, positions in a global order."""

from __future__ import annotations

import contextlib
import functools
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.session import ship
from tidemark.sources.staging import stage

# one word: a run of characters that are not ASCII white space
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# bytes of an Arrow batch; by default there are 10,000 rows in one, whatever their size
BATCH, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 2**22


@contextlib.contextmanager
def small_batches(spark: SparkSession):
    """Actions in here hand texts to Python in batches of about ``BATCH_BYTES``, a longer text alone; a limit the session sets stays.
    Executors and workers hold several copies of a batch and keep that memory for the next."""
    if spark.conf.get(BATCH, None) is not None:
        yield
        return
    spark.conf.set(BATCH, str(BATCH_BYTES))
    try:
        yield
    finally:
        spark.conf.unset(BATCH)


def stage_lean(df: DataFrame) -> DataFrame:
    """``stage``, after which the shuffle files of the job are removed: what is written is all that is
    read again. Keeps the disk of a long chain of shuffles at that of its largest step. Arrow batches are small."""
    spark = df.sparkSession
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        with small_batches(spark):
            return stage(df)
    finally:
        spark.conf.set(CLEANUP, before)


def shipped(operator):
    """An operator on a DataFrame whose Arrow functions need this package on the workers: it is handed out first."""

    @functools.wraps(operator)
    def run(df: DataFrame, *args, **kwargs):
        ship(df.sparkSession)
        return operator(df, *args, **kwargs)

    return run


def tidy(task: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """An Arrow function that gives back what Arrow's pool keeps, once its task is over. Workers serve task after task of
    any step, and each would stay as large as its largest batches made it."""

    @functools.wraps(task)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from task(batches)
        pa.default_memory_pool().release_unused()

    return run


_held: dict = {}


def hold(words: dict) -> dict:
    """``words``, which this worker remembers from now on. Those of another operator are dropped, so that a worker holds one's at a time."""
    global _held
    if words is not _held:
        _held.clear()
        _held = words
    return words


def packed(df: DataFrame) -> Column:
    """All columns as one struct, so that working columns clash with none of them."""
    return F.struct(*(F.col(f"`{name}`") for name in df.columns))


def unpack(df: DataFrame, like: DataFrame, column: str = "row") -> DataFrame:
    return df.select(*(F.col(f"{column}.`{name}`").alias(name) for name in like.columns))


class WordHashes(dict):
    """64-bit hash per word (bytes), remembered up to ``most`` words and then begun anew."""

    def __init__(self, most: int = 400_000):
        super().__init__()
        self.most = most

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def text_bytes(column) -> list[bytes]:
    """The texts of an Arrow string column as UTF-8; null is the empty text."""
    return [value or b"" for value in column.cast(pa.binary()).to_pylist()]


def in_slices(texts: list[bytes], most: int = 1_000_000) -> Iterator[tuple[int, list[bytes]]]:
    """(first, texts): runs of about ``most`` bytes, so that the words of a whole batch are never held at
    once; a longer text is a run of its own."""
    first, size = 0, 0
    for at, text in enumerate(texts):
        if size and size + len(text) > most:
            yield first, texts[first:at]
            first, size = at, 0
        size += len(text)
    if first < len(texts):
        yield first, texts[first:]


def positions(df: DataFrame, order: Sequence[Column], by: Sequence[str] = (), into: str = "position") -> DataFrame:
    """Add each row's 0-based position in ``order`` among the rows with equal ``by``, and ``n_in_group``.

    Rows are cut into ranges of (by, order), so a group of any size is spread over many ranges; a row's
    position is its number within its range plus the rows of its group in earlier ranges. Ranges only
    decide where work happens: positions depend on ``order`` alone, up to rows equal in all of it.
    The frame should be narrow; it is staged once so that ranges stay as they were dealt.
    """
    keys = [F.col(name) for name in by]
    ranged = stage(df.repartitionByRange(*keys, *order).withColumn("_range", F.spark_partition_id()))
    sizes = ranged.groupBy("_range", *by).agg(F.count(F.lit(1)).alias("_n"))
    group = Window.partitionBy(*by) if by else Window.partitionBy()
    before = group.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    # one row per range and group: as many as there are ranges, plus one per group
    starts = sizes.select(
        F.col("_range").alias("_at"),
        *(F.col(name).alias(f"_by_{name}") for name in by),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"),
        F.sum("_n").over(group).alias("n_in_group"),
    )
    same = F.col("_range") == F.col("_at")
    for name in by:
        same = same & F.col(name).eqNullSafe(F.col(f"_by_{name}"))
    inside = Window.partitionBy("_range", *by).orderBy(*order)
    return (
        ranged.withColumn("_inside", F.row_number().over(inside))
        .join(starts, same)
        .withColumn(into, F.col("_start") + F.col("_inside") - 1)
        .drop("_range", "_at", "_inside", "_start", *(f"_by_{name}" for name in by))
    )
