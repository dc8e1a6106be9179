"""Benchmark decontamination by a prefix-filtered set join.

A window of a benchmark item is a set of shingles (strings of up to three words, with their places in it). A
document holds the window exactly only if it holds all of them, so by prefix filtering one shingle must be
looked up: the rarest by its count over all documents. Occurrences of it are bounded by length and position (the window must begin
and end inside the document) and then verified, word for word. Expressions and joins only, no Python workers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stage_lean

WINDOW = 10
SHINGLE = 3
# item tables up to so many rows are broadcast, larger ones are joined by a shuffle
BROADCAST_ROWS = 100_000
# fixed values: what separates words, once A-Z are lower case
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: Column) -> Column:
    """Lower-cased (A-Z) words: runs of digits, letters and characters beyond ASCII; null has none."""
    lowered = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.array_remove(F.split(lowered, SEPARATORS, -1), "")


def small(df: DataFrame, rows: int) -> DataFrame:
    """Marked for broadcast if it has few rows; Spark chooses the join else."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def shingles(df: DataFrame, size: int) -> DataFrame:
    """All shingles of ``size`` words of the column ``words``: adds place (0-based) and shingle (64-bit hash)."""
    places = F.when(F.size("words") >= size, F.sequence(F.lit(0), F.size("words") - size))
    word = lambda k: F.get("words", F.col("place") + k)
    return df.withColumn("place", F.explode(places)).withColumn("shingle", F.xxhash64(*map(word, range(size))))


def item_windows(benchmark: DataFrame, item_col: str, text_col: str, length: int) -> tuple[DataFrame, DataFrame]:
    """(windows, members): distinct windows (window, words), and the items (window, item) that each is from."""
    items = benchmark.select(
        F.coalesce(F.col(f"`{item_col}`").cast("string"), F.lit("")).alias("item"), words_of(F.col(f"`{text_col}`")).alias("all")
    ).filter(F.size("all") > 0)
    begin = F.explode(F.sequence(F.lit(1), F.greatest(F.size("all") - length + 1, F.lit(1))))
    each = items.withColumn("begin", begin).select("item", F.slice("all", F.col("begin"), length).alias("words")).distinct()
    windows = stage_lean(each.select("words").distinct().withColumn("window", F.monotonically_increasing_id()))
    return windows, stage_lean(each.join(windows, "words").select("window", "item"))


def _probes(windows: DataFrame, docs: DataFrame, size: int) -> DataFrame:
    """Windows that may occur, with the one shingle to look up: shingle, offset (its place in the window),
    window, words. ``docs`` has the column words."""
    held = stage_lean(shingles(windows, size).select("window", "place", "shingle"))
    sharing = held.groupBy("shingle").agg(F.count(F.lit(1)).alias("sharing"))
    sought = stage_lean(sharing)
    # over all documents; counted before they are shuffled
    counts = shingles(docs.select("words"), size).join(small(sought, sought.count()), "shingle").groupBy("shingle", "sharing")
    counts = stage_lean(counts.agg(F.count(F.lit(1)).alias("n")))
    rarest = held.join(counts, "shingle").groupBy("window").agg(
        F.count(F.lit(1)).alias("found"), F.min(F.struct("n", "sharing", "shingle", F.col("place").alias("offset"))).alias("best")
    )
    # a window with a shingle that no document has can't occur
    possible = windows.join(rarest, "window").filter(F.col("found") == F.size("words") - (size - 1))
    return stage_lean(possible.select("best.shingle", "best.offset", "window", F.col("words").alias("sought")))


def _occurrences(probes: DataFrame, docs: DataFrame, size: int) -> DataFrame:
    """Exact occurrences of windows: row, window, begin, end (words of the document)."""
    begin, length = F.col("place") - F.col("offset"), F.size("sought")
    met = shingles(docs.select("row", "words"), size).join(small(probes, probes.count()), "shingle")
    inside = met.filter((begin >= 0) & (begin + length <= F.size("words")))
    same = inside.filter(F.slice("words", begin + 1, length) == F.col("sought"))
    return same.select("row", "window", begin.alias("begin"), (begin + length).alias("end"))


def merged(spans: Column) -> Column:
    """Sorted spans (begin, end) as maximal ones."""
    last = lambda done: F.element_at(done, -1)

    def add(done: Column, span: Column) -> Column:
        longer = F.struct(last(done)["begin"].alias("begin"), F.greatest(last(done)["end"], span["end"]).alias("end"))
        joins = (F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["end"] >= span["begin"])
        shorter = F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0)))
        return F.when(joins, F.concat(shorter, F.array(longer))).otherwise(F.concat(done, F.array(span)))

    return F.aggregate(spans, F.array().cast("array<struct<begin:int,end:int>>"), add)


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    length: int = WINDOW,
) -> tuple[DataFrame, DataFrame]:
    """(found, item_sets). found has one row per row of ``docs``: id, n_words, spans (maximal runs of words
    inside an occurrence of a window; begin, end) and item_set, null where nothing was hit. item_sets: item_set,
    items, the ids as sorted strings; documents that hold the same windows share one.

    A window is ``length`` consecutive words of an item, or all words of a shorter one. Texts without words,
    null and empty ones too, hold nothing and are held by nothing. Rows of one item id are one item, a null id
    is the empty string; repeated documents and ids, null ones too, are rows of their own. Other columns
    don't matter, whatever their names. Empty tables give empty results, an empty benchmark finds nothing. A text is one
    row of words, of any length that fits a task: about fifty bytes a word.
    """
    words = words_of(F.col(f"`{text_col}`"))
    told = docs.select(F.col(f"`{id_col}`").alias("id"), F.monotonically_increasing_id().alias("row"), words.alias("words"))
    told = stage_lean(told.withColumn("n_words", F.size("words").cast("long")))
    windows, members = item_windows(benchmark, item_col, item_text_col, length)
    sizes = [r[0] for r in windows.select(F.least(F.size("words"), F.lit(SHINGLE))).distinct().collect()]
    hits = docs.sparkSession.createDataFrame([], "row long, window long, begin int, end int")
    for size in sorted(sizes):
        own = windows.filter(F.least(F.size("words"), F.lit(SHINGLE)) == size)
        hits = hits.unionByName(_occurrences(_probes(own, told, size), told, size))
    by_row = stage_lean(
        hits.groupBy("row").agg(
            merged(F.array_sort(F.collect_set(F.struct("begin", "end")))).alias("spans"),
            F.array_sort(F.collect_set("window")).alias("windows"),
        )
    )
    # documents with the same windows hit the same items: these are gathered once
    sets = stage_lean(by_row.select("windows").distinct().withColumn("item_set", F.monotonically_increasing_id()))
    items = sets.select("item_set", F.explode("windows").alias("window")).join(members, "window").select("item_set", "item").distinct()
    item_sets = items.groupBy("item_set").agg(F.array_sort(F.collect_list("item")).alias("items"))
    judged = by_row.join(sets, "windows").select("row", "spans", "item_set")
    found = told.select("row", "id", "n_words").join(judged, "row", "left")
    nothing = F.array().cast("array<struct<begin:int,end:int>>")
    return found.select("id", "n_words", F.coalesce("spans", nothing).alias("spans"), "item_set"), item_sets
