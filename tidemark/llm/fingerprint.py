"""Document fingerprints: a homomorphic multiset hash over paragraphs.

Each paragraph gives a vector of 64 lanes, signed 16-bit numbers cut from two salted SHA-512 digests of it; a
document's fingerprint is their sum modulo 2^32 per lane. The sum does not depend on order, and paragraphs are added
to or taken from a fingerprint without the rest of the text. The difference of two fingerprints is the
sum over the paragraphs they don't share, so the angle between them tells how much they share.

All of it is column expressions; nothing leaves the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LANES = 64
MODULUS = 2**32
# a paragraph is a line; longer lines are cut after each PIECE_WORDS words
PIECE_WORDS = 8


def paragraphs(text: Column) -> Column:
    """Lines of a text, long ones cut after every eighth word; blank ones vanish, null has none."""
    pattern = r"(?:[^\s]+[^\S\n\r]*){1,%d}" % PIECE_WORDS
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(pattern), F.lit(0))


def _signed(lane: Column) -> Column:
    """The representative from -2^31 to 2^31 - 1."""
    return F.pmod(lane + MODULUS // 2, F.lit(MODULUS)) - MODULUS // 2


def lanes_of(piece: Column) -> Column:
    """A piece's vector: 1024 bits of digest, 16 a lane. Each lambda binds what it is given, so nothing is
    hashed or parsed twice."""
    digests = F.array(*(F.sha2(F.concat(F.lit(salt), piece), 512) for salt in "01"))
    starts = F.array(*(F.lit(1 + 16 * k) for k in range(8)))
    # to base -10: as a signed number of 64 bits
    parse = lambda digest, at: F.conv(F.substring(digest, at, F.lit(16)), 16, -10).cast("long")
    words = F.flatten(F.transform(digests, lambda digest: F.transform(starts, lambda at: parse(digest, at))))
    return F.flatten(F.transform(words, lambda w: F.array(*(F.shiftright(F.shiftleft(w, up), 48) for up in (0, 16, 32, 48)))))


def fingerprint(pieces: Column) -> Column:
    """The sum of the pieces' vectors: an array of 64 longs."""
    zero = F.array_repeat(F.lit(0).cast("long"), LANES)
    add = lambda sums, piece: F.zip_with(sums, lanes_of(piece), lambda lane, x: _signed(lane + x))
    return F.aggregate(pieces, zero, add)


def plus(a: Column, b: Column) -> Column:
    """The fingerprint of both multisets together: insertion of b into a."""
    return F.zip_with(a, b, lambda x, y: _signed(x + y))


def minus(a: Column, b: Column) -> Column:
    """The fingerprint of a without b: deletion."""
    return F.zip_with(a, b, lambda x, y: _signed(x - y))


def as_text(a: Column) -> Column:
    """512 hexadecimal digits, eight a lane."""
    return F.array_join(F.transform(a, lambda x: F.lpad(F.hex(F.pmod(x, F.lit(MODULUS))), 8, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Cosine of two fingerprints, 0 at least; 1 for equal ones, 0 if only one is empty."""
    total = lambda x: F.aggregate(x, F.lit(0.0), lambda acc, v: acc + v)
    product = lambda x, y: total(F.zip_with(x, y, lambda p, q: p.cast("double") * q))
    lengths = F.sqrt(product(a, a) * product(b, b))
    cosine = F.when(lengths > 0, product(a, b) / lengths).otherwise(F.lit(0.0))
    return F.when(a == b, F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), cosine)))


def with_next(rows: DataFrame, carried: list[str], key: str = "id") -> DataFrame:
    """Add ``next_<column>`` for each carried column: its value in the next row by ``key`` descending, of
    the last row in the first. Rows equal in ``key`` are ordered by the carried columns.

    The order is cut at keys taken from the data, a few per shuffle partition, so one exchange brings
    each piece of the order together; the first row of a piece also goes to the piece before it as a
    guest. Rows with a null key form the end of the last piece.
    """
    spark = rows.sparkSession
    parts = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    quantiles = F.percentile_approx(key, F.array(*(F.lit((i + 1) / parts) for i in range(parts))), F.lit(20 * parts))
    # at most 4 x shuffle.partitions keys; the last is the greatest of all
    cuts = sorted(set(rows.agg(quantiles).first()[0] or []))
    pieces = F.array(*(F.lit(c) for c in cuts)) if cuts else F.array().cast("array<bigint>")
    # piece p holds the keys in (cuts[p-1], cuts[p]]; its first row in descending order has key cuts[p]
    piece = F.when(F.col(key).isNull(), F.lit(0)).otherwise(_index_of(F.col(key), cuts))
    head = F.array_contains(pieces, F.col(key)) if cuts else F.lit(False)
    before = F.pmod(piece + 1, F.lit(max(1, len(cuts))))
    stays, visits = F.struct(piece.alias("piece"), F.lit(0).alias("guest")), F.struct(before.alias("piece"), F.lit(1).alias("guest"))
    dealt = rows.withColumn("at", F.explode(F.when(F.coalesce(head, F.lit(False)), F.array(stays, visits)).otherwise(F.array(stays))))
    order = [F.col("at.guest"), F.col(key).desc_nulls_last(), *(F.col(c).desc_nulls_last() for c in carried)]
    inside = Window.partitionBy("at.piece").orderBy(*order)
    led = dealt.withColumns({f"next_{c}": F.lead(c).over(inside) for c in carried} | {"follows": F.lead(F.lit(True)).over(inside)})
    first = {f"next_{c}": F.when(F.col("follows"), F.col(f"next_{c}")).otherwise(F.col(c)) for c in carried}
    return led.filter("at.guest = 0").withColumns(first).drop("at", "follows")


def _index_of(value: Column, cuts: list) -> Column:
    """How many cuts lie below the value, by a nested choice of depth log2(len(cuts))."""

    def choose(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(value <= cuts[middle], choose(low, middle)).otherwise(choose(middle + 1, high))

    return choose(0, len(cuts) - 1) if cuts else F.lit(0)


def edited(text: Column, other: Column) -> Column:
    """The text with its last floor(n/2) code points replaced by the first as many (or all) of the other."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - half), F.substring(other, F.lit(1), half))


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``df``: id, n_chars, edited_sha256, fingerprint, edited_fingerprint (hexadecimal),
    near_edited, near_next.

    The next document is the next smaller id, after the last the first; null ids are the last. Rows that
    repeat an id are ordered by text. Null is the empty text; empty texts have the zero fingerprint and
    are like each other. A table with one row follows itself; an empty table gives an empty result. Ids must be
    numbers. A text is moved once, as one row, with that of the next document. Other columns don't matter, whatever their names.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = df.select(F.col(f"`{id_col}`").alias("id"), text.alias("text"))
    rows = rows.withColumn("sums", fingerprint(paragraphs(F.col("text"))))
    pairs = with_next(rows, ["text", "sums"])
    changed = pairs.withColumn("changed", edited(F.col("text"), F.col("next_text")))
    changed = changed.withColumn("changed_sums", fingerprint(paragraphs(F.col("changed"))))
    return changed.select(
        "id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("changed", 256).alias("edited_sha256"),
        as_text(F.col("sums")).alias("fingerprint"),
        as_text(F.col("changed_sums")).alias("edited_fingerprint"),
        likeness(F.col("sums"), F.col("changed_sums")).alias("near_edited"),
        likeness(F.col("sums"), F.col("next_sums")).alias("near_next"),
    )
