"""Running aggregates per key: totals, counts, extremes, carried values and the previous value.

Each measure knows four things: its window form inside a block, its total over a block, what the
earlier blocks of a key hand over, and how the two combine. Keys without blocks have no carry, and
the combination then leaves the window result as it is.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..functions.scalars import ColumnOrName, as_column
from .hot import BLOCK, SPLIT, Split, as_list, cut_hot_keys, spread_missing


@dataclass(frozen=True)
class Measure:
    value: Column

    def local(self, rows: WindowSpec, order: WindowSpec) -> Column:
        raise NotImplementedError

    def total(self, position: Column) -> Column:
        raise NotImplementedError

    def carry(self, total: Column, before: WindowSpec) -> Column:
        raise NotImplementedError

    def merge(self, local: Column, carry: Column) -> Column:
        raise NotImplementedError

    def nothing(self) -> Column:
        """The carry where there is nothing before."""
        return F.lit(None)


@dataclass(frozen=True)
class _Sum(Measure):
    def local(self, rows, order):
        return F.sum(self.value).over(rows)

    def total(self, position):
        return F.sum(self.value)

    def carry(self, total, before):
        return F.sum(total).over(before)

    def merge(self, local, carry):
        return F.when(carry.isNull(), local).otherwise(F.coalesce(local, F.lit(0)) + carry)

    def nothing(self):
        return F.lit(None).cast("int")


@dataclass(frozen=True)
class _Count(_Sum):
    def local(self, rows, order):
        return F.count(self.value).over(rows)

    def total(self, position):
        return F.count(self.value)


@dataclass(frozen=True)
class _Max(Measure):
    def local(self, rows, order):
        return F.max(self.value).over(rows)

    def total(self, position):
        return F.max(self.value)

    def carry(self, total, before):
        return F.max(total).over(before)

    def merge(self, local, carry):
        return F.greatest(local, carry)


@dataclass(frozen=True)
class _Min(Measure):
    def local(self, rows, order):
        return F.min(self.value).over(rows)

    def total(self, position):
        return F.min(self.value)

    def carry(self, total, before):
        return F.min(total).over(before)

    def merge(self, local, carry):
        return F.least(local, carry)


@dataclass(frozen=True)
class _Last(Measure):
    def local(self, rows, order):
        return F.last(self.value, ignorenulls=True).over(rows)

    def total(self, position):
        return F.max_by(self.value, F.when(self.value.isNotNull(), position))

    def carry(self, total, before):
        return F.last(total, ignorenulls=True).over(before)

    def merge(self, local, carry):
        return F.coalesce(local, carry)


@dataclass(frozen=True)
class _First(Measure):
    def local(self, rows, order):
        return F.first(self.value, ignorenulls=True).over(rows)

    def total(self, position):
        return F.min_by(self.value, F.when(self.value.isNotNull(), position))

    def carry(self, total, before):
        return F.first(total, ignorenulls=True).over(before)

    def merge(self, local, carry):
        return F.coalesce(carry, local)


@dataclass(frozen=True)
class _Previous(Measure):
    default: Column | None = None

    def _row(self) -> Column:
        # a row whose value is NULL is not the same as no row
        return F.struct(self.value.alias("value"))

    def local(self, rows, order):
        return F.struct(
            (F.row_number().over(order) == 1).alias("top"), F.lag(self.value, 1).over(order).alias("value")
        )

    def total(self, position):
        return F.max_by(self._row(), position)

    def carry(self, total, before):
        return F.last(total).over(before)

    def merge(self, local, carry):
        default = F.lit(None) if self.default is None else self.default
        before = F.when(carry.isNull(), default).otherwise(carry.getField("value"))
        return F.when(local.getField("top"), before).otherwise(local.getField("value"))

    def nothing(self):
        return F.when(F.lit(False), self._row())


def run_sum(value: ColumnOrName) -> Measure:
    return _Sum(as_column(value))


def run_count(value: ColumnOrName) -> Measure:
    return _Count(as_column(value))


def run_max(value: ColumnOrName) -> Measure:
    return _Max(as_column(value))


def run_min(value: ColumnOrName) -> Measure:
    return _Min(as_column(value))


def run_last(value: ColumnOrName) -> Measure:
    """Latest non-null value so far."""
    return _Last(as_column(value))


def run_first(value: ColumnOrName) -> Measure:
    """Earliest non-null value so far: once set it sticks."""
    return _First(as_column(value))


def run_previous(value: ColumnOrName, default: Column | None = None) -> Measure:
    """Value of the row before, NULL if that is NULL; the default where there is no row before."""
    return _Previous(as_column(value), default)


def running(
    df: DataFrame,
    keys: str | Sequence[str],
    order: str,
    measures: Mapping[str, Measure],
    *,
    frame: str = "rows",
    ties: Sequence[Column | str] = (),
    split: Split | None = SPLIT,
    sized_by: Sequence[DataFrame] | None = None,
    spread_null_keys: bool = False,
) -> DataFrame:
    """Add running measures per key in time order.

    ``frame="range"`` gives rows at one instant the same value; ``"rows"`` needs ``ties`` to make
    the order total wherever one instant can hold several rows. Blocks are whole units of the
    order column, so tied rows never part. ``split=None`` switches the splitting off for inputs
    whose groups are bounded, such as one row per entity and day. ``sized_by`` names cheaper inputs
    with at least as many rows per key (same key names) to find hot keys in. Rows with a NULL key
    form a group, unless ``spread_null_keys`` says that nothing is asked of them.
    """
    if frame not in ("rows", "range"):
        raise ValueError(f"frame must be 'rows' or 'range', not {frame!r}")
    keys = as_list(keys)
    ordering = [F.col(order), *ties] if frame == "rows" else [F.col(order)]

    def windows(partition: Sequence[Column | str]) -> tuple[WindowSpec, WindowSpec]:
        ordered = Window.partitionBy(*partition).orderBy(*ordering)
        start, now = Window.unboundedPreceding, Window.currentRow
        framed = ordered.rowsBetween(start, now) if frame == "rows" else ordered.rangeBetween(start, now)
        return framed, ordered

    def plain(rows_of: DataFrame, spread: Sequence[Column]) -> DataFrame:
        rows, ordered = windows([*keys, *spread])
        local = rows_of.select("*", *[m.local(rows, ordered).alias(f"__local_{n}") for n, m in measures.items()])
        return local.select(
            *df.columns, *[m.merge(F.col(f"__local_{n}"), m.nothing()).alias(n) for n, m in measures.items()]
        )

    spread = [spread_missing(keys, order)] if spread_null_keys else []
    cut = None if split is None else cut_hot_keys(df, keys, order, split, sized_by or [df])
    if cut is None:
        return plain(df, spread)

    rows, ordered = windows([*keys, BLOCK])
    # the place of a row in its block: an order that any direction of ties can have
    placed = cut.hot.select(
        "*",
        F.row_number().over(ordered).alias("__place"),
        *[m.local(rows, ordered).alias(f"__local_{n}") for n, m in measures.items()],
    )
    totals = cut.hot.withColumn("__place", F.row_number().over(ordered)).groupBy(*keys, BLOCK).agg(
        *[m.total(F.col("__place")).alias(n) for n, m in measures.items()]
    )
    # one row per hot key and block: as many as the history has units of time
    before = Window.partitionBy(*keys).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.select(
        *keys, BLOCK, *[m.carry(F.col(n), before).alias(f"__carry_{n}") for n, m in measures.items()]
    )
    hot = placed.join(carry, [*keys, BLOCK], "left").select(
        *df.columns,
        *[m.merge(F.col(f"__local_{n}"), F.col(f"__carry_{n}")).alias(n) for n, m in measures.items()],
    )
    return plain(cut.rest, spread).unionByName(hot)


def last_state(
    published: DataFrame, keys: str | Sequence[str], order: str, columns: Sequence[str], before: Column,
    *, ties: Sequence[str] = (),
) -> DataFrame:
    """Per key the ``columns`` of its last published row with ``order < before``; NULL keys are a key.

    One aggregation, combined before it is shuffled, of the named columns only.
    """
    keys = as_list(keys)
    place = F.struct(F.col(order), *[F.col(t) for t in ties])
    kept = published.where(F.col(order) < before)
    return kept.groupBy(*keys).agg(F.max_by(F.struct(*columns), place).alias("__state")).select(*keys, "__state.*")


def continue_running(
    window: DataFrame,
    state: DataFrame,
    keys: str | Sequence[str],
    order: str,
    measures: Mapping[str, Measure],
    *,
    seeds: Mapping[str, str] | None = None,
    **options,
) -> DataFrame:
    """``running`` over the rows of a window of time, continued from what each key had before it.

    ``state`` has one row per key (see ``last_state``); ``seeds`` names its column for a measure where that
    is not called like the measure. The seed is the measure's own last value, for ``run_previous`` the last
    row's value. The result equals ``running`` over all rows, as far as the rows of the window go: all rows
    from its start on must be in it, late ones too. ``options`` are those of ``running``. Keys without state begin anew.
    """
    keys = as_list(keys)
    names = {n: (seeds or {}).get(n, n) for n in measures}
    # of a previous value it must be known whether there was a row: asked for as a struct
    asked = {n: _Previous(m._row()) if isinstance(m, _Previous) else m for n, m in measures.items()}
    local = running(window, keys, order, asked, **options)
    held = state.select(
        *[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], F.struct(*dict.fromkeys(names.values())).alias("__seed")
    )
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"__k{i}"))

    def continued(name: str, measure: Measure) -> Column:
        seed = F.col("__seed").getField(names[name])
        if not isinstance(measure, _Previous):
            return measure.merge(F.col(name), seed)
        default = F.lit(None) if measure.default is None else measure.default
        before = F.when(F.col("__seed").isNull(), default).otherwise(seed)
        return F.when(F.col(name).isNull(), before).otherwise(F.col(name).getField("value"))

    return local.join(held, same, "left").select(
        *window.columns, *[continued(n, m).alias(n) for n, m in measures.items()]
    )
