"""Removal of repeated strings, on the lines of difference-cover suffix sorting.

Which 100-byte strings also start earlier could be read off a suffix array. The difference-cover way to
one sorts the suffixes at sampled positions first, by names of short tuples and recursion on the names,
and places all other suffixes by the sampled one that follows them. Here the sample is chosen by content
instead of by position modulo 3: the least of 69 consecutive 32-byte strings, by hash. It has the cover's
property (equal 100-byte strings hold a sampled position at equal offset) with 3 % of the positions in
place of 67 %, and since only equality over 100 bytes is asked for, names need no order among different
strings: rows meet by hash and are ordered by position inside.

1. Sampled tuples are named: the core (32 bytes from the sampled position) and its triple (up to 68 bytes
   before, the core, up to 68 after). A triple that occurred earlier covers all strings through its core.
   This is the only pass over all bytes: what repeats within a slice is told right away, as spans.
2. Cores with one triple are done. Of the others each first triple is compared with its neighbours of the
   same core: the longest common context, to the left and to the right, tells which strings are equal.
   Cores with very many triples are split instead by the 100-byte strings themselves. Both read the
   bytes around such positions only.
3. What is covered is joined to the texts, and the bytes are cut out.

Rows of one name are combined per slice of documents before they are shuffled, so no name can gather more
rows than there are slices.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import shipped, stage_lean, text_bytes
from tidemark.llm.jaccard import mix

LENGTH = 100
CORE = 32
# a slice is at most so many documents and so many bytes; a longer document is a slice of its own
SLICE_BITS = 8
SLICE_BYTES = 1_000_000
# cores with more triples than this go by single strings; the first bound is for one slice
HOT_IN_SLICE, HOT = 32, 256
# bytes of a triple before its core
REACH = LENGTH - CORE
# pairs of contexts that are compared at once
PAIRS = 2**15
DUPLICATE, OPEN, OPEN_HOT, COVERED = 1, 2, 3, 4
# rows of ``sampled``: a name, one of a crowded core, the mark that a core is crowded, a span that is told already
NAME, CROWDED, MARK, TOLD = 0, 1, 2, 3

_TABLE = np.random.default_rng(31).integers(0, 2**64, 256, np.uint64)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64."""
    known = _POWERS.get(base)
    if known is None or len(known) < n:
        known = np.ones(max(n, 2**20), np.uint64)
        done = 1
        with np.errstate(over="ignore"):
            while done < len(known):
                step = min(done, len(known) - done)
                known[done : done + step] = known[:step] * np.uint64(pow(base, done, 2**64))
                done += step
        _POWERS[base] = known
    return known[:n]


def _sliding(x: np.ndarray, width: int, f: np.ufunc) -> np.ndarray:
    """f over every run of ``width`` values, from f over runs of 1, 2, 4, ... values."""
    have = 1
    while have < width:
        step = min(have, width - have)
        x = f(x[:-step], x[step:])
        have += step
    return x


def _values(strings: np.ndarray) -> np.ndarray:
    """What ``Scan`` makes names and the order of strings from; each is a row of bytes."""
    with np.errstate(over="ignore"):
        return (_TABLE[strings] * _powers(_BASE, strings.shape[1])).sum(axis=1)


def _order(values: np.ndarray) -> np.ndarray:
    return (values >> np.uint64(32)).astype(np.uint32)


class Scan:
    """Sampled positions of some texts laid end to end: text, at (position in all), low, high (its
    triple's bounds), core and triple names. Only triples of LENGTH bytes or more count. ``least`` is, per
    string of LENGTH bytes, the order of the cores that it samples."""

    def __init__(self, texts: list[bytes], length: int = LENGTH, core: int = CORE):
        self.length, reach = length, length - core
        self.bytes = np.frombuffer(b"".join(texts), np.uint8)
        self.sizes = np.array([len(t) for t in texts], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        n = len(self.bytes)
        self.text = self.at = self.low = self.high = np.zeros(0, np.int64)
        self.core = self.triple = np.zeros(0, np.uint64)
        self.least = np.zeros(0, np.uint32)
        if n < length:
            return
        with np.errstate(over="ignore"):
            self.sums = np.zeros(n + 1, np.uint64)
            np.cumsum(_TABLE[self.bytes] * _powers(_BASE, n), out=self.sums[1:])
            value = self.sums[core:] - self.sums[:-core]
            value *= _powers(_INVERSE, n - core + 1)
            # half a name tells the order: if two cores share it, both are sampled
            order = _order(value)
            ends = self.starts[self.starts > 0].tolist()
            for end in ends:
                order[max(end - core + 1, 0) : end] = 2**32 - 1
            least = _sliding(order, reach + 1, np.minimum)
            # strings that cross texts choose nothing
            for end in ends:
                least[max(end - length + 1, 0) : end] = 0
            self.least = least
            edge = np.zeros(reach, np.uint32)
            at = np.flatnonzero(_sliding(np.r_[edge, least, edge], reach + 1, np.maximum) == order)
            text = self.text_of(at)
            begin = self.starts[text]
            end = begin + self.sizes[text]
            low, high = np.maximum(at - reach, begin), np.minimum(at + length, end)
            wide = (high - low >= length) & (at + core <= end)
            self.text, self.at, self.low, self.high = text[wide], at[wide], low[wide], high[wide]
            at, low, high = self.at, self.low, self.high
            self.core = mix(value[at])
            bounds = mix(((at - low) * 1024 + high - at).astype(np.uint64))
            self.triple = mix((self.sums[high] - self.sums[low]) * self._back(at) + bounds)

    def text_of(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, at, "right") - 1

    def _back(self, at: np.ndarray) -> np.ndarray:
        return _powers(_INVERSE, len(self.bytes) + 1)[at]

    def named(self, at: np.ndarray, length: int) -> np.ndarray:
        """Names of the strings of ``length`` bytes at the positions."""
        with np.errstate(over="ignore"):
            return mix((self.sums[at + length] - self.sums[at]) * self._back(at))

    def offsets(self) -> np.ndarray:
        """Sampled positions within their texts."""
        return self.at - self.starts[self.text]

    def first_of_triple(self) -> np.ndarray:
        """Which sampled positions are the first of their (core, triple) here."""
        return first_of(self.triple, self.core)


def first_of(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Which rows are the first of their (one, two)."""
    # rows with equal names stay in order; a name shared by different others tells too many firsts at most
    order = np.argsort(one, kind="stable")
    one, two = one[order], two[order]
    out = np.ones(len(order), bool)
    out[order[1:]] = (one[1:] != one[:-1]) | (two[1:] != two[:-1])
    return out


def _held(low: np.ndarray, high: np.ndarray, n: int) -> np.ndarray:
    """Which of n positions lie in one of the ranges [low, high)."""
    return np.cumsum(np.bincount(low, minlength=n + 1) - np.bincount(high, minlength=n + 1))[:n] > 0


def _stretches(flags: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """begin, end of the maximal stretches of set flags; none goes on beyond one of the starts."""
    change = np.flatnonzero(flags[1:] != flags[:-1]) + 1
    cuts = np.unique(np.r_[0, starts[starts < len(flags)], change, len(flags)])
    begin, end = cuts[:-1], cuts[1:]
    return begin[flags[begin]], end[flags[begin]]


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def _runs(texts: list[bytes], places: np.ndarray, bits: int, most: int = 1_000_000) -> Iterator[tuple[int, list[bytes]]]:
    """(first, texts) of consecutive documents of one slice, of about ``most`` bytes."""
    begin = size = 0
    for k, text in enumerate(texts):
        if k > begin and (size + len(text) > most or places[k] >> bits != places[begin] >> bits):
            yield begin, texts[begin:k]
            begin, size = k, 0
        size += len(text)
    if begin < len(texts):
        yield begin, texts[begin:]


def sampled(docs: DataFrame) -> DataFrame:
    """core, triple, place, off: the first of each triple per run of documents; ``deal`` says where they
    meet. Rows of a core with very many triples in a run are CROWDED and dealt by triple; a MARK tells the
    core's other rows. What later triples of a run cover is TOLD: bytes from off up to ``triple`` of a place.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = batch.column(0).to_numpy()
            for begin, texts in _runs(text_bytes(batch.column(1)), places, SLICE_BITS):
                s = Scan(texts)
                is_first = s.first_of_triple()
                first, again = np.flatnonzero(is_first), np.flatnonzero(~is_first)
                core, triple, place, off = s.core[first], s.triple[first], places[begin + s.text[first]], s.offsets()[first]
                cores, which, times = np.unique(core, return_inverse=True, return_counts=True)
                crowded = times[which] > HOT_IN_SLICE
                hot = cores[times > HOT_IN_SLICE]
                none = np.full(len(hot), -1, np.int64)
                low = high = np.zeros(0, np.int64)
                if len(again):
                    low, high = _stretches(_held(s.low[again], s.high[again], len(s.bytes)), s.starts)
                text = s.text_of(low)
                told, start = places[begin + text], s.starts[text]
                # no row of a told span meets another, so they spread by their place
                spread = mix(told.astype(np.uint64))
                yield pa.record_batch(
                    [
                        _signed(np.r_[core, hot, spread]),
                        # rows of crowded cores are dealt by their triple, so they spread
                        _signed(np.r_[np.where(crowded, mix(triple), core), hot, spread]),
                        _signed(np.r_[triple, np.zeros(len(hot), np.uint64), (high - start).astype(np.uint64)]),
                        pa.array(np.r_[place, none, told]),
                        pa.array(np.r_[off, none, low - start]),
                        pa.array(np.r_[np.where(crowded, CROWDED, NAME), np.full(len(hot), MARK), np.full(len(low), TOLD)].astype(np.int8)),
                    ],
                    names=["core", "deal", "triple", "place", "off", "role"],
                )

    return docs.select("place", "text").mapInArrow(scan, "core long, deal long, triple long, place long, off long, role byte")


def judged(rows: DataFrame) -> DataFrame:
    """place, low, high, kind of the triples that need a second look: DUPLICATE (it occurred earlier), OPEN
    (first of its name, its core has several) or OPEN_HOT (and very many); and COVERED spans as they were
    told. The core of a triple lies at high - LENGTH; high may lie beyond the text's end.

    Rows of crowded cores come dealt by triple, with a mark for the core's other rows; they are judged by
    triple alone and are open if they are first of theirs.
    """

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in whole_keys(batches, 1):
            deal, core, triple, place, off = (group.column(c).to_numpy() for c in ("deal", "core", "triple", "place", "off"))
            role = group.column("role").to_numpy()
            crowded, mark, told = role == CROWDED, role == MARK, role == TOLD
            if told.any():
                yield pa.record_batch(
                    [pa.array(place[told]), pa.array(off[told]), pa.array(triple[told]), pa.array(np.full(told.sum(), COVERED))],
                    names=["place", "low", "high", "kind"],
                )
                if told.all():
                    continue
                deal, core, triple, place, off, crowded, mark = (x[~told] for x in (deal, core, triple, place, off, crowded, mark))
            new_core = np.r_[True, (deal[1:] != deal[:-1]) | (core[1:] != core[:-1])]
            of = np.cumsum(new_core) - 1
            new_triple = new_core | np.r_[True, triple[1:] != triple[:-1]]
            count = np.bincount(of, ~mark)[of]
            kinds = np.bincount(of, new_triple & ~mark)[of]
            hot = np.bincount(of, mark)[of] > 0
            # the mark shares the triple 0, which sorts anywhere: a row right after it is still the first
            first = new_triple | np.r_[False, mark[:-1]]
            kind = np.where(~first, DUPLICATE, np.where(crowded | hot | (kinds > HOT), OPEN_HOT, np.where(kinds > 1, OPEN, 0)))
            keep = ~mark & (kind > 0) & ((count > 1) | hot | crowded)
            yield pa.record_batch(
                [pa.array(place[keep]), pa.array(np.maximum(off[keep] - REACH, 0)), pa.array(off[keep] + LENGTH), pa.array(kind[keep])],
                names=["place", "low", "high", "kind"],
            )

    order = ["deal", "core", "triple", "place", "off"]
    return rows.repartition("deal").sortWithinPartitions(*order).select(*order, "role").mapInArrow(judge, "place long, low long, high long, kind long")


def whole_keys(batches: Iterator[pa.RecordBatch], n_keys: int) -> Iterator[pa.Table]:
    """The batches, cut so that rows with equal keys are in one table."""
    kept: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(k).to_numpy(zero_copy_only=False) for k in range(n_keys)])
        changes = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
        if kept:
            last = [kept[-1].column(k)[-1].as_py() for k in range(n_keys)]
            if last != keys[:, 0].tolist():
                yield pa.Table.from_batches(kept)
                kept = []
        if len(changes):
            yield pa.Table.from_batches([*kept, batch.slice(0, changes[-1])])
            kept = [batch.slice(changes[-1])]
        else:
            kept.append(batch)
    if kept:
        yield pa.Table.from_batches(kept)


def numbered(ordered: DataFrame, kind: str) -> DataFrame:
    """id, place, text of rows (id, text): places ascend in the order of the partitions and of their rows, and
    all but their last SLICE_BITS bits are the slice's number."""
    bits, most = SLICE_BITS, SLICE_BYTES

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, nth, size = TaskContext.get().partitionId() << 33 - bits, 0, 0
        for batch in batches:
            lengths = pa.compute.fill_null(pa.compute.binary_length(batch.column(1)), 0)
            places = []
            for length in lengths.to_pylist():
                if nth >> bits or nth and size + length > most:
                    own, nth, size = own + 1, 0, 0
                places.append(own << bits | nth)
                nth, size = nth + 1, size + length
            yield pa.record_batch([batch.column(0), pa.array(places, pa.int64()), batch.column(1)], names=["id", "place", "text"])

    return ordered.select("id", "text").mapInArrow(number, f"id {kind}, place long, text string")


def _slice_of(place):
    return F.shiftright(place, SLICE_BITS)


class Slice:
    """A slice of documents, laid end to end in the order of their places."""

    def __init__(self, docs: pa.Table):
        docs = docs.sort_by("place")
        self.places = docs.column("place").to_numpy()
        self.ids = docs.column("id").combine_chunks()
        texts = text_bytes(docs.column("text").combine_chunks())
        self.bytes = np.frombuffer(b"".join(texts), np.uint8)
        self.sizes = np.array([len(t) for t in texts], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes

    def text_of(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, at, "right") - 1

    def ranges(self, spans: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """text, and low and high (at most the text's end) in all, of rows (place, low, high)."""
        text = np.searchsorted(self.places, spans.column("place").to_numpy())
        low, high = (spans.column(c).to_numpy() for c in ("low", "high"))
        return text, self.starts[text] + low, self.starts[text] + np.minimum(high, self.sizes[text])


def contexts(docs: DataFrame, marks: DataFrame) -> DataFrame:
    """What open positions are compared by. Open ones: core, place, off, left (bytes before off) and
    context. Hot ones: the strings through their cores, as two names (core, left), place and off; spans of
    those equal to an earlier one in the slice: place, off, left (the end), context and core null.
    """

    def look(key, own: pa.Table, found: pa.Table) -> pa.Table:
        s = Slice(own)
        kind = found.column("kind").to_numpy()
        text, low, high = s.ranges(found)
        off = found.column("high").to_numpy() - LENGTH
        at = s.starts[text] + off
        near = np.flatnonzero(kind == OPEN)
        data = s.bytes.tobytes()
        context = pa.array([data[a:b] for a, b in zip(low[near].tolist(), high[near].tolist())], pa.binary())
        core = mix(_values(s.bytes[at[near, None] + np.arange(CORE)])).view(np.int64)
        left, place, off = at[near] - low[near], s.places[text[near]], off[near]
        again = np.zeros((3, 0), np.int64)
        hot = kind == OPEN_HOT
        if hot.any():
            one, two, where, again = strings(s, at[hot], low[hot], high[hot], low[kind == DUPLICATE], high[kind == DUPLICATE])
            owner = s.text_of(where)
            core, left = np.r_[core, one.view(np.int64)], np.r_[left, two.view(np.int64)]
            place, off = np.r_[place, s.places[owner]], np.r_[off, where - s.starts[owner]]
        nothing = pa.nulls(again.shape[1], pa.int64())
        return pa.table(
            {
                "core": pa.concat_arrays([pa.array(core), nothing]),
                "left": pa.array(np.r_[left, again[2]]),
                "place": pa.array(np.r_[place, again[0]]),
                "off": pa.array(np.r_[off, again[1]]),
                "context": pa.concat_arrays([context, pa.nulls(len(core) - len(near) + len(nothing), pa.binary())]),
            }
        )

    def strings(s: Slice, at: np.ndarray, low: np.ndarray, high: np.ndarray, same_low: np.ndarray, same_high: np.ndarray):
        """Two names and the place in all of the first of equal strings that sample a core at one of the
        positions; and spans (place, low, high) of the others."""
        n = len(s.bytes)
        # only what lies around the cores is scanned
        begin, end = _stretches(_held(low, high, n), s.starts)
        around = Scan([s.bytes[a:b].tobytes() for a, b in zip(begin.tolist(), end.tolist())])
        string = np.flatnonzero(np.isin(around.least, _order(_values(s.bytes[at[:, None] + np.arange(CORE)]))))
        part = around.text_of(string)
        where = begin[part] + string - around.starts[part]
        # a string in a triple that occurred earlier is decided
        open_ = (string + LENGTH <= around.starts[part] + around.sizes[part]) & ~_held(same_low, same_high - LENGTH + 1, n)[where]
        string, where = string[open_], where[open_]
        one, half = around.named(string, LENGTH), LENGTH // 2
        with np.errstate(over="ignore"):
            two = mix(around.named(string, half) * np.uint64(_BASE) + around.named(string + half, LENGTH - half))
        first = first_of(one, two)
        a, b = _stretches(_held(where[~first], where[~first] + LENGTH, n), s.starts)
        owner = s.text_of(a)
        return one[first], two[first], where[first], np.stack([s.places[owner], a - s.starts[owner], b - s.starts[owner]])

    schema = "core long, left long, place long, off long, context binary"
    return _by_slice(docs, marks, look, schema)


def _by_slice(docs: DataFrame, marks: DataFrame, f, schema: str) -> DataFrame:
    own = docs.select("id", "place", "text", _slice_of(F.col("place")).alias("slice")).groupBy("slice")
    return own.cogroup(marks.withColumn("slice", _slice_of(F.col("place"))).groupBy("slice")).applyInArrow(f, schema)


def _common(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """How many first values of each row are equal."""
    other = x != y
    at = other.argmax(axis=1)
    return np.where(other[np.arange(len(at)), at], at, x.shape[1])


def compared(open_rows: DataFrame) -> DataFrame:
    """place, low, high: bytes covered by strings that an earlier row of the same core has too."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in whole_keys(batches, 1):
            n = group.num_rows
            core, left, place, off = (group.column(c).to_numpy() for c in ("core", "left", "place", "off"))
            context = group.column("context").cast(pa.large_binary()).combine_chunks()
            ends = np.frombuffer(context.buffers()[1], np.int64)[context.offset : context.offset + n + 1]
            data = np.frombuffer(context.buffers()[2], np.uint8)
            own = ends[:-1] + left
            right = ends[1:] - own
            # bytes beyond a context's ends are other rows'; the lengths bound what counts of them
            before = data.take(own[:, None] - 1 - np.arange(REACH), mode="clip")
            after = data.take(own[:, None] + np.arange(LENGTH), mode="clip")
            begins = np.flatnonzero(np.r_[True, core[1:] != core[:-1]])
            first = np.repeat(begins, np.diff(np.r_[begins, n]))
            # each row meets all earlier ones of its core
            earlier = np.arange(n) - first
            done = np.cumsum(earlier)
            most_left, most_right = np.zeros(n, np.int64), np.zeros(n, np.int64)
            cuts = np.unique(np.r_[0, np.searchsorted(done, np.arange(PAIRS, done[-1], PAIRS), "right"), n])
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                rows = a + np.flatnonzero(earlier[a:b])
                if not len(rows):
                    continue
                times = earlier[rows]
                begin = np.cumsum(times) - times
                k = np.repeat(rows, times)
                j = np.arange(len(k)) - np.repeat(begin, times) + first[k]
                to_left = np.minimum(_common(before[k], before[j]), np.minimum(left[k], left[j]))
                to_right = np.minimum(_common(after[k], after[j]), np.minimum(right[k], right[j]))
                long = to_left + to_right >= LENGTH
                most_left[rows] = np.maximum.reduceat(to_left * long, begin)
                most_right[rows] = np.maximum.reduceat(to_right * long, begin)
            # all of them hold the core, so together they are one span
            low, high = off - most_left, off + most_right
            again = most_right > 0
            yield pa.record_batch([pa.array(place[again]), pa.array(low[again]), pa.array(high[again])], names=["place", "low", "high"])

    placed = open_rows.repartition("core").sortWithinPartitions("core", "place", "off")
    return placed.select("core", "left", "place", "off", "context").mapInArrow(compare, "place long, low long, high long")


def not_first(strings: DataFrame) -> DataFrame:
    """place, low, high of strings (two names) that occur in an earlier row."""

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in whole_keys(batches, 2):
            one, two, place, off = (group.column(c).to_numpy() for c in ("core", "left", "place", "off"))
            again = np.r_[False, (one[1:] == one[:-1]) & (two[1:] == two[:-1])]
            yield pa.record_batch(
                [pa.array(place[again]), pa.array(off[again]), pa.array(off[again] + LENGTH)], names=["place", "low", "high"]
            )

    order = ["core", "left", "place", "off"]
    return strings.repartition("core", "left").sortWithinPartitions(*order).select(*order).mapInArrow(judge, "place long, low long, high long")


@shipped
def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_kept: bool = False) -> DataFrame:
    """One row per row of ``df``: id, n_bytes, removed (spans: start, end), kept_sha256[, kept].

    Texts are UTF-8 bytes, null is empty. A byte is removed if a string of 100 bytes that holds it also
    starts earlier: in a document with a smaller id (null ids first; rows that repeat an id are ordered
    among themselves once), or earlier in the same document, overlaps included. Strings are judged on
    the input and never cross documents. ``kept`` is binary, as a cut may fall inside a character. A slice
    (SLICE_BYTES, or one longer document) is scanned in one task, which takes about a hundred bytes of
    memory for each of its own. An empty table gives an empty result.
    """
    rows = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    # ranges of ids in order: places as written then follow the ids
    ordered = rows.repartitionByRange(F.col("id").asc_nulls_first()).sortWithinPartitions(F.col("id").asc_nulls_first())
    kind = df.schema[id_col].dataType.simpleString()
    docs = stage_lean(numbered(ordered, kind))
    marks = stage_lean(judged(sampled(docs)))
    seen = stage_lean(contexts(docs, marks))
    by_context = compared(seen.filter("context is not null"))
    by_string = not_first(seen.filter("context is null and core is not null"))
    local = seen.filter("core is null").select("place", F.col("off").alias("low"), F.col("left").alias("high"))
    spans = stage_lean(by_context.unionByName(by_string).unionByName(local))
    told = marks.filter(F.col("kind").isin(DUPLICATE, COVERED)).select("place", "low", "high").unionByName(spans)

    def cut(key, own: pa.Table, found: pa.Table) -> pa.Table:
        s = Slice(own)
        _, low, high = s.ranges(found)
        gone = _held(low, high, len(s.bytes))
        begin, end = _stretches(gone, s.starts)
        text = s.text_of(begin)
        until = np.r_[0, np.cumsum(np.bincount(text, minlength=len(s.sizes)))]
        left = s.sizes - np.bincount(text, end - begin, minlength=len(s.sizes)).astype(np.int64)
        ends = np.cumsum(left)
        rest = s.bytes[~gone].tobytes()
        kept = [rest[a:b] for a, b in zip((ends - left).tolist(), ends.tolist())]
        digests = [hashlib.sha256(k).hexdigest() for k in kept]
        spans = pa.StructArray.from_arrays([pa.array(begin - s.starts[text]), pa.array(end - s.starts[text])], ["start", "end"])
        removed = pa.ListArray.from_arrays(pa.array(until, pa.int32()), spans)
        columns = {"id": s.ids, "n_bytes": pa.array(s.sizes), "removed": removed, "kept_sha256": pa.array(digests, pa.string())}
        return pa.table(columns | ({"kept": pa.array(kept, pa.binary())} if with_kept else {}))

    schema = f"id {kind}, n_bytes long, removed array<struct<start:long,end:long>>, kept_sha256 string" + ", kept binary" * with_kept
    return _by_slice(docs, told, cut, schema)
