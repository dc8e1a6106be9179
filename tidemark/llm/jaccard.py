"""N-gram Jaccard self-join by chosen paths.

A document is the set of its five-word shingles; equal sets are one class and only classes are joined.
Classes travel down random paths: at a node, a few of 128 min-hash values are chosen, and a class goes on
to the child named by each chosen value, so classes alike at the threshold are expected to share one
child of every node they share. Small nodes are compared all against all; in large ones what is
alike to one of a few pivots is settled first and what is left is compared or goes on. Runs are repeated until the probability that a pair
at the threshold shares a compared node reaches the target recall.

Nodes compare sketches and only tell what may belong together, at a similarity well below the threshold.
Within each such group all pairs are then compared exactly, in tiles of bounded size that give the number
of links of each class and a spanning forest, never the pairs themselves.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import WordHashes, hold, packed, shipped, stage_lean, text_bytes, tidy, unpack
from tidemark.llm.components import components

WORDS = 5
THRESHOLD = 0.8
RECALL = 0.999
HASHES = 128
# nodes of at most so many classes are compared all against all
SMALL = 256
# larger ones are settled first, in chunks of about so many against about so many pivots; what is left of
# a node is compared all against all up to the last number, and split further above it
CHUNK, PIVOTS, LEFT = 1024, 16, 2048
# classes of a node or group are compared in tiles of about twice so many
TILE = 256
# bits of a filter in front of a join: for each row wanted, and in all (16 MB); bits a row has
ROW_BITS, FILTER_BITS, PROBES = 16, 2**27, 3

_WORD_HASHES = WordHashes()
_MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD], np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit words."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
        return x ^ (x >> np.uint64(32))


def shingles(text: bytes) -> np.ndarray:
    """The text's shingle hashes, sorted, each once. One to four words are one shingle; none have none."""
    words = text.split()
    if not words:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(hold(_WORD_HASHES).__getitem__, words), np.uint64, len(words))
    n = max(1, len(words) - WORDS + 1)
    with np.errstate(over="ignore"):
        rolled = np.full(n, len(words) if len(words) < WORDS else WORDS, np.uint64)
        for k in range(min(WORDS, len(words))):
            rolled = mix(rolled + hashes[k : k + n] * _MULTIPLIERS[k])
    return np.unique(rolled)


def _coefficients() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20240229)
    return rng.integers(0, 2**32, HASHES, np.uint32) | np.uint32(1), rng.integers(0, 2**32, HASHES, np.uint32)


FACTORS, SHIFTS = _coefficients()


def signature(values: np.ndarray) -> np.ndarray:
    """128 min-hashes of a set of shingle hashes."""
    if not len(values):
        return np.zeros(HASHES, np.uint32)
    x = (values >> np.uint64(32)).astype(np.uint32)
    least = np.full(HASHES, 2**32 - 1, np.uint32)
    with np.errstate(over="ignore"):
        for at in range(0, len(x), 4096):
            part = x[at : at + 4096]
            np.minimum(least, (FACTORS[:, None] * part[None, :] + SHIFTS[:, None]).min(axis=1), out=least)
    return least


def class_of(values: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(values.tobytes())


def sets_of(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, hash (of the text), class, n (shingles) and signature (empty sets have one too)."""

    @tidy
    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for text in text_bytes(batch.column(2)):
                values = shingles(text)
                found.append((class_of(values), len(values), signature(values).tobytes()))
            kinds = (pa.binary(), pa.int64(), pa.binary())
            columns = [pa.array([row[k] for row in found], kind) for k, kind in enumerate(kinds)]
            yield pa.record_batch([batch.column(0), batch.column(1), *columns], names=["id", "hash", "class", "n", "signature"])

    text = F.col(f"`{text_col}`")
    rows = df.select(F.col(f"`{id_col}`").alias("id"), F.xxhash64(text).alias("hash"), text.alias("text"))
    kind = df.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(describe, f"id {kind}, hash long, class binary, n long, signature binary")


def survival(depth: int) -> float:
    """Probability that a pair at the threshold shares a node at ``depth``: it is expected to share one
    child of each node it shares, Poisson in number."""
    p = 1.0
    for _ in range(depth):
        p = 1 - math.exp(-p)
    return p


def runs_needed(recall: float, depth: int) -> int:
    return math.ceil(math.log(1 - recall) / math.log(1 - survival(depth)))


def children(node: np.ndarray, signatures: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """(row, child) for each hash chosen at the row's node; rows of one node choose the same hashes."""
    with np.errstate(over="ignore"):
        drawn = mix(mix(node)[:, None] + np.arange(1, HASHES + 1, dtype=np.uint64)[None, :] * _MULTIPLIERS[0])
        chosen = drawn < np.uint64(2**64 / (threshold * HASHES))
        row, hash_at = np.nonzero(chosen)
        child = mix(drawn[row, hash_at] + signatures[row, hash_at].astype(np.uint64) * _MULTIPLIERS[1])
    return row, child


def _signatures(column) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.uint32).reshape(-1, HASHES)


def first_nodes(classes: DataFrame, runs: range, threshold: float) -> DataFrame:
    """rep, node: the children of every run's root."""
    roots = mix(np.arange(runs.start + 1, runs.stop + 1, dtype=np.uint64))

    @tidy
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            signatures, rep = _signatures(batch.column(1).to_pylist()), batch.column(0).to_numpy()
            for root in roots:
                row, node = children(np.full(len(rep), root), signatures, threshold)
                yield pa.record_batch([pa.array(rep[row]), pa.array(node.view(np.int64))], names=["rep", "node"])

    return classes.select("rep", "signature").mapInArrow(emit, "rep long, node long")


def forest(alike: np.ndarray) -> np.ndarray:
    """For a symmetric boolean matrix: the least member of each row's connected component."""
    n = len(alike)
    label = np.full(n, -1)
    for start in range(n):
        if label[start] >= 0:
            continue
        label[start] = start
        frontier = np.array([start])
        while len(frontier):
            reached = alike[frontier].any(axis=0) & (label < 0)
            frontier = np.flatnonzero(reached)
            label[frontier] = start
    return label


def _sketch(signatures: np.ndarray) -> np.ndarray:
    return signatures.astype(np.uint8)


def _marks(signatures: np.ndarray) -> np.ndarray:
    """Two bits of each min-hash, four to a byte. They hang on all bits of the value, so that sets of few shingles differ."""
    two = ((signatures * np.uint32(0x9E3779B1)) >> np.uint32(30)).astype(np.uint8).reshape(len(signatures), -1, 4)
    return two[:, :, 0] | two[:, :, 1] << 2 | two[:, :, 2] << 4 | two[:, :, 3] << 6


def _marks_alike(marks: np.ndarray) -> np.ndarray:
    """Estimated similarity of all rows with all; a quarter of the marks of different min-hashes are equal."""
    two = np.stack([marks >> k & 3 for k in (0, 2, 4, 6)], axis=2).reshape(len(marks), -1)
    return (_alike(two, two) - 0.25) / 0.75


def shortened(classes: DataFrame, name: str, short: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
    """rep and ``short`` of its signature as ``name``."""

    @tidy
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                rows = short(_signatures(batch.column(1).to_pylist()))
                yield pa.record_batch([batch.column(0), pa.array([row.tobytes() for row in rows], pa.binary())], names=["rep", name])

    return classes.select("rep", "signature").mapInArrow(emit, f"rep long, {name} binary")


def _alike(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Estimated similarity of all rows of a with all of b."""
    return np.stack([(row[None, :] == b).mean(axis=1) for row in a]) if len(a) and len(b) else np.zeros((len(a), len(b)))


def groups_of(batches: Iterator[pa.RecordBatch], n_keys: int) -> Iterator[pa.Table]:
    """Tables of rows with equal keys (the first columns), from batches sorted by them."""
    kept: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(k).to_numpy(zero_copy_only=False) for k in range(n_keys)])
        cut = np.r_[0, np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1, batch.num_rows]
        for begin, end in zip(cut[:-1], cut[1:]):
            key = tuple(keys[:, begin])
            if key != last and kept:
                yield pa.Table.from_batches(kept)
                kept = []
            last = key
            kept.append(batch.slice(begin, end - begin))
    if kept:
        yield pa.Table.from_batches(kept)


def _edges(a: list[np.ndarray], b: list[np.ndarray]) -> pa.RecordBatch:
    join = lambda parts: pa.array(np.concatenate(parts) if parts else np.zeros(0, np.int64), pa.int64())
    return pa.record_batch([join(a), join(b)], names=["a", "b"])


def in_tiles(rows: DataFrame, group: str, size: Column) -> DataFrame:
    """Deal the classes of each group to blocks of about TILE; add the tiles (low, high) of two blocks each
    one belongs to, and its side in them. Every pair of a group meets in one tile."""
    blocks = F.ceil(size / TILE).cast("int")
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("rep"), blocks)).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    return dealt.withColumns(
        {
            "group": F.col(group),
            "low": F.least("block", "other").cast("long"),
            "high": F.greatest("block", "other").cast("long"),
            "side": (F.col("block") > F.col("other")).cast("long"),
        }
    ).drop("block", "other")


def compare(rows: DataFrame, loose: float) -> DataFrame:
    """Spanning forests (a, b) of what is alike in each tile and not known to belong together; rows are
    in_tiles with rep, label and marks."""

    @tidy
    def tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = [], []
        for tile in groups_of(batches, 3):
            rep, label = tile.column("rep").to_numpy(), tile.column("label").to_numpy()
            if len(rep) < 2 or (label == label[0]).all():
                continue
            marks = np.frombuffer(b"".join(tile.column("marks").to_pylist()), np.uint8).reshape(len(rep), HASHES // 4)
            tied = (_marks_alike(marks) >= loose) & (label[:, None] != label[None, :])
            if tile.column("low")[0] != tile.column("high")[0]:
                side = tile.column("side").to_numpy()
                tied &= side[:, None] != side[None, :]
            least = forest(tied)
            moved = least != np.arange(len(rep))
            if moved.any():
                a.append(rep[moved])
                b.append(rep[least[moved]])
            if len(a) > 1000:
                yield _edges(a, b)
                a, b = [], []
        yield _edges(a, b)

    keys = ["group", "low", "high"]
    placed = rows.select(*keys, "side", "rep", "label", "marks").repartition(*keys).sortWithinPartitions(*keys)
    return placed.mapInArrow(tiles, "a long, b long")


def settle(rows: DataFrame, threshold: float, loose: float) -> DataFrame:
    """Compare each class of a large node with a few pivots of the node: rep, node, label, other.

    Rows are node, n_node, rep, label, sketch. Classes with one label are known to belong together. A
    class alike to a pivot at ``loose`` takes the pivot's label (the least, if several); ``other`` then
    holds a label that is now known to be the same, if there is one. A class alike to a pivot at the
    threshold is settled and leaves the node (node null): by the triangle inequality whatever is alike to
    it at the threshold is alike to the pivot at 2 x threshold - 1, so both got the pivot's label.
    """
    draw = F.pmod(F.xxhash64("rep", "node"), F.lit(2**31)) / 2**31
    chunks = F.ceil(F.col("n_node") / CHUNK).cast("int")
    dealt = rows.withColumn("chunk", F.pmod(F.xxhash64("node", "rep"), chunks).cast("long"))
    dealt = dealt.select("node", "chunk", "rep", "label", "sketch")
    pivots = rows.filter(draw * F.col("n_node") < PIVOTS).withColumn("chunk", F.explode(F.sequence(F.lit(0), chunks - 1)))
    pivots = pivots.select(
        F.col("node").alias("at_node"), F.col("chunk").cast("long").alias("at_chunk"), F.col("label").alias("pivot_label"), F.col("sketch").alias("pivot")
    )

    def meet(own: pd.DataFrame, pivot: pd.DataFrame) -> pd.DataFrame:
        columns = ["rep", "node", "label", "other"]
        if not len(own):
            return pd.DataFrame({c: pd.Series(dtype="Int64") for c in columns})
        sketches = lambda column: np.frombuffer(b"".join(column), np.uint8).reshape(-1, HASHES)
        rep, label, node = (own[c].to_numpy() for c in ("rep", "label", "node"))
        if not len(pivot):
            return pd.DataFrame({"rep": rep, "node": node, "label": label, "other": None}, columns=columns).astype("Int64")
        ours, marks = sketches(own["sketch"]), sketches(pivot["pivot"])
        names = pivot["pivot_label"].to_numpy()
        # pivots alike to each other have one label, the least; every chunk of the node finds the same
        group = forest((_alike(marks, marks) >= loose) | (names[:, None] == names[None, :]))
        names = np.array([names[group == g].min() for g in group])
        alike = _alike(ours, marks)
        tied = alike >= loose
        new = np.where(tied.any(axis=1), np.where(tied, names[None, :], np.iinfo(np.int64).max).min(axis=1), label)
        out = [pd.DataFrame({"rep": rep, "node": node, "label": new, "other": np.where(new != label, label, new)}).astype("Int64")]
        out[0].loc[(alike >= threshold).any(axis=1), "node"] = pd.NA
        # a class alike to pivots of several labels ties these together
        pairs = {(a, b) for a, row in zip(new, tied) if len(met := set(names[row])) > 1 for b in met if a != b}
        if pairs:
            a, b = zip(*sorted(pairs))
            out.append(pd.DataFrame({"rep": None, "node": None, "label": a, "other": b}).astype("Int64"))
        return pd.concat(out, ignore_index=True)[columns]

    met = dealt.groupBy("node", "chunk").cogroup(pivots.groupBy("at_node", "at_chunk"))
    return met.applyInPandas(meet, "rep long, node long, label long, other long")


def split(rows: DataFrame, threshold: float) -> DataFrame:
    """rep, label, node: the children of each class's node; rows are node, rep, label, signature."""

    @tidy
    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rep, label, node = (batch.column(k).to_numpy() for k in range(3))
            row, child = children(node.view(np.uint64), _signatures(batch.column(3).to_pylist()), threshold)
            yield pa.record_batch([pa.array(rep[row]), pa.array(label[row]), pa.array(child.view(np.int64))], names=["rep", "label", "node"])

    return rows.select("rep", "label", "node", "signature").mapInArrow(go, "rep long, label long, node long")


def sized(nodes: DataFrame) -> DataFrame:
    """Rows of nodes in which more than one label is left, with the number of rows."""
    sizes = nodes.groupBy("node").agg(F.count(F.lit(1)).alias("n_node"), F.min("label").alias("_a"), F.max("label").alias("_b"))
    return nodes.join(sizes.filter("_a <> _b").select("node", "n_node"), "node")


def loose_edges(classes: DataFrame, threshold: float, recall: float) -> DataFrame:
    """Edges (a, b) between classes that may belong together, from as many runs as the recall needs."""
    loose = 2 * threshold - 1 - 0.05
    signatures = classes.select("rep", "signature")
    # most rows of nodes are only compared: they travel with marks, a quarter of a sketch
    marks = stage_lean(shortened(classes, "marks", _marks))

    def its_own(table: DataFrame, rows: DataFrame) -> DataFrame:
        """Few classes are in large nodes and below them: the others' rows of ``table`` need not be shuffled to be joined."""
        return sieve(table, rows, {"rep": "rep"})

    found: list[DataFrame] = []
    done, depth = 0, 2
    while (needed := runs_needed(recall, depth)) > done:
        nodes = first_nodes(classes, range(done, needed), threshold).withColumn("label", F.col("rep"))
        done, level = needed, 1
        while True:
            live = stage_lean(sized(stage_lean(nodes)))
            small = live.filter(F.col("n_node") <= SMALL)
            small = small.join(marks if level == 1 else its_own(marks, small), "rep")
            found.append(stage_lean(compare(in_tiles(small, "node", F.col("n_node")), loose)))
            large = live.filter(F.col("n_node") > SMALL)
            if large.isEmpty():
                break
            sketches = shortened(its_own(signatures, large), "sketch", _sketch)
            met = stage_lean(settle(large.join(sketches, "rep"), threshold, loose))
            found.append(met.filter("rep is not null").select(F.col("rep").alias("a"), F.col("label").alias("b")))
            found.append(met.select(F.col("label").alias("a"), F.col("other").alias("b")))
            left = stage_lean(sized(met.filter("node is not null").select("rep", "label", "node")))
            rest = left.filter(F.col("n_node") <= LEFT)
            rest = rest.join(its_own(marks, rest), "rep")
            found.append(stage_lean(compare(in_tiles(rest, "node", F.col("n_node")), loose)))
            more = left.filter(F.col("n_node") > LEFT)
            if more.isEmpty():
                break
            nodes, level = split(more.join(its_own(signatures, more), "rep"), threshold), level + 1
        depth = max(depth, level)
    edges = found[0]
    for more in found[1:]:
        edges = edges.unionByName(more)
    return edges.filter("a <> b")


def shared(sets: list[np.ndarray], split: int | None) -> np.ndarray:
    """Sizes of the intersections of all sets with all, or of the first ``split`` with the others."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    values, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    useful = times[column] > 1
    owner, column = owner[useful], (np.cumsum(times > 1) - 1)[column[useful]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    low, high = (len(sets), len(sets)) if split is None else (split, len(sets) - split)
    total = np.zeros((low, high), np.float32)
    width = 8192
    bounds = np.searchsorted(column, np.arange(0, (column[-1] if len(column) else -1) + width + 1, width))
    for k, (begin, end) in enumerate(zip(bounds[:-1], bounds[1:])):
        part = np.zeros((len(sets), width), np.float32)
        part[owner[begin:end], column[begin:end] - k * width] = 1
        total += part @ part.T if split is None else part[:split] @ part[split:].T
    return total


def verify(rows: DataFrame, threshold: float) -> DataFrame:
    """Rows (a, b, links): spanning edges of the exact links in each tile, or the links of class a.

    Rows are group, low, high, side, rep, copies, shingles, one tile per (group, low, high); pairs are
    taken within a tile if low = high, else between its sides, so every pair of a group is met once.
    """

    @tidy
    def tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[np.ndarray] = []

        def out() -> pa.RecordBatch:
            a, b, links = np.concatenate(rows, axis=1) if rows else np.zeros((3, 0), np.int64)
            edge = links == 0
            return pa.record_batch([pa.array(a), pa.array(b, mask=~edge), pa.array(links, mask=edge)], names=["a", "b", "links"])

        for group in groups_of(batches, 3):
            rep, first = np.unique(group.column("rep").to_numpy(), return_index=True)
            group = group.take(pa.array(first))
            inside = group.column("low")[0] == group.column("high")[0]
            side = group.column("side").to_numpy()
            order = np.argsort(side, kind="stable")
            rep, side, copies = rep[order], side[order], group.column("copies").to_numpy()[order]
            raw = group.column("shingles").to_pylist()
            sets = [np.frombuffer(raw[k], np.uint64) for k in order]
            split = None if inside else int((side == 0).sum())
            if len(rep) < 2 or split in (0, len(rep)):
                continue
            size = np.array([len(s) for s in sets])
            low, high = (slice(None), slice(None)) if inside else (slice(0, split), slice(split, None))
            common = shared(sets, split)
            union = size[low, None] + size[None, high] - common
            link = common >= threshold * union - 1e-6
            if inside:
                np.fill_diagonal(link, False)
                count = link @ copies
                square = link
            else:
                count = np.r_[link @ copies[high], link.T @ copies[low]]
                square = np.zeros((len(rep), len(rep)), bool)
                square[low, high] = link
                square[high, low] = link.T
            some = np.flatnonzero(count)
            label = forest(square)
            tied = np.flatnonzero(label != np.arange(len(rep)))
            rows.append(np.stack([rep[some], rep[some], count[some].astype(np.int64)]))
            rows.append(np.stack([rep[tied], rep[label[tied]], np.zeros(len(tied), np.int64)]))
            if len(rows) > 1000:
                yield out()
                rows.clear()
        yield out()

    keys = ["group", "low", "high"]
    placed = rows.select(*keys, "side", "rep", "copies", "shingles").repartition(*keys).sortWithinPartitions(*keys)
    return placed.mapInArrow(tiles, "a long, b long, links long")


def sieve(rows: DataFrame, wanted: DataFrame, keys: dict[str, str]) -> DataFrame:
    """``rows`` less most of those whose keys no row of ``wanted`` has; rows that have them all stay.

    ``keys`` maps columns of ``rows`` to those of ``wanted``. A key sets one bit in each of ``PROBES`` maps of 4 KB, of which
    at most 4096 are broadcast. Of other rows one in two hundred stays, more only where ``wanted`` has over
    ``FILTER_BITS / ROW_BITS`` rows; a join settles these.
    """
    bits = max(1, min(FILTER_BITS, wanted.count() * ROW_BITS) // PROBES)

    def places(names: Iterable[str]) -> tuple[Column, list[Column]]:
        """Number of the key's maps, and its bit in each."""
        within = F.lit(min(bits, 2**15))
        bucket = F.bitmap_bucket_number(F.pmod(F.xxhash64(*names), F.lit(bits)) + 1)
        return bucket, [F.pmod(F.xxhash64(*names, F.lit(k)), within) for k in range(PROBES)]

    bucket, at = places(keys.values())
    found = wanted.select(bucket.alias("_bucket"), *[bit.alias(f"_bit{k}") for k, bit in enumerate(at)])
    maps = found.groupBy("_bucket").agg(*[F.bitmap_construct_agg(f"_bit{k}").alias(f"_map{k}") for k in range(PROBES)])
    bucket, at = places(keys)
    met = rows.join(F.broadcast(maps), bucket == F.col("_bucket"))
    for k, bit in enumerate(at):
        byte = F.conv(F.hex(F.substring(f"_map{k}", (bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        met = met.filter(F.getbit(byte, (bit % 8).cast("int")) == 1)
    return met.select(*rows.columns)


@shipped
def jaccard_groups(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, recall: float = RECALL
) -> DataFrame:
    """One row per row of ``df``: id, hash (xxhash64 of the text), class_id, n_links, kept.

    Documents are linked when their sets of five-word shingles have a Jaccard similarity of ``threshold``
    or more. ``class_id`` is the least id among all documents connected by links, ``n_links`` the number
    of documents linked to this one, copies counted each. Texts of one to four words are one shingle;
    texts without words, null among them, are all alike. Of each class one row is ``kept``, one with the
    least id (null ids last; ties by hash; rows equal in both count as one and are all kept). A text
    is cut into shingles in one task, at some twenty bytes of memory per byte. Other columns don't matter, whatever their names.
    An empty table gives an empty result.
    """
    members = stage_lean(sets_of(df, id_col, text_col))
    first = F.struct(F.col("id").isNull().alias("none"), "id", "hash")
    classes = members.groupBy("class").agg(
        F.min(first).alias("first"), F.count(F.lit(1)).alias("copies"), F.max("n").alias("n"), F.max("signature").alias("signature")
    )
    classes = stage_lean(classes.withColumn("rep", F.monotonically_increasing_id()))
    joined = classes.filter("n > 0")
    groups = stage_lean(components(loose_edges(joined, threshold, recall))).withColumnRenamed("node", "rep")

    # exact comparison: shingles of the classes in groups, from the text of each one's first document
    sizes = groups.groupBy("component").agg(F.count(F.lit(1)).alias("members"))
    wanted = groups.join(sizes, "component").join(sieve(joined.select("rep", "copies", "class", "first"), groups, {"rep": "rep"}), "rep")
    wanted = stage_lean(wanted.select("rep", "component", "members", "copies", "class", F.col("first.id").alias("id"), F.col("first.hash").alias("hash")))
    text = F.col(f"`{text_col}`")
    texts = df.select(F.col(f"`{id_col}`").alias("own_id"), F.xxhash64(text).alias("own_hash"), text.alias("text"))

    @tidy
    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [(k, values.tobytes()) for k, text in enumerate(text_bytes(batch.column(5))) if class_of(values := shingles(text)) == batch.column(4)[k].as_py()]
            rows = pa.array([k for k, _ in kept], pa.int64())
            yield pa.record_batch(
                [*(batch.column(k).take(rows) for k in range(4)), pa.array([v for _, v in kept], pa.binary())],
                names=["rep", "component", "members", "copies", "shingles"],
            )

    likely = sieve(texts, wanted, {"own_id": "id", "own_hash": "hash"})
    found = likely.join(wanted, F.col("own_id").eqNullSafe(F.col("id")) & (F.col("own_hash") == F.col("hash")))
    expanded = "rep long, component long, members long, copies long, shingles binary"
    sets = found.select("rep", "component", "members", "copies", "class", "text").mapInArrow(expand, expanded)
    tiled = in_tiles(sets, "component", F.col("members"))
    exact = stage_lean(verify(tiled, threshold))
    links = exact.filter("links is not null").groupBy(F.col("a").alias("rep")).agg(F.sum("links").alias("links"))
    joint = components(exact.filter("b is not null").select("a", "b")).withColumnRenamed("node", "rep")
    placed = classes.join(joint, "rep", "left").join(links, "rep", "left")
    placed = stage_lean(placed.select("rep", "class", "copies", "first", F.coalesce("component", "rep").alias("component"), F.coalesce("links", F.lit(0)).alias("links")))
    heads = placed.groupBy("component").agg(F.min("first").alias("head"))
    told = placed.join(heads, "component").select("class", "head", (F.col("links") + F.col("copies") - 1).alias("n_links"))
    return members.select("id", "hash", "class").join(told, "class").select(
        "id",
        "hash",
        F.col("head.id").alias("class_id"),
        "n_links",
        (F.col("id").eqNullSafe(F.col("head.id")) & F.col("hash").eqNullSafe(F.col("head.hash"))).alias("kept"),
    )


def one_of_each(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Rows of ``df``, one of each group of linked documents: the one with the least id. Of rows that
    repeat id and text one stays, no matter which."""
    groups = stage_lean(jaccard_groups(df, id_col, text_col, threshold))
    kept = groups.filter("kept").select("id", "hash")
    again = not kept.groupBy("id", "hash").count().filter("count > 1").isEmpty()
    rows = df.select(packed(df).alias("row"), F.col(f"`{id_col}`").alias("own_id"), F.xxhash64(F.col(f"`{text_col}`")).alias("own_hash"))
    out = rows.join(kept.distinct() if again else kept, F.col("own_id").eqNullSafe(F.col("id")) & (F.col("own_hash") == F.col("hash")))
    return unpack(out.dropDuplicates(["id", "hash"]) if again else out, df)
