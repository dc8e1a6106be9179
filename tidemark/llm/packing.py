"""Packing token sequences by Karmarkar-Karp multiway differencing.

Documents are cut at multiples of the capacity; what is left over, together with short documents, is
dealt into blocks of bounded size. In a block every item starts as a partial partition into k windows;
the two partials with the widest spread are merged, heavy windows of one onto light windows of the other,
until one partition is left, whose windows are near-equal. k begins at the least number that could hold
the tokens and rises whenever a window exceeds the capacity.
"""

from __future__ import annotations

import heapq
import re
import zlib
from collections.abc import Iterator
from itertools import chain, filterfalse

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm.common import hold, in_slices, shipped, small_batches, text_bytes, tidy
from tidemark.sources.staging import stage

CAPACITY = 2048
END_ID = 1
# one document in FILLER_EVERY has its rest cut into pieces of FILLER_TOKENS, which level the windows
FILLER_EVERY = 16
FILLER_TOKENS = 32
# bytes of text encoded at once; their words are held as objects
SLICE = 4_000_000
# items of a block, on average
BLOCK = 2048


def differencing(sizes: np.ndarray, k: int) -> np.ndarray:
    """Window (0 .. k-1) of each item; the windows' sums are near-equal."""
    n = len(sizes)
    if k <= 1 or n == 0:
        return np.zeros(n, np.int64)
    loads, merged = {}, {}
    heap = []
    for item, size in enumerate(sizes):
        loads[item] = np.zeros(k, np.int64)
        loads[item][0] = size
        heap.append((-int(size), item))
    heapq.heapify(heap)
    node = n
    while len(heap) > 1:
        (_, a), (_, b) = heapq.heappop(heap), heapq.heappop(heap)
        total = loads.pop(a) + loads.pop(b)[::-1]
        order = np.argsort(-total, kind="stable")
        total = total[order]
        loads[node] = total - total[-1]
        merged[node] = (a, b, order)
        heapq.heappush(heap, (-int(loads[node][0]), node))
        node += 1
    # from the last partition down: which window of each part went where
    window, places = np.zeros(n, np.int64), {heap[0][1]: np.arange(k)}
    while places:
        node, names = places.popitem()
        if node < n:
            window[node] = names[0]
            continue
        a, b, order = merged[node]
        of_a, of_b = np.empty(k, np.int64), np.empty(k, np.int64)
        of_a[order] = names
        of_b[k - 1 - order] = names
        places[a], places[b] = of_a, of_b
    return window


def near_equal_windows(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, int]:
    """Window of each item and the number of windows, none above ``capacity``; no item may be."""
    total = int(sizes.sum())
    k = max(1, -(-total // capacity))
    while True:
        window = differencing(sizes, k)
        most = int(np.bincount(window, sizes, minlength=k).max()) if len(sizes) else 0
        if most <= capacity:
            return window, k
        k += max(1, k * (most - capacity) // (2 * capacity))


class Encoder:
    """Ids of texts, word by word; words are remembered, up to ``most`` of them.

    The tokenizer lower-cases, never joins characters across white space (its pre-tokenizer drops it and its
    normalizer composes nothing with it) and cuts words into parts: runs of letters, single digits, runs of other
    signs. So a text's ids are those of its parts in a row. To meet fewer different words, texts are lower-cased
    (A-Z) and cut where a sign follows a letter or digit, which always begins a part. New words of one part
    are encoded many at a time; each ends in the one id of its own that carries the end-of-word mark, which is
    checked. Words outside plain Latin characters go to the tokenizer as they are.
    """

    # fixed values: the tokenizer's own pattern of word parts, in lower case
    PARTS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
    PLAIN = regex.compile("[!-~\u00a1-\u012f\u0131-\u024f]+")
    # an ASCII sign after an ASCII letter or digit or a letter up to U+023F, in UTF-8; not after U+0130, whose
    # lower case ends in a sign
    SIGN = re.compile(
        rb"[!-/:-@\[-`{-~](?:(?<=[a-z0-9].)|(?<=\xc3[\x80-\x96\x98-\xb6\xb8-\xbf].)|(?<=\xc4[\x80-\xaf\xb1-\xbf].)|(?<=[\xc5-\xc8][\x80-\xbf].))"
    )

    def __init__(self, path: str, most: int = 1_000_000):
        self.tokenizer, self.most = Tokenizer.from_file(path), most
        self.words: dict[bytes, bytes] = {}
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[number for token, number in vocabulary.items() if token.endswith("</w>")]] = True

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """The ids of each text as little-endian 32-bit words."""
        # control strings, which begin with <|, are matched as they are written
        split = [(text if b"<|" in text else self.SIGN.sub(rb" \g<0>", text.lower())).split() for text in texts]
        if len(hold(self.words)) > self.most:
            self.words.clear()
        self._learn(set(filterfalse(self.words.__contains__, chain.from_iterable(split))))
        known = self.words.__getitem__
        return [b"".join(map(known, words)) for words in split]

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _learn(self, words: set[bytes]) -> None:
        single = [word for word in words if word.isalpha()]
        mixed = {}
        for word in words.difference(single):
            text = word.decode("utf-8", "replace")
            if "<|" in text or not self.PLAIN.fullmatch(text):
                self.words[word] = self._whole(text)
            elif text.isalpha():
                single.append(word)
            else:
                mixed[word] = [part.encode() for part in self.PARTS.findall(text.lower())]
        single += {part for parts in mixed.values() for part in parts} - self.words.keys() - words
        # a word that is its only part
        single += [word for word, parts in mixed.items() if parts == [word]]
        for at in range(0, len(single), 2000):
            self._learn_single(single[at : at + 2000])
        known = self.words.__getitem__
        self.words.update((word, b"".join(map(known, parts))) for word, parts in mixed.items() if parts != [word])

    def _learn_single(self, words: list[bytes]) -> None:
        data = self._whole(b" ".join(words).decode())
        ids = np.frombuffer(data, "<u4")
        ends = np.flatnonzero(self.ends[ids]) + 1
        if len(ends) == len(words) and ends[-1] == len(ids):
            to = (4 * ends).tolist()
            self.words.update((word, data[at:end]) for word, at, end in zip(words, [0, *to], to))
        else:
            self.words.update((word, self._whole(word.decode())) for word in words)


ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per worker process and vocabulary."""
    if path not in ENCODERS:
        ENCODERS[path] = Encoder(path)
    return ENCODERS[path]


def cuts(n: int, capacity: int, filler: bool) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: whole windows, then the rest, in small pieces if ``filler``."""
    step = min(FILLER_TOKENS, capacity) if filler else capacity
    whole = n // capacity * capacity
    out = [(at, capacity) for at in range(0, whole, capacity)]
    return out + [(at, min(step, n - at)) for at in range(whole, n, step)]


@shipped
def pieces(df: DataFrame, tokenizer: str, id_col: str, text_col: str, capacity: int, with_ids: bool) -> DataFrame:
    """Pieces of all documents: id, place (of the document), start, length, ids_crc32, doc_tokens[, ids]."""
    fields = ["id", "place", "start", "length", "ids_crc32", "doc_tokens"]

    @tidy
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).encode
        end = np.array([END_ID], "<u4").tobytes()
        for batch in batches:
            numbers, blobs = [], []
            places = batch.column(1).to_pylist()
            rows = ((first + k, text, ids) for first, part in in_slices(text_bytes(batch.column(2)), SLICE) for k, (text, ids) in enumerate(zip(part, encode(part))))
            for row, text, ids in rows:
                place, ids = places[row], memoryview(ids + end)
                n = len(ids) // 4
                # every sixteenth document by a digest of its text, so the choice follows no order
                filler = zlib.crc32(text) % FILLER_EVERY == 0
                for at, length in cuts(n, capacity, filler):
                    part = ids[4 * at : 4 * (at + length)]
                    numbers.append((row, place, at, length, zlib.crc32(part), n))
                    if with_ids:
                        blobs.append(bytes(part))
            columns = np.array(numbers, np.int64).reshape(-1, 6).T
            arrays = [batch.column(0).take(pa.array(columns[0]))] + [pa.array(c) for c in columns[1:]]
            if with_ids:
                arrays.append(pa.array(blobs, pa.binary()))
            yield pa.record_batch(arrays, names=fields + ["ids"] * with_ids)

    kind = df.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, " + ", ".join(f"{f} long" for f in fields[1:]) + ", ids binary" * with_ids
    rows = df.select(
        F.col(f"`{id_col}`").alias("id"), F.monotonically_increasing_id().alias("place"), F.col(f"`{text_col}`").alias("text")
    )
    return rows.mapInArrow(cut, schema)


@shipped
def pack(
    df: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, with_ids: bool = False
) -> DataFrame:
    """Pieces of all documents with sequence_id and offset; each token lies in exactly one piece.

    A document's tokens are its ids and the end id; null is the empty text, which has the end id alone.
    Sequences hold at most ``capacity`` tokens, offsets run from 0 without gaps. Rows that repeat an id
    are packed as documents of their own. ``with_ids`` adds each piece's ids (little-endian 32-bit). A text
    is encoded in one task, at about thirty bytes of memory per byte (27 measured on 16 MB), and cut into as many pieces as it needs.
    Other columns don't matter, whatever their names. An empty table gives an empty result.
    """
    with small_batches(df.sparkSession):
        cut = stage(pieces(df, tokenizer, id_col, text_col, capacity, with_ids))
    # blocks of whole windows and blocks of items to be packed, both of bounded size on average
    blocks = max(1, cut.count() // BLOCK)
    dealt = cut.withColumn("block", F.pmod(F.xxhash64("place", "start"), F.lit(blocks)))

    def place_block(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["place", "start"], ignore_index=True)
        sizes = rows["length"].to_numpy()
        whole = sizes == capacity
        window, k = near_equal_windows(sizes[~whole], capacity)
        sequence = np.empty(len(rows), np.int64)
        sequence[~whole] = window
        sequence[whole] = k + np.arange(whole.sum())
        # pieces of one sequence in the order of their rows
        order = np.argsort(sequence, kind="stable")
        before = np.cumsum(sizes[order]) - sizes[order]
        first = np.r_[True, np.diff(sequence[order]) != 0]
        offset = np.empty(len(rows), np.int64)
        offset[order] = before - np.maximum.accumulate(np.where(first, before, 0))
        rows["sequence_id"] = rows["block"] * 2**32 + sequence
        rows["offset"] = offset
        return rows.drop(columns=["block"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cut.schema) + ", sequence_id long, offset long"
    return dealt.groupBy("block").applyInPandas(place_block, schema).drop("place")
