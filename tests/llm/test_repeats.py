"""Removal of repeated strings against a byte-by-byte scan."""

from __future__ import annotations

import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from hard_rows import corpus, docs, none, plain, words  # noqa: F401
from tidemark.llm import repeats


def expected(rows: list[tuple]) -> dict:
    """Sorted (n_bytes, spans, digest) per id; rows are (id, text) in the order that counts."""
    seen, out = set(), defaultdict(list)
    for i, text in rows:
        data = text.encode()
        gone = bytearray(len(data))
        for k in range(len(data) - 99):
            piece = data[k : k + 100]
            if piece in seen:
                gone[k : k + 100] = b"\1" * 100
            seen.add(piece)
        spans, k = [], 0
        while k < len(gone):
            if gone[k]:
                end = k
                while end < len(gone) and gone[end]:
                    end += 1
                spans.append((k, end))
                k = end
            k += 1
        kept = bytes(b for b, g in zip(data, gone) if not g)
        out[i].append((len(data), spans, hashlib.sha256(kept).hexdigest()))
    return out


def check(df, rows):
    want = expected(rows)
    found = defaultdict(list)
    for r in repeats.remove_repeats(df, with_kept=True).collect():
        assert hashlib.sha256(r["kept"]).hexdigest() == r["kept_sha256"]
        found[r["id"]].append((r["n_bytes"], [(s["start"], s["end"]) for s in r["removed"]], r["kept_sha256"]))
    assert {k: sorted(v) for k, v in found.items()} == {k: sorted(v) for k, v in want.items()}


@pytest.mark.parametrize("hot", [None, (2, 2), (1, 1000)])
def test_hard_rows(spark, hot, monkeypatch):
    if hot:
        monkeypatch.setattr(repeats, "HOT_IN_SLICE", hot[0])
        monkeypatch.setattr(repeats, "HOT", hot[1])
        monkeypatch.setattr(repeats, "SLICE_BITS", 3)
    rng = random.Random(9)
    passage = words(rng, 60)
    rows = [(i, t) for i, t, _ in plain(corpus()) if i is not None]
    # rows that repeat an id are equal here or have nothing in common, so their order doesn't matter
    rows += [(1000 + k, words(rng, rng.randrange(30)) + passage[: rng.randrange(90, 300)] + words(rng, rng.randrange(30))) for k in range(40)]
    rows += [(2000, "ab" * 400), (2001, "Und " * 300), (2002, "z" * 99), (2003, "z" * 100), (2004, "z" * 101)]
    order = sorted(rows, key=lambda r: r[0])
    rng.shuffle(rows)
    check(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), order)


def test_nulls_and_nothing(spark, docs, none):
    assert repeats.remove_repeats(none).count() == 0
    assert repeats.remove_repeats(docs).count() == len(corpus())
    rows = [(None, "q" * 150), (5, "q" * 150), (6, None)]
    found = {r["id"]: [tuple(s) for s in r["removed"]] for r in repeats.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == {None: [(1, 150)], 5: [(0, 150)], 6: []}


def test_sample_covers():
    """Equal 100-byte strings hold a sampled position at equal offset."""
    rng = random.Random(2)
    passage = words(rng, 30).encode()
    a = repeats.Scan([words(rng, 40).encode() + passage + words(rng, 9).encode()])
    b = repeats.Scan([b"other", passage + words(rng, 50).encode()])
    at_a, at_b = bytes(a.bytes).index(passage), bytes(b.bytes).index(passage)
    for k in range(len(passage) - 99):
        inside = lambda s, at: {x - at for x in s.at.tolist() if at + k <= x <= at + k + 68}
        assert inside(a, at_a) & inside(b, at_b)


def test_slices_are_bounded_by_bytes(spark, monkeypatch):
    """Long documents with neighbouring ids: no task holds more text than a slice's bytes or one document."""
    rng = random.Random(4)
    passage = words(rng, 60)
    rows = [(k, words(rng, 20_000) if k < 24 else passage + words(rng, 20)) for k in range(60)]
    rows.append((30, words(rng, 300_000)))
    slices = []
    by_slice = repeats._by_slice
    monkeypatch.setattr(repeats, "_by_slice", lambda docs, *rest: slices.append(docs) or by_slice(docs, *rest))
    found = repeats.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1))
    for docs in slices:
        sizes = docs.groupBy(repeats._slice_of(F.col("place"))).agg(F.sum(F.octet_length("text")).alias("size"), F.count(F.lit(1)).alias("n"))
        assert all(r["size"] <= 1_000_000 or r["n"] == 1 for r in sizes.collect())
    assert len(slices) == 2 and found.count() == len(rows)


def test_texts_are_scanned_once(spark, monkeypatch):
    """Only the first step scans whole texts; the later ones read what lies around marked positions."""
    rng = random.Random(6)
    passage = words(rng, 60)
    rows = [(k, words(rng, 60) + passage[rng.randrange(90) : rng.randrange(200, 300)] + words(rng, 60)) for k in range(40)]
    monkeypatch.setattr(repeats, "HOT", 20)
    steps = []
    by_slice = repeats._by_slice
    monkeypatch.setattr(repeats, "_by_slice", lambda docs, marks, f, schema: steps.append((docs, marks, f)) or by_slice(docs, marks, f, schema))
    repeats.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    scanned = []
    scan = repeats.Scan.__init__
    monkeypatch.setattr(repeats.Scan, "__init__", lambda self, texts, *rest: scanned.append(sum(map(len, texts))) or scan(self, texts, *rest))
    for docs, marks, f in steps:
        f(None, docs.toArrow(), marks.toArrow())
    assert len(steps) == 2 and sum(scanned) < sum(len(text) for _, text in rows) / 2


def test_contexts_give_one_span(spark):
    """However many rows of a core agree with a row, what they cover together is one span of it."""
    rng = random.Random(7)
    passage = words(rng, 60)[:168].encode()
    rows = [(1, 68, k, 68, bytes([k]) * k + passage[k : 168 - k] + bytes([k]) * k) for k in range(30)]
    open_ = spark.createDataFrame(rows, "core long, left long, place long, off long, context binary")
    found = {r["place"]: (r["low"], r["high"]) for r in repeats.compared(open_).collect()}
    assert repeats.compared(open_).count() == 29 and found == {k: (k, 168 - k) for k in range(1, 30)}


@pytest.mark.parametrize("bits, hot, pairs", [(8, 256, 7), (2, 256, 2**15), (8, 3, 50), (2, 3, 50), (4, 1, 1)])
def test_passages_in_any_order(spark, bits, hot, pairs, monkeypatch):
    """Strings across the seam of two repeated passages occur for the first time late, in bytes that are covered."""
    monkeypatch.setattr(repeats, "SLICE_BITS", bits)
    monkeypatch.setattr(repeats, "HOT_IN_SLICE", hot)
    monkeypatch.setattr(repeats, "HOT", hot)
    monkeypatch.setattr(repeats, "PAIRS", pairs, raising=False)
    rng = random.Random(8)
    passages = [words(rng, rng.randrange(18, 60)) for _ in range(6)] + ["ab" * 90, "é" * 70, "x" * 130]
    cut = lambda p: p[rng.randrange(len(p) // 2) :] if rng.random() < 0.5 else p
    rows = [(k, "".join(cut(rng.choice(passages)) for _ in range(rng.randrange(6)))) for k in range(70)]
    check(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), rows)


@pytest.mark.parametrize("most", [0, 700])
def test_small_slices(spark, most, monkeypatch):
    monkeypatch.setattr(repeats, "SLICE_BYTES", most)
    rng = random.Random(5)
    passage = words(rng, 60)
    rows = [(k, words(rng, rng.randrange(30)) + passage[: rng.randrange(90, 300)] + words(rng, rng.randrange(30))) for k in range(60)]
    check(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), rows)
