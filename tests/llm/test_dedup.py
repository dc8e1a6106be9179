"""Exact dedup and the n-gram Jaccard join against brute force."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from hard_rows import corpus, docs, none, plain, words  # noqa: F401
from tidemark.llm import exact, jaccard
from tidemark.llm.components import components

LOW = -1


def test_misra_gries_keeps_what_is_frequent():
    keys = ["a"] * 40 + ["b"] * 25 + [f"x{k}" for k in range(60)]
    random.Random(1).shuffle(keys)
    summary = exact.MisraGries(9)
    summary.add(keys)
    assert len(summary.counts) <= 9
    for key, n in Counter(keys).items():
        if n > len(keys) / 10:
            assert n - len(keys) / 10 <= summary.counts[key] <= n


@pytest.mark.parametrize("share", [2, 8, 4096])
def test_exact_groups(docs, share):
    rows = plain(corpus())
    groups = defaultdict(list)
    for i, text, _ in rows:
        groups[text].append(LOW if i is None else i)
    found = exact.exact_groups(docs, share=share).collect()
    assert len(found) == len(rows)
    kept = Counter()
    for r in found:
        text = r["row"]["text"] or ""
        best = max(groups[text])
        assert (LOW if r["keep_id"] is None else r["keep_id"]) == best
        assert r["group_size"] == len(groups[text])
        assert bytes(r["digest"]) == hashlib.sha256(text.encode()).digest()
        assert not r["kept"] or (LOW if r["id"] is None else r["id"]) == best
        kept[text] += r["kept"]
    assert set(kept.values()) == {1}


def test_drop_copies_returns_the_rows(docs, none):
    out = exact.drop_copies(docs)
    assert out.columns == docs.columns
    assert out.count() == len({text for _, text, _ in plain(corpus())})
    assert out.exceptAll(docs).count() == 0
    assert exact.drop_copies(none).count() == 0


def shingle_set(text: str) -> frozenset:
    w = text.encode().split()
    return frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()


def linked(texts: list[str]) -> list[set[int]]:
    sets = [shingle_set(t) for t in texts]
    out = [set() for _ in texts]
    for a in range(len(texts)):
        for b in range(a):
            common, either = len(sets[a] & sets[b]), len(sets[a] | sets[b])
            if common >= 0.8 * either:
                out[a].add(b)
                out[b].add(a)
    return out


def closure(links: list[set[int]]) -> list[set[int]]:
    label = list(range(len(links)))
    changed = True
    while changed:
        changed = False
        for a, others in enumerate(links):
            least = min([label[a], *(label[b] for b in others)])
            changed |= least != label[a]
            label[a] = least
    return [{b for b, x in enumerate(label) if x == label[a]} for a in range(len(links))]


def check_groups(rows, found):
    texts = [text for _, text, _ in rows]
    links = linked(texts)
    groups = closure(links)
    expected = Counter()
    for k, (i, _, _) in enumerate(rows):
        ids = [rows[b][0] for b in groups[k] if rows[b][0] is not None]
        expected[(i, min(ids, default=None), len(links[k]))] += 1
    assert Counter((r["id"], r["class_id"], r["n_links"]) for r in found) == expected


@pytest.mark.parametrize("sizes", [None, (4, 4, 16, 4, 3), (4, 50, 16, 4, 3)])
def test_jaccard_groups(docs, sizes, monkeypatch):
    if sizes:
        for name, value in zip(("SMALL", "LEFT", "CHUNK", "PIVOTS", "TILE"), sizes):
            monkeypatch.setattr(jaccard, name, value)
    check_groups(plain(corpus()), jaccard.jaccard_groups(docs).collect())


def test_jaccard_large_group_of_near_copies(spark, monkeypatch):
    for name, value in (("SMALL", 8), ("LEFT", 20), ("CHUNK", 16), ("PIVOTS", 4), ("TILE", 10)):
        monkeypatch.setattr(jaccard, name, value)
    rng = random.Random(4)
    near = words(rng, 150).split()
    rows = []
    for k in range(90):
        copy = list(near)
        for _ in range(k % 4):
            copy[rng.randrange(len(copy))] = f"edit{rng.randrange(10**6)}"
        rows.append((k, " ".join(copy), None))
    shared = words(rng, 40)
    rows += [(200 + k, words(rng, 50) + " " + shared + " " + words(rng, 60), None) for k in range(60)]
    df = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    check_groups(rows, jaccard.jaccard_groups(df).collect())


def test_one_of_each(docs, none):
    out = jaccard.one_of_each(docs)
    assert out.columns == docs.columns
    rows = plain(corpus())
    groups = {frozenset(g) for g in closure(linked([t for _, t, _ in rows]))}
    assert out.count() == len(groups)
    assert jaccard.one_of_each(none).count() == 0
    assert jaccard.jaccard_groups(none).count() == 0


def test_recall_formula_holds():
    """Pairs at the threshold share a compared node about as often as the formula says."""
    rng = np.random.default_rng(2)
    hits = 0
    for _ in range(150):
        common = rng.integers(0, 2**64, 400, np.uint64)
        a = jaccard.signature(np.r_[common, rng.integers(0, 2**64, 50, np.uint64)])
        b = jaccard.signature(np.r_[common, rng.integers(0, 2**64, 50, np.uint64)])
        root = np.full(2, rng.integers(0, 2**64, dtype=np.uint64))
        row, child = jaccard.children(root, np.stack([a, b]), 0.8)
        hits += bool(set(child[row == 0]) & set(child[row == 1]))
    assert abs(hits / 150 - jaccard.survival(1)) < 0.15
    assert jaccard.runs_needed(0.999, 2) == 11


def test_components(spark):
    rng = random.Random(3)
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 140)] + [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(40)]
    found = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    links = defaultdict(set)
    for a, b in edges:
        links[a].add(b)
        links[b].add(a)
    for node in found:
        seen, todo = {node}, [node]
        while todo:
            for other in links[todo.pop()] - seen:
                seen.add(other)
                todo.append(other)
        assert found[node] == min(seen)
    assert set(found) == {n for a, b in edges if a != b for n in (a, b)}


@pytest.mark.parametrize("most", [jaccard.FILTER_BITS, 50])
def test_sieve_keeps_all_that_is_wanted(spark, monkeypatch, most):
    monkeypatch.setattr(jaccard, "FILTER_BITS", most)
    rows = spark.range(20_000).select(F.when(F.col("id") % 5 > 0, F.col("id")).alias("a"), F.col("id").alias("h"), F.lit("x").alias("map"))
    wanted = rows.filter("h % 50 in (0, 7)").select(F.col("a").alias("i"), F.col("h").alias("g"))
    left = jaccard.sieve(rows, wanted, {"a": "i", "h": "g"})
    assert left.columns == rows.columns
    assert left.filter("h % 50 in (0, 7)").count() == wanted.count() == 800
    assert left.count() < 4000 or most == 50
    assert jaccard.sieve(rows, wanted.limit(0), {"a": "i", "h": "g"}).count() == 0


def test_sieve_lets_few_others_through(spark):
    rows = spark.range(40_000).selectExpr("id AS a", "xxhash64(id) AS h")
    left = jaccard.sieve(rows, rows.filter("a % 20 = 0"), {"a": "a", "h": "h"})
    assert left.filter("a % 20 = 0").count() == 2_000
    assert left.count() - 2_000 <= 38_000 / 100


def test_rows_of_classes_outside_large_nodes_are_not_joined_with_them(spark, monkeypatch):
    """Signatures, sketches and marks of all classes would be shuffled anew for every level, to meet a few."""
    for name, value in (("SMALL", 8), ("LEFT", 20), ("CHUNK", 16), ("PIVOTS", 4), ("TILE", 10)):
        monkeypatch.setattr(jaccard, name, value)
    met = Counter()
    sieve = jaccard.sieve

    def seen(rows, wanted, keys):
        left = sieve(rows, wanted, keys)
        if keys == {"rep": "rep"}:
            ours = wanted.select("rep").distinct()
            assert left.join(ours, "rep").count() == ours.count()
            assert left.count() <= ours.count() + 20
            met[rows.columns[-1]] += left.count() < rows.count() / 2
        return left

    monkeypatch.setattr(jaccard, "sieve", seen)
    rng = random.Random(7)
    shared = words(rng, 40)
    rows = [(k, words(rng, 50) + " " + shared + " " + words(rng, 60), None) for k in range(60)]
    rows += [(100 + k, words(rng, 60), None) for k in range(400)]
    df = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    check_groups(rows, jaccard.jaccard_groups(df).collect())
    assert met["signature"] and met["marks"]


def test_marks_are_a_quarter_of_a_sketch_and_tell_what_is_alike():
    import numpy as np

    rng = np.random.default_rng(7)
    loose = 2 * jaccard.THRESHOLD - 1 - 0.05
    for size in (1, 9, 90, 900):
        sets = [rng.integers(0, 2**64, size, np.uint64) for _ in range(60)]
        # a ninth of the shingles exchanged: 8 of 10 are shared
        near = [np.r_[s[: size - size // 9], rng.integers(0, 2**64, size // 9, np.uint64)] for s in sets]
        marks = jaccard._marks(np.stack([jaccard.signature(s) for s in sets + near]))
        assert marks.dtype == np.uint8 and marks.shape == (120, jaccard.HASHES // 4)
        alike = jaccard._marks_alike(marks)
        assert (alike[np.arange(60), np.arange(60, 120)] >= loose).all()
        assert (alike[:60, :60][~np.eye(60, dtype=bool)] < loose).all()


def test_no_sketch_travels_beside_the_signature(spark):
    df = spark.createDataFrame([(1, "a b c d e f"), (2, None)], "doc_id long, text string")
    sets = jaccard.sets_of(df, "doc_id", "text")
    assert sets.columns == ["id", "hash", "class", "n", "signature"]
    classes = sets.withColumnRenamed("id", "rep")
    assert {len(r.marks) for r in jaccard.shortened(classes, "marks", jaccard._marks).collect()} == {jaccard.HASHES // 4}
