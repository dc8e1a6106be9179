"""Periodic runs, Merkle manifests and benchmark decontamination against plain Python."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from hard_rows import SCHEMA, corpus, docs, none, plain, words  # noqa: F401
from tidemark.llm import decontaminate, merkle, periodic


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def runs_by_definition(x) -> list[tuple]:
    """(start, length, period): every maximal stretch with a period, if that is its smallest."""
    numbers = {w: k for k, w in enumerate(dict.fromkeys(x))}
    codes, found = np.array([numbers[w] for w in x], np.int64), []
    for q in range(1, len(x) // 4 + 1):
        same = np.r_[False, codes[q:] == codes[:-q], False]
        ends = np.flatnonzero(same[1:] != same[:-1]).reshape(-1, 2) + q
        for i, j in ends.tolist():
            run = x[i - q : j]
            if len(run) >= max(6, 4 * q) and not any(run[p:] == run[:-p] for p in range(1, q)):
                found.append((i - q, len(run), q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapsed(x, runs) -> list:
    return [w for k, w in enumerate(x) if not any(s + q <= k < s + n for s, n, q in runs)]


def test_runs_of_random_documents():
    rng = random.Random(5)
    for _ in range(400):
        texts = []
        for _ in range(rng.randrange(1, 4)):
            letters, text = rng.randrange(1, 4), []
            for _ in range(rng.randrange(6)):
                part = [rng.randrange(letters) for _ in range(rng.randrange(1, 9))]
                text += (part * 8)[: rng.randrange(1, 60)]
            texts.append(text)
        flat = np.array([w for text in texts for w in text], np.int64)
        found = [tuple(r) for r in periodic.find_runs(flat, np.array([len(t) for t in texts])).tolist()]
        assert found == [(k, *run) for k, text in enumerate(texts) for run in runs_by_definition(text)]


def test_runs_of_overlapping_and_nested_periods():
    fibonacci = ["a", "b"]
    while len(fibonacci[-1]) < 300:
        fibonacci.append(fibonacci[-1] + fibonacci[-2])
    thue = "".join("ab"[bin(k).count("1") % 2] for k in range(256))
    nested = ("aaaaaab" * 5 + "c") * 5
    for text in (fibonacci[-1], thue, nested, "a" * 300, "ab" * 40 + "ba" * 40, ("ab" * 6 + "c") * 6):
        x = [ord(c) for c in text]
        found = [tuple(r[1:]) for r in periodic.find_runs(np.array(x), np.array([len(x)])).tolist()]
        assert found == runs_by_definition(x)


def test_runs_of_hard_rows(spark, none):
    rng = random.Random(2)
    rows = corpus()
    repeated = [" ".join((words(rng, q).split() * 9)[: 5 * q + 3]) for q in (1, 2, 5, 40)]
    rows += [(1000 + k, "head  \t" + text + "\ntail", None, None, None, None, None, None, None, None) for k, text in enumerate(repeated)]
    rows += [(2000, "            x", *[None] * 8), (2001, "la " * 400_000, *[None] * 8)]
    found = periodic.periodic_runs(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    want = Counter()
    for i, text, _ in plain(rows):
        own = re.findall(r"[^\x20\x09-\x0D]+", text)
        runs = [(0, 400_000, 1)] if i == 2001 else runs_by_definition(own)
        want[(i, len(own), tuple(runs), "la" if i == 2001 else " ".join(collapsed(own, runs)))] += 1
    assert Counter((r["id"], r["n_words"], tuple(map(tuple, r["runs"])), r["collapsed"]) for r in found) == want
    assert sum(len(r["runs"]) for r in found) >= 6
    assert periodic.periodic_runs(none).count() == 0


def test_long_texts_are_numbered_in_chunks(monkeypatch):
    monkeypatch.setattr(periodic, "CHUNK", 16)
    text = words(random.Random(1), 200).encode() + b"  \n" + b"x" * 100 + b" \t "
    numbering = periodic.Numbering()
    numbers = numbering.numbers(text)
    assert [numbering.words[k] for k in numbers] == text.split()
    assert numbering.joined(numbers) == b" ".join(text.split())


def fields(*values) -> str:
    return "".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values)


def climb(digests: list[str]) -> tuple[str, list[list[tuple[str, str]]]]:
    """Root of the digests, and per digest its steps (left, right) up to it."""
    steps, places, level = [[] for _ in digests], list(range(len(digests))), digests
    while len(level) > 1:
        for k, at in enumerate(places):
            run = level[at // 16 * 16 : at // 16 * 16 + 16]
            steps[k].append(("".join(run[: at % 16]), "".join(run[at % 16 + 1 :])))
            places[k] = at // 16
        level = [sha("".join(level[at : at + 16])) for at in range(0, len(level), 16)]
    return level[0], steps


def manifest_by_definition(rows) -> Counter:
    """(id, leaf, subroot, root, steps) of rows (doc_id, text, lang, source, n_chars)."""
    leaves = {}
    for doc_id, text, lang, source, n_chars, *_ in rows:
        leaf = sha(fields(doc_id, source, lang, n_chars, text))
        leaves.setdefault(source, []).append((doc_id is not None, doc_id or 0, leaf, doc_id))
    order = sorted(leaves, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: (sorted(leaves[s]), *climb([leaf for *_, leaf, _ in sorted(leaves[s])])) for s in order}
    root, above = climb([trees[s][1] for s in order])
    return Counter(
        (doc_id, leaf, trees[s][1], root, tuple(own + above[k]))
        for k, s in enumerate(order)
        for (*_, leaf, doc_id), own in zip(trees[s][0], trees[s][2])
    )


def found_manifest(df) -> Counter:
    out = merkle.manifest(df, carry={"odd": F.col("doc_id") % 2})
    out = out.withColumns({"proof": merkle.proof_digest(F.col("path")), "folded": merkle.fold(F.col("leaf"), F.col("path"))})
    found = out.collect()
    for r in found:
        assert r["folded"] == r["root"]
        assert r["proof"] == sha("".join(left + right for left, right in r["path"]))
        assert r["carried"]["odd"] == (None if r["id"] is None else r["id"] % 2)
    return Counter((r["id"], r["leaf"], r["subroot"], r["root"], tuple(map(tuple, r["path"]))) for r in found)


def test_manifest_of_hard_rows(docs, none):
    assert found_manifest(docs) == manifest_by_definition(corpus())
    assert merkle.manifest(none).count() == 0


def test_manifest_of_uneven_trees(spark):
    sizes = {"a": 1, "b": 16, "c": 17, "Z": 300, "é": 2, None: 33, "": 1} | {f"s{k}": 1 for k in range(20)}
    rows = [(k, f"text {k} {s}", None, s, k) for s, n in sizes.items() for k in range(n)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    assert found_manifest(df) == manifest_by_definition(rows)
    for part in (rows[:1], rows[18:30]):  # one leaf is its own root; one source has no tree above it
        assert found_manifest(spark.createDataFrame(part, df.schema)) == manifest_by_definition(part)


def test_manifest_shows_tampering(spark):
    rows = [(k, f"Text {k}", "en", f"s{k % 3}", k) for k in range(100)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    changed = F.when(F.col("doc_id") % 10 == 0, merkle.leaf_digest(F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), F.lower("text")))
    out = merkle.manifest(df, carry={"changed": changed})
    folded = merkle.fold(F.coalesce("carried.changed", "leaf"), F.col("path"))
    assert all(r["ok"] == (r["id"] % 10 != 0) for r in out.select("id", (folded == F.col("root")).alias("ok")).collect())


ITEMS = [
    (1, "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"),
    (2, "alpha BETA gamma delta epsilon zeta eta theta iota kappa"),
    (2, "short item, too"),
    (3, "one"),
    (4, "two words"),
    (5, ""),
    (6, None),
    (None, "é ü 7 ten words of its own and yet one more"),
    (7, "never ever seen " * 9),
    (8, "no no no no no no no no no no no no"),
    (9, "\n.,;"),
]


def contaminated_by_definition(texts, items) -> Counter:
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    windows = {}
    for item, text in items:
        own = split(text)
        for b in range(max(1, len(own) - 9) if own else 0):
            windows.setdefault(tuple(own[b : b + 10]), set()).add("" if item is None else str(item))
    want = Counter()
    for i, text in texts:
        own, hit, held = split(text), set(), set()
        for size in {len(w) for w in windows}:
            for b in range(len(own) - size + 1):
                if tuple(own[b : b + size]) in windows:
                    hit.update(range(b, b + size))
                    held |= windows[tuple(own[b : b + size])]
        want[(i, len(own), tuple(sorted(hit)), tuple(sorted(held)))] += 1
    return want


def found_contamination(df, items) -> Counter:
    found, sets = decontaminate.find_contamination(df, items)
    lists = {r["item_set"]: tuple(r["items"]) for r in sets.collect()}
    out = Counter()
    for r in found.collect():
        spans = [tuple(s) for s in r["spans"]]
        assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))
        hit = tuple(k for b, e in spans for k in range(b, e))
        out[(r["id"], r["n_words"], hit, lists[r["item_set"]] if spans else ())] += 1
        assert (r["item_set"] is None) == (not spans)
    return out


def test_contamination_of_hard_rows(spark, none, monkeypatch):
    rng = random.Random(3)
    passages = [t for _, t in ITEMS if t] + ["alpha beta gamma delta epsilon zeta eta theta iota", "beta gamma delta epsilon zeta eta theta iota kappa lambda"]
    rows = corpus()
    for k in range(60):
        parts = [words(rng, rng.randrange(0, 12)) for _ in range(3)]
        for _ in range(rng.randrange(3)):
            parts.insert(rng.randrange(4), rng.choice(passages).upper().replace(" ", rng.choice([" ", ", ", "\n"])))
        rows.append((3000 + k, " ".join(parts), *[None] * 8))
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    items = spark.createDataFrame([(i, t, "x", 1) for i, t in ITEMS], "item_id long, text string, words string, window int")
    want = contaminated_by_definition([(r[0], r[1]) for r in rows], ITEMS)
    assert sum(n for (*_, hit, _), n in want.items() if hit) > 20
    assert found_contamination(df, items) == want
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", 0)
    assert found_contamination(df, items) == want
    assert found_contamination(none, items) == Counter()
    assert found_contamination(df, items.limit(0)) == contaminated_by_definition([(r[0], r[1]) for r in rows], [])


def test_contamination_runs_without_python_workers(spark, docs):
    items = spark.createDataFrame([(1, "a b c d")], "item_id long, text string")
    found, sets = decontaminate.find_contamination(docs, items)
    for df in (found, sets):
        assert "Python" not in df._jdf.queryExecution().executedPlan().toString()
