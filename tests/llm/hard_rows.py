from __future__ import annotations

import random

import pytest

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, row long, id string, hash int, place string, digest int"
)


def words(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(["al", "be", "ce", "de", "el", "ga", "he", "io", "ka", "la"]) + str(rng.randrange(300)) for _ in range(n))


def corpus(seed: int = 0) -> list[tuple]:
    """Hard rows: nulls in any column, empty, blank and very long texts, copies, repeated ids and rows."""
    rng = random.Random(seed)
    base = [words(rng, rng.randrange(1, 90)) for _ in range(30)]
    long = words(rng, 9000)
    texts = base + base[:8] + [None, "", " \n\t ", "", None, "a", "a b c d", "a b c d e", long, long + " tail", "é ñ ü " * 40, "x" * 3000]
    near = words(rng, 60).split()
    for k in range(12):
        copy = list(near)
        copy[5 + 4 * k] = f"edit{k}"
        texts.append(" ".join(copy))
    rows = [(k, t, "en", f"s{k % 4}" if k % 9 else None, len(t or ""), k, str(k), k, None, k) for k, t in enumerate(texts)]
    return [
        *rows,
        rows[3],
        rows[3],
        (7, "another text under a known id " + words(rng, 12), None, "s1", None, None, None, None, "p", None),
        (None, "no id " + words(rng, 30), None, None, None, None, None, None, None, None),
        (None, None, None, None, None, None, None, None, None, None),
        (None, None, None, None, None, None, None, None, None, None),
    ]


@pytest.fixture
def docs(spark):
    return spark.createDataFrame(corpus(), SCHEMA).repartition(3)


@pytest.fixture
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def plain(rows: list[tuple]) -> list[tuple]:
    """(doc_id, text, source) with null texts as empty ones."""
    return [(r[0], r[1] or "", r[3]) for r in rows]
