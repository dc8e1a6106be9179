"""Sharding, mixing and packing."""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from hard_rows import corpus, docs, none, plain  # noqa: F401
from tidemark.llm import mixing, packing, sharding
from tidemark.llm.common import positions

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("n", [1, 2, 3, 16, 17, 1000, 4097])
def test_feistel_permutes(n):
    p = sharding.Feistel(n, 7)
    places = p.forward(np.arange(n))
    assert sorted(places) == list(range(n))
    assert (p.backward(places) == np.arange(n)).all()
    assert n < 100 or (places != sharding.Feistel(n, 8).forward(np.arange(n))).any()


def test_shards(docs, none):
    found = sharding.shard_rows(docs, 16, seed=3).collect()
    rows = corpus()
    assert sorted(r["row_number"] for r in found) == list(range(len(rows)))
    by_shard = defaultdict(list)
    for r in found:
        by_shard[r["shard"]].append(r["slot"])
    assert max(map(len, by_shard.values())) - min(map(len, by_shard.values())) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in by_shard.values())
    assert Counter((r["id"], r["size"], r["text_crc32"]) for r in found) == Counter(
        (i, len(t.encode()) + 1, zlib.crc32(t.encode())) for i, t, _ in plain(rows)
    )
    again = sharding.shard_rows(docs.repartition(7), 16, seed=3).collect()
    assert Counter(map(tuple, found)) == Counter(map(tuple, again))
    assert sharding.shard_rows(none, 16).count() == 0


def test_positions_by_group(spark):
    rows = [("a" if k % 3 else None, k * 7 % 50) for k in range(200)]
    df = spark.createDataFrame(rows, "g string, x long")
    found = positions(df, [F.col("x")], by=["g"]).collect()
    groups = defaultdict(list)
    for r in found:
        groups[r["g"]].append((r["position"], r["x"]))
    for g, pairs in groups.items():
        own = sorted(x for k, x in rows if k == g)
        assert [x for _, x in sorted(pairs)] == own and sorted(p for p, _ in pairs) == list(range(len(own)))


def fill(sizes: dict, weights=(3, 1, 2), share=1.5, stop=2.0) -> dict:
    """Targets by handing out the excess again and again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    target, free, left = dict.fromkeys(names, 0.0), set(names), share * sum(sizes.values())
    while free and left > 1e-9:
        total = sum(weight[s] for s in free)
        for s in free:
            target[s] += left * weight[s] / total
        left = 0.0
        for s in list(free):
            if target[s] >= stop * sizes[s]:
                left += target[s] - stop * sizes[s]
                target[s] = stop * sizes[s]
                free.discard(s)
    return target


def test_mix(docs, none):
    rows = plain(corpus())
    size = lambda t: len(t.encode().split())
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += size(t)
    target = fill(sizes)
    planned = mixing.plan_mix(docs).collect()
    assert len(planned) == len(rows)
    taken, largest = Counter(), Counter()
    for r in planned:
        assert r["copies"] in (0, 1, 2)
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(target[r["source"]])
        taken[r["source"]] += r["copies"] * r["size"]
        largest[r["source"]] = max(largest[r["source"]], r["size"])
    for s in sizes:
        assert abs(taken[s] - target[s]) <= 2 * largest[s]
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    assert Counter(r["source"] for r in mixed.collect()) == Counter(
        {s: n for s in sizes if (n := sum(r["copies"] for r in planned if r["source"] == s))}
    )
    again = mixing.mix(docs.repartition(5))
    assert mixed.exceptAll(again).count() == again.exceptAll(mixed).count() == 0
    assert mixing.mix(none).count() == mixing.plan_mix(none).count() == 0


def test_mix_without_words(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, "", None)], "doc_id long, text string, source string")
    assert [(r["target"], r["copies"]) for r in mixing.plan_mix(df).collect()] == [(0.0, 0)] * 2


@pytest.mark.parametrize("k", [1, 2, 7, 30])
def test_differencing_keeps_every_item(k):
    sizes = np.random.default_rng(k).integers(1, 500, 200)
    window = packing.differencing(sizes, k)
    loads = np.bincount(window, sizes, minlength=k)
    assert len(window) == 200 and loads.sum() == sizes.sum() and loads.max() - loads.min() <= 60


def test_windows_rise_above_capacity():
    window, k = packing.near_equal_windows(np.array([60, 60, 60]), 100)
    assert k == 3 and sorted(window) == [0, 1, 2]
    assert packing.near_equal_windows(np.zeros(0, np.int64), 100)[1] == 1


def test_pack(docs, none):
    rows = plain(corpus())
    tokenizer = Tokenizer.from_file(PATH)
    found = packing.pack(docs, PATH, capacity=256, with_ids=True).collect()
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in found:
        ids = np.frombuffer(r["ids"], "<u4").tolist()
        assert len(ids) == r["length"] and zlib.crc32(r["ids"]) == r["ids_crc32"]
        pieces[r["id"]].append((r["start"], tuple(ids), r["doc_tokens"]))
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    whole = defaultdict(Counter)
    for i, t, _ in rows:
        ids = tokenizer.encode(t, add_special_tokens=False).ids + [1]
        for start, part, n in [x for x in pieces[i] if x[2] == len(ids)]:
            assert part == tuple(ids[start : start + len(part)]) or sum(j == i for j, _, _ in rows) > 1
        whole[i][len(ids)] += len(ids)
    for i, sums in whole.items():
        for n, total in sums.items():
            assert sum(len(p) for _, p, m in pieces[i] if m == n) == total
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 256
    assert packing.pack(none, PATH).count() == 0


def test_encoder_equals_tokenizer():
    texts = [t for _, t, _ in plain(corpus())] + [
        "It's ½ ²x İstanbul ΟΔΟΣ don't <|endoftext|>x a<|startoftext|>  y\x1cz \u0085 é we'll 12a_b--c",
        "é ñ ﬁ ǅ   中文 字 🙂🙂 a\x0bb",
    ]
    tokenizer = Tokenizer.from_file(PATH)
    for text, ids in zip(texts, packing.Encoder(PATH).encode([t.encode() for t in texts])):
        assert np.frombuffer(ids, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids
