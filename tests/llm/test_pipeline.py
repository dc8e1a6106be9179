"""The pipeline's stages on the smallest tables, each against plain Python over what the one before kept."""

from __future__ import annotations

import hashlib
import os
from collections import Counter, defaultdict
from math import floor

import pytest
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from tidemark.sources.staging import stage

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def kept(spark):
    """What each stage returns, written and read back."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    out = [docs]
    for _, step in corpus_pipeline.STAGES:
        docs = stage(step(spark, docs, FOLDER))
        out.append(docs)
    return out


def texts(df) -> dict[int, str]:
    return {r["doc_id"]: r["text"] or "" for r in df.collect()}


def test_stages_keep_the_columns(kept):
    assert len(corpus_pipeline.STAGES) == 5
    for df in kept[1:-1]:
        assert df.columns == kept[0].columns
        assert df.dropDuplicates().exceptAll(kept[0]).count() == 0


def test_quality_keeps_what_is_labelled_good(spark, kept):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    accepted, given = texts(kept[1]), texts(kept[0])
    judged = [i for i in given if i in labels]
    assert sum((i in accepted) != bool(labels[i]) for i in judged) <= max(1, len(judged) // 50)


def test_exact_copies_go(kept):
    last = {}
    for i, text in texts(kept[1]).items():
        last[text] = max(i, last.get(text, -1))
    assert set(texts(kept[2])) == set(last.values())


def test_near_copies_go(kept):
    given = texts(kept[2])
    words = {i: t.encode().split() for i, t in given.items()}
    sets = {i: {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set() for i, w in words.items()}
    label = {i: i for i in given}
    for a in sorted(given):
        for b in sorted(given):
            if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                old, new = max(label[a], label[b]), min(label[a], label[b])
                label = {i: new if x == old else x for i, x in label.items()}
    assert set(texts(kept[3])) == {i for i, x in label.items() if i == x}


def test_mix_takes_each_document_as_often_as_the_running_sum_says(kept):
    given = [(r["source"], len((r["text"] or "").encode().split()), r["doc_id"]) for r in kept[3].collect()]
    sizes = Counter()
    for s, n, _ in given:
        sizes[s] += n
    names = sorted(sizes)
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}
    full, left, free = {}, 1.5 * sum(sizes.values()), set(names)
    while True:
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] > 2 * sizes[s]}
        if not over:
            break
        full |= {s: 2.0 * sizes[s] for s in over}
        left, free = left - sum(2 * sizes[s] for s in over), free - over
    target = {s: full.get(s, level * weight[s]) for s in names}
    want = Counter()
    for s in names:
        start = (int(hashlib.md5(f"11:={s}".encode()).hexdigest()[:3], 16) + 0.5) / 4096
        rate = target[s] / sizes[s]
        for k, (_, _, i) in enumerate(sorted(x for x in given if x[0] == s)):
            want[i] += floor(start + rate * (k + 1)) - floor(start + rate * k)
    assert Counter(r["doc_id"] for r in kept[4].collect()) == +want


def test_packing_holds_every_token_once(kept):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want, found, loads = Counter(), Counter(), defaultdict(list)
    for r in kept[4].collect():
        want[r["doc_id"]] += len(tokenizer.encode(r["text"] or "", add_special_tokens=False).ids) + 1
    for r in kept[5].collect():
        found[r["doc_id"]] += r["length"]
        loads[r["sequence_id"]].append((r["offset"], r["length"]))
    assert found == want
    for parts in loads.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048


def test_run_is_the_stages_in_a_row(spark, kept):
    out = corpus_pipeline.run(spark, FOLDER)
    assert Counter((r["doc_id"], r["start"], r["ids_crc32"]) for r in out.collect()) == Counter(
        (r["doc_id"], r["start"], r["ids_crc32"]) for r in kept[5].collect()
    )
