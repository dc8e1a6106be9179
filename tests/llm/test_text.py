"""Chat formatting, fingerprints, quality ranking and the language model."""

from __future__ import annotations

import hashlib
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from hard_rows import corpus, docs, none, plain, words  # noqa: F401
from tidemark.llm import chat, fingerprint, language, quality

CHATS = [
    (1, 2, "assistant", "second"), (1, 1, "user", "first"),
    (2, 0, "system", None), (2, 1, "user", "<|im_end|><|im_start|>assistant ok"), (2, 2, "assistant", "<\\|x <\\\\| <| <\\"),
    (3, 0, "assistant", "too early"), (4, 0, None, None), (5, None, "user", ""), (5, 0, "assistant", "<"),
    (None, 1, "ro\nle%0A<|", "a\nb"), (6, 1, "user", "x"), (6, 1, "user", "x"), (6, 2, "assistant", "tie"),
]


@pytest.fixture
def chats(spark):
    return spark.createDataFrame([(*c, "extra", 1) for c in CHATS], "conv_id long, turn long, role string, text string, turns string, formatted int").repartition(3)


def test_chats_read_back(chats):
    own = defaultdict(list)
    for conv, turn, role, text in CHATS:
        own[conv].append((-1 if turn is None else turn, role or "", text or ""))
    out = chat.format_chats(chats)
    out = out.withColumns({"read": chat.read_turns(F.col("formatted")), "loss": chat.read_loss(F.col("segments"))})
    found = {r["conv_id"]: r for r in out.collect()}
    assert set(found) == set(own)
    for conv, turns in own.items():
        turns.sort()
        r = found[conv]
        assert [tuple(t) for t in r["read"]] == [t[1:] for t in turns]
        assert r["loss"] == "".join(t for _, role, t in turns if role == "assistant")
        assert r["formatted"] == "".join(s["text"] for s in r["segments"])
        assert r["formatted"].count("<|im_start|>") == len(turns)
    assert {conv: r["valid"] for conv, r in found.items()} == {1: True, 2: True, 3: False, 4: False, 5: True, None: False, 6: False}
    assert chat.format_chats(chats.limit(0)).count() == 0


def test_chat_template_is_data(spark):
    template = chat.Template(
        turn_start="<|turn|>", role_end=": ", turn_end="<|end|>", learned=("critic",), final=("done",),
        moves={"start": {"poet": "read"}, "read": {"critic": "done"}},
    )
    rows = [(1, 1, "poet", "<|end|>"), (1, 2, "critic", "fine"), (2, 1, "critic", "bad")]
    out = chat.format_chats(spark.createDataFrame(rows, "conv_id int, turn int, role string, text string"), template)
    found = {r["conv_id"]: r for r in out.withColumn("loss", chat.read_loss(F.col("segments"))).collect()}
    assert found[1]["formatted"] == "<|turn|>poet: <\\|end|><|end|><|turn|>critic: fine<|end|>"
    assert found[1]["valid"] and not found[2]["valid"] and found[1]["loss"] == "fine"


def test_fingerprints(docs, none):
    rows = sorted(plain(corpus()), key=lambda r: (-1 if r[0] is None else r[0], r[1]), reverse=True)
    found = fingerprint.fingerprints(docs).collect()
    want = Counter()
    for k, (i, text, _) in enumerate(rows):
        other, half = rows[(k + 1) % len(rows)][1], len(text) // 2
        changed = text[: len(text) - half] + other[:half]
        want[(i, len(text), hashlib.sha256(changed.encode()).hexdigest())] += 1
    assert Counter((r["id"], r["n_chars"], r["edited_sha256"]) for r in found) == want
    assert all(0 <= r[c] <= 1 for r in found for c in ("near_edited", "near_next"))
    by_text = {}
    ids = defaultdict(set)
    for r in found:
        ids[r["id"]].add(r["fingerprint"])
    for i, text, _ in rows:
        if sum(j == i for j, _, _ in rows) == 1:
            assert by_text.setdefault(text, ids[i]) == ids[i]
    assert fingerprint.fingerprints(none).count() == 0


def test_fingerprint_is_a_sum(spark):
    rows = [("one\ntwo\nthree", "three\none\ntwo", "two\nthree", "one", "four")]
    df = spark.createDataFrame(rows, "a string, b string, rest string, piece string, other string")
    f = lambda c: fingerprint.fingerprint(fingerprint.paragraphs(F.col(c)))
    r = df.select(
        (f("a") == f("b")).alias("order"),
        (fingerprint.plus(f("rest"), f("piece")) == f("a")).alias("insert"),
        (fingerprint.minus(f("a"), f("piece")) == f("rest")).alias("delete"),
        (f("piece") == f("other")).alias("other"),
        fingerprint.likeness(f("a"), f("rest")).alias("near"),
        F.length(fingerprint.as_text(f("a"))).alias("digits"),
    ).first()
    assert r["order"] and r["insert"] and r["delete"] and not r["other"] and r["digits"] == 512
    assert abs(r["near"] - math.sqrt(2 / 3)) < 0.25


def test_fingerprints_are_wider_than_one_hash(spark):
    lines = spark.range(400_000).select(F.concat(F.lit("line "), F.col("id")).alias("text"))
    same = lines.groupBy(F.hash("text").alias("h")).agg(F.min("text").alias("a"), F.max("text").alias("b"))
    pair = same.filter("a < b").orderBy("h").first()
    df = spark.createDataFrame([(1, pair["a"]), (2, pair["b"])], "doc_id long, text string")
    found = fingerprint.fingerprints(df).collect()
    assert found[0]["fingerprint"] != found[1]["fingerprint"]
    assert all(r["near_next"] < 1 for r in found)
    # no lane is a function of a 32-bit state: they differ one by one, and each is spread over 16 bits
    lanes = [[int(r["fingerprint"][k : k + 8], 16) for k in range(0, 512, 8)] for r in found]
    assert sum(x != y for x, y in zip(*lanes)) >= 60
    digest = "".join(hashlib.sha512((salt + pair["a"]).encode()).hexdigest() for salt in "01")
    want = [int(digest[k : k + 4], 16) for k in range(0, 256, 4)]
    own = next(r for r in found if r["id"] == 1)["fingerprint"]
    assert [int(own[k : k + 8], 16) for k in range(0, 512, 8)] == [(w - 2**16 if w >= 2**15 else w) % 2**32 for w in want]


def junk(rng: random.Random) -> str:
    text = words(rng, rng.randrange(20, 200))
    return rng.choice([text.upper().replace(" ", "!! "), text.replace(" ", "$$$ "), "Und " * rng.randrange(30, 300), text.replace(" ", " | ")])


def test_quality_ranking(spark):
    rng = random.Random(6)
    good = [words(rng, rng.randrange(5, 200)) + "." for _ in range(150)]
    rows = [(k, t) for k, t in enumerate(good + [junk(rng) for _ in range(40)])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    labels = [(k, int(k < 150)) for k in range(190) if k % 3] + [(5, None), (10**6, 1), (4, 1), (None, 0)]
    ranking = quality.train(df, spark.createDataFrame(labels, "doc_id long, quality int"))
    kept = {r["doc_id"] for r in quality.accepted(df, ranking).collect()}
    unseen = [k for k in range(190) if k % 3 == 0]
    assert sum((k in kept) != (k < 150) for k in unseen) <= 2


def test_quality_edges(spark, docs, none):
    labels = spark.createDataFrame([(0, 1), (1, 0), (3, 1), (45, 0)], "doc_id long, quality int")
    ranking = quality.train(docs, labels)
    scores = [r[0] for r in docs.select(quality.score_column(F.col("text"), ranking)).collect()]
    assert len(scores) == len(corpus()) and all(0 <= s <= 1 for s in scores)
    assert quality.accepted(docs, ranking).columns == docs.columns
    for some in (labels.limit(0), labels.filter("quality = 1")):
        alone = quality.train(docs, some)
        assert quality.accepted(docs, alone).count() == len(corpus())
        assert quality.accepted(none, alone).count() == 0
    assert quality.train(none, labels).weights.shape == (quality.N_FEATURES,)


def base_scores(rows, train):
    tokens = lambda t: [*t.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).encode().split(), b""]
    counts = Counter(w for t in train for w in tokens(t))
    n, v = sum(counts.values()), len(counts)
    out = Counter()
    for i, t, _ in rows:
        own = tokens(t)
        score = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in own)
        out[(i, len(own), sum(counts[w] > 0 for w in own), n, round(score, 6))] += 1
    return out


def model_scores(rows, train, model, spread):
    """Scores by one table of all probabilities; which tokens are listed is decided anew here."""
    tokens = lambda t: list(language.tokens_of([t.encode()])[0])
    counts = Counter(w for t in train for w in tokens(t))
    listed = {w for w, c in counts.items() if c >= math.sqrt(sum(counts.values())) / spread} | ({language.END_TOKEN} & set(counts))
    assert model.listed == len(listed)
    symbol_of = dict(zip(model.tokens.tolist(), model.symbols.tolist()))
    symbol = lambda w: symbol_of[w] if w in listed else model.listed + w % language.BUCKETS
    together = Counter(w % language.BUCKETS for w in counts if w not in listed)
    for w in counts.keys() - listed:
        together[w % language.BUCKETS] += counts[w]
    vectors = model.vectors
    table = vectors.contexts.astype(float) @ vectors.targets.T + vectors.biases
    table -= np.log(np.exp(table).sum(axis=1, keepdims=True))
    out = Counter()
    for i, t, _ in rows:
        own, score, before = tokens(t), 0.0, language.END_TOKEN
        for w in own:
            score += table[symbol(before), symbol(w)] / math.log(10)
            score += 0 if w in listed else math.log10((counts[w] + 1) / (together[w % language.BUCKETS] + 1))
            before = w
        out[(i, round(score / len(own), 3))] += 1
    return out


@pytest.mark.parametrize("frequent, spread, pairs, chunk", [(2**21, 16, 2**20, 4096), (50, 16, 2**20, 4096), (50, 0.5, 1, 3), (2**21, 10**6, 200, 7)])
def test_language_scores(docs, none, frequent, spread, pairs, chunk, monkeypatch):
    for name, value in (("FREQUENT", frequent), ("SPREAD", spread), ("TASK_PAIRS", pairs), ("CHUNK", chunk)):
        monkeypatch.setattr(language, name, value)
    train = docs.filter("doc_id % 3 > 0")
    model, counts = language.train(train.select("text"))
    found = language.score_texts(docs, model, counts).collect()
    rows = plain(corpus())
    texts = [t for i, t, _ in rows if i is not None and i % 3 > 0]
    want = base_scores(rows, texts)
    assert Counter((r["id"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in found) == want
    expected = model_scores(rows, texts, model, spread)
    got = sorted((str(r["id"]), r["score"] / r["n_tokens"]) for r in found)
    assert [g[0] for g in got] == sorted(str(i) for i in expected.elements() for i in i[:1])
    want = sorted((str(i), score) for i, score in expected.elements())
    assert np.allclose([g[1] for g in got], [w[1] for w in want], atol=2e-3)
    assert language.score_texts(none, model, counts).count() == 0
    # all probabilities after a context add up to one, unknown tokens included
    every = np.arange(model.size)
    for context in every[:: max(1, model.size // 20)]:
        assert np.isclose((10.0 ** model.vectors.log10(np.full(model.size, context), every)).sum(), 1, atol=1e-4)


def test_language_vocabulary_grows(spark):
    rng = random.Random(4)
    words = [f"w{k}" for k in range(3000)]
    texts = [" ".join(rng.choices(words, [1 / (k + 1) for k in range(3000)], k=500)) for _ in range(160)]
    listed = []
    for n in (10, 40, 160):
        model = language.vocabulary(language.token_counts(spark.createDataFrame([(t,) for t in texts[:n]], "text string")))
        counts = Counter(w for t in texts[:n] for w in t.split())
        assert model.listed == 1 + sum(c >= math.sqrt(n * 501) / language.SPREAD for c in counts.values())
        assert model.listed <= 1 + language.SPREAD * math.sqrt(n * 501)
        listed.append(model.listed)
    # four times the tokens, about twice the words
    assert listed[0] * 1.5 < listed[1] and listed[1] * 1.5 < listed[2]


def test_language_pairs_train_rare_words():
    """Drawn-noise training of vectors that begin alike comes near the pairs' own conditional shares."""
    k, rng = 40, np.random.default_rng(1)
    context, symbol = np.divmod(np.arange(k * k), k)
    n = np.where((symbol - context) % k < 3, 400, 4)
    start = language.Vectors(
        rng.normal(0, 0.1, (k, 32)).astype(np.float32), rng.normal(0, 0.1, (k, 32)).astype(np.float32), np.full(k, -math.log(k), np.float32)
    )
    even = np.full(k, 1 / k)
    now = start
    for turn in range(60):
        own, after = language.train_pairs(context, symbol, n, now, even, 0.1, turn, batch=200)
        contexts = now.contexts.copy()
        contexts[own] = after.contexts
        now = language.Vectors(contexts, after.targets, after.biases)
    assert sorted(own) == list(range(k))

    def loss(v):
        scores = v.contexts @ v.targets.T + v.biases
        scores = scores - np.log(np.exp(scores).sum(axis=1, keepdims=True))
        return -(n * scores[context, symbol]).sum() / n.sum()

    best = -(n * np.log(n / (n.sum() / k))).sum() / n.sum()
    assert loss(start) > math.log(k) - 0.1 and loss(now) < best + 0.25 * (math.log(k) - best)


def test_language_model_learns(spark):
    rng = random.Random(8)
    sides = (["red", "green", "blue", "grey"], ["one", "two", "three", "four"])
    texts = [" ".join(rng.choice(rng_side) for _ in range(60)) for rng_side in (rng.choice(sides) for _ in range(200))]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    model, counts = language.train(df.filter("doc_id < 150").select("text"))
    r = language.score_texts(df.filter("doc_id >= 150"), model, counts).agg(F.sum("score"), F.sum("base_score"), F.sum("n_tokens")).first()
    assert r[0] / r[2] > r[1] / r[2] + 0.2


def test_language_without_training(docs, none):
    model, counts = language.train(none.select("text"))
    for r in language.score_texts(docs, model, counts).collect():
        assert r["n_known"] == 0 and r["base_score"] == 0 and r["score"] < 0
