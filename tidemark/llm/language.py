"""Language-model scores: a log-bilinear model trained in numpy by noise-contrastive estimation.

Tokens are words in lower case (A-Z) and one end per document. Every token that occurs sqrt(N) / SPREAD
times or more among the N training tokens is listed: it is a symbol with vectors of its own, so the
vocabulary grows with the corpus, to at most SPREAD * sqrt(N) symbols. The other tokens share one of
BUCKETS symbols by their last bytes; within a bucket a token has its share of the bucket's add-one
counts, with one share for all unknown tokens.

The model scores symbol w after symbol c as r_c . q_w + b_w. It is fitted in two steps to the counts of
(context, symbol), which are gathered by a shuffle over all training documents. A start of fixed size,
HEAD symbols and the buckets, is fitted on the driver. Every symbol then begins with the vectors of its
counterpart there, and Spark tasks train them on: each owns some contexts, goes through their pairs in
minibatches against drawn noise, and what the tasks make of a symbol's target vector is averaged.
Products of blocks of contexts with all symbols give every context's normaliser, so log-probabilities
are normalised and scoring a token is one product of two vectors.

Tokens are known by 58 bits of a hash and 6 bits of bucket.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import in_slices, shipped, stage_lean, text_bytes
from tidemark.sources.staging import stage

# a token with sqrt(N) / SPREAD occurrences or more has vectors of its own
SPREAD = 16
BUCKETS = 64
HEAD = 960
WIDTH = 32
NOISE = 10
STEPS = 120
ROUNDS = 4
RATE = 0.02
# a symbol seen less often than this hardly leaves the vectors it began with
INERTIA = 50.0
# the counts of a token with at least one in so many of the training tokens are looked up where a text is read
FREQUENT = 2**21
# tokens gathered before equal ones are added up, pairs a training task takes, symbols a row of vectors carries
GATHERED = 2**22
TASK_PAIRS = 2**20
CHUNK = 4096
END = b""


class Tokens(dict):
    """Token number per word (bytes): 58 bits of its hash, then 6 bits of bucket; begun anew when full."""

    def __init__(self, most: int = 400_000):
        super().__init__()
        self.most = most

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        number = xxhash.xxh3_64_intdigest(word) & ~(BUCKETS - 1) | xxhash.xxh32_intdigest(word[-3:]) & (BUCKETS - 1)
        value = self[word] = number - 2**64 if number >= 2**63 else number
        return value


TOKENS = Tokens()
END_TOKEN = TOKENS[END]


def tokens_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The tokens of all texts in a row, each text's end included, and the number of each text."""
    words, lengths = [], []
    for text in texts:
        own = text.lower().split()
        words += own
        words.append(END)
        lengths.append(len(own) + 1)
    return np.fromiter(map(TOKENS.__getitem__, words), np.int64, len(words)), np.array(lengths, np.int64)


def added_up(batches: Iterator[pa.RecordBatch], values: Callable[[list[bytes]], np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Distinct values of the texts with their counts, over about GATHERED tokens at a time."""
    held, size = [], 0
    for batch in batches:
        for _, part in in_slices(text_bytes(batch.column(0))):
            held.append(values(part))
            size += len(held[-1])
            if size >= GATHERED:
                yield np.unique(np.concatenate(held), return_counts=True)
                held, size = [], 0
    if held:
        yield np.unique(np.concatenate(held), return_counts=True)


def token_counts(texts: DataFrame) -> DataFrame:
    """token, n over a frame with the one column text."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for token, n in added_up(batches, lambda part: tokens_of(part)[0]):
            yield pa.record_batch([pa.array(token), pa.array(n)], names=["token", "n"])

    return texts.mapInArrow(count, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))


@dataclass(frozen=True)
class Vectors:
    """Context and target vectors, biases and log normalisers by symbol."""

    contexts: np.ndarray
    targets: np.ndarray
    biases: np.ndarray
    norms: np.ndarray | None = None

    def log10(self, contexts: np.ndarray, symbols: np.ndarray, step: int = 2**16) -> np.ndarray:
        """log10 P(symbol | context) of each pair."""
        out = np.empty(len(symbols))
        for at in range(0, len(symbols), step):
            c, w = contexts[at : at + step], symbols[at : at + step]
            out[at : at + step] = np.einsum("ij,ij->i", self.contexts[c], self.targets[w]) + self.biases[w] - self.norms[c]
        return out / math.log(10)


@dataclass(frozen=True)
class Model:
    """What scoring needs: frequent tokens (sorted) with counts and symbols, how many are listed, bucket
    totals, totals of training tokens and distinct ones, the least count of a frequent token, vectors."""

    tokens: np.ndarray
    counts: np.ndarray
    symbols: np.ndarray
    listed: int
    bucket_totals: np.ndarray
    n: int
    v: int
    least: int
    vectors: Vectors | None = None

    @property
    def size(self) -> int:
        """Number of symbols."""
        return self.listed + BUCKETS

    def look_up(self, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Counts (-1 where the token is not frequent), symbols, and which tokens are listed."""
        bucket = self.listed + (tokens & (BUCKETS - 1))
        if not len(self.tokens):
            return np.full(len(tokens), -1), bucket, np.zeros(len(tokens), bool)
        at = np.minimum(np.searchsorted(self.tokens, tokens), len(self.tokens) - 1)
        known = self.tokens[at] == tokens
        symbol = np.where(known, self.symbols[at], bucket)
        return np.where(known, self.counts[at], -1), symbol, symbol < self.listed

    def contexts(self, symbols: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Each token's context: the symbol before it; at the beginning of a text that of the end."""
        before = np.empty_like(symbols)
        before[1:] = symbols[:-1]
        starts = np.cumsum(lengths) - lengths
        before[starts] = self.look_up(np.array([END_TOKEN]))[1][0]
        return before

    def head(self) -> np.ndarray:
        """Each symbol's counterpart in the start: listed ones beyond HEAD have that of their bucket."""
        at = np.arange(self.size)
        own = self.symbols < self.listed
        at[self.symbols[own]] = HEAD + (self.tokens[own] & (BUCKETS - 1))
        at[: min(HEAD, self.listed)] = np.arange(min(HEAD, self.listed))
        at[self.listed :] = HEAD + np.arange(BUCKETS)
        return at

    def frequency(self) -> np.ndarray:
        """Each symbol's share of the training tokens, never 0."""
        n = np.append(np.zeros(self.listed), self.bucket_totals)
        own = self.symbols < self.listed
        n[self.symbols[own]] = self.counts[own] + 1.0
        return n / n.sum()


def vocabulary(counts: DataFrame) -> Model:
    """The model of staged counts (token, n), still without vectors."""
    n, v = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    # counts add up to n, so at most max(FREQUENT, SPREAD * sqrt(n)) tokens reach ``least``, and the end
    enough = math.ceil(math.sqrt(n) / SPREAD)
    least = max(1, min(enough, math.ceil(n / FREQUENT)))
    top = counts.filter((F.col("n") >= least) | (F.col("token") == END_TOKEN)).toPandas().sort_values("token")
    tokens, own = top["token"].to_numpy(np.int64), top["n"].to_numpy(np.int64)
    # the end is always listed and comes first; then by count, ties by number
    order = np.lexsort((tokens, -own, tokens != END_TOKEN))
    listed = order[(own[order] >= enough) | (tokens[order] == END_TOKEN)]
    symbols = len(listed) + (tokens & (BUCKETS - 1))
    symbols[listed] = np.arange(len(listed))
    buckets = counts.groupBy(F.col("token").bitwiseAND(BUCKETS - 1).alias("bucket")).agg(F.sum(F.col("n") + 1).alias("total"))
    totals = np.ones(BUCKETS)
    for bucket, total in buckets.collect():
        totals[bucket] += total
    np.subtract.at(totals, tokens[listed] & (BUCKETS - 1), own[listed] + 1)
    return Model(tokens, own, symbols, len(listed), totals, int(n), int(v), least)


def pair_counts(texts: DataFrame, model: Model) -> DataFrame:
    """context, symbol, n over all tokens: sparse, one row per pair that occurs."""
    shared = texts.sparkSession.sparkContext.broadcast(model)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value

        def cells(part: list[bytes]) -> np.ndarray:
            tokens, lengths = tokens_of(part)
            symbols = m.look_up(tokens)[1]
            return m.contexts(symbols, lengths) * m.size + symbols

        for cell, n in added_up(batches, cells):
            context, symbol = np.divmod(cell, m.size)
            yield pa.record_batch([pa.array(context.astype(np.int32)), pa.array(symbol.astype(np.int32)), pa.array(n)], names=["context", "symbol", "n"])

    pairs = texts.mapInArrow(count, "context int, symbol int, n long")
    return pairs.groupBy("context", "symbol").agg(F.sum("n").alias("n"))


def head_pairs(pairs: DataFrame, head: np.ndarray) -> np.ndarray:
    """The pair counts between symbols of the start, (HEAD + BUCKETS) squared whatever the corpus."""
    k = HEAD + BUCKETS
    shared = pairs.sparkSession.sparkContext.broadcast(head)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            context, symbol, n = (batch.column(at).to_numpy() for at in range(3))
            cell, at = np.unique(shared.value[context] * k + shared.value[symbol], return_inverse=True)
            yield pa.record_batch([pa.array(cell), pa.array(np.bincount(at, n, len(cell)).astype(np.int64))], names=["cell", "n"])

    cells = pairs.mapInArrow(fold, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(k * k)
    out[cells["cell"].to_numpy(np.int64)] = cells["n"]
    return out.reshape(k, k)


def fit_head(pairs: np.ndarray, width: int = WIDTH, noise: int = NOISE, steps: int = STEPS, seed: int = 3) -> Vectors:
    """A log-bilinear model fitted to a square of counts (context, symbol).

    Noise-contrastive estimation tells each seen symbol from ``noise`` ones drawn from the symbols'
    frequencies; on so few symbols the draws enter by their expectation. Adam on the whole.
    """
    k = len(pairs)
    per_context = pairs.sum(axis=1, keepdims=True)
    total = max(1.0, per_context.sum())
    frequency = (pairs.sum(axis=0) + 0.5) / (pairs.sum() + 0.5 * k)
    seen, drawn = (pairs / total).astype(np.float32), (noise * (per_context / total) * frequency).astype(np.float32)
    prior = np.log(frequency).astype(np.float32)
    offset = np.float32(np.log(noise)) + prior
    rng = np.random.default_rng(seed)
    params = [rng.normal(0, 0.1, (k, width)).astype(np.float32), rng.normal(0, 0.1, (k, width)).astype(np.float32), prior.copy()]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    for step in range(1, steps + 1):
        r, q, b = params
        margin = r @ q.T + b - offset
        right = 1 / (1 + np.exp(-np.clip(margin, -30, 30)))
        slope = drawn * right - seen * (1 - right)
        gradients = [slope @ q, slope.T @ r, slope.sum(axis=0)]
        rate = 0.05 * min(1.0, 2 * (1 - (step - 1) / steps))
        for p, g, (m, s) in zip(params, gradients, moments):
            m += 0.1 * (g - m)
            s += 0.01 * (g * g - s)
            p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-10)
    return Vectors(*params)


def grown(start: Vectors, model: Model) -> Vectors:
    """Every symbol with its counterpart's vectors, and its share of the counterpart's bias."""
    head, frequency = model.head(), model.frequency()
    together = np.bincount(head, frequency, HEAD + BUCKETS)
    share = np.log(frequency / together[head]).astype(np.float32)
    return Vectors(start.contexts[head], start.targets[head], start.biases[head] + share)


def sums_by(groups: np.ndarray, rows: np.ndarray, n_groups: int) -> np.ndarray:
    """Sum of the rows of each group."""
    out = np.zeros((n_groups, rows.shape[1]), np.float32)
    if len(groups):
        order = np.argsort(groups, kind="stable")
        ordered = groups[order]
        starts = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))
        out[ordered[starts]] = np.add.reduceat(rows[order], starts)
    return out


def climb(values: np.ndarray, squares: np.ndarray, at: np.ndarray, slope: np.ndarray, rate: float) -> None:
    """One AdaGrad step of the values at distinct places."""
    squares[at] += slope * slope
    values[at] += rate * slope / np.sqrt(squares[at])


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def train_pairs(
    context: np.ndarray, symbol: np.ndarray, n: np.ndarray, vectors: Vectors, frequency: np.ndarray, rate: float, seed: int,
    noise: int = NOISE, drawn: int = 512, batch: int = 2**15,
) -> tuple[np.ndarray, Vectors]:
    """Go once through pairs that hold whole contexts: the contexts, and all vectors after it (``contexts``
    those of these contexts only).

    A minibatch is some contexts with all their pairs, about ``batch`` of them. ``drawn`` symbols are
    drawn by frequency and stand for ``noise`` ones per seen pair with each of its contexts.
    """
    rng = np.random.default_rng(seed)
    # contexts in an order by chance, pairs by context
    own, place = np.unique(context, return_inverse=True)
    order = rng.permutation(len(own))
    place, own = np.argsort(order)[place], own[order]
    by_place = np.argsort(place, kind="stable")
    place, symbol, n = place[by_place], symbol[by_place], n[by_place].astype(np.float32)
    first = np.searchsorted(place, np.arange(len(own) + 1))
    r, q, b = vectors.contexts[own], vectors.targets.copy(), vectors.biases.copy()
    squares = [np.full(p.shape, INERTIA**2, np.float32) for p in (r, q, b)]
    offset = np.log(noise * frequency).astype(np.float32)
    chances = np.cumsum(frequency)
    at = 0
    while at < len(own):
        to = max(at + 1, int(np.searchsorted(first, first[at] + batch, side="right")) - 1)
        pairs = slice(first[at], first[to])
        c, w, seen = place[pairs] - at, symbol[pairs], n[pairs]
        x = np.minimum(np.searchsorted(chances, rng.random(drawn) * chances[-1]), len(b) - 1)
        here = r[at:to]
        up = seen * sigmoid(offset[w] - b[w] - np.einsum("ij,ij->i", here[c], q[w]))
        per_context = np.bincount(c, seen, to - at).astype(np.float32) * np.float32(noise / drawn)
        down = per_context[:, None] * sigmoid(here @ q[x].T + b[x] - offset[x])
        touched, among = np.unique(np.append(w, x), return_inverse=True)
        slope_r = sums_by(c, up[:, None] * q[w], to - at) - down @ q[x]
        slope_q = sums_by(among, np.concatenate([up[:, None] * here[c], -(down.T @ here)]), len(touched))
        slope_b = np.bincount(among, np.append(up, -down.sum(axis=0)), len(touched)).astype(np.float32)
        climb(r, squares[0], np.arange(at, to), slope_r, rate)
        climb(q, squares[1], touched, slope_q, rate)
        climb(b, squares[2], touched, slope_b, rate)
        at = to
    return own, Vectors(r, q, b)


STEP = "chunk int, symbols binary, vectors binary, weights binary"


def train_round(pairs: DataFrame, vectors: Vectors, frequency: np.ndarray, tasks: int, rate: float, seed: int) -> Vectors:
    """One pass over all pairs: contexts are dealt to tasks by their number; a symbol's target vector
    becomes the mean of what the tasks made of it, weighted by how often each saw it."""
    context = pairs.sparkSession.sparkContext
    shared = context.broadcast((vectors, frequency))

    def step(key, table):
        before, often = shared.value
        c, w, n = (table.column(name).to_numpy() for name in ("context", "symbol", "n"))
        own, after = train_pairs(c, w, n, before, often, rate, seed * 1_000_003 + key[0].as_py())
        rows = [(-1, own.astype(np.int32), after.contexts, np.zeros(0, np.float32))]
        mass = np.bincount(w, n, len(often)).astype(np.float32)
        met = np.flatnonzero(mass)
        change = np.column_stack([after.targets[met] - before.targets[met], after.biases[met] - before.biases[met]])
        for chunk in np.unique(met // CHUNK):
            some = slice(*np.searchsorted(met, [chunk * CHUNK, (chunk + 1) * CHUNK]))
            rows.append((chunk, met[some].astype(np.int32), change[some], mass[met[some]]))
        columns = zip(*((int(chunk), *(np.ascontiguousarray(x).tobytes() for x in parts)) for chunk, *parts in rows))
        kinds = (pa.int32(), pa.binary(), pa.binary(), pa.binary())
        return pa.table([pa.array(column, kind) for column, kind in zip(columns, kinds)], names=["chunk", "symbols", "vectors", "weights"])

    def mean(table):
        total, weight = np.zeros((CHUNK, WIDTH + 1)), np.zeros((CHUNK, 1))
        chunk = table.column("chunk")[0].as_py()
        for row in table.select(["symbols", "vectors", "weights"]).to_batches():
            for parts in zip(*row.columns):
                symbols, change, mass = (np.frombuffer(part.as_py(), kind) for part, kind in zip(parts, (np.int32, np.float32, np.float32)))
                total[symbols - chunk * CHUNK] += change.reshape(-1, WIDTH + 1) * mass[:, None]
                weight[symbols - chunk * CHUNK] += mass[:, None]
        met = np.flatnonzero(weight)
        change = (total[met] / weight[met]).astype(np.float32)
        parts = ((met + chunk * CHUNK).astype(np.int32), change, np.zeros(0, np.float32))
        return pa.table([pa.array([chunk], pa.int32()), *(pa.array([x.tobytes()], pa.binary()) for x in parts)], names=["chunk", "symbols", "vectors", "weights"])

    dealt = pairs.groupBy((F.col("context") % tasks).alias("task"))
    made = stage_lean(dealt.applyInArrow(step, STEP))
    r, q, b = vectors.contexts.copy(), vectors.targets.copy(), vectors.biases.copy()
    # a context belongs to one task, a chunk is averaged in one: what arrives here is one copy of the model
    for _, symbols, rows, _ in made.filter("chunk < 0").toLocalIterator():
        r[np.frombuffer(symbols, np.int32)] = np.frombuffer(rows, np.float32).reshape(-1, WIDTH)
    for _, symbols, rows, _ in made.filter("chunk >= 0").groupBy("chunk").applyInArrow(mean, STEP).collect():
        at, change = np.frombuffer(symbols, np.int32), np.frombuffer(rows, np.float32).reshape(-1, WIDTH + 1)
        q[at] += change[:, :WIDTH]
        b[at] += change[:, WIDTH]
    shared.unpersist()
    return Vectors(r, q, b)


def normalised(spark: SparkSession, vectors: Vectors) -> Vectors:
    """With the log normaliser of every context: blocks of contexts times all symbols, in Spark tasks."""
    k = len(vectors.biases)
    step = max(1, 2**22 // k)
    shared = spark.sparkContext.broadcast(vectors)

    def norms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = shared.value
        for batch in batches:
            for block in batch.column(0).to_pylist():
                scores = v.contexts[block * step : (block + 1) * step] @ v.targets.T + v.biases
                most = scores.max(axis=1, keepdims=True)
                norm = most[:, 0] + np.log(np.exp(scores - most).sum(axis=1, dtype=np.float64))
                yield pa.record_batch([pa.array(block * step + np.arange(len(norm))), pa.array(norm)], names=["context", "norm"])

    blocks = -(-k // step)
    found = spark.range(0, blocks, 1, min(blocks, 1000)).mapInArrow(norms, "context long, norm double").toPandas()
    out = np.empty(k)
    out[found["context"].to_numpy(np.int64)] = found["norm"]
    shared.unpersist()
    return replace(vectors, norms=out)


@shipped
def train(texts: DataFrame) -> tuple[Model, DataFrame]:
    """The model of a frame with the one column text, and the staged counts (token, n) of its tokens.

    The driver and each worker hold one copy of the model: 2 * WIDTH + 3 numbers for each of at most
    SPREAD * sqrt(N) + 1 + BUCKETS symbols.
    """
    counts = stage(token_counts(texts))
    model = vocabulary(counts)
    pairs = stage_lean(pair_counts(texts, model))
    vectors = grown(fit_head(head_pairs(pairs, model.head())), model)
    frequency = model.frequency()
    tasks = -(-max(1, pairs.count()) // max(TASK_PAIRS, 8 * model.size))
    for round_ in range(ROUNDS):
        vectors = train_round(pairs, vectors, frequency, tasks, RATE / (1 + round_), round_)
    return replace(model, vectors=normalised(texts.sparkSession, vectors)), counts


@shipped
def score_texts(df: DataFrame, model: Model, counts: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``df``: id, n_tokens, n_known, train_tokens, base_score, score.

    Frequent tokens are looked up where the text is read; counts of the others come by a join on the
    token, one row per document and token. A null text is empty: its end is its one token. Rows that
    repeat an id are scored each; an empty table gives an empty result. Without training documents every
    token is unknown and the base score is 0. A text is scored in one task, at some twelve bytes of memory per byte.
    Other columns don't matter, whatever their names.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)
    kind = df.schema[id_col].dataType.simpleString()

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        base_total = m.n + m.v + 1
        for batch in batches:
            texts = text_bytes(batch.column(2))
            for first, part in in_slices(texts):
                tokens, lengths = tokens_of(part)
                document = np.repeat(np.arange(len(part)), lengths)
                count, symbol, listed = m.look_up(tokens)
                add = lambda values, size=len(part), at=document: np.bincount(at, values, minlength=size)
                frequent = count >= 0
                ones = np.log10(np.where(frequent, count, 0) + 1.0)
                model_score = m.vectors.log10(m.contexts(symbol, lengths), symbol)
                in_bucket = -np.log10(m.bucket_totals[tokens & (BUCKETS - 1)])
                model_score = model_score + np.where(listed, 0, ones + in_bucket)
                place = batch.column(1).slice(first, len(part)).to_numpy(zero_copy_only=False)
                none = pa.nulls(len(part), pa.int64())
                yield pa.record_batch(
                    [
                        batch.column(0).slice(first, len(part)), pa.array(place), none, none, pa.array(lengths),
                        pa.array(add(frequent).astype(np.int64)), pa.array(add(ones) - lengths * np.log10(base_total)), pa.array(add(model_score)),
                    ],
                    names=NAMES,
                )
                pair, n = np.unique(np.stack([document[~frequent], tokens[~frequent]]), axis=1, return_counts=True)
                if len(n):
                    gap, dull = pa.nulls(len(n), pa.int64()), pa.nulls(len(n), pa.float64())
                    yield pa.record_batch(
                        [pa.nulls(len(n), batch.column(0).type), pa.array(place[pair[0]]), pa.array(pair[1]), pa.array(n), gap, gap, dull, dull],
                        names=NAMES,
                    )

    rows = df.select(F.col(f"`{id_col}`").alias("id"), F.monotonically_increasing_id().alias("place"), F.col(f"`{text_col}`").alias("text"))
    schema = f"id {kind}, place long, token long, n long, n_tokens long, n_known long, base_score double, score double"
    found = stage(rows.mapInArrow(look, schema))
    # a rare token adds log10(count + 1) to either score; unknown ones have no counts
    rare = found.filter("token is not null").select("place", "token", "n")
    rare = rare.join(counts.filter(F.col("n") < model.least).withColumnRenamed("n", "c"), "token")
    gains = rare.groupBy("place").agg(F.sum("n").alias("more"), F.sum(F.col("n") * F.log10(F.col("c") + 1)).alias("gain"))
    own = found.filter("token is null").drop("token", "n").join(gains, "place", "left")
    gain = F.coalesce("gain", F.lit(0.0))
    return own.select(
        "id",
        "n_tokens",
        (F.col("n_known") + F.coalesce("more", F.lit(0))).alias("n_known"),
        F.lit(model.n).cast("long").alias("train_tokens"),
        (F.col("base_score") + gain).alias("base_score"),
        (F.col("score") + gain).alias("score"),
    )


NAMES = ["id", "place", "token", "n", "n_tokens", "n_known", "base_score", "score"]
