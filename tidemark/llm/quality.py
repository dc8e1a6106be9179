"""Quality classifier by Bradley-Terry pairwise ranking.

Each document is described by shares of characters, words and lines. From labelled documents pairs of a
better and a worse one are drawn; a linear score is fitted by logistic loss on the difference of their
features, so that the better one wins. The threshold is a quantile of the labelled documents' scores: the
share of them that is labelled worse lies below it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import shipped, small_batches, text_bytes, tidy
from tidemark.sources.staging import stage

# labelled documents the ranking is fitted on, at most; all if there are fewer
LABEL_SAMPLE = 20_000
PAIRS = 200_000
# the score at the threshold
ACCEPT = 0.7

SIGNS = [code for code in range(33, 127) if not chr(code).isalnum()]
N_FEATURES = len(SIGNS) + 13


def describe(text: bytes) -> np.ndarray:
    """The features of one text; all zero for an empty one."""
    out = np.zeros(N_FEATURES)
    if not text:
        return out
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    shares = np.sqrt(counts / len(text))
    out[: len(SIGNS)] = shares[SIGNS]
    group = lambda low, high: np.sqrt(counts[low:high].sum() / len(text))
    words, lines = text.split(), [line for line in text.split(b"\n") if line.strip()]
    n = max(1, len(words))
    out[len(SIGNS) :] = (
        group(48, 58),  # digits
        group(65, 91),  # capitals
        group(97, 123),  # small letters
        group(128, 256),
        group(32, 33),
        group(9, 14),
        np.sqrt(counts[:9].sum() / len(text)),
        np.log1p(len(words)),
        len(text) / n / 10,
        -np.log(max(1, len(set(words))) / n),  # repeated words
        -np.log(max(1, len(set(lines))) / max(1, len(lines))),  # and lines
        sum(not (word[:1].isalnum() or word[0] > 127) for word in words) / n,  # words that begin with a sign
        np.sqrt(sum(word[-1:] in b"!?#$%&*|" for word in words) / n),  # and that end with a loud one
    )
    return out


@dataclass(frozen=True)
class Ranking:
    """A fitted linear score, its threshold, and the scale that turns distance from it into a 0-to-1 score."""

    weights: np.ndarray
    threshold: float
    scale: float

    def scores(self, features: np.ndarray) -> np.ndarray:
        """ACCEPT at the threshold, more above, less below."""
        away = (features @ self.weights - self.threshold) / self.scale
        return 1 / (1 + np.exp(-np.clip(away + np.log(ACCEPT / (1 - ACCEPT)), -500, 500)))


def fit(features: np.ndarray, labels: np.ndarray, pairs: int = PAIRS, penalty: float = 1e-3, seed: int = 5) -> Ranking:
    """Bradley-Terry by Newton's method on pairs drawn at random.

    With labels of one kind only there is nothing to rank: all documents score the same, above the
    threshold, or below it if all labels are 0.
    """
    good, bad = np.flatnonzero(labels > 0), np.flatnonzero(labels <= 0)
    if not len(good) or not len(bad):
        return Ranking(np.zeros(features.shape[1] if features.size else N_FEATURES), 1.0 if len(bad) else -1.0, 1.0)
    spread = features.std(axis=0)
    spread[spread < 1e-9] = np.inf
    rng = np.random.default_rng(seed)
    better, worse = rng.choice(good, pairs), rng.choice(bad, pairs)
    x = (features / spread)[better] - (features / spread)[worse]
    w = np.zeros(x.shape[1])
    for _ in range(25):
        p = 1 / (1 + np.exp(np.clip(x @ w, -40, 40)))
        gradient = x.T @ p / len(x) - penalty * w
        curvature = (x * (p * (1 - p))[:, None]).T @ x / len(x) + penalty * np.eye(len(w))
        step = np.linalg.solve(curvature, gradient)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    weights = w / spread
    ranked = np.sort(features @ weights)
    # the quantile between the labelled worse and better shares, half way between its neighbours
    threshold = (ranked[len(bad) - 1] + ranked[len(bad)]) / 2
    return Ranking(weights, float(threshold), float(max(ranked.std() / 3, 1e-9)))


def remainder(id_col: str, by: int) -> Column:
    """crc32 of the id as text, modulo ``by``; null for a null id."""
    return F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")) % by


@shipped
def train(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", most: int = LABEL_SAMPLE) -> Ranking:
    """Fit on at most ``most`` labelled documents, chosen by the hash of their id.

    Rows without a label, and labels of documents that aren't there, are not used; several labels of one
    document count as their majority, an even split as 1. Null and empty texts are described like any other. Documents that repeat
    an id are all used. A text is described in one task, at about eight bytes of memory per byte. Other columns don't matter, whatever their names.
    """
    by_hash = F.xxhash64("id")
    judged = labels.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").alias("label")).dropna()
    judged = judged.groupBy("id").agg((F.avg("label") >= 0.5).cast("int").alias("label"))
    judged = stage(judged)
    # about ``most`` rows by the hash of their id, then the limit: so few that they may be broadcast
    share = most / max(1, judged.count())
    thinned = judged.filter(F.pmod(by_hash, F.lit(2**31)) < int(min(1.0, share) * 2**31))
    chosen = F.broadcast(stage(thinned.orderBy(by_hash, "id").limit(most)))

    @tidy
    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [describe(text).tolist() for text in text_bytes(batch.column(2))]
            yield pa.record_batch(
                [batch.column(0), batch.column(1), pa.array(rows, pa.list_(pa.float64()))], names=["id", "label", "x"]
            )

    rows = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text")).join(chosen, "id")
    kind = df.schema[id_col].dataType.simpleString()
    described = rows.select("id", "label", "text").mapInArrow(features, f"id {kind}, label int, x array<double>")
    # ids may repeat, so the limit holds for the rows too
    with small_batches(df.sparkSession):
        sample = described.orderBy(by_hash, "id", "x").limit(most).select("label", "x").toPandas()
    x = np.array(sample["x"].tolist(), float).reshape(len(sample), N_FEATURES)
    return fit(x, sample["label"].to_numpy())


def score_column(text: Column, ranking: Ranking) -> Column:
    """The 0-to-1 score of a text; null is the empty text."""

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        rows = [describe((text or "").encode()) for text in texts]
        return pd.Series(ranking.scores(np.array(rows).reshape(len(rows), N_FEATURES)))

    return score(text)


def accepted(df: DataFrame, ranking: Ranking, text_col: str = "text") -> DataFrame:
    """Rows whose text scores at least ACCEPT; repeated rows stay repeated."""
    return df.filter(score_column(F.col(f"`{text_col}`"), ranking) >= ACCEPT)
