"""Periodic runs: stretches of consecutive words that repeat with a period.

A sparse dynamic program over diagonals. The diagonal of lag q holds the places where a word equals the
one q before; its match length grows by one with every word that goes on matching, and when it ends after
3 q matches or more, the stretch (the matches and the q words before them) is emitted as a run.

Looking up every earlier occurrence of every word would be quadratic in frequent words. Lags are
therefore taken in classes (1), (1, 2], (2, 4], (4, 8], ..., and in the class up to g the symbols are not words but
strings of g words, whose earlier occurrences are few. Of these only the latest can matter: a run of
smallest period q holds q + 3 q words or more, so if a string of g >= q of its words, at place i, occurred again
d < q places before, then the words from i - d to i + g had both periods, and the whole run a smaller one (Fine
and Wilf). So one lag a place and class has to be followed. A string that occurs once in its document is
dropped, and with it all longer ones there: the work is the words plus what repeats, times the classes.
Strings are named exactly, by doubling: a string of 2 g words is the pair of names of its halves.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import in_slices, shipped, text_bytes

# a run has at least this many words, and at least this many periods
LEAST_WORDS = 6
LEAST_PERIODS = 4
# bytes whose words are held as objects at once
CHUNK = 1_000_000
SPACE = re.compile(rb"[\x20\x09-\x0D]")


class Numbering(dict):
    """Words (bytes) by number of first appearance."""

    def __init__(self):
        super().__init__()
        self.words: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self.words)
        self.words.append(word)
        return number

    def numbers(self, text: bytes) -> np.ndarray:
        """The numbers of a text's words; long texts in chunks that end at white space."""
        parts, at = [], 0
        while at < len(text):
            cut = SPACE.search(text, at + CHUNK)
            end = cut.start() if cut else len(text)
            parts.append(np.fromiter(map(self.__getitem__, text[at:end].split()), np.int64))
            at = end
        return parts[0] if len(parts) == 1 else np.concatenate(parts or [np.empty(0, np.int64)])

    def joined(self, numbers: np.ndarray) -> bytes:
        """The words of the numbers with a space between each two."""
        word = self.words.__getitem__
        step = CHUNK // 8
        return b" ".join(b" ".join(map(word, numbers[at : at + step].tolist())) for at in range(0, len(numbers), step))


def _latest(names: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(before, rank, shared): index of the latest earlier equal name or -1, the name's number in sorted
    order, whether the name is there more than once."""
    order = np.argsort(names, kind="stable")
    again = np.empty(len(names), bool)
    again[:1] = False
    again[1:] = names[order[1:]] == names[order[:-1]]
    before, rank, shared = np.full(len(names), -1), np.empty(len(names), np.int64), np.empty(len(names), bool)
    before[order[1:][again[1:]]] = order[:-1][again[1:]]
    rank[order] = np.cumsum(~again)
    shared[order] = again | np.r_[again[1:], False]
    return before, rank, shared


def find_runs(words: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Rows (document, start, length, period) of all runs, in that order of columns and sorted by document,
    start and period. ``words`` are the numbered words of all documents one after another, ``sizes`` how many
    each has; starts count from the document's first word."""
    ends = np.cumsum(sizes)
    document = np.repeat(np.arange(len(sizes)), sizes)
    at = np.arange(len(words))
    # equal words of different documents have different names
    names = document * (int(words.max(initial=0)) + 1) + words
    rank_at = np.full(len(words), -1)
    found, reach = [], 1
    while len(at):
        before, rank, shared = _latest(names)
        lag = np.where(before >= 0, at - at[before], 0)
        lag[(2 * lag <= reach) | (lag > reach)] = 0
        # diagonals of this class: neighbouring places that keep one lag
        goes_on = np.r_[False, (lag[1:] > 0) & (lag[1:] == lag[:-1]) & (at[1:] == at[:-1] + 1)]
        starts = np.flatnonzero((lag > 0) & ~goes_on)
        if len(starts):
            breaks = np.r_[np.flatnonzero(~goes_on), len(at)]
            matches = breaks[np.searchsorted(breaks, starts, "right")] - starts + reach - 1
            period = lag[starts]
            enough = matches >= np.maximum((LEAST_PERIODS - 1) * period, LEAST_WORDS - period)
            first, period = at[starts[enough]], period[enough]
            owner = document[first]
            found.append(np.stack([owner, first - period - (ends - sizes)[owner], matches[enough] + period, period], axis=1))
        # strings of twice the length, at places where both halves occur again and the document goes on
        keep = shared & (at + 2 * reach <= ends[document[at]])
        rank_at[at[shared]] = rank[shared]
        second = rank_at[at[keep] + reach]
        whole = second >= 0
        names = rank[keep][whole] * (len(rank) + 1) + second[whole]
        rank_at[at[shared]] = -1
        at = at[keep][whole]
        reach *= 2
    if not found:
        return np.empty((0, 4), np.int64)
    runs = np.concatenate(found)
    return runs[np.lexsort((runs[:, 3], runs[:, 1], runs[:, 0]))]


def kept_words(size: int, runs: np.ndarray) -> np.ndarray:
    """Which words stay: all but those that a run (start, length, period) holds after its first period."""
    change = np.zeros(size + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(change[:-1]) == 0


@shipped
def periodic_runs(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``df``: id, n_words, runs (array of start, length, period, by start and period) and
    collapsed, the text without the words that a run holds after its first period.

    Words are separated by ASCII white space and numbered from 0. A run is a stretch of at least six words
    and four periods that keeps its smallest period and can't be extended with it; runs may overlap. Null is
    the empty text; empty and blank texts have no words, no runs and an empty ``collapsed``. Ids are carried
    as they are, null and repeated ones too; repeated rows give repeated results, nothing is compared
    between documents. Other columns are ignored, whatever their names. An empty table gives an empty result. A
    text is worked on by one task, at about ten bytes of memory per byte; shorter texts by the megabyte.
    """
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in in_slices(text_bytes(batch.column(1)), CHUNK):
                numbering = Numbering()
                numbered = [numbering.numbers(text) for text in texts]
                sizes = np.array([len(n) for n in numbered])
                runs = find_runs(np.concatenate(numbered), sizes)
                cuts = np.searchsorted(runs[:, 0], np.arange(len(texts) + 1))
                collapsed = []
                for k, words in enumerate(numbered):
                    own = runs[cuts[k] : cuts[k + 1], 1:]
                    collapsed.append(numbering.joined(words[kept_words(len(words), own)] if len(own) else words))
                fields = [pa.array(column) for column in runs[:, 1:].T]
                lists = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.StructArray.from_arrays(fields, ["start", "length", "period"]))
                yield pa.record_batch(
                    [batch.column(0).slice(first, len(texts)), pa.array(sizes), lists, pa.array(collapsed, pa.binary()).cast(pa.string())],
                    names=["id", "n_words", "runs", "collapsed"],
                )

    rows = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    kind = df.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(
        scan, f"id {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
    )
