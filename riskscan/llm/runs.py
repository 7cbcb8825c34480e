"""Periodic runs of words, by seeds and extension along diagonals.

A run is a longest stretch of words with smallest period q and at least
``max(least, power * q)`` words.  Its words match those q further on ("lag q")
over its length less q, so at least over ``max(least - q, (power - 1) * q)``
words.  Lags are dealt to classes Q, Q+1, ... 2Q-1 (Q = 1, 2, 4, ...), and the
seeds of a class are grams of as many words as every run of the class is
guaranteed to match, K, which is 2Q or more.

Of the positions where a gram stands, only the last one at a lag of the class is paired
with each position: if the gram stands at two lags d < e of one class, then it
has a period of at most e - d < Q, and d + (e - d) <= e < 2Q <= K, so that period
divides d, and d is not the smallest period of any run there.  That makes at most one pair
for a position and class, however often a gram occurs.  For the same reason a pair at lag d goes
if its gram stands again c words on, c < d and c + d <= K.

Pairs are extended both ways along their lag.  A table of how far each lag is
covered suppresses the pairs inside a stretch that is known already.  Stretches
that are too short go; of the lags that give one stretch, the smallest is its period.

Grams are exact ranks, not hashes: a gram of 2n words is the pair of the ranks of its
halves, and positions whose gram does not recur in the document drop out at each doubling.
Several documents are worked on at a time; their words are told apart, so no match crosses.

Every row is worked on where it lies, without any shuffle.  Defined results: a null
text has no words; equal rows give equal results; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Documents are worked on together up to so many words, and texts are cut into words so many bytes at a time.
WORDS_AT_ONCE, BYTES_AT_ONCE = 1 << 18, 1 << 20
VOCABULARY = 1 << 20
RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
SPACES = b" \t\n\x0b\x0c\r"


class Numbers(dict):
    """A number for each word, given when first met."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def ranks(values: np.ndarray, at: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Equal values get equal ranks, in an array of ``n`` that holds -1 elsewhere; values met once drop out.

    Also returns the positions that are left, ascending.
    """
    _, rank, count = np.unique(values, return_inverse=True, return_counts=True)
    again = count[rank] > 1
    out = np.full(n, -1, dtype=np.int64)
    out[at[again]] = rank[again]
    return out, at[again]


def pairs_of(rank: np.ndarray, at: np.ndarray, size: int, grown: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the grams of ``grown`` words (at most ``2 * size``), from the ranks of grams of ``size``."""
    at = at[at + grown - size < len(rank)]
    a, b = rank[at], rank[at + grown - size]
    both = b >= 0
    return a[both] * len(rank) + b[both], at[both]


def match_end(x: np.ndarray, at: int, lag: int) -> int:
    """The first position from ``at`` on whose word differs from the one ``lag`` further on."""
    step, last = 64, len(x) - lag
    while at < last:
        stop = min(at + step, last)
        differ = x[at:stop] != x[at + lag:stop + lag]
        if differ.any():
            return at + int(differ.argmax())
        at, step = stop, 2 * step
    return last


def match_start(x: np.ndarray, at: int, lag: int, low: int) -> int:
    """The first position of the matches that end before ``at``, not below ``low``."""
    step = 64
    while at > low:
        start = max(at - step, low)
        differ = (x[start:at] != x[start + lag:at + lag])[::-1]
        if differ.any():
            return at - int(differ.argmax())
        at, step = start, 2 * step
    return low


def runs(x: np.ndarray, least: int = 24, power: int = 3) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs, by start and period."""
    if power < 3:
        raise ValueError("runs of fewer than three periods are not guaranteed to have seeds")
    n = len(x)
    rank, at = ranks(x, np.arange(n), n)
    size, lag, found = 1, 1, {}
    covered: dict[int, int] = {}
    while len(at) and power * lag <= n:
        overlap = min(max(least - q, (power - 1) * q) for q in range(lag, 2 * lag))
        while 2 * size <= overlap and len(at):
            rank, at = ranks(*pairs_of(rank, at, size, 2 * size), n)
            size *= 2
        codes, seeds = pairs_of(rank, at, size, overlap)
        gram = np.unique(codes, return_inverse=True)[1]
        key = gram * (2 * n + 1) + seeds
        order = np.argsort(key)
        key, seeds = key[order], seeds[order]
        far = seeds[np.searchsorted(key, key + 2 * lag) - 1] - seeds  # to the last one less than 2 * lag further on
        near = np.append(np.where(gram[order][1:] == gram[order][:-1], seeds[1:] - seeds[:-1], n), n)[:len(seeds)]
        good = (far >= lag) & ((near >= far) | (near + far > overlap))
        seeds, lags = seeds[good], far[good]
        order = np.lexsort((seeds, lags))
        seeds, lags = seeds[order], lags[order]
        # a pair next to another one of its lag lies on the same stretch
        new = np.ones(len(seeds), dtype=bool)
        new[1:] = (lags[1:] != lags[:-1]) | (seeds[1:] != seeds[:-1] + 1)
        for i, d in zip(seeds[new].tolist(), lags[new].tolist()):
            low = covered.get(d, 0)
            if i < low:
                continue
            start, end = match_start(x, i, d, low), match_end(x, i + overlap, d)
            covered[d] = end
            if end + d - start >= max(least, power * d):
                stretch = (start, end + d)
                found[stretch] = min(d, found.get(stretch, d))
        lag *= 2
    return sorted((start, end - start, d) for (start, end), d in found.items())


def word_numbers(text: bytes, numbers: Numbers) -> np.ndarray:
    """The numbers of the words of one text, cut at ASCII white space."""
    parts, at = [], 0
    while at < len(text):
        stop = at + BYTES_AT_ONCE
        while stop < len(text) and text[stop] not in SPACES:
            stop += 1
        words = text[at:stop].split()
        parts.append(np.fromiter(map(numbers.__getitem__, words), dtype=np.int64, count=len(words)))
        at = stop
    return np.concatenate(parts) if parts else np.zeros(0, dtype=np.int64)


def repeats(n: int, found: list[tuple[int, int, int]]) -> np.ndarray:
    """For each of n words: does some run contain it after the run's first period?"""
    steps = np.zeros(n + 1, dtype=np.int64)
    for start, length, period in found:
        steps[start + period] += 1
        steps[start + length] -= 1
    return np.cumsum(steps[:n]) > 0


def find_runs(docs: DataFrame, least: int = 24, power: int = 3) -> DataFrame:
    """One row per document: doc_id, n_words, runs (start, length, period; by start and period), and the text
    ``collapsed``: its words joined by single spaces, without those that a run repeats after its first period."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("runs", pa.list_(RUN)), ("collapsed", pa.string())])

    def worked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, block, words = Numbers(), [], 0

        def flush() -> pa.RecordBatch:
            nonlocal numbers, block, words
            names = list(numbers)
            sizes = [len(x) for _, x in block]
            starts = np.concatenate([[0], np.cumsum(sizes)])
            told_apart = np.concatenate([x + i * len(names) for i, (_, x) in enumerate(block)])
            own: list[list[tuple[int, int, int]]] = [[] for _ in block]
            for start, length, period in runs(told_apart, least, power):
                doc = int(np.searchsorted(starts, start, side="right")) - 1
                own[doc].append((start - int(starts[doc]), length, period))
            texts = []
            for (_, x), found in zip(block, own):
                kept = x[~repeats(len(x), found)] if found else x
                texts.append(b" ".join(map(names.__getitem__, kept.tolist())))
            out = pa.RecordBatch.from_arrays([
                pa.array([doc for doc, _ in block], pa.int64()), pa.array(sizes, pa.int64()),
                pa.array([[dict(zip(("start", "length", "period"), r)) for r in found] for found in own], pa.list_(RUN)),
                pa.array(texts, pa.binary()).cast(pa.string()),
            ], schema=schema)
            block, words = [], 0
            if len(numbers) > VOCABULARY:
                numbers = Numbers()
            return out

        for batch in batches:
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                block.append((doc, word_numbers(text.as_py(), numbers)))
                words += len(block[-1][1])
                if words >= WORDS_AT_ONCE or len(block) >= 1 << 14:
                    yield flush()
        if block:
            yield flush()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    return rows.mapInArrow(
        worked, "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
    )
