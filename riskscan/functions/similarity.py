"""The fuzzy scorer (F1) and the Arrow functions that apply it to small name lists.

Scores are 0-100.  Similarity is the insert/delete kind: twice the longest
common subsequence over the summed lengths.  Spark has no such function
(``levenshtein`` also substitutes), so this is the one place where values
cross to Python - in Arrow batches, only for values no exact rule has settled.
Each worker process keeps a bounded memo across its tasks, so a repeated value is
scored about once per worker; values of over a thousand characters are not kept.
There is no shuffle, so one label that fills a third of the table costs nothing extra.
"""

from __future__ import annotations

import heapq
import re
from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

NEAR = 1.5  # below this length ratio whole strings are compared, above it windows
FAR = 8.0  # from this length ratio on, window scores are damped further
NEAR_DAMP, FAR_DAMP = 0.9, 0.6
TOKEN_DAMP = 0.95

#: Pairs compared at a time, at least and at most; 64-bit words a string may take there; strings whose windows are bounded.
LEAST_LANES, LANES, LANE_WORDS, LONG = 16, 1 << 14, 8, 1 << 8
MEMO_CHARS = 1 << 22  # what a worker's memo may hold, counted in characters of its keys
MEMO_LONGEST = 1 << 10  # longer values are scored each time


def normalise(s: str) -> str:
    """Lower case, every non-word character a blank, trimmed."""
    return re.sub(r"\W", " ", s.lower()).strip()


@lru_cache(maxsize=1 << 10)
def _kept_bits(s: str) -> dict[str, int]:
    return _made_bits(s)


def _made_bits(s: str) -> dict[str, int]:
    bits: dict[str, int] = {}
    for pos, ch in enumerate(s):
        bits[ch] = bits.get(ch, 0) | (1 << pos)
    return bits


def _position_bits(s: str) -> dict[str, int]:
    return _kept_bits(s) if len(s) <= 128 else _made_bits(s)


def _lcs(bits: dict[str, int], size: int, other: str) -> int:
    """Length of the longest common subsequence, one machine-word step per character."""
    full = (1 << size) - 1
    row = full
    for ch in other:
        hit = row & bits.get(ch, 0)
        if hit:
            row = ((row + hit) | (row - hit)) & full
    return size - row.bit_count()


def lcs_lengths(pairs: Sequence[tuple[str, str]]) -> np.ndarray:
    """Length of the longest common subsequence of every pair, all pairs at a time.

    The shorter string of a pair is a row of 64-bit words with a bit a character; a step
    takes the next character of every longer string, and a carry goes from word to
    word.  Strings of more than LANE_WORDS words go one by one, as one long number.
    """
    out = np.zeros(len(pairs), dtype=np.int64)
    by_words: dict[int, list[int]] = {}
    for i, (a, b) in enumerate(pairs):
        if a and b:
            by_words.setdefault(-(-min(len(a), len(b)) // 64), []).append(i)
    for words, rows in by_words.items():
        if words > LANE_WORDS or len(rows) < LEAST_LANES:
            for i in rows:
                a, b = sorted(pairs[i], key=len)
                out[i] = _lcs(_position_bits(a), len(a), b)
        else:
            for at in range(0, len(rows), LANES):
                part = rows[at:at + LANES]
                out[part] = _lane_lengths([sorted(pairs[i], key=len) for i in part], words)
    return out


def _lane_lengths(pairs: list[list[str]], words: int) -> np.ndarray:
    """The same for pairs (shorter, longer) whose shorter strings take so many 64-bit words."""
    order = sorted(range(len(pairs)), key=lambda i: -len(pairs[i][1]))  # lanes end from the last one on
    short, long = [pairs[i][0] for i in order], [pairs[i][1] for i in order]
    points = lambda strings: np.frombuffer("".join(strings).encode("utf-32-le", "surrogatepass"), dtype="<u4")
    sizes, ends = np.array([len(s) for s in short]), np.array([len(s) for s in long])
    alphabet, letter = np.unique(points(short), return_inverse=True)
    lane = np.repeat(np.arange(len(short)), sizes)
    bit = np.arange(len(lane)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    # where each letter stands in each shorter string; the last column is for all other letters
    stands = np.zeros((words, len(short), len(alphabet) + 1), dtype=np.uint64)
    np.bitwise_or.at(stands, (bit >> 6, lane, letter), np.uint64(1) << (bit & 63).astype(np.uint64))
    text = points(long)
    found = np.minimum(np.searchsorted(alphabet, text), len(alphabet) - 1)
    code = np.where(alphabet[found] == text, found, len(alphabet))
    starts = np.cumsum(ends) - ends
    state = np.full((words, len(short)), ~np.uint64(0), dtype=np.uint64)
    live, lanes = len(short), np.arange(len(short))
    for step in range(int(ends[0])):
        while ends[live - 1] <= step:
            live -= 1
        at = code[starts[:live] + step]
        carry = np.zeros(live, dtype=np.uint64)
        for word in range(words):
            held = state[word, :live]
            hit = held & stands[word, lanes[:live], at]
            added = held + hit
            total = added + carry
            if word + 1 < words:
                carry = ((added < held) | (total < added)).astype(np.uint64)
            state[word, :live] = total | (held ^ hit)
    # a bit that has become 0 counts; beyond a string's end no bit can
    length = np.bitwise_count(~state).sum(axis=0, dtype=np.int64)
    out = np.zeros(len(pairs), dtype=np.int64)
    out[order] = length
    return out


def ratio(a: str, b: str) -> float:
    if not a and not b:
        return 100.0
    return 200.0 * _lcs(_position_bits(a), len(a), b) / (len(a) + len(b))


def partial(a: str, b: str, floor: float = 0.0) -> float:
    """Best ratio of the shorter string against a stretch of the longer one: every
    window of its own length, and the shorter stretches at both ends.

    Exact where it exceeds ``floor``; otherwise no more than that.
    """
    if len(a) > len(b):
        a, b = b, a
    if not a:
        return 100.0 if not b else 0.0
    best = _best_window(a, b, floor)
    return max(best, _best_window(b, a, max(floor, best))) if len(a) == len(b) else best


def _best_window(a: str, b: str, floor: float) -> float:
    """Slides over ``b`` and counts the characters that window and ``a`` share; no
    common subsequence is longer, so only windows that can still win are compared."""
    if len(a) >= LONG:
        return _best_long_window(a, b, floor)
    bits, size, best, found = _position_bits(a), len(a), floor, 0.0
    left = Counter(a)  # of each character of a, how many more the window may have
    shared, end = 0, len(b)
    for stop in range(1, end + size):  # the window is b[stop - size:stop], cut at both ends
        if stop <= end:
            ch = b[stop - 1]
            if ch in left:
                left[ch] -= 1
                if left[ch] >= 0:
                    shared += 1
        start = stop - size
        if start > 0:
            ch = b[start - 1]
            if ch in left:
                left[ch] += 1
                if left[ch] > 0:
                    shared -= 1
        width = min(stop, end) - max(start, 0)
        if 200.0 * shared / (size + width) > best:
            score = 200.0 * _lcs(bits, size, b[max(start, 0):stop]) / (size + width)
            found = max(found, score)
            if score > best:
                best = score
                if best == 100.0:
                    break
    return found


def _best_long_window(a: str, b: str, floor: float) -> float:
    """The same by bounds between windows: a subsequence grows by no more than one character when the window
    moves by one, so between two windows that were compared it is bounded from both sides.  The stretch with the
    highest bound is halved, until none can win."""
    bits, size, end = _position_bits(a), len(a), len(b)
    best, found = floor, 0.0

    def width(stop: int) -> int:
        return min(stop, end) - max(stop - size, 0)

    def length(stop: int) -> int:
        nonlocal best, found
        common = _lcs(bits, size, b[max(stop - size, 0):min(stop, end)])
        score = 200.0 * common / (size + width(stop))
        found, best = max(found, score), max(best, score)
        return common

    stretches: list[tuple[float, int, int, int, int]] = []

    def bounded(low: int, at_low: int, high: int, at_high: int) -> None:
        if high - low > 1:
            narrow, wide = sorted((width(low), width(high)))
            most = min((at_low + at_high + high - low) / 2, size)
            bound = 200.0 * most / (size + max(narrow, most if wide < size else narrow))
            if bound > best:
                heapq.heappush(stretches, (-bound, low, at_low, high, at_high))

    marks = sorted({1, min(size, end), max(size, end), end + size - 1})  # where windows grow, are whole, and shrink
    values = [length(m) for m in marks]
    for i in range(len(marks) - 1):
        bounded(marks[i], values[i], marks[i + 1], values[i + 1])
    while stretches and best < 100.0:
        bound, low, at_low, high, at_high = heapq.heappop(stretches)
        if -bound <= best:
            break
        middle = (low + high) // 2
        value = length(middle)
        bounded(low, at_low, middle, value)
        bounded(middle, value, high, at_high)
    return found


def token_sort(a: str, b: str) -> float:
    return ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


def _token_parts(left: list[str], right: list[str]) -> tuple[str, str, str]:
    """The common words, and these followed by the others of either side; all sorted, each word once."""
    a, b = set(left), set(right)
    base = " ".join(sorted(a & b))
    return base, f"{base} {' '.join(sorted(a - b))}".strip(), f"{base} {' '.join(sorted(b - a))}".strip()


def token_set(a: str, b: str) -> float:
    left, right = a.split(), b.split()
    if not left or not right:
        return 0.0
    base, with_a, with_b = _token_parts(left, right)
    if base and (with_a == base or with_b == base):
        return 100.0
    return max([ratio(with_a, with_b)] + ([ratio(base, with_a), ratio(base, with_b)] if base else []))


def _partial_token(a: str, b: str, floor: float = 0.0) -> float:
    words_a, words_b = a.split(), b.split()
    if not set(words_a).isdisjoint(words_b):
        return 100.0
    best = partial(" ".join(sorted(words_a)), " ".join(sorted(words_b)), floor)
    once_a, once_b = sorted(set(words_a)), sorted(set(words_b))
    if len(once_a) == len(words_a) and len(once_b) == len(words_b):
        return best
    return max(best, partial(" ".join(once_a), " ".join(once_b), max(floor, best)))


def _damping(a: str, b: str) -> float:
    """1 for strings of about equal length, which are compared as wholes; less for windows."""
    spread = max(len(a), len(b)) / min(len(a), len(b))
    return 1.0 if spread < NEAR else NEAR_DAMP if spread < FAR else FAR_DAMP


def weighted(a: str, b: str, floor: float = 0.0) -> float:
    """Exact from ``floor`` on; otherwise less than that."""
    if not a or not b:
        return 0.0
    k = _damping(a, b)
    if k == 1.0:
        return max(ratio(a, b), TOKEN_DAMP * max(token_sort(a, b), token_set(a, b)))
    most = 200.0 * min(len(a), len(b)) / (len(a) + len(b))
    least = floor * (1 - 1e-9)  # what falls short of it by no more than rounding is still computed
    if max(most, 100 * k) < least:
        return 0.0
    whole = ratio(a, b) if most >= least else 0.0
    best = max(whole, least)
    by_token = TOKEN_DAMP * k * _partial_token(a, b, min(100.0, best / (TOKEN_DAMP * k)) * (1 - 1e-9))
    best = max(best, by_token)
    window = k * partial(a, b, min(100.0, best / k) * (1 - 1e-9)) if best < 100 * k else 0.0
    score = max(whole, window, by_token)
    return score if score >= floor else 0.0


def _from(cutoff: float, score: float) -> float:
    return score if score >= cutoff else 0.0


def similarity(a: str | None, b: str | None, cutoff: float = 65.0) -> float:
    """F1. Best of all scores, each dropped below the cutoff, as 0-1."""
    return similarities([(a, b)], cutoff)[0]


def similarities(pairs: Sequence[tuple[str | None, str | None]], cutoff: float = 65.0) -> list[float]:
    """F1 of every pair.  The whole-string scores of all pairs are computed together; windows
    are compared only as far as they can beat them."""
    normal = [(normalise(a or ""), normalise(b or "")) for a, b in pairs]
    best = [100.0 if a and a == b else 0.0 for a, b in normal]
    wanted: list[tuple[int, str, str]] = []
    for i, (a, b) in enumerate(normal):
        if not a or not b or a == b:
            continue
        left, right = a.split(), b.split()
        wanted += [(i, a, b), (i, " ".join(sorted(left)), " ".join(sorted(right)))]
        base, with_a, with_b = _token_parts(left, right)
        if base and (with_a == base or with_b == base):
            best[i] = 100.0
        elif left and right:
            wanted += [(i, with_a, with_b), *([(i, base, with_a), (i, base, with_b)] if base else [])]
    wanted = [w for w in wanted if best[w[0]] < 100.0]
    for (i, a, b), common in zip(wanted, lcs_lengths([w[1:] for w in wanted]).tolist()):
        score = 200.0 * common / (len(a) + len(b))
        best[i] = max(best[i], _from(cutoff, score))
    for i, (a, b) in enumerate(normal):
        if not a or not b or best[i] == 100.0:
            continue
        # of the weighted score, all but windows of sorted words is no more than one of the other scores;
        # windows are exact beyond the cutoff and the scores so far, and below these they do not matter
        damp = TOKEN_DAMP * _damping(a, b)
        floor = max(best[i], cutoff) * (1 - 1e-9)
        if damp < TOKEN_DAMP and 100 * damp > floor:
            best[i] = max(best[i], _from(cutoff, damp * _partial_token(a, b, floor / damp)))
        best[i] = max(best[i], _from(cutoff, partial(a, b, max(floor, best[i] * (1 - 1e-9)))))
    return [score / 100.0 for score in best]


# --------------------------------------------------------------------------
# Columns
# --------------------------------------------------------------------------

def _once(udf: Callable) -> Callable:
    """Keeps the optimizer from copying the call into a filter below it and so scoring every row twice."""
    return udf.asNondeterministic()


class _Memo:
    """Results of one worker process, by scorer, cutoff and names; bounded by the length of the keys it holds."""

    def __init__(self):
        self.tables: dict[tuple, dict] = {}
        self.chars = 0

    def get(self, table: tuple, key, size: int, make: Callable):
        if size > MEMO_LONGEST:
            return make()
        known = self.tables.setdefault(table, {})
        if key not in known:
            self.chars += size + 64  # an entry costs something even when it is short
            if self.chars > MEMO_CHARS:
                self.tables.clear()
                self.chars = size + 64
                known = self.tables.setdefault(table, {})
            known[key] = make()
        return known[key]


_MEMO = _Memo()


def _hits(names: Sequence[str], scorer: Callable, cutoff: float, k: int | None) -> Callable:
    """value -> [(ord, score)] of the names at or above the cutoff, best first, ties in name order.

    A repeated label is scored once per worker process, whatever task asks.
    """
    normal = [normalise(n) for n in names]
    table = (tuple(normal), scorer.__name__, cutoff, k)
    below_cutoff = (cutoff,) if scorer is weighted else ()

    def score(value: str) -> list[tuple[int, float]]:
        query = normalise(value)
        scored = [(pos, scorer(query, name, *below_cutoff)) for pos, name in enumerate(normal)] if query else []
        return sorted([s for s in scored if s[1] >= cutoff], key=lambda s: (-s[1], s[0]))[:k]

    return lambda value: _MEMO.get(table, value, len(value), lambda: score(value))


def similarity_col(a: Column, b: Column, cutoff: float = 65.0) -> Column:
    """F1 as a column; null counts as empty."""

    @F.pandas_udf("double")
    def score(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for left, right in batches:
            pairs = list(zip(left.fillna(""), right.fillna("")))
            once = dict.fromkeys(pairs)
            known = dict(zip(once, similarities(list(once), cutoff)))
            yield pd.Series([known[p] for p in pairs], dtype="float64")

    return _once(score)(a, b)


def best_hits(value: Column, names: Sequence[str], scorer: Callable = weighted, cutoff: float = 65.0,
              k: int | None = 3) -> Column:
    """array<struct<ord, score>>: the best ``k`` names for each value (all with ``k=None``); null stays null."""

    @F.pandas_udf("array<struct<ord:int,score:double>>")
    def match(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        hits = _hits(names, scorer, cutoff, k)
        for values in batches:
            rows = [None if v is None else [{"ord": o, "score": s} for o, s in hits(v)] for v in values]
            yield pd.Series(rows, dtype="object")

    return _once(match)(value)


def names_of_several(cells: Sequence[tuple[Column, Callable, float, int | None]], names: Sequence[str]) -> Column:
    """array<string>: the best names of several cells of a row, each (value, scorer, cutoff, k), all together
    in name order; one call for all of them."""
    rules = [c[1:] for c in cells]

    @F.pandas_udf("array<string>")
    def match(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        hits = [_hits(names, *rule) for rule in rules]
        for columns in batches:
            found = [sorted({o for hit, v in zip(hits, row) if v is not None for o, _ in hit(v)}) for row in zip(*columns)]
            yield pd.Series([[names[o] for o in ords] for ords in found], dtype="object")

    return _once(match)(*[c[0] for c in cells])


def best_names_of_each(values: Column, names: Sequence[str], scorer: Callable = weighted, cutoff: float = 55.0,
                       k: int | None = 2) -> Column:
    """array<string>: the best ``k`` names of every element of an array, all together in name order."""

    @F.pandas_udf("array<string>")
    def match(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        hits = _hits(names, scorer, cutoff, k)
        for arrays in batches:
            found = [[] if a is None else sorted({o for v in a for o, _ in hits(v)}) for a in arrays]
            yield pd.Series([[names[o] for o in ords] for ords in found], dtype="object")

    return _once(match)(values)


def nested_hits(value: Column, names: Sequence[str], children: Sequence[Sequence[str]], cutoff: float,
                child_cutoff: float) -> Column:
    """struct<ord, score, children>: the best name (weighted) and every child of it whose
    token-set score reaches ``child_cutoff``; (null, 0, []) without one."""

    @F.pandas_udf("ord int, score double, children array<string>")
    def match(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        best = _hits(names, weighted, cutoff, 1)
        below = [_hits(child_names, token_set, child_cutoff, None) for child_names in children]
        for values in batches:
            rows = []
            for v in values:
                top = best(v) if v is not None else []
                if not top:
                    rows.append((None, 0.0, []))
                    continue
                ord_, score = top[0]
                rows.append((ord_, score, [children[ord_][o] for o in sorted(o for o, _ in below[ord_](v))]))
            frame = pd.DataFrame(rows, columns=["ord", "score", "children"])
            yield frame.astype({"ord": "Int32"})

    return _once(match)(value)
