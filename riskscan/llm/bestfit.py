"""Best-fit packing by patterns of lengths, their repeat counts fitted by non-negative least squares.

How well documents can be packed depends only on how many pieces there are of each
length, and there are at most ``capacity`` lengths.  So the plan is made on that
histogram, whatever the size of the table:

1. Lengths are rounded up to ``BINS`` sizes.  The patterns are all ways to fill a sequence
   exactly with up to three sizes, or with copies of two sizes.
2. Non-negative least squares gives the repeat counts whose pieces come nearest to the
   histogram; they are rounded to what there is.  Each pattern takes real pieces of its sizes,
   longest first; sequences that rounding leaves too loosely filled are given up again.
3. The residual pieces, and all pieces shorter than an eighth of a sequence, which are
   better as filling than in patterns, go by best fit, longest first, into the space that
   patterns leave and then into new sequences.  Equal sequences are handled as one group.

A plan row says which of the pieces of one length (by number) go where.  Pieces get their
numbers where they lie: a running number per task and length, plus how many the tasks
before it have.  So only (task, length) counts are shuffled, no texts and no ids; the
histogram of at most ``capacity`` rows is all that the driver sees.

Defined results: a null text is empty and has only the end id; every row is packed, also
those with the same or no doc_id; an empty table gives no pieces.  Sequence ids run from 0.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskscan.llm.common import written
from riskscan.llm.encoding import MEMO_PARTS, encoder

#: Sizes that lengths are rounded up to; pieces under 1 / SMALL of a sequence are only filling; a pattern's
#: sequence may leave 1 / LOOSE of itself empty.
BINS, SMALL, LOOSE = 128, 8, 256
CUT_SCHEMA = pa.schema([
    ("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()),
    ("_task", pa.int32()), ("_nth", pa.int64()),
])
#: Bytes of ids in one Arrow batch.
BATCH_BYTES = 1 << 24


# ---------------------------------------------------------------- the plan, on the histogram


def patterns(bins: int, smallest: int) -> list[tuple[tuple[int, int], ...]]:
    """Ways to fill ``bins`` units with sizes of ``smallest`` and more: ((size, copies), ...)."""
    found = {((bins, 1),)}
    for a in range(smallest, bins + 1):
        for b in range(a, bins - a + 1):  # up to three pieces, a <= b <= c
            c = bins - a - b
            if c == 0:
                found.add(tuple(sorted(Counter([a, b]).items())))
            elif c >= b:
                found.add(tuple(sorted(Counter([a, b, c]).items())))
        for copies in range(1, bins // a + 1):  # copies of one size, and of a second one
            rest = bins - copies * a
            if rest == 0:
                found.add(((a, copies),))
            for more in range(1, rest // smallest + 1):
                if rest % more == 0 and rest // more != a:
                    found.add(tuple(sorted([(a, copies), (rest // more, more)])))
    return sorted(found)


def least_squares(matrix: np.ndarray, target: np.ndarray, rounds: int = 2000) -> np.ndarray:
    """x >= 0 with least ``|matrix x - target|``, by active sets (Lawson and Hanson)."""
    columns = matrix.shape[1]
    x, passive = np.zeros(columns), np.zeros(columns, dtype=bool)
    enough = 1e-9 * max(1.0, float(np.abs(matrix.T @ target).max(initial=0)))
    for _ in range(rounds):
        gain = np.where(passive, -np.inf, matrix.T @ (target - matrix @ x))
        if not columns or gain.max() <= enough:
            break
        passive[int(gain.argmax())] = True
        while True:
            chosen = np.flatnonzero(passive)
            solved = np.linalg.lstsq(matrix[:, chosen], target, rcond=None)[0]
            if (solved > 0).all():
                x[:] = 0
                x[chosen] = solved
                break
            low = solved <= 0
            step = (x[chosen][low] / np.maximum(x[chosen][low] - solved[low], 1e-300)).min()
            x[chosen] += step * (solved - x[chosen])
            passive[chosen[x[chosen] <= 1e-12]] = False
            x[~passive] = 0
            if not passive.any():
                break
    return x


def repeat_counts(sizes: np.ndarray, ways: list[tuple[tuple[int, int], ...]]) -> list[int]:
    """How often each way is used: the fit to ``sizes`` (pieces of each size), rounded down to what there is."""
    matrix = np.zeros((len(sizes), len(ways)))
    for j, way in enumerate(ways):
        for size, copies in way:
            matrix[size, j] = copies
    fitted, left, counts = least_squares(matrix, sizes.astype(float)), sizes.astype(object).copy(), [0] * len(ways)
    for j in np.argsort(-fitted, kind="stable").tolist():
        counts[j] = max(0, min(int(fitted[j] + 0.5), *[left[size] // copies for size, copies in ways[j]]))
        for size, copies in ways[j]:
            left[size] -= counts[j] * copies
    return counts


class Plan:
    """Where the pieces of each length go.

    ``rows``: (length, first number, pieces, first sequence, offset, pieces of this row in one sequence),
    by length and number.
    """

    def __init__(self, histogram: dict[int, int], capacity: int):
        self.capacity, self.sequences = capacity, 0
        self.left = {length: n for length, n in sorted(histogram.items()) if n}
        self.open: list[tuple[int, int, int]] = []  # (free space, first sequence, sequences), ascending
        self.put: list[tuple[int, int, int, int, int]] = []  # rows without their numbers
        self.by_patterns()
        self.by_best_fit()
        self.rows, used = [], Counter()
        for length, n, first, offset, each in sorted(self.put):
            self.rows.append((length, used[length], n, first, offset, each))
            used[length] += n

    def by_patterns(self) -> None:
        bins = min(BINS, self.capacity)
        size_of = lambda length: -(-length * bins // self.capacity)
        smallest = max(1, bins // SMALL)
        by_size = {s: list(g) for s, g in groupby(self.left, key=size_of) if s >= smallest}
        sizes = np.zeros(bins + 1, dtype=np.int64)
        for size, lengths in by_size.items():
            sizes[size] = sum(self.left[length] for length in lengths)
        ways = [w for w in patterns(bins, smallest) if all(sizes[size] >= copies for size, copies in w)]
        loose = self.capacity // LOOSE
        for way, count in zip(ways, repeat_counts(sizes, ways) if ways else []):
            # every slot takes pieces of its size, longest first; as many sequences at a time as have the same lengths
            slots = [self.draw(by_size[size], count) for size, copies in way for _ in range(copies)]
            while count:
                same = min(slot[-1][1] for slot in slots)
                lengths = [slot[-1][0] for slot in slots]
                free = self.capacity - sum(lengths)
                for slot in slots:
                    length, n = slot.pop()
                    if n > same:
                        slot.append((length, n - same))
                count -= same
                if free > loose:  # filled too badly: these pieces are residual
                    for length in lengths:
                        self.left[length] += same
                    continue
                for i, length in enumerate(lengths):
                    self.put.append((length, same, self.sequences, sum(lengths[:i]), 1))
                self.add(free, self.sequences, same)
                self.sequences += same

    def draw(self, lengths: list[int], count: int) -> list[tuple[int, int]]:
        """The next ``count`` pieces of a size as runs (length, pieces), the first run last."""
        runs = []
        while count:
            n = min(count, self.left[lengths[-1]])
            if n:
                runs.append((lengths[-1], n))
                self.left[lengths[-1]] -= n
                count -= n
            else:
                lengths.pop()
        return runs[::-1]

    def add(self, free: int, first: int, n: int) -> None:
        if free and n:
            insort(self.open, (free, first, n))

    def by_best_fit(self) -> None:
        for length in sorted(self.left, reverse=True):
            while left := self.left[length]:
                at = bisect_left(self.open, (length, -1, -1))
                if at < len(self.open):
                    free, first, n = self.open.pop(at)
                    if left < n:
                        self.add(free, first + left, n - left)
                        n = left
                else:
                    each = self.capacity // length
                    free, first, n = self.capacity, self.sequences, max(1, left // each)
                    self.sequences += n
                each = min(free // length, left // n)
                self.put.append((length, n * each, first, self.capacity - free, each))
                self.left[length] -= n * each
                self.add(free - each * length, first, n)


# ---------------------------------------------------------------- pieces of documents


def cut(docs: DataFrame, tokenizer: str, end_id: int = 1, capacity: int = 4096, spaced: bool = False,
        memo_parts: int = MEMO_PARTS) -> DataFrame:
    """A written table with one row per piece: doc_id, piece, start, length, ids, and its number among its task's
    pieces of that length (``_task``, ``_nth``).  ids are little-endian unsigned 32-bit."""
    end = np.array([end_id], dtype="<u4").tobytes()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, task, seen = encoder(tokenizer, spaced, memo_parts).encode, TaskContext.get().partitionId(), Counter()
        out, size = [], 0
        for batch in batches:
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                ids = encode(text.as_py()) + end
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at:at + 4 * capacity]
                    length = len(part) // 4
                    out.append((doc, piece, at // 4, length, part, task, seen[length]))
                    seen[length] += 1
                    size += len(part)
                    if size >= BATCH_BYTES:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*out), CUT_SCHEMA)], schema=CUT_SCHEMA)
                        out, size = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*out), CUT_SCHEMA)], schema=CUT_SCHEMA)

    made = rows.mapInArrow(pieces, "doc_id long, piece int, start long, length long, ids binary, _task int, _nth long")
    return written(made, "pieces")


def place(pieces: DataFrame, capacity: int = 4096) -> DataFrame:
    """The pieces that ``cut`` made, with sequence_id and offset in place of ``_task`` and ``_nth``.

    All other columns stay as they are.
    """
    counts = written(pieces.groupBy("_task", "length").agg(F.count("*").alias("_n")), "piece-counts")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("_n").alias("n")).collect()}
    plan = np.array(Plan(histogram, capacity).rows, dtype=np.int64).reshape(-1, 6)
    before = Window.partitionBy("length").orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    based = counts.select("_task", "length", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    numbered = pieces.join(based, ["_task", "length"])
    kept = [c for c in pieces.columns if c not in ("_task", "_nth")]
    width = 1 << 48  # more than there are pieces of a length
    starts = plan[:, 0] * width + plan[:, 1]

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy()
            number = batch.column("_before").to_numpy() + batch.column("_nth").to_numpy()
            row = plan[np.searchsorted(starts, length * width + number, side="right") - 1]
            nth, each = number - row[:, 1], row[:, 5]
            out = batch.select(kept)
            out = out.append_column("sequence_id", pa.array(row[:, 3] + nth // each))
            yield out.append_column("offset", pa.array(row[:, 4] + nth % each * length))

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema if f.name in kept]
    return numbered.mapInArrow(placed, ", ".join([*fields, "sequence_id long", "offset long"]))


def pack(docs: DataFrame, tokenizer: str, end_id: int = 1, capacity: int = 4096, spaced: bool = False) -> DataFrame:
    """One row per piece of a document: doc_id, piece, start, length, ids, sequence_id, offset."""
    return place(cut(docs, tokenizer, end_id, capacity, spaced), capacity)
