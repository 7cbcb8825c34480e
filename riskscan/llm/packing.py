"""Order-preserving packing of token ids into sequences, by dynamic programming.

Documents are dealt out by ranges of doc_id and stand in ascending order.  Their
ids form one stream, cut where a document or a sentence ends.  The cuts that cost
least are found exactly: ``best[j] = penalty[j] + min(best[i] + padding(j - i))``
over the cuts ``i`` at most ``capacity`` ids before ``j``.  Padding is linear in
``i`` but for lengths that are a power of two, so a monotone queue gives the
minimum in constant time; the powers of two are looked up beside it.

A range is worked on in blocks of about ``block_ids`` ids that end with a
document, which bounds memory; each block ends its last sequence.

Defined results: a null text is empty and has only the end id; documents with the
same id follow each other by text; a null doc_id comes first; an empty table gives
no pieces; a sentence longer than a sequence is cut every ``capacity / 4`` ids.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskscan.llm.common import by_range
from riskscan.llm.encoding import MEMO_PARTS, Encoder, encoder

SENTENCE_PENALTY, INSIDE_PENALTY, SEQUENCE_COST = 4, 64, 16
POWERS = (64, 128, 256, 512)
SCHEMA = (
    "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
)


@lru_cache(maxsize=2)
def sentence_ends(coder: Encoder) -> np.ndarray:
    """By id: does the token end a sentence or a line?  Of the loaded tokenizer, since a second one takes much memory."""
    token = coder.tokenizer.id_to_token
    ends = (".", "!", "?", "Ċ")  # the last is a line end in byte-level form
    return np.array([(token(at) or "")[-1:] in ends for at in range(coder.tokenizer.get_vocab_size())], dtype=bool)


def cut_points(ends: np.ndarray, sentences: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions where the stream may be cut, 0 first, and what each cut costs."""
    points = np.union1d(np.concatenate([[0], ends]), sentences)
    wide = np.flatnonzero(np.diff(points) > capacity)
    step = max(1, capacity // 4)
    forced = [np.arange(points[i] + step, points[i + 1], step) for i in wide]
    if forced:
        inside = np.concatenate(forced)
        points = np.union1d(points, inside)
    cost = np.full(len(points), float(SENTENCE_PENALTY))
    if forced:
        cost[np.searchsorted(points, inside)] = INSIDE_PENALTY
    cost[np.searchsorted(points, ends)] = 0
    return points, cost


def best_cuts(points: np.ndarray, cost: np.ndarray, capacity: int) -> np.ndarray:
    """The positions that end a sequence, at least total cost (see above)."""
    n = len(points)
    at, fee = points.tolist(), (cost + SEQUENCE_COST).tolist()
    back = [0] * n
    exact: dict[int, list[int]] = {}
    for length in POWERS:
        if length < capacity:
            found = np.minimum(np.searchsorted(points, points - length), n - 1)
            for j in np.flatnonzero((points[found] == points - length) & (points >= length)).tolist():
                exact.setdefault(j, []).append(int(found[j]))
    best = [0.0] * n
    queue = deque([(0.0, 0)])  # (best[i] + position of i, i): keys ascend, positions too
    for j in range(1, n):
        here = at[j]
        low = here - capacity
        while at[queue[0][1]] < low:
            queue.popleft()
        key, i = queue[0]
        least = key + capacity - here
        if j in exact:
            for k in exact[j]:
                if best[k] < least:
                    least, i = best[k], k
        least += fee[j]
        best[j], back[j] = least, i
        key = least + here
        while queue and queue[-1][0] >= key:
            queue.pop()
        queue.append((key, j))
    cuts, j = [], n - 1
    while j:
        cuts.append(at[j])
        j = back[j]
    return np.array(cuts[::-1], dtype=np.int64)


def pack_block(docs: list[tuple[int | None, bytes]], is_end: np.ndarray, capacity: int) -> dict[str, list]:
    """Pieces of one block of (doc_id, ids); sequences are numbered from 0."""
    stream = b"".join(ids for _, ids in docs)
    ids = np.frombuffer(stream, dtype="<u4")
    ends = np.cumsum([len(b) // 4 for _, b in docs])
    sentences = np.flatnonzero(is_end[np.minimum(ids, len(is_end) - 1)]) + 1
    cuts = best_cuts(*cut_points(ends, sentences, capacity), capacity)
    stops = np.union1d(ends, cuts)
    starts = np.concatenate([[0], stops[:-1]])
    doc = np.searchsorted(ends, starts, side="right")
    sequence = np.searchsorted(cuts, starts, side="right")
    doc_start = np.concatenate([[0], ends[:-1]])[doc]
    first = np.concatenate([[0], cuts])[sequence]
    return {
        "doc_id": [docs[d][0] for d in doc.tolist()], "start": (starts - doc_start).tolist(),
        "length": (stops - starts).tolist(),
        "ids": [stream[4 * a:4 * b] for a, b in zip(starts.tolist(), stops.tolist())],
        "doc_tokens": (ends[doc] - doc_start).tolist(), "sequence_id": sequence.tolist(),
        "offset": (starts - first).tolist(),
    }


def pack(
    docs: DataFrame, tokenizer: str, end_id: int = 0, capacity: int = 1024, spaced: bool = True,
    block_ids: int = 1 << 19, memo_parts: int = MEMO_PARTS,
) -> DataFrame:
    """One row per piece of a document in a sequence, with its ids (little-endian unsigned 32-bit)."""
    end = np.array([end_id], dtype="<u4").tobytes()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    dealt = by_range(rows, "doc_id", "_range").sortWithinPartitions("_range", "doc_id", "text")
    schema = pa.schema([
        ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()),
        ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()),
    ])

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(tokenizer, spaced, memo_parts)
        encode, is_end = coder.encode, sentence_ends(coder)
        block, size, current, used = [], 0, None, 0

        def flush() -> pa.RecordBatch:
            nonlocal block, size, used
            pieces = pack_block(block, is_end, capacity)
            number = pieces["sequence_id"][-1] + 1
            pieces["sequence_id"] = [(current << 36) + used + s for s in pieces["sequence_id"]]
            block, size, used = [], 0, used + number
            return pa.RecordBatch.from_pydict(pieces, schema)

        for batch in batches:
            for doc, text, part in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "_range"))):
                if block and (part != current or size >= block_ids):
                    yield flush()
                if part != current:
                    current, used = part, 0
                ids = encode(text) + end
                block.append((doc, ids))
                size += len(ids) // 4
        if block:
            yield flush()

    return dealt.mapInArrow(packed, SCHEMA)
