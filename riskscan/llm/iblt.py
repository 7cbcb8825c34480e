"""Document fingerprints as invertible Bloom lookup sketches.

A text is a set of paragraph digests (a repeated paragraph counts as another one).
Each digest is added to one cell in each of three parts of a small table; a cell
keeps how many digests it has, their XOR and the XOR of their check sums.  Cell by
cell, the sketches of two versions are subtracted; what both hold cancels out.
Peeling takes a cell with a single digest, removes that digest from its other
cells, and goes on: it recovers the digests that only one version has.  When cells
are left over, both sketches are made anew, four times as large, until it succeeds.

Paragraphs are lines; long lines are cut at sentence ends into stretches of at
least ``STRETCH`` characters, by the line's own text alone.

Defined results: a null text is empty; an empty text has one empty paragraph; equal
texts have equal fingerprints; likeness is shared digests over all digests.  Rows
follow each other by doc_id, then text; a null doc_id counts as the smallest; the next
document of a single row is the row itself; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from base64 import b64encode
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskscan.llm.common import range_cuts, range_of, shuffle_partitions

CELLS, PARTS, GROWTH, STRETCH = 24, 3, 4, 80
ROUNDS = 24
SENTENCE = re.compile(r"(?<=[.!?]) ")
MIX = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)
CHECK = 0xD6E8FEB86659FD93
ALL = (1 << 64) - 1


def paragraphs(text: str) -> list[str]:
    found = []
    for line in text.split("\n"):
        if len(line) <= STRETCH:
            found.append(line)
            continue
        held = ""
        for sentence in SENTENCE.split(line):
            held = f"{held} {sentence}" if held else sentence
            if len(held) >= STRETCH:
                found.append(held)
                held = ""
        if held:
            found.append(held)
    return found


def digests(text: str) -> np.ndarray:
    """64-bit digests of the paragraphs; the n-th copy of a paragraph has a digest of its own."""
    seen: Counter[str] = Counter()
    out = []
    for paragraph in paragraphs(text):
        out.append(xxhash.xxh64_intdigest(paragraph, seen[paragraph]))
        seen[paragraph] += 1
    return np.array(out, dtype=np.uint64)


def places(keys: np.ndarray, cells: int, salt: int) -> np.ndarray:
    """For each key a cell in each part: an array of PARTS rows."""
    size = cells // PARTS
    rows = []
    for part, odd in enumerate(MIX):
        mixed = (keys ^ np.uint64(salt * 0x2545F491 + part)) * np.uint64(odd)
        mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(odd)
        rows.append((mixed >> np.uint64(32)) % np.uint64(size) + np.uint64(part * size))
    return np.array(rows, dtype=np.int64)


def checks(keys: np.ndarray) -> np.ndarray:
    mixed = keys * np.uint64(CHECK)
    return (mixed ^ (mixed >> np.uint64(31))) * np.uint64(CHECK) >> np.uint64(32)


def place_and_check(key: int, size: int, salt: int) -> tuple[list[int], int]:
    """``places`` and ``checks`` of one key in plain numbers, which is faster for a single one."""
    cells = []
    for part, odd in enumerate(MIX):
        mixed = ((key ^ (salt * 0x2545F491 + part)) * odd) & ALL
        mixed = ((mixed ^ (mixed >> 29)) * odd) & ALL
        cells.append((mixed >> 32) % size + part * size)
    mixed = (key * CHECK) & ALL
    return cells, (((mixed ^ (mixed >> 31)) * CHECK) & ALL) >> 32


class Sketch:
    """Counts, XOR of digests and XOR of check sums, by cell."""

    def __init__(self, keys: np.ndarray, cells: int = CELLS, salt: int = 0):
        self.cells, self.salt, self.n = cells, salt, len(keys)
        self.count = np.zeros(cells, dtype=np.int64)
        self.key, self.check = np.zeros(cells, dtype=np.uint64), np.zeros(cells, dtype=np.uint64)
        sums = checks(keys)
        for row in places(keys, cells, salt):
            self.count += np.bincount(row, minlength=cells)
            np.bitwise_xor.at(self.key, row, keys)
            np.bitwise_xor.at(self.check, row, sums)

    def text(self) -> str:
        """The sketch as text: number of digests, then its cells."""
        cells = self.count.astype("<u4").tobytes() + self.key.astype("<u8").tobytes() + self.check.astype("<u4").tobytes()
        return f"{self.n}:{b64encode(cells).decode()}"

    def differences(self, other: Sketch) -> tuple[list[int], list[int]] | None:
        """The digests that only this one and only the other one holds; None if peeling gets stuck."""
        count = (self.count - other.count).tolist()
        key, check = (self.key ^ other.key).tolist(), (self.check ^ other.check).tolist()
        ours, theirs = [], []
        todo = [i for i, c in enumerate(count) if c in (1, -1)]
        while todo:
            i = todo.pop()
            if count[i] not in (1, -1):
                continue
            value, sign = key[i], count[i]
            cells, total = place_and_check(value, self.cells // PARTS, self.salt)
            if check[i] != total:
                continue
            (ours if sign == 1 else theirs).append(value)
            for cell in cells:
                count[cell] -= sign
                key[cell] ^= value
                check[cell] ^= total
                if count[cell] in (1, -1):
                    todo.append(cell)
        return None if any(count) or any(key) else (ours, theirs)


def recovered(a: np.ndarray, b: np.ndarray, first: tuple[Sketch, Sketch] | None = None) -> tuple[list[int], list[int]]:
    """The digests that differ, from sketches of growing size."""
    cells = CELLS
    for salt in range(ROUNDS):
        pair = first if salt == 0 and first else (Sketch(a, cells, salt), Sketch(b, cells, salt))
        found = pair[0].differences(pair[1])
        if found is not None:
            return found
        cells = min(cells * GROWTH, PARTS * max(CELLS, len(a) + len(b)))
    # so many failures at twice the room needed do not happen by chance: the digests clash by design
    return list(set(a.tolist()) - set(b.tolist())), list(set(b.tolist()) - set(a.tolist()))


def likeness(a: np.ndarray, b: np.ndarray, first: tuple[Sketch, Sketch] | None = None) -> float:
    """Shared digests over all digests, 0 to 1."""
    ours, theirs = recovered(a, b, first)
    shared = (len(a) + len(b) - len(ours) - len(theirs)) / 2
    return shared / (len(a) + len(b) - shared)


def edited_text(text: str, following: str) -> str:
    """The last third of the code points replaced by as many of the next text's first."""
    n = len(text) // 3
    return text[:len(text) - n] + following[:n]


class Version:
    """A text with its digests and base sketch."""

    def __init__(self, doc_id: int | None, text: str):
        self.doc_id, self.text, self.digests = doc_id, text, digests(text)
        self.sketch = Sketch(self.digests)

    def near(self, other: Version) -> float:
        return likeness(self.digests, other.digests, (self.sketch, other.sketch))


SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def fingerprint_edits(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, and how alike they and the next document are.

    The table is dealt out once, by ranges of doc_id.  The first row of a range is
    also sent to the range above it, as the one that follows its last row; the
    table's first row to the lowest range.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    cuts = range_cuts(rows.select("doc_id"), "doc_id", shuffle_partitions(spark))
    ranged = rows.withColumn("_range", range_of(F.col("doc_id"), cuts))
    # one row per range that has any, so no more than there are cuts plus one
    tops = ranged.select("doc_id", "_range").groupBy("_range").agg(F.max("doc_id").alias("_top")).collect()
    order = sorted(((r["_range"], r["_top"]) for r in tops), reverse=True)
    goes_to = [(top, order[i - 1][0] if i else order[-1][0]) for i, (_, top) in enumerate(order)]
    to = F.create_map(*[F.lit(x) for pair in goes_to if pair[0] is not None for x in pair]) if any(
        top is not None for top, _ in goes_to
    ) else None
    alone = [target for top, target in goes_to if top is None]
    target = F.when(F.col("doc_id").isNull(), F.lit(alone[0] if alone else None).cast("int"))
    if to is not None:
        target = target.otherwise(F.try_element_at(to, F.col("doc_id")).cast("int"))
    copies = F.array(F.struct(F.col("_range").alias("r"), F.lit(False).alias("copy")))
    both = F.when(target.isNotNull(), F.concat(copies, F.array(F.struct(target.alias("r"), F.lit(True).alias("copy"))))).otherwise(copies)
    dealt = (
        ranged.withColumn("_sent", F.explode(both)).select("doc_id", "text", "_sent.r", "_sent.copy")
        .repartitionById(len(cuts) + 1, F.col("r"))
        .sortWithinPartitions("r", "copy", F.col("doc_id").desc_nulls_last(), "text")
    )
    schema = pa.schema([
        ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
        ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()),
    ])

    def row(now: Version, following: Version) -> tuple:
        edited = Version(None, edited_text(now.text, following.text))
        return (
            now.doc_id, len(now.text), hashlib.sha256(edited.text.encode()).hexdigest(), now.sketch.text(),
            edited.sketch.text(), now.near(edited), now.near(following),
        )

    def paired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, part, closed = None, None, False
        for batch in batches:
            out = []
            for doc_id, text, r, copy in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "r", "copy"))):
                if r != part:
                    before, part, closed = None, r, False
                if closed:  # several rows share the following range's first id: the first of them follows
                    continue
                now = Version(doc_id, text)
                if before is not None:
                    out.append(row(before, now))
                before, closed = now, copy
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema) if out else pa.RecordBatch.from_pylist([], schema)

    return dealt.mapInArrow(paired, SCHEMA)
