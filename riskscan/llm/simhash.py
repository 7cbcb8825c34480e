"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two 64-bit fingerprints differ in at most ``2 * half`` bits exactly when some
64-bit value lies within ``half`` bits of both.  So every distinct fingerprint
stands for all its variants within ``half`` bits, and fingerprints that share a
variant are linked.

The 2,081 variants of a fingerprint (half = 2) are not written out one by one.
Bits are dealt to ``n`` groups, and the parity of each group gives an n-bit key.
Flipping up to two bits flips up to two parities, so a fingerprint sends itself
to the 1 + n + n(n-1)/2 keys that its variants have, and the task of a key makes
just those variants that have that key.  Near copies differ in a few bits and so
have different keys, which spreads a large group of them.

In a task, fingerprints that share a variant are linked to the smallest of them
(all are true links, each is verified), and the links are reduced to one per
fingerprint.  No pairs within a group are written out.

Defined results: null and empty texts have fingerprint zero and are linked like
any other; repeated rows are kept; a null doc_id has a component, but counts for
none; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskscan.llm.common import written
from riskscan.llm.components import connected

BITS = 64
HASHED_AT_ONCE = 1 << 16
#: Variants that one task makes on average, and at most holds at a time.
VARIANTS_PER_KEY = 1 << 20
VARIANTS_AT_ONCE = 1 << 21


def fingerprint(text: str | None, words: int = 4) -> int:
    """The SimHash of word shingles as a signed 64-bit number: a bit is set if more than half of the hashes have it."""
    found = (text or "").encode().lower().split()  # lower-cases A-Z and splits at ASCII white space only
    if not found:
        return 0
    joined = b" ".join(found)
    ends = np.cumsum([len(w) + 1 for w in found]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(found) - words + 1)
    starts, ends = starts[:n].tolist(), ends[-n:].tolist()
    counts = np.zeros(BITS, dtype=np.int64)
    one = xxhash.xxh64_intdigest
    for at in range(0, n, HASHED_AT_ONCE):
        span = zip(starts[at:at + HASHED_AT_ONCE], ends[at:at + HASHED_AT_ONCE])
        hashes = np.array([one(joined[a:b], 42) for a, b in span], dtype=">u8")
        counts += np.unpackbits(hashes.view(np.uint8)).reshape(-1, BITS).sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n).view(">u8")[0].astype(np.int64))


def fingerprints(docs: DataFrame, words: int = 4) -> DataFrame:
    """(doc_id, fp) of every row."""

    @F.pandas_udf("long")
    def hashed(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series([fingerprint(t, words) for t in batch], dtype="int64")

    return docs.select(F.col("doc_id"), hashed(F.col("text")).alias("fp"))


class Balls:
    """Keys and variants: ``n`` parity groups, balls of radius ``half`` around each fingerprint."""

    def __init__(self, n: int, half: int):
        self.n = n
        self.groups = [sum(1 << bit for bit in range(g, BITS, n)) for g in range(n)]
        flips = [[1 << b for b in bits] for r in range(half + 1) for bits in combinations(range(BITS), r)]
        by_delta: dict[int, list[int]] = {}
        for mask in map(sum, flips):
            by_delta.setdefault(self.key(mask), []).append(mask)
        self.masks = {d: np.array(m, dtype=np.uint64) for d, m in by_delta.items()}

    def key(self, value: int) -> int:
        return sum(((value & g).bit_count() & 1) << i for i, g in enumerate(self.groups))

    def keys(self, values: np.ndarray) -> np.ndarray:
        parity = [(np.bitwise_count(values & np.uint64(g)) & 1).astype(np.int64) << i for i, g in enumerate(self.groups)]
        return np.sum(parity, axis=0, dtype=np.int64)

    @staticmethod
    def choose(count: int, half: int) -> int:
        """Parity groups for so many fingerprints: as few as keep the variants of a key near VARIANTS_PER_KEY."""
        ball = sum(math.comb(BITS, r) for r in range(half + 1))
        return min(24, max(6, math.ceil(math.log2(max(1, count * ball / VARIANTS_PER_KEY)))))

    def variants(self, values: np.ndarray, key: int, rounds: int, this: int) -> tuple[np.ndarray, np.ndarray]:
        """The variants with that key, and whose they are (ascending); only the ``this``-th part of ``rounds``."""
        delta = self.keys(values) ^ key
        made, owner = [], []
        for d in np.unique(delta):
            own = np.flatnonzero(delta == d)
            step = max(1, VARIANTS_AT_ONCE // max(1, len(self.masks[int(d)])))
            for at in range(0, len(own), step):
                part = own[at:at + step]
                v = (values[part][:, None] ^ self.masks[int(d)][None, :]).ravel()
                o = np.repeat(part.astype(np.int32), len(self.masks[int(d)]))
                if rounds > 1:
                    keep = ((v * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)) % np.uint64(rounds) == this
                    v, o = v[keep], o[keep]
                made.append(v)
                owner.append(o)
        return np.concatenate(made), np.concatenate(owner)

    def links(self, values: np.ndarray, key: int, limit: int) -> tuple[np.ndarray, np.ndarray]:
        """Links between positions of distinct ascending ``values`` that share a variant with this key."""
        sizes = {d: len(m) for d, m in self.masks.items()}
        total = sum(int(c) * sizes[int(d)] for d, c in zip(*np.unique(self.keys(values) ^ key, return_counts=True)))
        rounds = -(-total // VARIANTS_AT_ONCE)
        pairs = []
        for this in range(rounds):
            v, owner = self.variants(values, key, rounds, this)
            order = np.lexsort((owner, v))
            v, owner = v[order], owner[order]
            starts = np.concatenate([[True], v[1:] != v[:-1]]) if len(v) else np.zeros(0, bool)
            first = owner[np.flatnonzero(starts)][np.cumsum(starts) - 1] if len(v) else owner
            apart = first != owner
            found = np.unique(first[apart].astype(np.int64) * len(values) + owner[apart])
            a, b = found // len(values), found % len(values)
            near = np.bitwise_count(values[a] ^ values[b]) <= limit
            pairs.append((a[near], b[near]))
        return np.concatenate([p[0] for p in pairs]), np.concatenate([p[1] for p in pairs])


def smallest_linked(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For positions 0..n-1 the smallest position that links lead to."""
    root = np.arange(n)
    while len(a):
        np.minimum.at(root, b, root[a])
        np.minimum.at(root, a, root[b])
        while (root[root] != root).any():
            root = root[root]
        open_ = root[a] != root[b]
        a, b = root[a[open_]], root[b[open_]]
    return root


def near_links(prints: DataFrame, half: int = 2, count: int | None = None) -> DataFrame:
    """Links (a, b) that connect exactly the distinct fingerprints ``fp`` which differ in up to ``2 * half`` bits."""
    balls = Balls(Balls.choose(prints.count() if count is None else count, half), half)
    parity = [F.bit_count(F.col("fp").bitwiseAND(F.lit(g - (1 << 64) if g >> 63 else g))) % 2 for g in balls.groups]
    key = sum((F.shiftleft(p.cast("int"), i) for i, p in enumerate(parity)), F.lit(0))
    deltas = F.array(*[F.lit(d) for d in sorted(balls.masks)])
    sent = prints.select("fp", key.alias("_own"), F.explode(deltas).alias("_delta")).select(
        "fp", F.col("_own").bitwiseXOR(F.col("_delta")).alias("_key")
    )

    def linked(keys: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        values = np.unique(frame["fp"].to_numpy().astype(np.uint64))
        root = smallest_linked(len(values), *balls.links(values, int(keys[0]), 2 * half))
        far = np.flatnonzero(root != np.arange(len(values)))
        return pd.DataFrame({"a": values[root[far]].astype(np.int64), "b": values[far].astype(np.int64)})

    return sent.groupBy("_key").applyInPandas(linked, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, words: int = 4, half: int = 2) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id."""
    prints = written(fingerprints(docs, words), "simhash")
    classes = written(prints.groupBy("fp").agg(F.min("doc_id").alias("_least")), "simhash-classes")
    return grouped(prints, near_links(classes.select("fp"), half), classes)


def grouped(prints: DataFrame, links: DataFrame, classes: DataFrame | None = None) -> DataFrame:
    """doc_id, fingerprint and component_id of every print, by links between fingerprints."""
    if classes is None:
        classes = prints.groupBy("fp").agg(F.min("doc_id").alias("_least"))
    roots = connected(links)
    grouped = classes.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "_least", F.coalesce("root", "fp").alias("_root")
    )
    least = grouped.groupBy("_root").agg(F.min("_least").alias("component_id"))
    named = grouped.join(least, "_root").select(F.col("fp").alias("_fp"), "component_id")
    return prints.join(named, F.col("fp") == F.col("_fp")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def one_of_each(docs: DataFrame, words: int = 4, half: int = 2) -> DataFrame:
    """The documents without near-duplicates: of each component the smallest doc_id stays, once.

    Rows with a null doc_id stay only where their component has no id, once for each text.
    """
    return stay(docs, near_duplicates(docs, words, half))


def stay(docs: DataFrame, groups: DataFrame) -> DataFrame:
    """The documents that stay, one for each component."""
    stays = groups.select(F.col("component_id").alias("_stays")).distinct()
    # one shuffle of the texts, by doc_id, is for both
    one = docs.where("doc_id is not null").dropDuplicates(["doc_id"])
    named = one.join(stays, F.col("doc_id") == F.col("_stays"), "left_semi")
    nameless = docs.where("doc_id is null").join(stays, F.col("doc_id").eqNullSafe(F.col("_stays")), "left_semi")
    return named.unionByName(nameless.dropDuplicates(["text"]))
