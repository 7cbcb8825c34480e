"""Near copies by their shingles: Jaccard similarity of the sets of five-word shingles.

SimHash within four bits, as in `simhash`, finds only a few of the texts that are 80
percent alike.  Here all texts whose sets of shingles have that similarity are connected as well, and
none is left to chance; SimHash's own links are added.

Two alike sets share at least ``similarity`` of each one's ``n`` shingles.  So, in any order that all sets go
by, the first ``n - ceil(similarity * n) + k`` of both have ``k`` in common.  This is used twice.
By the order of the hashes, ``k`` a twentieth of the shingles: texts of whose first shingles fewer recur
in other texts drop out, which are most.  Then, among those that are left, by rarity and with
``k = 1``: each text goes to the buckets of its rarest shingles (those that no other text left
has need no bucket), so all that are alike meet in some bucket.

In a bucket, a few turns compare each text with one of its slot (one slot, two, four and
more); this connects most of a large group of near copies at a few rows a text.  Then all pairs of a
bucket that are not yet connected are compared.  Shingles are compared only of pairs that sizes and sketches don't
rule out.  A sketch has a bit for the parity of each of ``SKETCH_BITS`` parts of a set: sketches differ
in no more bits than the sets do in shingles.

What is shuffled is a multiple of the table, so that bulky columns move seldom: texts twice, each one's first shingles
once, the shingles of the texts left by hash, and their sets twice.

What grows faster than the table is the comparison of sketches in a bucket that holds several
large groups which are not connected; rows come only from pairs that may be alike.

Defined results: texts of equal shingles are one text; a text of fewer than five words
has one shingle; texts without words have no shingles, SimHash links them as fingerprint
zero; a null doc_id and an empty table as in `simhash`.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskscan.llm import simhash
from riskscan.llm.common import written
from riskscan.llm.components import connected

WORDS = 5
SIMILARITY = 0.8
#: Of how many shingles one more is looked at in the order of hashes, and turns that go before the comparison of all.
SPARE, TURNS = 20, 4
#: Bits of a first shingle that are not shuffled; of 48 bits so few fall together by chance that hardly a set is added.
KEY_CUT = 16
SKETCH_BITS = 1024
#: Keeps products that should be whole from being rounded up to the next number.
ROUNDING = 1e-9


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """The distinct hashes of the word shingles, ascending; words as in `simhash.fingerprint`."""
    found = (text or "").encode().lower().split()
    if not found:
        return np.zeros(0, np.uint64)
    one = xxhash.xxh64_intdigest
    hashes = np.array([one(w) for w in found], dtype=np.uint64)
    n = max(1, len(found) - words + 1)
    mixed = np.full(n, min(words, len(found)), dtype=np.uint64)
    for j in range(min(words, len(found))):
        mixed = (mixed ^ hashes[j:j + n]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(32)
    return np.unique(mixed)


def least_common(n: int, similarity: float) -> int:
    """So many of its n shingles a set shares with an alike one at least."""
    return math.ceil(similarity * n - ROUNDING)


def first_shingles(found: np.ndarray, similarity: float) -> np.ndarray:
    """The first shingles by hash: two alike sets share a twentieth of the smaller one's (rounded up) among them."""
    n = len(found)
    return found[:n - least_common(n, similarity) + -(-n // SPARE)].view(np.int64)


def sketch(found: np.ndarray) -> np.ndarray:
    """The parity of the set's share in each of SKETCH_BITS parts, as 64-bit numbers."""
    parts = (found * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - SKETCH_BITS.bit_length() + 1)
    odd = np.bincount(parts.astype(np.int64), minlength=SKETCH_BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def marks(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, text hash, SimHash fingerprint, hash of the set of shingles or null, their number, the first of them) of every row."""

    @F.pandas_udf("fp long, shingled long, n int, first array<long>")
    def marked(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in texts:
            sets = [shingles(t) for t in batch]
            yield pd.DataFrame({
                "fp": pd.Series([simhash.fingerprint(t) for t in batch], dtype="int64"),
                "shingled": pd.Series([int(np.uint64(xxhash.xxh64_intdigest(s.tobytes())).astype(np.int64)) if len(s) else None for s in sets], dtype="Int64"),
                "n": pd.Series([len(s) for s in sets], dtype="int32"),
                "first": [first_shingles(s, similarity) for s in sets],
            })

    rows = docs.select("doc_id", F.xxhash64("text").alias("hashed"), marked("text").alias("_mark"))
    return rows.select("doc_id", "hashed", "_mark.*")


def recurring(marked: DataFrame, similarity: float) -> DataFrame:
    """The sets (shingled) of whose first shingles so many stand in other sets too that one of these may be alike.

    Shingles that no other set has are counted, which takes one shuffle of the shingles: a shingle whose smallest and
    greatest set are one is its own.  Their last ``KEY_CUT`` bits are left out; what falls together by that only adds sets.
    """
    sets = marked.where("shingled is not null")
    keys = sets.select("shingled", F.explode("first").alias("key")).withColumn("key", F.shiftrightunsigned("key", KEY_CUT))
    ends = keys.groupBy("key").agg(F.min("shingled").alias("shingled"), F.max("shingled").alias("_last"))
    own = ends.where("shingled = _last").groupBy("shingled").agg(F.count("*").alias("_own"))
    sizes = sets.groupBy("shingled").agg(F.any_value("n").alias("n"), F.any_value(F.size("first")).alias("_first"))
    found = F.col("_first") - F.coalesce("_own", F.lit(0))
    # an alike set may be smaller, and so have fewer to spare
    least = F.ceil(F.ceil(similarity * F.col("n") - ROUNDING) / SPARE)
    return sizes.join(own, "shingled", "left").where(found >= least).select("shingled")


def shared(rows: DataFrame, of: str = "shingled") -> DataFrame:
    """The rows of buckets that hold different texts, or other things by that column."""
    apart = rows.groupBy("key").agg(F.min(of).alias("_a"), F.max(of).alias("_b")).where("_a <> _b")
    return rows.join(apart.select("key"), "key", "left_semi")


def alike(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Those of the pairs (a, b) whose sets of shingles have that similarity."""
    of = lambda c: sets.select(F.col("shingled").alias(c), F.col("shingles").alias(f"_{c}"))
    both = pairs.join(of("a"), "a").join(of("b"), "b")
    a, b = F.size("_a"), F.size("_b")
    common = F.size(F.array_intersect("_a", "_b"))
    # the sizes alone rule most of the others out, before the sets are compared
    return both.where((F.least(a, b) >= similarity * F.greatest(a, b)) & (common >= similarity * (a + b - common))).select("a", "b")


def tried(rows: DataFrame) -> DataFrame:
    """The pairs (a, b) of each text of a bucket with one of its slot, of one slot, of two, of four and more."""
    slots = F.explode(F.array(*[F.lit(1 << turn) for turn in range(TURNS)]))
    rank = F.xxhash64("_slots", "key", "shingled")
    dealt = rows.select("key", "shingled", slots.alias("_slots")).select("*", rank.alias("_rank"), F.pmod(rank, "_slots").alias("_slot"))
    centres = dealt.groupBy("key", "_slots", "_slot").agg(F.min_by("shingled", "_rank").alias("_centre"))
    met = dealt.join(centres, ["key", "_slots", "_slot"]).where("shingled <> _centre")
    return met.select(F.least("shingled", "_centre").alias("a"), F.greatest("shingled", "_centre").alias("b")).distinct()


def may_be_alike(a: str, b: str, similarity: float) -> Column:
    """Whether the sizes ``n`` and the sketches of two sets, in columns of these suffixes, leave it open that they are alike."""
    of = lambda c, x: F.col(f"{c}_{x}")
    differ = sum((F.bit_count(of("sketch", a)[i].bitwiseXOR(of("sketch", b)[i])) for i in range(SKETCH_BITS // 64)), F.lit(0))
    sizes = of("n", a) + of("n", b)
    return (
        (F.least(of("n", a), of("n", b)) >= similarity * F.greatest(of("n", a), of("n", b)) - ROUNDING)
        & (differ * (1 + similarity) <= sizes * (1 - similarity) + ROUNDING * sizes)
    )


def open_pairs(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Those of the pairs (a, b) that may be alike by their sizes and sketches."""
    of = lambda x: sets.select(F.col("shingled").alias(x), F.col("n").alias(f"n_{x}"), F.col("sketch").alias(f"sketch_{x}"))
    return pairs.join(of("a"), "a").join(of("b"), "b").where(may_be_alike("a", "b", similarity)).select("a", "b")


def rarest(sets: DataFrame, similarity: float) -> DataFrame:
    """The texts (shingled) under keys: each text's rarest shingles that other texts left have."""
    held = sets.select(
        "shingled", F.col("n").alias("_n"), F.explode("shingles").alias("_shingle")
    )
    often = held.groupBy("_shingle").agg(F.count("*").alias("_often")).where("_often > 1")
    of_text = Window.partitionBy("shingled")
    ranked = held.join(often, "_shingle").select(
        "shingled", "_shingle", "_n", F.count("*").over(of_text).alias("_shared"),
        F.row_number().over(of_text.orderBy("_often", "_shingle")).alias("_rank"),
    )
    # those that only this text has are rarer than all others
    kept = ranked.where(F.col("_rank") + F.col("_n") - F.col("_shared") <= 1 + F.col("_n") - F.ceil(similarity * F.col("_n") - ROUNDING))
    return kept.select(F.col("_shingle").alias("key"), "shingled")


def unconnected(rows: DataFrame, groups: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) that share a bucket, are in different groups (node, root), and may be alike by their sizes and sketches."""
    grouped = rows.join(groups, F.col("shingled") == F.col("node"), "left").select(
        "key", "shingled", F.coalesce("root", "shingled").alias("group")
    )
    apart = shared(grouped, "group").join(sets.select("shingled", "n", "sketch"), "shingled")
    held = written(apart, "apart")
    a, b = (held.select(*[F.col(c).alias(f"{c}_{x}") for c in held.columns]) for x in "ab")
    apart_still = (F.col("shingled_a") < F.col("shingled_b")) & (F.col("group_a") != F.col("group_b"))
    met = a.join(b, (F.col("key_a") == F.col("key_b")) & apart_still & may_be_alike("a", "b", similarity))
    return met.select(F.col("shingled_a").alias("a"), F.col("shingled_b").alias("b")).distinct()


def similar(docs: DataFrame, marked: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """Links (a, b) between sets of shingles that are alike, by which all that are alike are connected."""
    some = marked.where("shingled is not null").groupBy("shingled").agg(F.min("hashed").alias("hashed"))
    some = some.join(recurring(marked, similarity), "shingled", "left_semi")

    @F.pandas_udf("n int, shingles array<long>, sketch array<long>")
    def shingled(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in texts:
            found = [shingles(t) for t in batch]
            yield pd.DataFrame({
                "n": pd.Series([len(s) for s in found], dtype="int32"),
                "shingles": [s.view(np.int64) for s in found], "sketch": [sketch(s) for s in found],
            })

    texts = docs.select(F.xxhash64("text").alias("hashed"), "text").groupBy("hashed").agg(F.min("text").alias("text"))
    sets = texts.join(some, "hashed").select("shingled", shingled("text").alias("_set"))
    sets = written(sets.select("shingled", "_set.*"), "shingles")
    rows = written(shared(rarest(sets, similarity)), "rare")
    links = written(alike(open_pairs(written(tried(rows), "tried"), sets, similarity), sets, similarity), "links")
    return links.unionByName(alike(unconnected(rows, connected(links), sets, similarity), sets, similarity))


def one_of_each(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The documents without near copies: of each group that links connect, the smallest doc_id stays."""
    marked = written(marks(docs, similarity), "marks")
    fps = marked.where("shingled is not null").groupBy("shingled").agg(F.min("fp").alias("_fp"))
    links = simhash.near_links(marked.select("fp").distinct())
    same = marked.select("shingled", "fp").distinct().join(fps, "shingled").where("fp <> _fp")
    links = links.unionByName(same.select(F.col("_fp").alias("a"), F.col("fp").alias("b")))
    found = written(similar(docs, marked, similarity), "similar")
    of = lambda c: fps.select(F.col("shingled").alias(c), F.col("_fp").alias(f"_{c}"))
    links = links.unionByName(found.join(of("a"), "a").join(of("b"), "b").select(F.col("_a").alias("a"), F.col("_b").alias("b")))
    return simhash.stay(docs, simhash.grouped(marked.select("doc_id", "fp"), links))
