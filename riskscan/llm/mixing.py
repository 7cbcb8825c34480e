"""Mixing sources to target weights by Sainte-Lague apportionment.

The mix is made of blocks of as many words each.  Blocks go to sources, and
within a source to its shards, by highest quotients ``target / (2 * seats + 1)``,
which gives whole quotas.  In a shard the documents stand in a seeded order and
form a circle of words; the shard's blocks are taken from a seeded start
around that circle, so a word is taken once more only when every other word of
the shard has been taken as often.

Defined results: a null text has size 0; a null source is a source of its own and
comes last; repeated rows are documents of their own; sources of size 0 get
nothing; an empty table gives an empty mix.  The result depends on the rows, the
weights and the seed only.

Only one row per source and shard reaches the driver.  Shards hold at least
``total / MAX_SHARDS`` words, so there are at most ``MAX_SHARDS`` plus one per
source; sources are part of the recipe, and more than ``max_sources`` are refused.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskscan.llm.common import WORD, written

MAX_SHARDS = 32_768
SIZE_COLUMNS = ["_row", "_source", "_size"]


def n_words(text: Column) -> Column:
    """Words between ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: Sequence[int], weights: Sequence[float], total: float, most: float) -> list[float]:
    """Shares of ``total`` by weight; what exceeds ``most * size`` is shared anew until nothing does."""
    goal, open_, left = [0.0] * len(sizes), [i for i, s in enumerate(sizes) if s > 0], float(total)
    while open_:
        unit = left / sum(weights[i] for i in open_)
        full = [i for i in open_ if weights[i] * unit > most * sizes[i]]
        if not full:
            for i in open_:
                goal[i] = weights[i] * unit
            break
        for i in full:
            goal[i] = float(most * sizes[i])
            left -= goal[i]
        open_ = [i for i in open_ if i not in set(full)]
    return goal


def sainte_lague(shares: Sequence[float], seats: int, most: Sequence[int] | None = None) -> list[int]:
    """Whole seats for the shares, to the highest quotients ``share / (2 * got + 1)``; ties go to the first.

    The quotient that the last seat needs is found by bisection; the few seats
    beside it are dealt one by one.
    """
    shares = np.asarray(shares, dtype=float)
    cap = np.full(len(shares), seats) if most is None else np.asarray(most)
    seats = int(min(seats, cap[shares > 0].sum()))
    if not len(shares) or seats <= 0:
        return [0] * len(shares)
    low, high = 0.0, float(shares.max()) * 2
    for _ in range(200):  # at ``high`` fewer seats than wanted are dealt, at ``low`` enough
        mid = (low + high) / 2
        if np.minimum(np.floor((shares / mid + 1) / 2), cap).sum() > seats:
            low = mid
        else:
            high = mid
    got = np.minimum(np.floor((shares / high + 1) / 2), cap).astype(int)
    while got.sum() < seats:
        quotients = np.where((got < cap) & (shares > 0), shares / (2 * got + 1), -1)
        got[int(np.argmax(quotients))] += 1
    return [int(x) for x in got]


def block_words(total: int, n_sources: int, most: int = 1024) -> int:
    """Words in a block: small enough that rounding costs a source under a thousandth of an even share."""
    return max(1, min(most, total // (1000 * max(1, n_sources))))


def plan_quotas(shards: pd.DataFrame, weights: Sequence[float], most: float, total: int) -> pd.DataFrame:
    """Adds source_size, target and the words that each shard gives (``quota``) to rows of _source, _shard and _size."""
    names = sorted((s for s in shards["_source"].unique() if s is not None), key=lambda s: s)
    names += [None] * int(shards["_source"].isna().any())
    key = shards["_source"].map({s: i for i, s in enumerate(names) if s is not None}).fillna(len(names) - 1).astype(int)
    sizes = np.bincount(key, weights=shards["_size"].astype(float), minlength=len(names))
    goal = targets([int(x) for x in sizes], [weights[i % len(weights)] for i in range(len(names))], total, most)
    block = block_words(int(total), len(names))
    blocks = sainte_lague(goal, round(sum(goal) / block), [math.ceil(most * s / block) for s in sizes])
    shards = shards.assign(source_size=sizes[key].astype("int64"), target=np.asarray(goal)[key], quota=0)
    for source, rows in shards.groupby(key).groups.items():
        own = [int(x) for x in shards.loc[rows, "_size"]]
        quota = sainte_lague(own, blocks[source], [math.ceil(most * s / block) for s in own])
        shards.loc[rows, "quota"] = [min(q * block, int(most * s)) for q, s in zip(quota, own)]
    return shards


def mix_sizes(
    sizes: DataFrame, weights: Sequence[float] = (5, 2, 1), most: float = 3, seed: int = 7,
    share: float = 1.0, max_sources: int = 100_000,
) -> DataFrame:
    """What the mix takes of each row of (_row, _source, _size): source_size, target, taken, and the span it comes from.

    A row's words are taken ``_times`` times in full, and those from ``_a`` to
    ``_b`` and from ``_c`` to ``_d`` once more.
    """
    spark = sizes.sparkSession
    total = int(sizes.agg(F.sum("_size")).first()[0] or 0)
    shard_words = max(1, -(-total // MAX_SHARDS), min(total // 64 + 1, 10_000_000))
    by_source = sizes.groupBy("_source").agg(F.sum("_size").alias("_all"))
    n_shards = F.greatest(F.lit(1), F.ceil(F.col("_all") / F.lit(shard_words)))
    recipe = by_source.withColumn("_shards", n_shards.cast("long")).limit(max_sources + 1).collect()
    if len(recipe) > max_sources:
        raise ValueError(f"more than {max_sources} sources")
    recipe_df = spark.createDataFrame(
        [(r["_source"], r["_shards"]) for r in recipe] or [(None, 1)], "_name string, _shards long"
    )
    order = F.xxhash64(F.col("_row"), F.lit(seed))
    dealt = (
        sizes.join(F.broadcast(recipe_df), F.col("_source").eqNullSafe(F.col("_name")))
        .withColumn("_shard", F.pmod(F.xxhash64(F.col("_row"), F.lit(seed + 1)), F.col("_shards")))
        .drop("_name", "_shards")
    )
    shards = dealt.groupBy("_source", "_shard").agg(F.sum("_size").alias("_size")).toPandas()
    shards["_source"] = shards["_source"].astype(object).where(shards["_source"].notna(), None)
    schema = "_name string, _number long, source_size long, target double, _quota long, _shard_size long"
    plan = plan_quotas(shards.astype({"_size": "int64"}), weights, most, int(share * total))
    plan_df = spark.createDataFrame(
        [(r._1, int(r._2), int(r.source_size), float(r.target), int(r.quota), int(r._3))
         for r in plan.rename(columns={"_source": "_1", "_shard": "_2", "_size": "_3"}).itertuples()],
        schema,
    )
    ordered = "sum(_size) OVER (PARTITION BY _source, _shard ORDER BY _order, _row, _size ROWS UNBOUNDED PRECEDING)"
    placed = (
        dealt.withColumn("_order", order).withColumn("_end", F.expr(ordered))
        .join(F.broadcast(plan_df), F.col("_source").eqNullSafe(F.col("_name")) & (F.col("_shard") == F.col("_number")))
    )
    n, quota = F.col("_shard_size"), F.col("_quota")
    start = F.pmod(F.xxhash64(F.lit(seed + 2), F.col("_source"), F.col("_shard")), F.greatest(n, F.lit(1)))
    first = F.col("_end") - F.col("_size")
    rest = F.when(n > 0, quota % n).otherwise(0)
    inside = lambda lo, hi: (  # noqa: E731 - the part of this row in [lo, hi), counted from the row's first word
        F.greatest(F.lit(0), F.least(lo - first, F.col("_size"))), F.greatest(F.lit(0), F.least(hi - first, F.col("_size")))
    )
    head = inside(F.lit(0), F.col("_start") + rest - n)  # what wraps around
    tail = inside(F.col("_start"), F.col("_start") + rest)
    return (
        placed.withColumn("_start", start)
        .withColumn("_times", F.when(n > 0, F.floor(quota / n)).otherwise(0).cast("long"))
        .withColumn("_a", head[0]).withColumn("_b", F.greatest(*head)).withColumn("_c", tail[0])
        .withColumn("_d", F.greatest(*tail))
        .withColumn("taken", F.col("_times") * F.col("_size") + F.col("_b") - F.col("_a") + F.col("_d") - F.col("_c"))
        .select("_row", "_source", "_size", "source_size", "target", "taken", "_times", "_a", "_b", "_c", "_d")
    )


def mix(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), most: float = 3, seed: int = 7) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, taken."""
    sizes = docs.select(
        F.col("doc_id").cast("long").alias("_row"), F.col("source").cast("string").alias("_source"),
        n_words(F.col("text")).alias("_size"),
    )
    mixed = mix_sizes(written(sizes, "mix-sizes"), weights, most, seed)
    return mixed.select(
        F.col("_row").alias("doc_id"), F.col("_source").alias("source"), F.col("_size").alias("size"), "source_size",
        "target", "taken",
    )


def take_words(text: str | None, times: int, spans: list[tuple[int, int]]) -> str:
    """The text ``times`` times and the words of each span once, one below the other; inner white space stays."""
    text = text or ""
    pieces = [text] * times
    spans = [(a, b) for a, b in spans if b > a]
    if spans:
        bounds, at = [], 0
        for word in text.encode().split():  # bytes split at ASCII white space only
            at = text.index(word.decode(), at)
            bounds.append((at, at + len(word.decode())))
            at = bounds[-1][1]
        pieces += [text[bounds[a][0]:bounds[b - 1][1]] for a, b in spans]
    return "\n".join(pieces)


def mixed_documents(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), most: float = 3, seed: int = 7) -> DataFrame:
    """The documents as the mix takes them, with the columns they had.

    A document that is taken more than once holds its text as often; one that a
    block cuts holds the words taken; one of which nothing is taken goes.  A
    document without words neither counts nor stays.  Ids are expected to be unique, as
    after deduplication; rows that share one are taken alike.
    """
    sizes = docs.select(
        F.col("doc_id").cast("long").alias("_row"), F.col("source").cast("string").alias("_source"),
        n_words(F.col("text")).alias("_size"),
    )
    mixed = mix_sizes(written(sizes, "mix-sizes"), weights, most, seed).where("taken > 0")
    chosen = mixed.groupBy("_row").agg(*[F.first(c).alias(c) for c in ("_times", "_a", "_b", "_c", "_d")])
    kept = docs.join(chosen, F.col("doc_id").eqNullSafe(F.col("_row")))
    names, extra = docs.columns, ("_times", "_a", "_b", "_c", "_d")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [
                take_words(t, k, [(a, b), (c, d)])
                for t, k, a, b, c, d in zip(*(batch.column(x).to_pylist() for x in ("text", *extra)))
            ]
            columns = [pa.array(texts, pa.string()) if n == "text" else batch.column(n) for n in names]
            yield pa.RecordBatch.from_arrays(columns, names)

    out = kept.select(*names, *extra).mapInArrow(cut, docs.schema)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in names else out
