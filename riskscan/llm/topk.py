"""Exact top-k inner products by MaxScore over shards of an inverted index.

A shard keeps one dense column of values per dimension in place of posting lists by
sign, because embeddings have hardly any zeros, and knows the largest and the smallest
value of each column; the sign of a query's term picks the one that bounds it.  Terms are
ordered by bound; those whose bounds together stay below the k-th best score known
are non-essential: a vector cannot be among the best by them alone.  Essential columns
are computed for all vectors of the shard, of either sign; the others are probed, in
order, only for vectors that are still competitive.  Each shard gives its k best per
query, and the shards' lists are merged.

Vectors are dealt to shards of about ``shard_rows``, queries to blocks of about
``block_rows``; a task holds one shard and one block, whatever the table's size.

Defined results: vectors that are null or hold a null, NaN or infinity take no
part, nor do rows without vec_id; shorter vectors are filled up with zeros; rows that share
a vec_id are candidates of their own, and one query with the smallest vector; ties
go to the smaller vec_id; an empty table gives an empty result.  Components are
taken to 64-bit integers and scores are 64-bit sums.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

SEEDS = 256
PROBED_AT_ONCE = 8


def finite(vector: Column) -> Column:
    return vector.isNotNull() & F.forall(vector, lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf"))))


def quantized(vectors: pd.Series, scale: float) -> np.ndarray:
    """Rows of floor(scale * x), shorter ones filled up with zeros."""
    width = max((len(v) for v in vectors), default=0)
    out = np.zeros((len(vectors), width), dtype=np.int64)
    for i, v in enumerate(vectors):
        out[i, :len(v)] = np.clip(np.floor(scale * np.asarray(v, dtype=np.float64)), -(2.0**62), 2.0**62)
    return out


def exact_type(queries: np.ndarray, vectors: np.ndarray) -> type:
    """Doubles add integers exactly up to 2**53; beyond that whole numbers are used."""
    most = float(np.abs(queries).max(initial=0)) * float(np.abs(vectors).max(initial=0)) * max(1, vectors.shape[1])
    return np.float64 if most < 2**53 else np.int64


def shard_best(
    query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int
) -> tuple[list[int], list[int], list[int]]:
    """(query id, vector id, score) of the k best vectors of the shard for each query, in no order."""
    width = max(queries.shape[1], vectors.shape[1])
    queries = np.pad(queries, ((0, 0), (0, width - queries.shape[1])))
    vectors = np.pad(vectors, ((0, 0), (0, width - vectors.shape[1])))
    kind = exact_type(queries, vectors)
    q, lists = queries.astype(kind), np.ascontiguousarray(vectors.T.astype(kind))
    highest, lowest = lists.max(axis=1, initial=0), lists.min(axis=1, initial=0)  # largest impact by sign
    some = np.unique(np.linspace(0, len(ids) - 1, min(SEEDS, len(ids))).astype(int))
    seeds = q @ lists[:, some]
    out: tuple[list[int], list[int], list[int]] = ([], [], [])
    for n, (own, query) in enumerate(zip(query_ids.tolist(), q)):
        known = seeds[n][ids[some] != own]
        threshold = np.partition(known, len(known) - k)[len(known) - k] if len(known) >= k else None
        bound = np.where(query > 0, query * highest, query * lowest)
        order = np.argsort(-bound, kind="stable")
        rest = np.cumsum(bound[order][::-1])[::-1]  # of this term and all after it
        essential = width if threshold is None else int(np.searchsorted(-rest, -threshold, side="right"))
        first = order[:essential]
        score = query[first] @ lists[first]
        alive = ids != own
        if threshold is not None:
            left = rest[essential] if essential < width else 0
            alive &= score + left >= threshold
        at = np.flatnonzero(alive)
        score = score[at]
        for step in range(essential, width, PROBED_AT_ONCE):
            terms = order[step:step + PROBED_AT_ONCE]
            score = score + query[terms] @ lists[terms[:, None], at[None, :]]
            after = step + PROBED_AT_ONCE
            left = rest[after] if after < width else 0
            keep = score + left >= threshold
            at, score = at[keep], score[keep]
        if len(at) > k:
            best = np.lexsort((ids[at], -score))[:k]
            at, score = at[best], score[best]
        out[0].extend([own] * len(at))
        out[1].extend(ids[at].tolist())
        out[2].extend(int(s) for s in score)
    return out


def search(
    vectors: DataFrame, is_query: Column, k: int = 5, scale: float = 256.0, shard_rows: int = 4096, block_rows: int = 2048
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row that ``is_query`` (of vec_id) picks, the k best other rows."""
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")
    ).where(F.col("vec_id").isNotNull() & finite(F.col("embedding")))
    asking = rows.where(is_query).groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    counts = rows.agg(F.count("*").alias("n"), F.count_if(is_query).alias("q")).first()
    shards, blocks = -(-counts["n"] // shard_rows) or 1, -(-counts["q"] // block_rows) or 1
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    spot = F.monotonically_increasing_id()
    left = (
        asking.withColumn("_block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int"))
        .withColumn("_shard", every(shards)).withColumn("_query", F.lit(True))
    )
    right = (
        rows.withColumn("_shard", F.pmod(F.xxhash64("vec_id", "embedding", spot), F.lit(shards)).cast("int"))
        .withColumn("_block", every(blocks)).withColumn("_query", F.lit(False))
    )

    def best(queries: pd.DataFrame, shard: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(shard):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")
        found = shard_best(
            queries["vec_id"].to_numpy(), quantized(queries["embedding"], scale),
            shard["vec_id"].to_numpy(), quantized(shard["embedding"], scale), k,
        )
        return pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), found)), dtype="int64")

    per_shard = left.groupBy("_shard", "_block").cogroup(right.groupBy("_shard", "_block")).applyInPandas(
        best, "query_id long, vec_id long, score long"
    )
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return per_shard.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
