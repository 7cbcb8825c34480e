"""Chat rows and the train / eval split."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from riskscan.functions.prompts import MESSAGE_TYPE, ddl_chat, inference_prompt, pii_chat, risk_chat
from riskscan.taxonomy import DEFAULT, Taxonomy

#: Leading bits of a hash that are counted at a time, and rows that are few enough to be put in order.
RANK_BITS, FEW_ROWS = 16, 1 << 16


def union_examples(*tables: DataFrame) -> DataFrame:
    """Risk, PII and DDL examples in one wide table; absent fields are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def format_chat(examples: DataFrame, taxonomy: Taxonomy = DEFAULT) -> DataFrame:
    """G5. Adds ``messages`` by example type; null for an unknown type or a missing field."""

    def field(name: str) -> Column | None:
        return F.col(name) if name in examples.columns else None

    builders = {
        "risk": (risk_chat, ["text", "l2_category", "macro_risks"]),
        "pii": (pii_chat, ["text", "pc_category", "pii_types"]),
        "ddl": (ddl_chat, ["ddl_statement", "analysis_result"]),
    }
    messages = F.lit(None).cast(MESSAGE_TYPE)
    for kind, (build, names) in builders.items():
        columns = [field(n) for n in names]
        if all(c is not None for c in columns):
            messages = F.when(F.col("type") == kind, build(*columns, taxonomy)).otherwise(messages)
    return examples.withColumn("messages", messages)


def chat_rows(formatted: DataFrame) -> DataFrame:
    """The rows that have a chat."""
    return formatted.where(F.col("messages").isNotNull())


def chat_counts(formatted: DataFrame) -> DataFrame:
    """Formatted and dropped rows per type."""
    done = F.col("messages").isNotNull()
    return formatted.groupBy("type").agg(F.count_if(done).alias("formatted"), F.count_if(~done).alias("dropped"))


def add_prompts(texts: DataFrame, text: str = "text", kind: str = "type", taxonomy: Taxonomy = DEFAULT) -> DataFrame:
    """G7. Adds ``prompt`` for routed texts."""
    return texts.withColumn("prompt", inference_prompt(F.col(kind), F.col(text), taxonomy))


def split_examples(df: DataFrame, id_col: str, train: float = 0.9, seed: int = 0, exact: bool = False,
                   order: Column | None = None) -> DataFrame:
    """G8. Adds ``split`` (train / eval) in a repeatable random order of the unique ``id_col``.

    The plain form decides each row by its hash: no shuffle, sizes correct on
    average.  ``exact=True`` puts exactly floor(train * n) rows into train.  Scans of the
    ids alone find the last row that goes there: each counts rows by the next leading
    bits of their hash, which tells the one prefix that holds the cut, until that has few rows;
    these are put in order up to the cut.  Then each row is compared with the last one, where it
    lies: nothing else is moved.  ``order`` is another long, as good as random, to go by (as an unsigned number).
    """
    order = F.xxhash64(F.col(id_col), F.lit(seed)) if order is None else order
    if not exact:
        return df.withColumn("split", F.when(F.pmod(order, F.lit(10_000)) < int(train * 10_000), "train").otherwise("eval"))
    last = _last_in_train(df.select(order.alias("_order"), F.col(id_col).alias("_id")), train)
    if last is None:
        return df.withColumn("split", F.lit("eval"))
    edge = F.lit(last["_order"])
    same = F.lit(last["_id"]).cast(df.schema[id_col].dataType)
    # the order of hashes as unsigned numbers is that of the numbers with their first bit flipped
    flip = lambda c: c.bitwiseXOR(F.lit(-(1 << 63)))
    before = (flip(order) < flip(edge)) | ((order == edge) & (F.col(id_col) <= same))
    return df.withColumn("split", F.when(before, "train").otherwise("eval"))


def _last_in_train(ids: DataFrame, train: float) -> Row | None:
    """The last of floor(train * n) rows (_order, _id) by unsigned hash, then id."""
    n = ids.count()
    wanted, known, prefix = int(train * n), 0, F.lit(0).cast("long")
    if not wanted:
        return None
    while n > FEW_ROWS and known < 64:
        known = min(64, known + RANK_BITS)
        prefix = F.shiftrightunsigned("_order", 64 - known) if known < 64 else F.col("_order")
        # at most 2 ** RANK_BITS rows; within a longer prefix, signed order is unsigned order
        counts = sorted(tuple(r) for r in ids.groupBy(prefix.alias("_prefix")).agg(F.count("*")).collect())
        for holds, n in counts:
            if n >= wanted:
                break
            wanted -= n
        ids = ids.where(prefix == holds)
    # by prefix first, since only inside one are signed numbers in unsigned order
    sign = F.shiftrightunsigned("_order", 63)
    return ids.orderBy(sign, "_order", "_id").offset(wanted - 1).limit(1).first()
