"""Counts and top lists over results and examples.

All of them are plain grouped aggregates: partial sums leave each task, so hot
values are harmless, and a top-k keeps k rows per task.  Ties are broken by name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskscan.functions import text as tx
from riskscan.operators.findings import REJECT_REASONS, field_hits

TOP = 10


def _percent(part: Column, total: Column) -> Column:
    return F.when(total > 0, F.round(part * 100.0 / total, 1)).otherwise(0.0)


def _top(counts: DataFrame, name: str, k: int) -> DataFrame:
    return counts.orderBy(F.desc("n"), F.asc(name)).limit(k)


def batch_summary(results: DataFrame) -> DataFrame:
    """A1. One row: total, risk, pii and successful results (errors have no type)."""
    return results.agg(
        F.count("*").alias("total_texts"),
        F.count_if(F.col("type") == "risk").alias("risk_texts"),
        F.count_if(F.col("type") == "pii").alias("pii_texts"),
        F.count_if(F.col("success")).alias("successful_analyses"),
    )


def extraction_summary(examples: DataFrame) -> DataFrame:
    """A2 / S7. One row of counts over examples."""
    return examples.agg(*extraction_counts())


def extraction_counts() -> list[Column]:
    """A2, the counts themselves."""
    with_l2 = F.col("l2_category") != tx.UNKNOWN
    with_risks = F.col("macro_risks") != F.array(F.lit(tx.UNSPECIFIED))
    return [
        F.count("*").alias("total_training_examples"),
        F.count_if(F.col("type") == "risk").alias("risk_examples"),
        F.count_if(F.col("type") == "pii").alias("pii_examples"),
        F.count_if(with_l2).alias("with_l2"),
        F.count_if(with_risks).alias("with_risks"),
        F.count_if(with_l2 & with_risks).alias("complete"),
    ]


def field_stats(raw: DataFrame, text: Column) -> DataFrame:
    """A3. One row: entries, processed / failed with percentages, and how often each field was filled."""
    processed = F.count_if(text.isNotNull())
    total = F.count("*")
    empty = F.lit(True)
    for c in raw.columns:
        empty = empty & F.col(f"`{c}`").isNull()
    return raw.agg(
        total.alias("total_entries"),
        F.count_if(empty).alias("empty_entries"),
        processed.alias("processed_entries"),
        F.count_if(text.isNull()).alias("failed_entries"),
        _percent(processed, total).alias("processed_pct"),
        *[F.count_if(hit).alias(f"{name}_hits") for name, hit in field_hits(raw).items()],
    )


def reject_counts(labelled: DataFrame) -> DataFrame:
    """A4. (reason, n, pct of all rows); a row may have two reasons, and every reason has a row."""
    total = F.count("*").alias("total")
    wide = labelled.agg(
        total, *[F.count_if(F.array_contains("reject_reasons", r)).alias(r) for r in REJECT_REASONS]
    )
    rows = F.explode(F.array(*[F.struct(F.lit(r).alias("reason"), F.col(r).alias("n")) for r in REJECT_REASONS]))
    return wide.select("total", rows.alias("r")).select(
        "r.reason", "r.n", _percent(F.col("r.n"), F.col("total")).alias("pct")
    )


def empty_field_counts(df: DataFrame, title: str = "FINDING_TITLE", description: str = "FINDING_DESCRIPTION") -> DataFrame:
    """A5. One row: blank titles only, blank descriptions only, both blank."""
    no_title, no_text = tx.clean_text(F.col(title)) == "", tx.clean_text(F.col(description)) == ""
    return df.agg(
        F.count_if(no_title & ~no_text).alias("title_missing"),
        F.count_if(no_text & ~no_title).alias("description_missing"),
        F.count_if(no_title & no_text).alias("both_missing"),
    )


def top_l2_values(labelled: DataFrame, column: str = "raw_l2", unmatched_only: bool = False, k: int = TOP) -> DataFrame:
    """A6. The most frequent raw L2 values (value, n).

    Only ``unmatched_only`` needs labelled rows; otherwise the raw table will do.
    """
    rows = labelled.where(F.col("l2_category") == tx.UNKNOWN) if unmatched_only else labelled
    value = tx.btrim_u(F.col(column).cast("string"))
    return _top(rows.where(F.col(column).isNotNull()).groupBy(value.alias("value")).agg(F.count("*").alias("n")),
                "value", k)


def top_risk_values(labelled: DataFrame, column: str = "raw_risks", unmatched_only: bool = False,
                    k: int = TOP) -> DataFrame:
    """A6. The most frequent raw risk cells; the items of list cells count one by one."""
    rows = labelled.where(F.col("macro_risks") == F.array(F.lit(tx.UNSPECIFIED))) if unmatched_only else labelled
    if labelled.schema[column].dataType.typeName() == "array":
        rows = rows.select(F.explode(F.col(column)).cast("string").alias("value"))
    else:
        rows = rows.select(F.col(column).alias("value")).where(F.col("value").isNotNull())
    return _top(rows.groupBy("value").agg(F.count("*").alias("n")), "value", k)


def l2_distribution(examples: DataFrame) -> DataFrame:
    """A7. (l2_key, n, pct of all examples) without UNKNOWN; keys sort as strings.

    The total is the sum of the same grouped counts, so the examples are read once.
    """
    key = F.when(F.col("l2_category") != tx.UNKNOWN, F.substring_index("l2_category", ".", 1))
    counts = examples.groupBy(key.alias("l2_key")).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    # Also looks at n, so that the filter stays above the counts and both uses share them.
    known = counts.where(F.when(F.col("l2_key").isNotNull(), F.col("n")) > 0)
    return known.withColumn("pct", _percent(F.col("n"), total)).orderBy("l2_key")


def top_macro_risks(examples: DataFrame, k: int = TOP) -> DataFrame:
    """A8. (risk, n, pct of all examples).

    Every example adds one null next to its risks, so that the total comes out of
    the same grouped counts; the null row sorts first and rides along with the top k.
    """
    marked = examples.select(F.explode(F.concat(F.array(F.lit(None).cast("string")), "macro_risks")).alias("risk"))
    counted = marked.where(F.col("risk").isNull() | (F.col("risk") != tx.UNSPECIFIED))
    counts = counted.groupBy("risk").agg(F.count("*").alias("n"))
    best = counts.orderBy(F.col("risk").isNotNull(), F.desc("n"), "risk").limit(k + 1)
    everything = Window.partitionBy()  # k + 1 rows
    with_total = best.withColumn("_total", F.max(F.when(F.col("risk").isNull(), F.col("n"))).over(everything))
    named = with_total.where(F.col("risk").isNotNull())
    return named.select("risk", "n", _percent(F.col("n"), F.col("_total")).alias("pct"))


def pc_distribution(examples: DataFrame) -> DataFrame:
    """A9. (pc_category, n)."""
    return examples.groupBy("pc_category").agg(F.count("*").alias("n"))


def top_pii_types(examples: DataFrame, k: int = TOP) -> DataFrame:
    """A10. (pii_type, n)."""
    types = examples.select(F.explode("pii_types").alias("pii_type"))
    return _top(types.groupBy("pii_type").agg(F.count("*").alias("n")), "pii_type", k)


def privacy_summary(labelled: DataFrame) -> DataFrame:
    """A11. One row: total, mapped and skipped inventory rows."""
    return labelled.agg(
        F.count("*").alias("total"),
        F.count_if(F.col("mapped")).alias("mapped"),
        F.count_if(~F.col("mapped")).alias("skipped"),
    )
