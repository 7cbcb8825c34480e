"""Whole-table text operators: dedupe (P11), route and scan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskscan.functions.classify import (
    choose_type,
    l2_keyword_hits,
    matched_types,
    named_types,
    pc_of_lowered,
    route_by_scores,
    route_scores,
    scan_result,
)
from riskscan.functions.text import btrim_u
from riskscan.operators.common import pin
from riskscan.taxonomy import DEFAULT, Taxonomy


def dedupe_texts(df: DataFrame, text: str = "text") -> DataFrame:
    """P11. Distinct non-blank texts.

    Copies collapse map-side before the shuffle, so a text that fills a third
    of the table leaves each task as one row.
    """
    return df.select(text).where(F.col(text).isNotNull() & (btrim_u(F.col(text)) != "")).distinct()


def scan_texts(df: DataFrame, text: str = "text", taxonomy: Taxonomy = DEFAULT) -> DataFrame:
    """C5 for a table: adds pc_category, pii_types and confidence.

    The lower-cased text and the hits are bound in projections of their own, so
    each runs once per row.
    """
    scanned = _scan(df.withColumn("_low", F.lower(F.col(text))), text, taxonomy)
    return scanned.select(*[F.col(f"`{c}`") for c in df.columns], "_scan.*")


def _scan(lowered: DataFrame, text: str, taxonomy: Taxonomy) -> DataFrame:
    hits = lowered.withColumns(
        {"_named": named_types(F.col("_low"), taxonomy), "_matched": matched_types(F.col(text))}
    )
    return pin(hits, {"_scan": scan_result(F.col("_named"), F.col("_matched"), taxonomy)})


def classify_texts(df: DataFrame, text: str = "text", force_type: str | None = None, task_type: str | None = None,
                   taxonomy: Taxonomy = DEFAULT) -> DataFrame:
    """The model-free analysis: adds ``type`` (C1/C9), ``keyword_pc`` (C2) and the C5 columns."""
    low = F.col("_low")
    step = df.withColumn("_low", F.lower(F.col(text)))
    if force_type is None and task_type is None:
        risk, pii = route_scores(low)
        step = step.withColumns({"_risk": risk, "_pii": pii})
        kind = route_by_scores(low, F.col("_risk"), F.col("_pii"))
    else:
        kind = choose_type(F.col(text), force_type, task_type)
    step = step.withColumns({"type": kind, "keyword_pc": pc_of_lowered(low, taxonomy)})
    scanned = _scan(step, text, taxonomy)
    return scanned.select(*[F.col(f"`{c}`") for c in df.columns], "type", "keyword_pc", "_scan.*")


def keyword_affinity(df: DataFrame, id_col: str, text: str = "text", taxonomy: Taxonomy = DEFAULT) -> DataFrame:
    """C8. One row per document and L2 with at least one phrase: (id, l2_key, hits)."""
    lowered = df.select(id_col, F.lower(F.col(text)).alias("_low"))
    hits = lowered.select(id_col, F.explode(l2_keyword_hits(F.col("_low"), taxonomy)).alias("h"))
    return hits.select(id_col, "h.l2_key", "h.hits")
