"""Privacy inventories -> labelled PII examples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskscan.functions import similarity as sim
from riskscan.functions import text as tx
from riskscan.functions.classify import matched_types, named_types, pc_from_classification, scan_result
from riskscan.operators.findings import metadata_map
from riskscan.taxonomy import DEFAULT, Taxonomy, str_array

REQUIRED = ["COLUMNNAME", "PRIVACYTYPE"]
TYPE_CUTOFF, TYPE_TOP = 75.0, 2
DESCRIPTION_CUTOFF, DESCRIPTION_TOP = 65.0, 3


def _maybe(df: DataFrame, name: str) -> Column:
    return F.col(name).cast("string") if name in df.columns else F.lit(None).cast("string")


def privacy_text(df: DataFrame) -> Column:
    """P14. The lines that describe one inventory column."""
    return F.concat_ws(
        "\n",
        tx.labelled("Database Column", _maybe(df, "COLUMNNAME")),
        tx.labelled("Entity", _maybe(df, "ENTITYNAME")),
        tx.labelled("Description", _maybe(df, "ENTITYDESC")),
        tx.labelled("Privacy Description", _maybe(df, "PRIVACYTYPEDESCRIPTION")),
    )


def match_pii_types(privacy_type: Column, privacy_name: Column, description: Column,
                    taxonomy: Taxonomy = DEFAULT) -> Column:
    """F10, the matching part: types by type and name (weighted, 75, best two each) and by
    description (token set, 65, best three), in taxonomy order.  A missing cell matches nothing."""
    by_name, by_text = (sim.weighted, TYPE_CUTOFF, TYPE_TOP), (sim.token_set, DESCRIPTION_CUTOFF, DESCRIPTION_TOP)
    cells = [(tx.btrim_u(privacy_type), *by_name), (tx.btrim_u(privacy_name), *by_name), (description, *by_text)]
    return sim.names_of_several(cells, taxonomy.pii_types)


def label_privacy(df: DataFrame, taxonomy: Taxonomy = DEFAULT) -> DataFrame:
    """P14, C6, F10, P12. Every row comes back with text, pc_category, pii_types and
    metadata; ``mapped`` tells whether any PII type was found."""
    df = df.toDF(*[c.strip().upper() for c in df.columns])
    missing = [c for c in REQUIRED if c not in df.columns]
    if missing:
        raise ValueError(f"a privacy inventory needs the columns {missing}")
    kind, name = tx.btrim_u(_maybe(df, "PRIVACYTYPE")), tx.btrim_u(_maybe(df, "PRIVACYTYPENAME"))
    fixed = {
        "source": F.lit("raw_data"),
        "original_type": kind,
        "original_name": name,
        "original_classification": _maybe(df, "PRIVACYTYPECLASSIFICATION"),
    }
    extra = [c for c in df.columns if c not in REQUIRED]
    step = df.withColumn("text", privacy_text(df)).withColumn(
        "_types", match_pii_types(kind, name, _maybe(df, "PRIVACYTYPEDESCRIPTION"), taxonomy)
    )
    unmatched = F.when(F.size("_types") == 0, F.col("text"))
    step = step.withColumn("_unmatched", unmatched).withColumns(
        {"_named": named_types(F.lower("_unmatched"), taxonomy), "_matched": matched_types(F.col("_unmatched"))}
    )
    scanned = scan_result(F.col("_named"), F.col("_matched"), taxonomy)["pii_types"]
    step = step.withColumn("pii_types", F.when(F.col("_unmatched").isNotNull(), scanned).otherwise(F.col("_types")))
    return step.select(
        *[F.col(f"`{c}`") for c in df.columns],
        "text",
        pc_from_classification(_maybe(df, "PRIVACYTYPECLASSIFICATION")).alias("pc_category"),
        "pii_types",
        metadata_map(df, fixed, extra).alias("metadata"),
        (F.size("pii_types") > 0).alias("mapped"),
    )


def privacy_examples(labelled: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """The mapped rows in example shape."""
    return labelled.where("mapped").select(
        *[F.col(f"`{c}`") for c in keep or []],
        F.lit("pii").alias("type"), "text", "pc_category", "pii_types", "metadata",
    )
