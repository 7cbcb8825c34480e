"""Tables of model responses (R1-R8): parse, validate, put into one result shape."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskscan.functions.classify import normalise_pii_types, pc_from_keywords, pc_upgrade
from riskscan.functions.matching import filter_risks_by_l2
from riskscan.functions.responses import (
    MAX_RISKS,
    Field,
    any_of,
    extract_json,
    l2_in_text,
    pc_in_text,
    risks_for_l2_text,
    risks_in_text,
    types_in_text,
    with_field,
)
from riskscan.functions.text import btrim_u, label_key, parse_json
from riskscan.operators.common import pin
from riskscan.taxonomy import DEFAULT, Taxonomy, str_array

EMPTY_ERROR = "Model returned empty response"
NOT_DETERMINED = "Could not determine"

RESULT_FIELDS = [
    "success", "type", "l2_category", "macro_risks", "pc_category", "pii_types", "error", "parsing_method",
    "raw_response", "input_text",
]


def parse_responses(
    df: DataFrame,
    response: str = "response",
    text: str = "text",
    kind: str = "type",
    taxonomy: Taxonomy = DEFAULT,
) -> DataFrame:
    """R1-R8 for a table with a ``risk`` / ``pii`` column; adds ``result``, one struct of RESULT_FIELDS."""
    flat = parsed_fields(df, response, text, kind, taxonomy, prefix="_out_")
    kept = [F.col(f"`{c}`") for c in df.columns if c != "result"]
    return flat.select(*kept, F.struct(*[F.col(f"_out_{f}").alias(f) for f in RESULT_FIELDS]).alias("result"))


def parsed_fields(
    df: DataFrame,
    response: str = "response",
    text: str = "text",
    kind: str = "type",
    taxonomy: Taxonomy = DEFAULT,
    prefix: str = "",
) -> DataFrame:
    """R1-R8 with RESULT_FIELDS as plain columns, of which only those are made that are used; same-named input
    columns give way.

    Everything is a projection: no shuffle, and the pattern cascade of the text
    fallback only sees the responses whose JSON could not be used.  How a response was
    read is settled first, once per row; what it says is made from that by plain columns, so a
    query of the counts or the success alone never looks for risks or types.
    """
    is_risk = F.col(kind) == "risk"
    raw = F.coalesce(F.col(response), F.lit(""))
    staged = (
        df.withColumn("_raw", raw)
        .withColumn("_empty", btrim_u(F.col("_raw")) == "")
        .withColumn("_json", parse_json(extract_json(F.col("_raw"))))
    )
    staged, fields, states = _states(staged, is_risk, taxonomy)
    staged = pin(staged, states)
    staged = _pii_content(_risk_content(staged, fields, taxonomy), fields, F.col(text), taxonomy)
    empty, risk, pii = _empty_result(is_risk, F.col(text)), _risk_result(F.col(text)), _pii_result(F.col(text))
    kept = [F.col(f"`{c}`") for c in df.columns if c not in [prefix + f for f in RESULT_FIELDS]]
    return staged.select(*kept, *[
        F.when(F.col("_empty"), empty[f]).when(is_risk, risk[f]).otherwise(pii[f]).alias(prefix + f) for f in RESULT_FIELDS
    ])


def parse_risk_responses(df: DataFrame, response: str = "response", text: str = "text",
                         taxonomy: Taxonomy = DEFAULT) -> DataFrame:
    """R2 with R3 as fallback, for a table that only holds risk responses."""
    return parse_responses(df.withColumn("_kind", F.lit("risk")), response, text, "_kind", taxonomy).drop("_kind")


def parse_pii_responses(df: DataFrame, response: str = "response", text: str = "text",
                        taxonomy: Taxonomy = DEFAULT) -> DataFrame:
    """R4 with R5 as fallback, for a table that only holds PII responses."""
    return parse_responses(df.withColumn("_kind", F.lit("pii")), response, text, "_kind", taxonomy).drop("_kind")


def flatten_results(df: DataFrame) -> DataFrame:
    """The ``result`` struct as plain columns; same-named input columns give way."""
    keep = [F.col(f"`{c}`") for c in df.columns if c not in (*RESULT_FIELDS, "result")]
    return df.select(*keep, "result.*")


# --------------------------------------------------------------------------


def _states(df: DataFrame, is_risk: Column, taxonomy: Taxonomy) -> tuple[DataFrame, dict[str, Field], dict[str, Column]]:
    """The members of the parsed JSON, and how each response is read: _r_state or _p_state (ok / error / fallback)."""
    # the members of the other kind of response are not looked for
    df = df.withColumns({"_risk_json": F.when(is_risk, F.col("_json")), "_pii_json": F.when(~is_risk, F.col("_json"))})
    members = {"l2_category": "_risk_json", "macro_risks": "_risk_json", "pc_category": "_pii_json", "pii_types": "_pii_json"}
    fields = {}
    for name, parsed in members.items():
        df, fields[name] = with_field(df, parsed, name)
    l2, risks, types = (fields[n] for n in ("l2_category", "macro_risks", "pii_types"))
    no_json = F.col("_json").isNull()
    known = label_key(l2.string).isin(*[k for k, risks in taxonomy.macro_risks.items() if risks])
    scalar = risks.is_a("number", "bool")
    no_risks = any_of(
        risks.is_a("null"),
        scalar & (risks.falsy | l2.falsy),
        scalar & l2.is_a("string") & known,
    )
    to_text = any_of(
        ~l2.falsy & ~l2.is_a("string") & ~risks.falsy,
        ~l2.falsy & l2.is_a("string") & known & ~risks.only_strings,
    )
    no_types = any_of(types.is_a("null", "number", "bool"), ~types.only_strings)
    risk = F.when(no_json, "fallback").when(no_risks, "error").when(to_text, "fallback").otherwise("ok")
    pii = F.when(no_json, "fallback").when(no_types, "error").otherwise("ok")
    filled = ~F.col("_empty")
    return df, fields, {"_r_state": F.when(is_risk & filled, risk), "_p_state": F.when(~is_risk & filled, pii)}


def _risk_content(df: DataFrame, fields: dict[str, Field], taxonomy: Taxonomy) -> DataFrame:
    """Adds _r_l2 and _r_risks."""
    l2, risks = fields["l2_category"], fields["macro_risks"]
    ok = F.col("_r_state") == "ok"
    plain = F.when(F.col("_r_state") == "fallback", btrim_u(F.col("_raw")))
    df = df.withColumns({"_r_text_l2": l2_in_text(plain), "_r_items": risks_in_text(plain)})
    valid = F.when(ok, filter_risks_by_l2(F.when(l2.is_a("string"), l2.string), risks.strings, taxonomy))
    text_risks = risks_for_l2_text(F.col("_r_text_l2"), F.col("_r_items"), taxonomy)
    return df.withColumns({
        "_r_l2": F.when(ok, l2.string).otherwise(F.col("_r_text_l2")),
        "_r_risks": F.slice(F.when(ok, valid).otherwise(text_risks), 1, MAX_RISKS),
    })


def _pii_content(df: DataFrame, fields: dict[str, Field], text: Column, taxonomy: Taxonomy) -> DataFrame:
    """Adds _p_pc and _p_types."""
    pc, types = fields["pc_category"], fields["pii_types"]
    ok = F.col("_p_state") == "ok"
    stated = F.when(pc.is_a("string") & pc.string.isin(*taxonomy.protection), pc.string)
    json_types = F.when(ok, normalise_pii_types(types.strings, taxonomy))
    plain = F.when(F.col("_p_state") == "fallback", F.col("_raw"))
    df = df.withColumn(
        "_p_found_pc",
        F.when(ok, F.coalesce(stated, pc_from_keywords(F.coalesce(text, F.lit("")), taxonomy))).otherwise(
            F.when(plain.isNotNull(), pc_in_text(plain, taxonomy))
        ),
    ).withColumn("_p_types", F.when(ok, json_types).otherwise(types_in_text(plain, taxonomy)))
    return df.withColumn("_p_pc", pc_upgrade(F.col("_p_found_pc"), F.col("_p_types")))


def _result(**values: Column) -> dict[str, Column]:
    types = {"success": "boolean", "macro_risks": "array<string>", "pii_types": "array<string>"}
    return {name: values.get(name, F.lit(None)).cast(types.get(name, "string")) for name in RESULT_FIELDS}


def _empty_result(is_risk: Column, text: Column) -> dict[str, Column]:
    """R6."""
    return _result(
        success=F.lit(False),
        type=F.when(is_risk, "risk").otherwise("pii"),
        l2_category=F.when(is_risk, NOT_DETERMINED),
        macro_risks=F.when(is_risk, str_array([])),
        pc_category=F.when(~is_risk, NOT_DETERMINED),
        pii_types=F.when(~is_risk, str_array([])),
        error=F.lit(EMPTY_ERROR),
        parsing_method=F.lit("empty_response"),
        raw_response=F.col("_raw"),
        input_text=text,
    )


def _risk_result(text: Column) -> dict[str, Column]:
    state, failed = F.col("_r_state"), F.col("_r_state") == "error"
    fallback = state == "fallback"
    return _result(
        success=F.when(failed, False).when(fallback, F.col("_r_l2").isNotNull()).otherwise(True),
        type=F.when(~failed, "risk"),
        l2_category=F.when(~failed, F.col("_r_l2")),
        macro_risks=F.when(~failed, F.col("_r_risks")),
        error=F.when(failed, "macro_risks is not a list"),
        parsing_method=F.when(fallback, "text_fallback").when(~failed, "json"),
        raw_response=F.when(fallback, btrim_u(F.col("_raw"))),
        input_text=text,
    )


def _pii_result(text: Column) -> dict[str, Column]:
    state, failed = F.col("_p_state"), F.col("_p_state") == "error"
    return _result(
        success=~failed,
        type=F.when(~failed, "pii"),
        pc_category=F.when(~failed, F.col("_p_pc")),
        pii_types=F.when(~failed, F.col("_p_types")),
        error=F.when(failed, "pii_types is not a list of names"),
        parsing_method=F.when(state == "fallback", "text_fallback").when(~failed, "json"),
        raw_response=F.when(~failed, F.col("_raw")),
        input_text=text,
    )
