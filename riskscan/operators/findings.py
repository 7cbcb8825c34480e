"""Findings tables -> labelled risk examples."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskscan.functions import text as tx
from riskscan.functions.matching import infer_l2, infer_risks, normalise_l2, normalise_risks, split_risks
from riskscan.operators.common import pin
from riskscan.taxonomy import DEFAULT, Taxonomy, str_array

# --------------------------------------------------------------------------
# Accepted column names (upper case), in order of preference.
# --------------------------------------------------------------------------

COLUMN_ALIASES = {
    "FINDING_TITLE": [
        "FINDING_TITLE", "TITLE", "FINDING NAME", "NAME", "FINDING", "SUMMARY", "ISSUE_TITLE", "ISSUE",
        "OBSERVATION_TITLE", "VULNERABILITY_TITLE", "VULN_TITLE", "HEADING", "SUBJECT",
    ],
    "FINDING_DESCRIPTION": [
        "FINDING_DESCRIPTION", "DESCRIPTION", "DESC", "DETAILS", "FINDING DETAILS", "ISSUE_DESCRIPTION", "DETAIL",
        "OBSERVATION", "OBSERVATION_DETAILS", "VULNERABILITY_DESCRIPTION", "VULN_DESCRIPTION", "FINDING_DETAILS",
        "NOTES", "COMMENTS", "CONTENT", "BODY",
    ],
    "L2": [
        "L2", "L2_CATEGORY", "CATEGORY", "RISK_CATEGORY", "FINDING_CATEGORY", "CLASSIFICATION", "TYPE",
        "FINDING_TYPE", "VULNERABILITY_TYPE", "VULN_TYPE", "RISK_TYPE", "ISSUE_TYPE", "SEVERITY",
        "RISK_CLASSIFICATION", "SECURITY_CLASSIFICATION",
    ],
    "MACRO_RISKS": [
        "MACRO_RISKS", "RISKS", "RISK_TYPES", "RISK_CATEGORIES", "MACRO_RISK", "RISK_TAGS", "TAGS",
        "RISK_CLASSIFICATION", "THREAT_TYPES", "THREAT_CATEGORIES", "IMPACT_TYPES", "VULNERABILITY_TAGS",
        "SECURITY_TAGS", "RISK_AREAS", "RISK_DOMAINS",
    ],
}
KNOWN_NAMES = {name for names in COLUMN_ALIASES.values() for name in names}
NOT_TEXT = "_not_text"  # array column: which string columns hold no text in this row's file
REJECT_REASONS = ["no_l2", "no_risks", "empty_data", "error", "invalid_format"]

MIN_TEXT_LENGTH = 10
SAMPLE_ROWS = 10

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def _present(df: DataFrame, names: list[str]) -> list[str]:
    """The names that are columns of the table, by exact case."""
    return [n for n in names if n in df.columns]


def _col(name: str) -> Column:
    return F.col(f"`{name}`")


def _is_string(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.StringType)


def _is_list(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.ArrayType)


# --------------------------------------------------------------------------
# Raw rows -> examples (labels as they are)
# --------------------------------------------------------------------------


def _label_column(df: DataFrame, name: str) -> Column:
    return tx.truthy_string(_col(name), isinstance(df.schema[name].dataType, NUMERIC_TYPES))


def _raw_risks(df: DataFrame, names: list[str]) -> Column:
    """P7 over several candidate columns: the first filled one decides."""
    choices = []
    for name in names:
        c = _col(name)
        if _is_list(df, name):
            choices.append(F.when(F.size(c) > 0, c.cast("array<string>")))
        elif _is_string(df, name):
            choices.append(F.when(c != "", tx.split_labels(c)))
        else:
            choices.append(F.when(_label_column(df, name).isNotNull(), F.array(F.lit(tx.UNSPECIFIED))))
    return F.coalesce(*choices, F.array(F.lit(tx.UNSPECIFIED)))


def field_hits(df: DataFrame) -> dict[str, Column]:
    """A3. Which of title, description, l2 and risks a row fills."""
    filled = F.lit(False)
    hits = {
        "title": tx.first_meaningful([_col(n) for n in _present(df, tx.TITLE_FIELDS)]).isNotNull(),
        "description": tx.first_meaningful([_col(n) for n in _present(df, tx.DESCRIPTION_FIELDS)]).isNotNull(),
    }
    for key, fields in (("l2", tx.L2_FIELDS), ("risks", tx.RISK_FIELDS)):
        tests = [
            F.coalesce(F.size(_col(n)) > 0, F.lit(False)) if _is_list(df, n) else _label_column(df, n).isNotNull()
            for n in _present(df, fields)
        ]
        hits[key] = reduce(lambda a, b: a | b, tests, filled)
    return hits


def _text_cells(df: DataFrame, exclude_label_columns: bool) -> tuple[list[str], list[str], list[str]]:
    """Title, description and residual columns of a raw table."""
    skip = set(tx.TITLE_FIELDS + tx.DESCRIPTION_FIELDS)
    if exclude_label_columns:
        skip |= set(tx.L2_FIELDS + tx.RISK_FIELDS)
    rest = [n for n in df.columns if n not in skip and _is_string(df, n)]
    return _present(df, tx.TITLE_FIELDS), _present(df, tx.DESCRIPTION_FIELDS), rest


def assembled_text(df: DataFrame, exclude_label_columns: bool = False) -> Column:
    """P3 + P4 + P5. Title, description and every other meaningful string cell.

    By default that includes the label columns, so labels leak into the text;
    ``exclude_label_columns`` leaves them out.
    """
    titles, descriptions, rest = _text_cells(df, exclude_label_columns)
    return tx.assemble_text(
        [
            tx.labelled("Finding", tx.first_meaningful([_col(n) for n in titles])),
            tx.labelled("Description", tx.first_meaningful([_col(n) for n in descriptions])),
            *[F.when(_holds_text(df, n), tx.residual_part(n)) for n in rest],
        ]
    )


def _holds_text(df: DataFrame, name: str) -> Column:
    return ~F.array_contains(NOT_TEXT, F.lit(name)) if NOT_TEXT in df.columns else F.lit(True)


def has_text(df: DataFrame, exclude_label_columns: bool = False) -> Column:
    """Whether ``assembled_text`` gives anything, without assembling it."""
    titles, descriptions, rest = _text_cells(df, exclude_label_columns)
    tests = [tx.is_meaningful(_col(n)) for n in titles + descriptions]
    tests += [_holds_text(df, n) & tx.is_meaningful(_col(n)) for n in rest]
    return reduce(lambda a, b: a | b, tests, F.lit(False))


def raw_to_examples(df: DataFrame, exclude_label_columns: bool = False, keep: list[str] | None = None) -> DataFrame:
    """P3-P7. Rows of any findings table -> (type, text, l2_category, macro_risks, metadata).

    Rows without any text are dropped.  ``keep`` carries further columns along
    (they do not enter the text).
    """
    keep = keep or []
    body = df.drop(*keep) if keep else df
    original = F.to_json(F.struct(*[_col(c) for c in body.columns if c != NOT_TEXT]))
    return df.where(has_text(body, exclude_label_columns)).select(
        *[_col(c) for c in keep],
        F.lit("risk").alias("type"),
        assembled_text(body, exclude_label_columns).alias("text"),
        F.coalesce(*[_label_column(body, n) for n in _present(body, tx.L2_FIELDS)], F.lit(tx.UNKNOWN)).alias(
            "l2_category"
        ),
        _raw_risks(body, _present(body, tx.RISK_FIELDS)).alias("macro_risks"),
        F.create_map(F.lit("source"), F.lit("raw_data"), F.lit("original_entry"), original).alias("metadata"),
    )


# --------------------------------------------------------------------------
# Findings with labels -> examples on the taxonomy
# --------------------------------------------------------------------------


def map_columns(df: DataFrame) -> DataFrame:
    """P8. Upper-case, trimmed names; the first alias found becomes the standard name.

    A standard name that is present stays, and an alias that two standard names
    could claim goes to the earlier one.
    """
    names = [c.strip().upper() for c in df.columns]
    double = sorted({n for n in names if names.count(n) > 1})
    if double:
        raise ValueError(f"columns differ only in case or blanks: {double}")
    for standard, aliases in COLUMN_ALIASES.items():
        if standard not in names:
            alias = next((a for a in aliases if a in names), None)
            if alias is not None:
                names[names.index(alias)] = standard
    return df.toDF(*names)


def detect_text_columns(df: DataFrame, order_by: str | None = None) -> list[str]:
    """P9. Columns no standard name claims whose first ten filled cells are all strings longer than ten.

    "First" follows ``order_by``; without it, it is whatever Spark reads first.
    At least one filled cell is needed.
    """
    candidates = [c for c in df.columns if c.strip().upper() not in KNOWN_NAMES and _is_string(df, c)]
    if not candidates:
        return []

    # one scan; each task passes on ten cells of a column at most
    lengths = [F.struct(F.lit(c).alias("name"), F.length(_col(c)).alias("n")) for c in candidates]
    order = _col(order_by) if order_by else F.monotonically_increasing_id()
    cells = df.select(order.alias("_at"), F.explode(F.array(*lengths)).alias("_cell")).select("_at", "_cell.*")
    place = F.row_number().over(Window.partitionBy("name").orderBy("_at"))
    first = cells.where("n is not null").withColumn("_place", place).where(F.col("_place") <= SAMPLE_ROWS)
    shortest = first.groupBy("name").agg(F.min("n").alias("n")).collect()
    long_enough = {r["name"] for r in shortest if r["n"] > MIN_TEXT_LENGTH}
    return [c for c in candidates if c in long_enough]


def findings_context(df: DataFrame, text_columns: list[str]) -> Column:
    """P10. Title and description, or the extra text columns when both are empty; null when there is nothing."""

    def cleaned(name: str, label: str) -> Column:
        if name not in df.columns:
            return F.lit(None).cast("string")
        value = tx.clean_text(_col(name))
        return F.when(tx.is_meaningful(value), tx.labelled(label, value))

    primary = tx.assemble_text(
        [cleaned("FINDING_TITLE", "Finding"), cleaned("FINDING_DESCRIPTION", "Description")]
    )
    return F.coalesce(primary, tx.assemble_text([tx.residual_part(c) for c in text_columns]))


def metadata_map(df: DataFrame, fixed: dict[str, Column], names: list[str]) -> Column:
    """P12. map<string,string> of the fixed entries and every filled extra column, keys in lower case."""
    entries = fixed | {n.lower(): _col(n) for n in names}
    filled = F.map_from_arrays(str_array(list(entries)), F.array(*[c.cast("string") for c in entries.values()]))
    return F.map_filter(filled, lambda _, value: value.isNotNull())


def label_findings(df: DataFrame, text_columns: list[str] | None = None, keep: list[str] | None = None,
                   whole_first: bool = True, taxonomy: Taxonomy = DEFAULT) -> DataFrame:
    """P10, F5-F9, P12, P13 for a table that went through ``map_columns``.

    Every input row comes back with the ``keep`` columns, raw_l2, raw_risks,
    context, l2_category, l2_tier, macro_risks, metadata and reject_reasons
    (empty = kept).  All of it is row-wise; the two fuzzy steps are the only
    ones that leave the JVM.
    """
    extra = [c for c in df.columns if c not in COLUMN_ALIASES]
    df = _with_missing(df)
    risks = _col("MACRO_RISKS")
    if _is_list(df, "MACRO_RISKS"):
        items, bad_format = F.transform(risks.cast("array<string>"), tx.btrim_u), F.lit(False)
    elif _is_string(df, "MACRO_RISKS"):
        items, bad_format = split_risks(risks, taxonomy, whole_first), F.lit(False)
    else:
        items, bad_format = str_array([]), risks.isNotNull()
    originals = {"source": F.lit("raw_data"), "original_l2": _col("L2"), "original_risks": _as_text(df, "MACRO_RISKS")}

    step = df.withColumn("_context", findings_context(df, text_columns or []))
    # The fuzzy scorer is only asked about rows that have a context at all.
    alive = F.col("_context").isNotNull() & ~bad_format
    step = step.withColumn("_l2", normalise_l2(F.when(alive, _col("L2").cast("string")), taxonomy))
    step = step.withColumn("_found", normalise_risks(F.when(alive, items), taxonomy))
    l2, found = F.col("_l2.l2_category"), F.col("_found")
    step = step.withColumn(
        "_risks",
        F.when(l2.isNotNull() & (F.size(found) == 0), infer_risks(F.col("_context"), tx.label_key(l2), taxonomy)).otherwise(
            found
        ),
    )
    step = pin(step, {"_label": F.coalesce(l2, infer_l2(F.col("_risks"), taxonomy)), "_bad_format": bad_format})
    no_l2, no_risks = F.col("_label").isNull(), F.size("_risks") == 0
    reasons = (
        F.when(F.col("_context").isNull(), str_array(["empty_data"]))
        .when(F.col("_bad_format"), str_array(["invalid_format"]))
        .when(no_l2 & no_risks, str_array(["no_l2", "no_risks"]))
        .otherwise(str_array([]))
    )
    out = step.select(
        *[_col(c) for c in keep or []],
        _col("L2").alias("raw_l2"),
        _col("MACRO_RISKS").alias("raw_risks"),
        F.col("_context").alias("context"),
        metadata_map(df, originals, extra).alias("metadata"),
        "_label", "_l2", "_risks", "_context", "_bad_format",
    )
    made = {
        "l2_category": F.coalesce(F.col("_label"), F.lit(tx.UNKNOWN)),
        "l2_tier": F.col("_l2.tier"),
        "macro_risks": F.when(no_risks, F.array(F.lit(tx.UNSPECIFIED))).otherwise(F.col("_risks")),
        "reject_reasons": reasons,
    }
    return pin(out, made).drop("_label", "_l2", "_risks", "_context", "_bad_format")


def _as_text(df: DataFrame, name: str) -> Column:
    return F.to_json(_col(name)) if _is_list(df, name) else _col(name)


def _with_missing(df: DataFrame) -> DataFrame:
    """The four standard columns, null where the table has none."""
    for name in COLUMN_ALIASES:
        if name not in df.columns:
            df = df.withColumn(name, F.lit(None).cast("string"))
    return df


def kept(labelled: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """The rows that became examples, in example shape."""
    return labelled.where(F.size("reject_reasons") == 0).select(
        *[_col(c) for c in keep or []],
        F.lit("risk").alias("type"),
        F.col("context").alias("text"),
        "l2_category", "macro_risks", "metadata",
    )


def rejected(labelled: DataFrame) -> DataFrame:
    """P13. The rows that did not, with their reasons."""
    return labelled.where(F.size("reject_reasons") > 0)
