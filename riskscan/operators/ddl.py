"""Schema analysis for tables of DDL statements and for catalogs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskscan.functions import ddl as rules
from riskscan.functions.text import btrim_u
from riskscan.operators.common import pin
from riskscan.taxonomy import str_array

LEVELS = ["PC3", "PC1", "PC0", "AMBIGUOUS"]
MARKS = {name: 1 << bit for bit, name in enumerate(["PC3", "PC1", "AMBIGUOUS", *rules.TYPE_RECOMMENDATIONS])}


def explode_columns(df: DataFrame, ddl: str = "ddl", id_col: str = "stmt_id") -> DataFrame:
    """D3 + D4 as a table: (id, pos, column_name, data_type, constraints)."""
    found = df.select(id_col, F.posexplode(rules.columns_of(F.col(ddl))).alias("pos", "c"))
    return found.select(id_col, "pos", "c.*")


def classify_columns(df: DataFrame, column_name: str = "column_name", data_type: str = "data_type") -> DataFrame:
    """D5-D8 for a table with one row per column, such as ``explode_columns`` or a catalog.

    Adds pii_types, pc_category, confidence_score, is_ambiguous, ambiguous_type,
    pii_possibility, context_clues and reasoning.
    """
    name, kind = F.col(column_name), F.col(data_type)
    bound = df.withColumn("_rules", rules.column_rules(name))
    found = rules.classify_column(F.col("_rules"), kind)
    return bound.select(
        *[F.col(f"`{c}`") for c in df.columns],
        *[value.alias(field) for field, value in found.items()],
        rules.reasoning(name, kind, F.col("_rules.rule.kind")).alias("reasoning"),
    )


def analyze_ddl(df: DataFrame, ddl: str = "ddl") -> DataFrame:
    """D1-D13 per statement.

    Adds statement_type, table_name, columns, pii_summary, overall_classification,
    ambiguous_columns, requires_human_review, privacy_recommendations and
    compliance_flags.  A statement's columns stay in its row, so nothing is shuffled.
    """
    text = F.col(ddl)
    ruled = F.transform(rules.columns_of(text), lambda c: c.withField("rules", rules.column_rules(c["column_name"])))
    # settled once per row; the findings themselves are plain columns, made only where they are asked for
    out = pin(df, {"_ruled": ruled}).withColumn("_marks", _marks(F.col("_ruled")))
    marked = {name: F.col("_marks").bitwiseAND(F.lit(bit)) > 0 for name, bit in MARKS.items()}
    overall = rules.overall_class(marked["PC3"], marked["PC1"], marked["AMBIGUOUS"])
    out = out.withColumns({
        "columns": F.transform("_ruled", _column_finding), "statement_type": rules.statement_type(text),
        "table_name": rules.table_name(text), "overall_classification": overall,
    })
    ambiguous = F.transform(
        F.filter("columns", lambda c: c["is_ambiguous"]),
        lambda c: F.struct(
            c["column_name"], c["ambiguous_type"], c["pii_possibility"], c["context_clues"], c["data_type"]
        ),
    )
    has_type = {t: marked[t] for t in rules.TYPE_RECOMMENDATIONS}
    return out.select(
        *[F.col(f"`{c}`") for c in out.columns if c not in ("_ruled", "_marks", "overall_classification")],
        _summary(F.col("columns")).alias("pii_summary"), "overall_classification", ambiguous.alias("ambiguous_columns"),
        marked["AMBIGUOUS"].alias("requires_human_review"),
        rules.recommendations(F.col("overall_classification"), has_type).alias("privacy_recommendations"),
        rules.compliance_flags(F.col("overall_classification"), has_type).alias("compliance_flags"),
    )


def _marks(ruled: Column) -> Column:
    """What any column of a statement is, as bits of MARKS: its categories, and sensitive types that call for advice."""

    def mark(c: Column) -> Column:
        rule = c["rules"]["rule"]
        category = F.when(rule["pc"] == "PC3", MARKS["PC3"]).when(rule["pc"] == "PC1", MARKS["PC1"]).when(
            rule["kind"].isNull() & c["rules"]["group"].isNotNull(), MARKS["AMBIGUOUS"]
        ).otherwise(0)
        sensitive = rule["pc"].isin("PC3", "PC1")
        kind = F.lit(0)
        for name in rules.TYPE_RECOMMENDATIONS:
            kind = F.when(sensitive & (rule["kind"] == name), MARKS[name]).otherwise(kind)
        return category.bitwiseOR(kind)

    return F.coalesce(F.aggregate(ruled, F.lit(0), lambda marks, c: marks.bitwiseOR(mark(c))), F.lit(0))


def _column_finding(c: Column) -> Column:
    """The eleven fields of one column finding."""
    name, kind = c["column_name"], c["data_type"]
    found = rules.classify_column(c["rules"], kind)
    lines = rules.reasoning(name, kind, c["rules"]["rule"]["kind"])
    return F.struct(
        name.alias("column_name"),
        kind.alias("data_type"),
        c["constraints"].alias("constraints"),
        *[value.alias(field) for field, value in found.items()],
        lines.alias("reasoning"),
    )


def _summary(columns: Column) -> Column:
    """D9. Types per level in column order; an ambiguous column is listed twice."""

    def level(name: str) -> Column:
        def types(c: Column) -> Column:
            if name == "AMBIGUOUS":
                return F.when(c["is_ambiguous"], F.concat(c["pii_types"], c["pii_types"])).otherwise(str_array([]))
            return F.when(c["pc_category"] == name, c["pii_types"]).otherwise(str_array([]))

        return F.flatten(F.transform(columns, types)).alias(name)

    return F.struct(*[level(name) for name in LEVELS])


def ddl_examples(analyzed: DataFrame, ddl: str = "ddl") -> DataFrame:
    """D14. Training rows (type, ddl_statement, analysis_result) from analyzed statements."""
    summary = F.col("pii_summary")
    result = F.struct(
        F.col("table_name"),
        F.col("overall_classification"),
        F.array_distinct(F.concat(*[summary[level] for level in LEVELS])).alias("detected_pii_types"),
        F.transform(F.filter("columns", lambda c: c["pc_category"] == "PC3"), lambda c: c["column_name"]).alias(
            "high_risk_columns"
        ),
        F.transform("ambiguous_columns", lambda c: c["column_name"]).alias("ambiguous_columns"),
        F.col("requires_human_review"),
        F.col("compliance_flags"),
        F.slice("privacy_recommendations", 1, 3).alias("privacy_recommendations"),
    )
    return analyzed.withColumn("_result", result).select(
        *[F.col(f"`{c}`") for c in analyzed.columns if c == "stmt_id"],
        F.lit("ddl").alias("type"),
        btrim_u(F.col(ddl)).alias("ddl_statement"),
        F.col("_result").alias("analysis_result"),
    )


def ddl_report(analyzed: DataFrame) -> DataFrame:
    """D15. The readable form: one row per statement with lines for PII and review columns."""

    def line(c: Column) -> Column:
        return F.concat(
            c["column_name"], F.lit(" ("), c["data_type"], F.lit(") -> "),
            F.array_join(c["pii_types"], ", "), F.lit(" ["), c["pc_category"], F.lit("]"),
        )

    def review(c: Column) -> Column:
        return F.concat(c["column_name"], F.lit(" ("), c["data_type"], F.lit(") -> "), c["ambiguous_type"])

    return analyzed.select(
        *[F.col(f"`{c}`") for c in analyzed.columns if c == "stmt_id"],
        "table_name",
        "overall_classification",
        *[F.array_distinct(F.col("pii_summary")[level]).alias(f"{level.lower()}_types") for level in LEVELS[:3]],
        F.transform(F.filter("columns", lambda c: F.size(c["pii_types"]) > 0), line).alias("pii_columns"),
        F.transform(F.filter("columns", lambda c: c["is_ambiguous"]), review).alias("review_columns"),
        "requires_human_review",
        "compliance_flags",
        F.slice("privacy_recommendations", 1, 3).alias("top_recommendations"),
    )


def catalog_report(columns: DataFrame, table: str = "table_name") -> DataFrame:
    """D10-D13 for a classified catalog (one row per column): one row per table.

    Only counts and maxima are aggregated, so a table with very many columns
    costs no more than its partial sums; list its columns from the input.
    """
    pc, types, ambiguous = F.col("pc_category"), F.col("pii_types"), F.col("is_ambiguous")
    typed = F.size(types) > 0
    sensitive = pc.isin("PC3", "PC1")
    grouped = columns.groupBy(table).agg(
        F.count("*").alias("n_columns"),
        F.count_if((pc == "PC3") & typed).alias("n_pc3"),
        F.count_if((pc == "PC1") & typed).alias("n_pc1"),
        F.count_if((pc == "PC0") & typed).alias("n_pc0"),
        F.count_if(ambiguous).alias("n_ambiguous"),
        *[
            F.bool_or(sensitive & F.array_contains(types, t)).alias(f"_has_{t}")
            for t in rules.TYPE_RECOMMENDATIONS
        ],
    )
    has_type = {t: F.col(f"_has_{t}") for t in rules.TYPE_RECOMMENDATIONS}
    grouped = grouped.withColumn(
        "overall_classification",
        rules.overall_class(F.col("n_pc3") > 0, F.col("n_pc1") > 0, F.col("n_ambiguous") > 0),
    )
    overall = F.col("overall_classification")
    return grouped.select(
        table, "n_columns", "n_pc3", "n_pc1", "n_pc0", "n_ambiguous", "overall_classification",
        (F.col("n_ambiguous") > 0).alias("requires_human_review"),
        rules.recommendations(overall, has_type).alias("privacy_recommendations"),
        rules.compliance_flags(overall, has_type).alias("compliance_flags"),
    )


def catalog_type_counts(columns: DataFrame, table: str = "table_name") -> DataFrame:
    """D9 for a catalog: columns per table, level and PII type."""
    exploded = columns.select(table, "pc_category", F.explode("pii_types").alias("pii_type"))
    return exploded.groupBy(table, "pc_category", "pii_type").agg(F.count("*").alias("n_columns"))
