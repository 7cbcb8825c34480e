"""Registered queries for schemas: D1-D15."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskscan.functions import ddl as rules
from riskscan.operators import ddl as dd
from riskscan.plans.fixtures import fixture, fixture_sql
from riskscan.plans.registry import plain_sql, query, quote, spark_sql, trim_sql, values_sql, words_sql

FX = fixture_sql("ddl_fx")

# --------------------------------------------------------------------------
# Oracle: columns by a running parenthesis depth, rules by joins to small tables
# --------------------------------------------------------------------------

_PREFIXES = " OR ".join(f"starts_with(upper(line), {quote(p)})" for p in rules.NON_COLUMN_PREFIXES)

COLUMNS_CTE = rf"""
body AS (SELECT stmt_id, regexp_extract(ddl, '(?s)\((.*)\)', 1) AS b FROM {FX}),
piece AS (SELECT stmt_id, unnest(string_split(b, ',')) AS p, generate_subscripts(string_split(b, ','), 1) AS i FROM body WHERE b <> ''),
deep AS (SELECT *, sum(length(replace(p, ')', '')) - length(replace(p, '(', ''))) OVER (PARTITION BY stmt_id ORDER BY i) AS depth FROM piece),
grouped AS (SELECT *, coalesce(sum(CASE WHEN depth = 0 THEN 1 ELSE 0 END) OVER
  (PARTITION BY stmt_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS grp FROM deep),
lines AS (SELECT stmt_id, grp, {trim_sql("string_agg(p, ',' ORDER BY i)")} AS line FROM grouped GROUP BY stmt_id, grp),
worded AS (SELECT stmt_id, grp, {words_sql('line')} AS w FROM lines WHERE line <> '' AND NOT ({_PREFIXES})),
cols AS (SELECT stmt_id, row_number() OVER (PARTITION BY stmt_id ORDER BY grp) - 1 AS pos,
  trim(w[1], '`"''') AS column_name, w[2] AS data_type, array_to_string(w[3:], ' ') AS constraints FROM worded WHERE len(w) >= 2)"""

_RULES = values_sql(
    [
        (ord_, pc, kind, part)
        for ord_, (pc, kind, parts) in enumerate(
            (pc, kind, parts) for pc, kinds in rules.NAME_RULES.items() for kind, parts in kinds.items()
        )
        for part in parts
    ]
)
_HINTS = values_sql([(pos, kind, p) for pos, (kind, ps) in enumerate(rules.TYPE_HINTS.items()) for p in ps])
_GROUPS = values_sql(
    [(pos, g, e, 1 if e == a.examples[0] else 0) for pos, (g, a) in enumerate(rules.AMBIGUOUS.items()) for e in a.examples]
)
_TEXTS = values_sql([(g, a.possibility, a.clues) for g, a in rules.AMBIGUOUS.items()])


def _classified(source: str, keys: list[str]) -> str:
    """classified: one row per column with the outcome of D5-D7; ``keys`` identify a column."""
    k = ", ".join(keys)
    on = " AND ".join("{a}." + c + " = {b}." + c for c in keys)

    def join(a: str, b: str) -> str:
        return on.format(a=a, b=b)

    return f"""
named AS (SELECT {k}, arg_min(pc, ord) AS pc, arg_min(kind, ord) AS kind FROM {source}
  JOIN ({_RULES}) r(ord, pc, kind, part) ON contains(lower(column_name), part) GROUP BY {k}),
hinted AS (SELECT {k}, list(kind ORDER BY ord) AS kinds FROM (SELECT DISTINCT {k}, ord, kind FROM {source}
  JOIN ({_HINTS}) h(ord, kind, part) ON contains(upper(data_type), part)) GROUP BY {k}),
hits AS (SELECT {k}, gpos, grp, max(is_first) AS first_hit FROM {source}
  JOIN ({_GROUPS}) a(gpos, grp, example, is_first) ON contains(lower(column_name), example) GROUP BY {k}, gpos, grp),
started AS (SELECT *, min(gpos) OVER (PARTITION BY {k}) AS start FROM hits),
grouped_names AS (SELECT {k}, arg_max(grp, gpos) AS grp FROM started WHERE gpos = start OR first_hit = 1 GROUP BY {k}),
classified AS (SELECT c.*, n.kind,
  CASE WHEN n.kind IS NOT NULL THEN [n.kind] WHEN g.grp IS NOT NULL THEN ['Ambiguous_' || g.grp] ELSE coalesce(h.kinds, []) END AS pii_types,
  CASE WHEN n.kind IS NOT NULL THEN n.pc WHEN g.grp IS NOT NULL THEN 'AMBIGUOUS' ELSE 'PC0' END AS pc_category,
  CASE WHEN n.kind IS NOT NULL THEN 0.9 WHEN g.grp IS NOT NULL THEN 0.5 ELSE 0.0 END AS confidence_score,
  n.kind IS NULL AND g.grp IS NOT NULL AS is_ambiguous,
  CASE WHEN n.kind IS NULL THEN g.grp END AS ambiguous_type
  FROM {source} c LEFT JOIN named n ON {join('c', 'n')} LEFT JOIN hinted h ON {join('c', 'h')}
  LEFT JOIN grouped_names g ON {join('c', 'g')})"""


CLASSIFIED = f"WITH {COLUMNS_CTE},{_classified('cols', ['stmt_id', 'pos'])}"


def _listed(level: str) -> str:
    """Types of one level in column order, as a|b|c."""
    return (
        f"coalesce(string_agg(array_to_string(pii_types, '|'), '|' ORDER BY pos) "
        f"FILTER (WHERE pc_category = '{level}' AND len(pii_types) > 0), '')"
    )


_AMBIGUOUS_TWICE = (
    "coalesce(string_agg(pii_types[1] || '|' || pii_types[1], '|' ORDER BY pos) FILTER (WHERE is_ambiguous), '')"
)
_TYPE_FLAGS = ", ".join(
    f"coalesce(bool_or(kind = '{t}' AND pc_category IN ('PC3', 'PC1')), false) AS has_{t.lower()}"
    for t in rules.TYPE_RECOMMENDATIONS
)


def statements_cte(classified: str, statements: str, key: str) -> str:
    return f"""{classified},
agg AS (SELECT {key}, bool_or(pc_category = 'PC3') AS has_pc3, bool_or(pc_category = 'PC1') AS has_pc1,
  bool_or(is_ambiguous) AS review, {_TYPE_FLAGS} FROM classified GROUP BY {key}),
stmt AS (SELECT s.{key}, coalesce(review, false) AS review, coalesce(has_ssn, false) AS has_ssn,
  coalesce(has_financial, false) AS has_financial, coalesce(has_health, false) AS has_health,
  CASE WHEN has_pc3 THEN 'PC3' WHEN has_pc1 THEN 'PC1' WHEN review THEN 'AMBIGUOUS' ELSE 'PC0' END AS overall
  FROM {statements} s LEFT JOIN agg a ON s.{key} = a.{key})"""


STATEMENTS = statements_cte(CLASSIFIED, FX, "stmt_id")


def _lines_sql(lines: list[str]) -> str:
    return "[" + ", ".join(quote(line) for line in lines) + "]"


RECOMMENDED = (
    "list_concat(CASE overall "
    + " ".join(f"WHEN '{c}' THEN {_lines_sql(lines)}" for c, lines in rules.RECOMMENDATIONS.items())
    + " END, list_filter(["
    + ", ".join(f"CASE WHEN has_{t.lower()} THEN {quote(line)} END" for t, line in rules.TYPE_RECOMMENDATIONS.items())
    + "], lambda r: r IS NOT NULL))"
)
FLAGGED = (
    "concat_ws('|', CASE WHEN has_ssn THEN 'REQUIRES_GDPR_REVIEW|REQUIRES_CCPA_REVIEW' END, "
    "CASE WHEN has_health THEN 'REQUIRES_HIPAA_REVIEW' END, CASE WHEN has_financial THEN 'REQUIRES_PCI_DSS_REVIEW' END, "
    "CASE overall WHEN 'PC3' THEN 'REQUIRES_DPO_APPROVAL' "
    "WHEN 'AMBIGUOUS' THEN 'REQUIRES_HUMAN_REVIEW|REQUIRES_PRIVACY_OFFICER_REVIEW' END)"
)

_KIND = trim_sql("ddl")
TYPE_SQL = (
    f"CASE WHEN starts_with(upper({_KIND}), 'CREATE TABLE') THEN 'CREATE_TABLE' "
    f"WHEN starts_with(upper({_KIND}), 'ALTER TABLE') THEN 'ALTER_TABLE' "
    f"WHEN starts_with(upper({_KIND}), 'CREATE VIEW') THEN 'CREATE_VIEW' ELSE 'UNKNOWN' END"
)
NAME_SQL = (
    "coalesce("
    + ", ".join(
        rf"nullif(regexp_extract(ddl, '(?i){a}\s+{b}\s+{left}([\p{{L}}\p{{N}}_]+){right}', 1), '')"
        for a, b in (("CREATE", "TABLE"), ("ALTER", "TABLE"), ("CREATE", "VIEW"))
        for left, right in (("`", "`"), ('"', '"'), ("''", "''"), ("", ""))
    )
    + ", 'unknown_table')"
)


def _analyzed(spark, sf):
    return dd.analyze_ddl(fixture(spark, sf, "ddl_fx"))


def _columns(spark, sf):
    return dd.classify_columns(dd.explode_columns(fixture(spark, sf, "ddl_fx")))


def _joined(column: str):
    return F.array_join(column, "|")


@query("d1_statement_type", f"SELECT stmt_id, {TYPE_SQL} AS statement_type FROM {FX}")
def d1(spark, sf):
    return fixture(spark, sf, "ddl_fx").select("stmt_id", rules.statement_type(F.col("ddl")).alias("statement_type"))


@query("d2_table_name", f"SELECT stmt_id, {NAME_SQL} AS table_name FROM {FX}")
def d2(spark, sf):
    return fixture(spark, sf, "ddl_fx").select("stmt_id", rules.table_name(F.col("ddl")).alias("table_name"))


@query(
    "d3_column_lines",
    f"""WITH {COLUMNS_CTE} SELECT stmt_id, row_number() OVER (PARTITION BY stmt_id ORDER BY grp) - 1 AS pos, line
FROM lines WHERE line <> ''""",
)
def d3(spark, sf):
    lines = F.posexplode(rules.column_lines(F.col("ddl"))).alias("pos", "line")
    return fixture(spark, sf, "ddl_fx").select("stmt_id", lines).withColumn("pos", F.col("pos").cast("bigint"))


@query("d4_parse_columns", f"WITH {COLUMNS_CTE} SELECT * FROM cols")
def d4(spark, sf):
    columns = dd.explode_columns(fixture(spark, sf, "ddl_fx"))
    return columns.withColumn("pos", F.col("pos").cast("bigint"))


@query(
    "d5_classify_column_name",
    f"{CLASSIFIED} SELECT c.stmt_id, c.pos, c.column_name, n.pc, n.kind FROM cols c LEFT JOIN named n ON c.stmt_id = n.stmt_id AND c.pos = n.pos",
)
def d5(spark, sf):
    columns = dd.explode_columns(fixture(spark, sf, "ddl_fx"))
    ruled = columns.withColumn("_rule", rules.name_rule(F.lower("column_name")))
    return ruled.select("stmt_id", F.col("pos").cast("bigint").alias("pos"), "column_name", "_rule.pc", "_rule.kind")


@query(
    "d6_type_hints",
    f"""{CLASSIFIED} SELECT c.stmt_id, c.pos, array_to_string(coalesce(h.kinds, []), '|') AS hints
FROM cols c LEFT JOIN hinted h ON c.stmt_id = h.stmt_id AND c.pos = h.pos""",
)
def d6(spark, sf):
    columns = dd.explode_columns(fixture(spark, sf, "ddl_fx"))
    hints = F.array_join(rules.type_hints(F.col("data_type")), "|")
    return columns.select("stmt_id", F.col("pos").cast("bigint").alias("pos"), hints.alias("hints"))


@query(
    "d7_ambiguity",
    f"""{CLASSIFIED} SELECT stmt_id, pos, column_name, array_to_string(pii_types, '|') AS pii_types, pc_category,
CAST(confidence_score AS DOUBLE) AS confidence_score, is_ambiguous, ambiguous_type FROM classified""",
)
def d7(spark, sf):
    return _columns(spark, sf).select(
        "stmt_id", F.col("pos").cast("bigint").alias("pos"), "column_name", _joined("pii_types").alias("pii_types"),
        "pc_category", "confidence_score", "is_ambiguous", "ambiguous_type",
    )


@query(
    "d8_reasoning",
    f"""{CLASSIFIED},
name_lines AS (SELECT stmt_id, pos, 0 AS block, 0 AS ord, 'Column name ''' || column_name || ''' matches ' || kind || ' pattern' AS line
  FROM classified WHERE kind IS NOT NULL),
hint_lines AS (SELECT stmt_id, pos, 1 AS block, h.ord, 'Data type ''' || data_type || ''' suggests ' || h.kind AS line
  FROM classified c JOIN ({_HINTS}) h(ord, kind, part) ON contains(upper(data_type), part) WHERE c.kind IS NULL),
step_lines AS (SELECT s.stmt_id, s.pos, 2 AS block, s.gpos AS ord, 'Column name ''' || column_name || ''' is ambiguous - ' || t.possibility AS line
  FROM started s JOIN classified c ON s.stmt_id = c.stmt_id AND s.pos = c.pos JOIN ({_TEXTS}) t(grp, possibility, clues) ON s.grp = t.grp
  WHERE c.kind IS NULL AND (gpos = start OR first_hit = 1)),
all_lines AS (SELECT * FROM name_lines UNION ALL SELECT * FROM hint_lines UNION ALL SELECT * FROM step_lines)
SELECT c.stmt_id, c.pos, coalesce(string_agg(line, '|' ORDER BY block, ord), '') AS reasoning
FROM cols c LEFT JOIN all_lines l ON c.stmt_id = l.stmt_id AND c.pos = l.pos GROUP BY c.stmt_id, c.pos""",
)
def d8(spark, sf):
    return _columns(spark, sf).select(
        "stmt_id", F.col("pos").cast("bigint").alias("pos"), _joined("reasoning").alias("reasoning")
    )


@query(
    "d9_pii_summary",
    f"""{CLASSIFIED}, listed AS (SELECT stmt_id, {_listed('PC3')} AS pc3, {_listed('PC1')} AS pc1, {_listed('PC0')} AS pc0,
{_AMBIGUOUS_TWICE} AS ambiguous FROM classified GROUP BY stmt_id)
SELECT f.stmt_id, coalesce(pc3, '') AS pc3, coalesce(pc1, '') AS pc1, coalesce(pc0, '') AS pc0, coalesce(ambiguous, '') AS ambiguous
FROM {FX} f LEFT JOIN listed l ON f.stmt_id = l.stmt_id""",
)
def d9(spark, sf):
    return _analyzed(spark, sf).select(
        "stmt_id", *[_joined(f"pii_summary.{level}").alias(level.lower()) for level in dd.LEVELS]
    )


@query("d10_overall_classification", f"{STATEMENTS} SELECT stmt_id, overall AS overall_classification FROM stmt")
def d10(spark, sf):
    return _analyzed(spark, sf).select("stmt_id", "overall_classification")


@query("d11_recommendations", f"{STATEMENTS} SELECT stmt_id, array_to_string({RECOMMENDED}, '|') AS recommendations FROM stmt")
def d11(spark, sf):
    return _analyzed(spark, sf).select("stmt_id", _joined("privacy_recommendations").alias("recommendations"))


@query("d12_compliance_flags", f"{STATEMENTS} SELECT stmt_id, {FLAGGED} AS compliance_flags FROM stmt")
def d12(spark, sf):
    return _analyzed(spark, sf).select("stmt_id", _joined("compliance_flags").alias("compliance_flags"))


@query(
    "d13_ambiguous_columns",
    f"""{CLASSIFIED} SELECT stmt_id, column_name, ambiguous_type, possibility AS pii_possibility, clues AS context_clues, data_type
FROM classified JOIN ({_TEXTS}) t(grp, possibility, clues) ON ambiguous_type = grp WHERE is_ambiguous""",
)
def d13(spark, sf):
    listed = _analyzed(spark, sf).where("requires_human_review")
    return listed.select("stmt_id", F.explode("ambiguous_columns").alias("c")).select("stmt_id", "c.*")


@query(
    "d14_ddl_examples",
    f"""{STATEMENTS}, types AS (SELECT stmt_id, CASE pc_category WHEN 'PC3' THEN 0 WHEN 'PC1' THEN 1 WHEN 'PC0' THEN 2 ELSE 3 END AS level,
  pos, unnest(pii_types) AS t, generate_subscripts(pii_types, 1) AS k FROM classified),
firsts AS (SELECT stmt_id, t, min(level * 1000000 + pos * 1000 + k) AS seq FROM types GROUP BY stmt_id, t),
detected AS (SELECT stmt_id, string_agg(t, '|' ORDER BY seq) AS detected FROM firsts GROUP BY stmt_id),
named_cols AS (SELECT stmt_id, string_agg(column_name, '|' ORDER BY pos) FILTER (WHERE pc_category = 'PC3') AS high,
  string_agg(column_name, '|' ORDER BY pos) FILTER (WHERE is_ambiguous) AS unclear FROM classified GROUP BY stmt_id)
SELECT f.stmt_id, 'ddl' AS type, {trim_sql('f.ddl')} AS ddl_statement, {NAME_SQL} AS table_name, overall AS overall_classification,
coalesce(detected, '') AS detected_pii_types, coalesce(high, '') AS high_risk_columns, coalesce(unclear, '') AS ambiguous_columns,
review AS requires_human_review, {FLAGGED} AS compliance_flags, array_to_string({RECOMMENDED}[1:3], '|') AS privacy_recommendations
FROM {FX} f JOIN stmt s ON f.stmt_id = s.stmt_id LEFT JOIN detected d ON f.stmt_id = d.stmt_id
LEFT JOIN named_cols n ON f.stmt_id = n.stmt_id""",
)
def d14(spark, sf):
    examples = dd.ddl_examples(_analyzed(spark, sf))
    lists = ["detected_pii_types", "high_risk_columns", "ambiguous_columns", "compliance_flags", "privacy_recommendations"]
    return examples.select(
        "stmt_id", "type", "ddl_statement", "analysis_result.table_name", "analysis_result.overall_classification",
        "analysis_result.requires_human_review", *[_joined(f"analysis_result.{c}").alias(c) for c in lists],
    )


@query(
    "d15_ddl_report",
    f"""{STATEMENTS}, shown AS (SELECT stmt_id,
  string_agg(column_name || ' (' || data_type || ') -> ' || array_to_string(pii_types, ', ') || ' [' || pc_category || ']', '|' ORDER BY pos)
    FILTER (WHERE len(pii_types) > 0) AS pii_columns,
  string_agg(column_name || ' (' || data_type || ') -> ' || ambiguous_type, '|' ORDER BY pos) FILTER (WHERE is_ambiguous) AS review_columns
  FROM classified GROUP BY stmt_id)
SELECT f.stmt_id, {NAME_SQL} AS table_name, overall AS overall_classification, coalesce(pii_columns, '') AS pii_columns,
coalesce(review_columns, '') AS review_columns, review AS requires_human_review, {FLAGGED} AS compliance_flags,
array_to_string({RECOMMENDED}[1:3], '|') AS top_recommendations
FROM {FX} f JOIN stmt s ON f.stmt_id = s.stmt_id LEFT JOIN shown w ON f.stmt_id = w.stmt_id""",
)
def d15(spark, sf):
    report = dd.ddl_report(_analyzed(spark, sf))
    lists = ["pii_columns", "review_columns", "compliance_flags", "top_recommendations"]
    return report.select(
        "stmt_id", "table_name", "overall_classification", "requires_human_review", *[_joined(c).alias(c) for c in lists]
    )


# --------------------------------------------------------------------------
# The same rules over a catalog with one row per column
# --------------------------------------------------------------------------

CATALOG = """
SELECT p_brand AS table_name, p_partkey AS pos,
  CASE p_partkey % 6 WHEN 0 THEN replace(p_name, ' ', '_') WHEN 1 THEN 'customer_' || lower(p_type) || '_id'
    WHEN 2 THEN 'ref_no' WHEN 3 THEN lower(p_type) || '_key' WHEN 4 THEN 'patient_number' ELSE 'iban_' || CAST(p_size AS STRING) END AS column_name,
  CASE p_partkey % 4 WHEN 0 THEN 'VARCHAR(255)' WHEN 1 THEN 'CHAR(9)' WHEN 2 THEN 'INT' ELSE 'VARCHAR(50)' END AS data_type
FROM $part
"""
CATALOG_SQL = f"WITH catalog AS ({plain_sql(CATALOG, ['part'])}),{_classified('catalog', ['table_name', 'pos'])}"


def _catalog(spark, sf):
    return dd.classify_columns(spark_sql(spark, sf, CATALOG, ["part"]))


@query(
    "d5_classify_catalog",
    f"""{CATALOG_SQL} SELECT table_name, pos, column_name, array_to_string(pii_types, '|') AS pii_types, pc_category,
is_ambiguous, ambiguous_type FROM classified""",
)
def d5_catalog(spark, sf):
    return _catalog(spark, sf).select(
        "table_name", "pos", "column_name", _joined("pii_types").alias("pii_types"), "pc_category", "is_ambiguous",
        "ambiguous_type",
    )


@query(
    "d9_catalog_type_counts",
    f"""{CATALOG_SQL} SELECT table_name, pc_category, pii_type, CAST(count(*) AS BIGINT) AS n_columns
FROM (SELECT table_name, pc_category, unnest(pii_types) AS pii_type FROM classified) GROUP BY ALL""",
)
def d9_catalog(spark, sf):
    return dd.catalog_type_counts(_catalog(spark, sf))


@query(
    "d10_catalog_report",
    f"""{statements_cte(CATALOG_SQL, '(SELECT DISTINCT table_name FROM catalog)', 'table_name')},
counts AS (SELECT table_name, CAST(count(*) AS BIGINT) AS n_columns,
  CAST(count(*) FILTER (WHERE pc_category = 'PC3' AND len(pii_types) > 0) AS BIGINT) AS n_pc3,
  CAST(count(*) FILTER (WHERE pc_category = 'PC1' AND len(pii_types) > 0) AS BIGINT) AS n_pc1,
  CAST(count(*) FILTER (WHERE is_ambiguous) AS BIGINT) AS n_ambiguous FROM classified GROUP BY table_name)
SELECT s.table_name, n_columns, n_pc3, n_pc1, n_ambiguous, overall AS overall_classification, review AS requires_human_review,
{FLAGGED} AS compliance_flags, array_to_string({RECOMMENDED}, '|') AS privacy_recommendations
FROM stmt s JOIN counts c ON s.table_name = c.table_name""",
)
def d10_catalog(spark, sf):
    report = dd.catalog_report(_catalog(spark, sf)).drop("n_pc0")
    for name in ("compliance_flags", "privacy_recommendations"):
        report = report.withColumn(name, _joined(name))
    return report
