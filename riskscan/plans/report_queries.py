"""Registered queries for counts and top lists: A2-A11, and the taxonomy tables S10."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskscan.functions import text as tx
from riskscan.operators import findings as fd
from riskscan.operators import report as rp
from riskscan.plans.fixtures import fixture, fixture_sql
from riskscan.plans.matching_queries import (
    FINDINGS,
    L2_DIM,
    LABELLED_CTE,
    PRIVACY_CTE,
    RISK_DIM,
    labelled_findings,
    labelled_privacy,
)
from riskscan.plans.registry import query, table, trim_sql, values_sql
from riskscan.plans.text_queries import assembled_sql, clean_sql, keyword_pc_sql, meaningful_sql, scan_sql, split_sql
from riskscan.operators.privacy import privacy_examples
from riskscan.operators.texts import scan_texts
from riskscan.functions.classify import pc_from_keywords
from riskscan.taxonomy import DEFAULT


def _n(condition: str | None = None) -> str:
    return f"CAST(count(*) FILTER (WHERE {condition}) AS BIGINT)" if condition else "CAST(count(*) AS BIGINT)"


def _pct(part: str, total: str) -> str:
    return f"CAST(CASE WHEN {total} > 0 THEN round({part} * 100.0 / {total}, 1) ELSE 0 END AS DOUBLE)"


# --------------------------------------------------------------------------
# Every taxonomy row with how often the data uses it
# --------------------------------------------------------------------------


@query(
    "s10_l2_usage",
    f"""SELECT d.l2_key, CAST(d.ord AS BIGINT) AS l2_ord, d.name AS l2_name, CAST(count(c.id) AS BIGINT) AS n FROM ({L2_DIM}) d(ord, l2_key, name)
LEFT JOIN {fixture_sql('claims_fx')} c ON split_part(c.l2_category, '.', 1) = d.l2_key GROUP BY ALL""",
)
def s10_l2(spark, sf):
    claims = fixture(spark, sf, "claims_fx").groupBy(tx.label_key(F.col("l2_category")).alias("l2_key"))
    used = claims.agg(F.count("*").alias("n"))
    dim = DEFAULT.l2_dim(spark).withColumn("l2_ord", F.col("l2_ord").cast("bigint"))
    return dim.join(used, "l2_key", "left").fillna(0, ["n"])


@query(
    "s10_macro_risk_usage",
    f"""SELECT d.l2_key, d.name AS risk, CAST(count(o.o_orderkey) AS BIGINT) AS n FROM ({RISK_DIM}) d(ord, l2_key, name)
LEFT JOIN orders o ON o.o_custkey % 61 = d.ord GROUP BY ALL""",
)
def s10_risks(spark, sf):
    used = table(spark, sf, "orders").groupBy((F.col("o_custkey") % 61).alias("pick")).agg(F.count("*").alias("n"))
    names = F.posexplode(F.array(*[F.lit(r) for r in DEFAULT.all_risks])).alias("pick", "risk")
    order = spark.range(1).select(names)
    counted = order.join(used, "pick", "left").fillna(0, ["n"])
    return DEFAULT.macro_risk_dim(spark).join(counted, "risk").select("l2_key", "risk", "n")


@query(
    "s10_keyword_usage",
    f"""SELECT pc_category, phrase, CAST(count(t.id) AS BIGINT) AS n
FROM ({values_sql([(pc, p) for pc, ps in DEFAULT.pii_keywords.items() for p in ps])}) d(pc_category, phrase)
LEFT JOIN {fixture_sql('pii_fx')} t ON contains(lower(t.text), phrase) GROUP BY ALL""",
)
def s10_keywords(spark, sf):
    dim = DEFAULT.pii_keyword_dim(spark)
    phrases = [p for ps in DEFAULT.pii_keywords.values() for p in ps]
    low = fixture(spark, sf, "pii_fx").select(F.lower("text").alias("_low"))
    hits = low.select(F.explode(F.filter(F.array(*[F.lit(p) for p in phrases]), lambda p: F.contains("_low", p))).alias("phrase"))
    return dim.join(hits.groupBy("phrase").agg(F.count("*").alias("n")), "phrase", "left").fillna(0, ["n"])


@query(
    "s10_protection_labels",
    f"""SELECT d.pc_category, d.label AS privacy_label, CAST(count(t.id) AS BIGINT) AS n
FROM ({values_sql(list(DEFAULT.privacy_labels.items()))}) d(pc_category, label)
LEFT JOIN (SELECT id, {keyword_pc_sql('text')} AS pc FROM {fixture_sql('pii_fx')}) t ON t.pc = d.pc_category GROUP BY ALL""",
)
def s10_pc(spark, sf):
    found = fixture(spark, sf, "pii_fx").groupBy(pc_from_keywords(F.col("text")).alias("pc_category"))
    dim = DEFAULT.pc_dim(spark).select("pc_category", "privacy_label")
    return dim.join(found.agg(F.count("*").alias("n")), "pc_category", "left").fillna(0, ["n"])


# --------------------------------------------------------------------------
# A2, A3 over raw findings
# --------------------------------------------------------------------------

EXAMPLES_SQL = f"""SELECT * FROM (SELECT id, {assembled_sql(True)} AS text, coalesce(nullif(L2, ''), 'UNKNOWN') AS l2_category,
{split_sql('Risks')} AS macro_risks FROM {FINDINGS}) WHERE text IS NOT NULL"""


A2_SQL = f"""SELECT {_n()} AS total_training_examples, {_n()} AS risk_examples, CAST(0 AS BIGINT) AS pii_examples,
{_n("l2_category <> 'UNKNOWN'")} AS with_l2, {_n("macro_risks <> ['UNSPECIFIED']")} AS with_risks,
{_n("l2_category <> 'UNKNOWN' AND macro_risks <> ['UNSPECIFIED']")} AS complete FROM ({EXAMPLES_SQL})"""


@query("a2_extraction_summary", A2_SQL)
def a2(spark, sf):
    return rp.extraction_summary(fd.raw_to_examples(fixture(spark, sf, "findings_fx"), keep=["id"]))


@query(
    "a3_field_stats",
    f"""SELECT {_n()} AS total_entries, CAST(0 AS BIGINT) AS empty_entries, {_n('text IS NOT NULL')} AS processed_entries,
{_n('text IS NULL')} AS failed_entries, {_pct('count(text)', 'count(*)')} AS processed_pct, {_n('title')} AS title_hits,
{_n('description')} AS description_hits, {_n("L2 <> ''")} AS l2_hits, {_n("Risks <> ''")} AS risks_hits
FROM (SELECT *, {assembled_sql(True)} AS text, {meaningful_sql('Title')} AS title, {meaningful_sql('Description')} AS description FROM
(SELECT Title, Description, L2, Risks, Origin FROM {FINDINGS}) f(Title, Description, L2, Risks, Origin)) g(t, d, L2, Risks, Origin, text, title, description)""",
)
def a3(spark, sf):
    raw = fixture(spark, sf, "findings_fx")
    return rp.field_stats(raw, fd.assembled_text(raw))


# --------------------------------------------------------------------------
# A4-A8 over labelled findings
# --------------------------------------------------------------------------


@query(
    "a4_reject_counts",
    f"""WITH {LABELLED_CTE}, total AS (SELECT count(*) AS total FROM labelled)
SELECT r.reason, CAST(count(l.id) AS BIGINT) AS n, {_pct('count(l.id)', 'max(total)')} AS pct
FROM ({values_sql([(r,) for r in fd.REJECT_REASONS])}) r(reason) CROSS JOIN total
LEFT JOIN labelled l ON list_contains(string_split(l.reject_reasons, '|'), r.reason) GROUP BY r.reason""",
)
def a4(spark, sf):
    return rp.reject_counts(labelled_findings(spark, sf))


@query(
    "a5_empty_fields",
    f"""SELECT {_n("t = '' AND d <> ''")} AS title_missing, {_n("d = '' AND t <> ''")} AS description_missing, {_n("t = '' AND d = ''")} AS both_missing
FROM (SELECT {clean_sql('Title')} AS t, {clean_sql('Description')} AS d FROM {FINDINGS})""",
)
def a5(spark, sf):
    return rp.empty_field_counts(fd.map_columns(fixture(spark, sf, "findings_fx")))


@query(
    "a6_top_l2_values",
    f"SELECT {trim_sql('L2')} AS value, {_n()} AS n FROM {FINDINGS} WHERE L2 IS NOT NULL GROUP BY 1 ORDER BY n DESC, value LIMIT 10",
)
def a6_l2(spark, sf):
    return rp.top_l2_values(fixture(spark, sf, "findings_fx"), "L2")  # raw values need no labels


@query(
    "a6_top_risk_values",
    f"SELECT Risks AS value, {_n()} AS n FROM {FINDINGS} WHERE Risks IS NOT NULL GROUP BY 1 ORDER BY n DESC, value LIMIT 10",
)
def a6_risks(spark, sf):
    return rp.top_risk_values(fixture(spark, sf, "findings_fx"), "Risks")


@query(
    "a6_top_unmatched_l2_values",
    f"""WITH {LABELLED_CTE} SELECT {trim_sql('L2')} AS value, {_n()} AS n FROM labelled WHERE L2 IS NOT NULL AND l2_category = 'UNKNOWN'
GROUP BY 1 ORDER BY n DESC, value LIMIT 10""",
)
def a6_unmatched(spark, sf):
    return rp.top_l2_values(labelled_findings(spark, sf), unmatched_only=True)


_KEPT = f"WITH {LABELLED_CTE}, kept AS (SELECT * FROM labelled WHERE reject_reasons = ''), total AS (SELECT count(*) AS total FROM kept)"


@query(
    "a7_l2_distribution",
    f"""{_KEPT} SELECT split_part(l2_category, '.', 1) AS l2_key, {_n()} AS n, {_pct('count(*)', 'max(total)')} AS pct
FROM kept CROSS JOIN total WHERE l2_category <> 'UNKNOWN' GROUP BY 1""",
)
def a7(spark, sf):
    return rp.l2_distribution(fd.kept(labelled_findings(spark, sf)))


@query(
    "a8_top_macro_risks",
    f"""{_KEPT} SELECT risk, {_n()} AS n, {_pct('count(*)', 'max(total)')} AS pct
FROM (SELECT unnest(macro_risks) AS risk FROM kept) CROSS JOIN total WHERE risk <> 'UNSPECIFIED' GROUP BY 1 ORDER BY n DESC, risk LIMIT 10""",
)
def a8(spark, sf):
    return rp.top_macro_risks(fd.kept(labelled_findings(spark, sf)))


# --------------------------------------------------------------------------
# A9-A11 over privacy examples and scanned texts
# --------------------------------------------------------------------------


@query("a9_pc_distribution", f"{PRIVACY_CTE} SELECT pc AS pc_category, {_n()} AS n FROM typed WHERE len(types) > 0 GROUP BY 1")
def a9(spark, sf):
    return rp.pc_distribution(privacy_examples(labelled_privacy(spark, sf)))


@query("a9_pc_distribution_documents", f"SELECT pc_category, {_n()} AS n FROM ({scan_sql('documents', 'doc_id')}) GROUP BY 1")
def a9_documents(spark, sf):
    return rp.pc_distribution(scan_texts(table(spark, sf, "documents")))


@query(
    "a10_top_pii_types",
    f"""{PRIVACY_CTE} SELECT pii_type, {_n()} AS n FROM (SELECT unnest(types) AS pii_type FROM typed) GROUP BY 1 ORDER BY n DESC, pii_type LIMIT 10""",
)
def a10(spark, sf):
    return rp.top_pii_types(privacy_examples(labelled_privacy(spark, sf)))


@query(
    "a10_top_pii_types_lines",
    f"""SELECT pii_type, {_n()} AS n FROM (SELECT unnest(pii_types) AS pii_type FROM ({scan_sql(fixture_sql('pii_lines_fx'))}))
GROUP BY 1 ORDER BY n DESC, pii_type LIMIT 10""",
)
def a10_lines(spark, sf):
    return rp.top_pii_types(scan_texts(fixture(spark, sf, "pii_lines_fx")))


@query(
    "a11_privacy_summary",
    f"{PRIVACY_CTE} SELECT {_n()} AS total, {_n('len(types) > 0')} AS mapped, {_n('len(types) = 0')} AS skipped FROM typed",
)
def a11(spark, sf):
    return rp.privacy_summary(labelled_privacy(spark, sf))


