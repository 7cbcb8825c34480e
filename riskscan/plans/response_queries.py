"""Registered queries for model responses: R1-R8, and the batch summary A1 over them."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskscan.functions import responses as rs
from riskscan.operators import report as rp
from riskscan.operators import responses as ro
from riskscan.plans.fixtures import fixture, fixture_sql
from riskscan.plans.matching_queries import loose_match_cte, strict_match_cte
from riskscan.plans.registry import query, quote, table, trim_sql
from riskscan.plans.text_queries import keyword_pc_sql, named_types_sql, normalise_types_sql, upgrade_sql
from riskscan.taxonomy import DEFAULT

FX = fixture_sql("responses_fx")
KNOWN_KEYS = ", ".join(quote(k) for k in DEFAULT.macro_risks)

# --------------------------------------------------------------------------
# Oracle pieces
# --------------------------------------------------------------------------


def first_match_sql(text: str, patterns: list[str]) -> str:
    tries = [f"nullif(regexp_extract({text}, {quote('(?i)' + p)}, 1), '')" for p in patterns]
    return f"coalesce({', '.join(tries)})"


def items_sql(text: str, patterns: list[str], least: int) -> str:
    found = " || ".join(f"regexp_extract_all({text}, {quote('(?i)' + p)}, 1)" for p in patterns)
    pieces = f"flatten(list_transform({found}, lambda m: string_split(m, ',')))"
    bare = f"list_transform({pieces}, lambda p: trim({trim_sql('p')}, '\"'''))"
    return f"list_filter({bare}, lambda p: length(p) >= {least})"


def distinct_in_order_sql(items: str) -> str:
    return f"list_filter({items}, lambda x, i: list_position({items}, x) = i)"


JSON_SQL = r"nullif(regexp_extract(replace(response, chr(10), ' '), '\{[^}]*\}'), '')"


def _falsy(kind: str, string: str) -> str:
    return (
        f"({kind} IS NULL OR {kind} = 'NULL' OR ({kind} = 'VARCHAR' AND {string} = '') "
        f"OR ({kind} <> 'VARCHAR' AND {string} IN ('0', '0.0', 'false', '[]', '{{}}')))"
    )


def _list(member: str, kind: str) -> str:
    return (
        f"CASE {kind} WHEN 'ARRAY' THEN CAST(json_extract(j, '$.{member}') AS VARCHAR[]) "
        f"WHEN 'OBJECT' THEN json_keys(j, '$.{member}') ELSE CAST([] AS VARCHAR[]) END"
    )


def _only_strings(member: str, kind: str) -> str:
    return (
        f"({kind} <> 'ARRAY' OR len(list_filter(range(CAST(json_array_length(j, '$.{member}') AS BIGINT)), "
        f"lambda i: json_type(j, '$.{member}[' || i || ']') <> 'VARCHAR')) = 0)"
    )


RESULTS = rf"""WITH
base AS (SELECT id, type AS kind, text, response AS raw, {trim_sql('response')} AS plain,
  CASE WHEN json_valid({JSON_SQL}) THEN CAST({JSON_SQL} AS JSON) END AS j FROM {FX}),
typed AS (SELECT *, json_type(j, '$.l2_category') AS lt, json_extract_string(j, '$.l2_category') AS ls,
  json_type(j, '$.macro_risks') AS rt, json_extract_string(j, '$.macro_risks') AS rstr,
  json_type(j, '$.pc_category') AS ct, json_extract_string(j, '$.pc_category') AS cs, json_type(j, '$.pii_types') AS pt FROM base),
stated AS (SELECT *, {trim_sql("split_part(ls, '.', 1)")} AS l2_key,
  {_list('macro_risks', 'rt')} AS given_risks, {_list('pii_types', 'pt')} AS given_types,
  CASE WHEN plain = '' THEN 'empty' WHEN j IS NULL THEN 'fallback'
    WHEN kind = 'risk' THEN CASE
      WHEN rt = 'NULL' THEN 'error'
      WHEN rt NOT IN ('ARRAY', 'OBJECT', 'VARCHAR') AND ({_falsy('rt', 'rstr')} OR {_falsy('lt', 'ls')} OR (lt = 'VARCHAR' AND {trim_sql("split_part(ls, '.', 1)")} IN ({KNOWN_KEYS}))) THEN 'error'
      WHEN NOT {_falsy('lt', 'ls')} AND lt <> 'VARCHAR' AND NOT {_falsy('rt', 'rstr')} THEN 'fallback'
      WHEN NOT {_falsy('lt', 'ls')} AND lt = 'VARCHAR' AND {trim_sql("split_part(ls, '.', 1)")} IN ({KNOWN_KEYS}) AND NOT coalesce({_only_strings('macro_risks', 'rt')}, true) THEN 'fallback'
      ELSE 'ok' END
    WHEN pt IS NOT NULL AND pt NOT IN ('ARRAY', 'OBJECT', 'VARCHAR') THEN 'error'
    WHEN NOT coalesce({_only_strings('pii_types', 'pt')}, true) THEN 'error' ELSE 'ok' END AS state FROM typed),
strict_rows AS (SELECT id, l2_key, unnest(given_risks) AS item FROM stated WHERE kind = 'risk' AND state = 'ok' AND lt = 'VARCHAR' AND ls <> ''),
{strict_match_cte('SELECT * FROM strict_rows').strip()},
texted AS (SELECT *, CASE WHEN kind = 'risk' AND state = 'fallback' THEN {trim_sql(first_match_sql('plain', rs.L2_PATTERNS))} END AS text_l2,
  CASE WHEN kind = 'risk' AND state = 'fallback' THEN {items_sql('plain', rs.RISK_PATTERNS, 4)} END AS text_items FROM stated),
loose_rows AS (SELECT id, {trim_sql("split_part(text_l2, '.', 1)")} AS l2_key, unnest(text_items) AS item FROM texted WHERE text_l2 <> ''),
{loose_match_cte('SELECT * FROM loose_rows').strip()},
risk_out AS (SELECT t.*, CASE WHEN state = 'ok' AND NOT (lt = 'VARCHAR' AND ls <> '') THEN given_risks[1:5]
    WHEN state = 'ok' AND lt IS NULL THEN given_risks[1:5] WHEN state = 'ok' THEN coalesce(s.risks, [])[1:5]
    WHEN text_l2 IS NULL OR text_l2 = '' THEN ({distinct_in_order_sql('text_items')})[1:5] ELSE coalesce(l.risks, [])[1:5] END AS risks
  FROM texted t LEFT JOIN strict s ON s.id = t.id LEFT JOIN loose l ON l.id = t.id WHERE kind = 'risk'),
pii_found AS (SELECT *, CASE WHEN state = 'ok' THEN given_types ELSE
    {items_sql('raw', rs.TYPE_PATTERNS, 3)} || list_filter({named_types_sql('raw')}, lambda t: NOT list_contains({items_sql('raw', rs.TYPE_PATTERNS, 3)}, t)) END AS names,
  CASE WHEN state = 'ok' THEN CASE WHEN ct = 'VARCHAR' AND cs IN ('PC0', 'PC1', 'PC3') THEN cs ELSE {keyword_pc_sql('text')} END
    ELSE coalesce(upper({first_match_sql('raw', rs.PC_PATTERNS)}), {keyword_pc_sql('raw')}) END AS found_pc FROM stated WHERE kind <> 'risk'),
pii_out AS (SELECT *, list_filter(string_split({normalise_types_sql('names')}, '|'), lambda t: t <> '') AS types FROM pii_found),
results AS (
SELECT id, CASE state WHEN 'empty' THEN false WHEN 'error' THEN false WHEN 'fallback' THEN text_l2 IS NOT NULL ELSE true END AS success,
  CASE WHEN state <> 'error' THEN 'risk' END AS type,
  CASE state WHEN 'empty' THEN 'Could not determine' WHEN 'ok' THEN ls WHEN 'fallback' THEN text_l2 END AS l2_category,
  CASE state WHEN 'empty' THEN '' WHEN 'error' THEN NULL ELSE array_to_string(risks, '|') END AS macro_risks,
  CAST(NULL AS VARCHAR) AS pc_category, CAST(NULL AS VARCHAR) AS pii_types,
  CASE state WHEN 'empty' THEN 'Model returned empty response' WHEN 'error' THEN 'macro_risks is not a list' END AS error,
  CASE state WHEN 'empty' THEN 'empty_response' WHEN 'fallback' THEN 'text_fallback' WHEN 'ok' THEN 'json' END AS parsing_method,
  CASE state WHEN 'empty' THEN raw WHEN 'fallback' THEN plain END AS raw_response, text AS input_text FROM risk_out
UNION ALL
SELECT id, state IN ('ok', 'fallback'), CASE WHEN state <> 'error' THEN 'pii' END, NULL, NULL,
  CASE state WHEN 'empty' THEN 'Could not determine' WHEN 'error' THEN NULL ELSE {upgrade_sql('found_pc', 'types')} END,
  CASE state WHEN 'empty' THEN '' WHEN 'error' THEN NULL ELSE array_to_string(types, '|') END,
  CASE state WHEN 'empty' THEN 'Model returned empty response' WHEN 'error' THEN 'pii_types is not a list of names' END,
  CASE state WHEN 'empty' THEN 'empty_response' WHEN 'fallback' THEN 'text_fallback' WHEN 'ok' THEN 'json' END,
  CASE WHEN state <> 'error' THEN raw END, text FROM pii_out)"""


def results(spark, sf):
    parsed = ro.parsed_fields(fixture(spark, sf, "responses_fx"))
    return parsed.drop("response").withColumns(
        {"macro_risks": F.array_join("macro_risks", "|"), "pii_types": F.array_join("pii_types", "|")}
    )


def _case(name: str, where: str, columns: list[str]):
    picked = ", ".join(["id", *columns])

    @query(name, f"{RESULTS} SELECT {picked} FROM results WHERE {where}")
    def run(spark, sf):
        return results(spark, sf).where(where).select("id", *columns)

    return run


@query("r1_extract_json", f"SELECT id, {JSON_SQL} AS json, json_valid({JSON_SQL}) AS valid FROM {FX} WHERE {JSON_SQL} IS NOT NULL")
def r1(spark, sf):
    found = fixture(spark, sf, "responses_fx").select("id", rs.extract_json(F.col("response")).alias("json"))
    return found.where(F.col("json").isNotNull()).withColumn("valid", F.try_parse_json("json").isNotNull())


_case("r2_parse_risk_json", "type = 'risk' AND parsing_method = 'json'", ["success", "l2_category", "macro_risks"])
_case("r3_parse_risk_text", "type = 'risk' AND parsing_method = 'text_fallback'", ["success", "l2_category", "macro_risks", "raw_response"])
_case("r4_parse_pii_json", "type = 'pii' AND parsing_method = 'json'", ["success", "pc_category", "pii_types"])
_case("r5_parse_pii_text", "type = 'pii' AND parsing_method = 'text_fallback'", ["success", "pc_category", "pii_types"])
_case("r6_empty_response", "parsing_method = 'empty_response'", ["success", "type", "l2_category", "pc_category", "error", "raw_response"])
_case("r8_result_envelope", "id >= 0", [c for c in ro.RESULT_FIELDS])


@query(
    "r3_text_patterns",
    f"""SELECT id, {trim_sql(first_match_sql('response', rs.L2_PATTERNS))} AS l2, array_to_string({items_sql('response', rs.RISK_PATTERNS, 4)}, '~') AS items FROM {FX}""",
)
def r3_patterns(spark, sf):
    text = F.col("response")
    return fixture(spark, sf, "responses_fx").select(
        "id", rs.l2_in_text(text).alias("l2"), F.array_join(rs.risks_in_text(text), "~").alias("items")
    )


@query(
    "r3_text_patterns_documents",
    f"""SELECT doc_id, {trim_sql(first_match_sql('text', rs.L2_PATTERNS))} AS l2, array_to_string({items_sql('text', rs.RISK_PATTERNS, 4)}, '~') AS items FROM documents""",
)
def r3_documents(spark, sf):
    text = F.col("text")
    return table(spark, sf, "documents").select(
        "doc_id", rs.l2_in_text(text).alias("l2"), F.array_join(rs.risks_in_text(text), "~").alias("items")
    )


@query(
    "r5_text_patterns",
    f"""SELECT id, coalesce(upper({first_match_sql('response', rs.PC_PATTERNS)}), {keyword_pc_sql('response')}) AS pc_category,
trim({normalise_types_sql(items_sql('response', rs.TYPE_PATTERNS, 3) + ' || list_filter(' + named_types_sql('response') + ', lambda t: NOT list_contains(' + items_sql('response', rs.TYPE_PATTERNS, 3) + ', t))')}, '|') AS pii_types FROM {FX}""",
)
def r5_patterns(spark, sf):
    text = F.col("response")
    return fixture(spark, sf, "responses_fx").select(
        "id", rs.pc_in_text(text).alias("pc_category"), F.array_join(rs.types_in_text(text), "|").alias("pii_types")
    )


@query(
    "r7_risk_cap",
    f"""{RESULTS} SELECT CAST(len(list_filter(string_split(macro_risks, '|'), lambda r: r <> '')) AS BIGINT) AS n_risks, CAST(count(*) AS BIGINT) AS n
FROM results WHERE type = 'risk' GROUP BY 1""",
)
def r7(spark, sf):
    parsed = ro.parsed_fields(fixture(spark, sf, "responses_fx"))
    return (
        parsed.where("type = 'risk'")
        .groupBy(F.size("macro_risks").cast("bigint").alias("n_risks"))
        .agg(F.count("*").alias("n"))
    )


A1_SQL = f"""{RESULTS} SELECT CAST(count(*) AS BIGINT) AS total_texts, CAST(count(*) FILTER (WHERE type = 'risk') AS BIGINT) AS risk_texts,
CAST(count(*) FILTER (WHERE type = 'pii') AS BIGINT) AS pii_texts, CAST(count(*) FILTER (WHERE success) AS BIGINT) AS successful_analyses FROM results"""


@query("a1_batch_summary", A1_SQL)
def a1(spark, sf):
    return rp.batch_summary(ro.parsed_fields(fixture(spark, sf, "responses_fx")))
