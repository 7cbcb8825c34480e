"""Registered queries for texts: S4, P1-P11, P15, C1-C10."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskscan.functions import classify as cl
from riskscan.functions import text as tx
from riskscan.operators import findings as fd
from riskscan.operators import texts as tt
from riskscan.plans.fixtures import fixture, fixture_sql
from riskscan.plans.registry import (
    SQL_BLANK,
    SQL_WORD,
    any_sql,
    count_sql,
    list_sql,
    query,
    quote,
    table,
    trim_sql,
    values_sql,
)
from riskscan.sources import readers as rd
from riskscan.taxonomy import DEFAULT

# --------------------------------------------------------------------------
# Oracle pieces
# --------------------------------------------------------------------------


def clean_sql(c: str) -> str:
    t = trim_sql(c)
    t = rf"regexp_replace({t}, '[{SQL_BLANK}]+', ' ', 'g')"
    t = rf"regexp_replace({t}, '[^{SQL_WORD}{SQL_BLANK}\-.,;:?!()]', ' ', 'g')"
    t = rf"regexp_replace({t}, '\([{SQL_BLANK}]*\)', '', 'g')"
    return f"coalesce({trim_sql(t)}, '')"


def meaningful_sql(c: str) -> str:
    t = trim_sql(c)
    return (
        f"coalesce(length({t}) >= 3 AND regexp_matches({t}, '[{SQL_WORD}]') "
        rf"AND NOT regexp_matches({t}, '^[\p{{Nd}}²³¹⁰⁴-⁹₀-₉]+$'), false)"
    )


def part_sql(label: str, c: str) -> str:
    return f"CASE WHEN {meaningful_sql(c)} THEN {quote(label + ': ')} || {clean_sql(c)} END"


def split_sql(c: str) -> str:
    cases = " ".join(
        f"WHEN contains({c}, {d}) THEN list_transform(string_split({c}, {d}), lambda p: {trim_sql('p')})"
        for d in ("','", "';'", "'|'", "chr(10)")
    )
    return f"CASE WHEN {c} IS NULL OR {c} = '' THEN ['UNSPECIFIED'] {cases} ELSE [{trim_sql(c)}] END"


_NOT_W, _W = f"[^{SQL_WORD}]", f"[{SQL_WORD}]"
_D = r"\p{Nd}"
_START, _END = f"(?:^|{_NOT_W})", f"(?:$|{_NOT_W})"
PATTERN_SQL = {
    "SSN": rf"{_START}{_D}{{3}}[-.]?{_D}{{2}}[-.]?{_D}{{4}}{_END}",
    "Email": (
        rf"(?:{_START}[A-Za-z0-9_][A-Za-z0-9._%+-]*|{_W}[.%+-][A-Za-z0-9._%+-]*)@[A-Za-z0-9.-]+\."
        rf"(?:[A-Z|a-z]+[A-Za-z]{_END}|[A-Z|a-z]+\|{_W})"
    ),
    "Phone": rf"{_START}{_D}{{3}}[-.]?{_D}{{3}}[-.]?{_D}{{4}}{_END}",
    "Address": (
        rf"{_START}{_D}{{1,5}}[{SQL_BLANK}]+[A-Za-z{SQL_BLANK}]{{2,30}}[{SQL_BLANK}]+"
        rf"(?:St|Street|Ave|Avenue|Rd|Road|Blvd|Boulevard){_END}"
    ),
    "DOB": rf"{_START}(?:19|20){_D}{{2}}[-/]{_D}{{1,2}}[-/]{_D}{{1,2}}{_END}",
}


def scan_sql(source: str, key: str = "id", text: str = "text") -> str:
    """(key, pc_category, pii_types list, tenths) of C5, straight from the rules."""
    low = f"lower({text})"
    named = [f"CAST(contains({low}, {quote(t.lower())}) AS BIGINT) AS n{i}" for i, t in enumerate(DEFAULT.pii_types)]
    shaped = [f"CAST(regexp_matches({text}, '{p}') AS BIGINT) AS r_{t}" for t, p in PATTERN_SQL.items()]
    index = {t: i for i, t in enumerate(DEFAULT.pii_types)}
    found = {t: f"(n{i} + r_{t} > 0)" if t in PATTERN_SQL else f"(n{i} > 0)" for t, i in index.items()}
    types = ", ".join(f"CASE WHEN {found[t]} THEN {quote(t)} END" for t in DEFAULT.pii_types)
    total = "2 * (" + " + ".join(f"n{i}" for i in index.values()) + ") + 3 * ("
    total += " + ".join(f"r_{t}" for t in PATTERN_SQL) + ")"
    high = " OR ".join(found[t] for t in ("SSN", "Financial", "Health", "DOB"))
    return f"""
SELECT {key}, CASE WHEN {high} THEN 'PC3' WHEN {total} > 0 THEN 'PC1' ELSE 'PC0' END AS pc_category,
  list_filter([{types}], lambda t: t IS NOT NULL) AS pii_types,
  CASE WHEN {high} THEN least(10, {total} + 4) WHEN {total} > 0 THEN least(10, {total} + 2) ELSE 1 END AS tenths
FROM (SELECT {key}, {', '.join(named)}, {', '.join(shaped)} FROM {source} WHERE {text} IS NOT NULL)"""


def scan_out_sql(source: str, key: str) -> str:
    return f"""SELECT {key}, pc_category, array_to_string(pii_types, '|') AS pii_types, round(tenths / 10.0, 2) AS confidence
FROM ({scan_sql(source, key)})"""


def route_sql(text: str) -> str:
    low = f"lower({text})"
    risk, pii = count_sql(low, cl.ROUTE_RISK_WORDS), count_sql(low, cl.ROUTE_PII_WORDS)
    return (
        f"CASE WHEN {any_sql(low, cl.ROUTE_PII_OVERRIDE)} THEN 'pii' WHEN {risk} > {pii} THEN 'risk' "
        f"WHEN {pii} > 0 THEN 'pii' ELSE 'risk' END"
    )


def keyword_pc_sql(text: str) -> str:
    low = f"lower({text})"
    return (
        f"CASE WHEN {any_sql(low, DEFAULT.pii_keywords['PC3'])} THEN 'PC3' "
        f"WHEN {any_sql(low, DEFAULT.pii_keywords['PC1'])} THEN 'PC1' ELSE 'PC0' END"
    )


def _scan_out(df, key: str):
    return df.select(
        key, "pc_category", F.array_join("pii_types", "|").alias("pii_types"), F.round("confidence", 2).alias("confidence")
    )


# --------------------------------------------------------------------------
# Texts from lines, JSON lines, JSON documents and tables
# --------------------------------------------------------------------------


@query(
    "s4a_texts_from_lines",
    f"""SELECT {trim_sql('line')} AS text FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents)
WHERE {trim_sql('line')} <> ''""",
)
def s4a(spark, sf):
    lines = table(spark, sf, "documents").select(F.explode(F.split("text", "\n")).alias("value"))
    return rd.texts_from_lines(lines)


@query(
    "s4b_texts_from_jsonl",
    """SELECT text FROM documents WHERE doc_id % 6 IN (0, 1, 4) AND text <> ''""",
)
def s4b(spark, sf):
    docs = table(spark, sf, "documents")
    kind = F.col("doc_id") % 6
    line = (
        F.when(kind == 0, F.to_json(F.struct("text")))
        .when(kind == 1, F.to_json(F.struct(F.col("text").alias("description"), F.lit("other").alias("content"))))
        .when(kind == 2, F.lit('{"text": null, "description": "not used"}'))
        .when(kind == 3, F.concat(F.lit('{"text": '), F.col("text")))
        .when(kind == 4, F.to_json(F.struct(F.col("text").alias("content"), F.col("lang"))))
        .otherwise(F.lit("  "))
    )
    return rd.texts_from_jsonl(docs.select(line.alias("value")))


@query(
    "s4c_texts_from_json",
    """SELECT text FROM documents WHERE text <> ''
UNION ALL SELECT 'about ' || doc_id FROM documents WHERE doc_id % 2 = 0""",
)
def s4c(spark, sf):
    docs = table(spark, sf, "documents")
    one = F.to_json(F.struct(F.col("text").alias("description")))
    about = F.to_json(F.struct(F.concat(F.lit("about "), F.col("doc_id").cast("string")).alias("content")))
    many = F.concat(F.lit("["), one, F.lit(', 5, "loose", {"title": "x"}, '), about, F.lit("]"))
    return rd.texts_from_json(docs.select(F.when(F.col("doc_id") % 2 == 0, many).otherwise(one).alias("value")))


@query("s4d_texts_from_table", "SELECT text FROM conversations WHERE text IS NOT NULL")
def s4d(spark, sf):
    return rd.texts_from_table(table(spark, sf, "conversations"))


# --------------------------------------------------------------------------
# P: cleaning and assembly
# --------------------------------------------------------------------------


@query("p1_clean_text", f"SELECT doc_id, {clean_sql('text')} AS clean FROM documents")
def p1(spark, sf):
    return table(spark, sf, "documents").select("doc_id", tx.clean_text(F.col("text")).alias("clean"))


@query("p1_clean_html", f"SELECT page_id, {clean_sql('html')} AS clean FROM pages")
def p1_html(spark, sf):
    return table(spark, sf, "pages").select("page_id", tx.clean_text(F.col("html")).alias("clean"))


@query(
    "p2_is_meaningful",
    f"""SELECT id, {meaningful_sql('Title')} AS title_ok, {meaningful_sql('Description')} AS description_ok,
{meaningful_sql('CAST(id AS VARCHAR)')} AS id_ok FROM {fixture_sql('findings_fx')}""",
)
def p2(spark, sf):
    return fixture(spark, sf, "findings_fx").select(
        "id",
        tx.is_meaningful(F.col("Title")).alias("title_ok"),
        tx.is_meaningful(F.col("Description")).alias("description_ok"),
        tx.is_meaningful(F.col("id").cast("string")).alias("id_ok"),
    )


@query(
    "p2_meaningful_lines",
    f"""SELECT doc_id, CAST(count(*) AS BIGINT) AS lines, CAST(count(*) FILTER (WHERE {meaningful_sql('line')}) AS BIGINT) AS meaningful
FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents) GROUP BY doc_id""",
)
def p2_lines(spark, sf):
    lines = table(spark, sf, "documents").select("doc_id", F.split("text", "\n").alias("lines"))
    return lines.select(
        "doc_id",
        F.size("lines").cast("bigint").alias("lines"),
        F.size(F.filter("lines", tx.is_meaningful)).cast("bigint").alias("meaningful"),
    )


@query(
    "p3_first_meaningful",
    f"""SELECT id, coalesce(CASE WHEN {meaningful_sql('Title')} THEN {clean_sql('Title')} END,
CASE WHEN {meaningful_sql('Description')} THEN {clean_sql('Description')} END) AS first_text FROM {fixture_sql('findings_fx')}""",
)
def p3(spark, sf):
    cells = [F.col("Title"), F.col("Description")]
    return fixture(spark, sf, "findings_fx").select("id", tx.first_meaningful(cells).alias("first_text"))


def assembled_sql(labels: bool) -> str:
    parts = [part_sql("Finding", "Title"), part_sql("Description", "Description")]
    parts += [part_sql(c, c) for c in (["L2", "Risks"] if labels else []) + ["Origin"]]
    return f"nullif(concat_ws(chr(10) || chr(10), {', '.join(parts)}), '')"


@query(
    "p4_assemble_text",
    f"SELECT * FROM (SELECT id, {assembled_sql(False)} AS text FROM {fixture_sql('findings_fx')}) WHERE text IS NOT NULL",
)
def p4(spark, sf):
    raw = fixture(spark, sf, "findings_fx")
    return fd.raw_to_examples(raw, exclude_label_columns=True, keep=["id"]).select("id", "text")


@query(
    "p5_residual_columns",
    f"SELECT * FROM (SELECT id, {assembled_sql(True)} AS text FROM {fixture_sql('findings_fx')}) WHERE text IS NOT NULL",
)
def p5(spark, sf):
    return fd.raw_to_examples(fixture(spark, sf, "findings_fx"), keep=["id"]).select("id", "text")


@query("p6_raw_label", f"SELECT id, coalesce(nullif(L2, ''), 'UNKNOWN') AS label FROM {fixture_sql('findings_fx')}")
def p6(spark, sf):
    return fixture(spark, sf, "findings_fx").select("id", tx.raw_label([F.col("L2")]).alias("label"))


@query(
    "p7_split_labels",
    f"SELECT id, array_to_string({split_sql('Risks')}, '~') AS labels FROM {fixture_sql('findings_fx')}",
)
def p7(spark, sf):
    labels = F.array_join(tx.split_labels(F.col("Risks")), "~")
    return fixture(spark, sf, "findings_fx").select("id", labels.alias("labels"))


@query(
    "p8_map_columns",
    f"""SELECT id AS ID, Title AS FINDING_TITLE, Description AS FINDING_DESCRIPTION, L2, Risks AS MACRO_RISKS,
Origin AS ORIGIN FROM {fixture_sql('findings_fx')}""",
)
def p8(spark, sf):
    raw = fixture(spark, sf, "findings_fx")
    # "Issue" is the alias of the title, "details" of the description, "Risk_Classification" of L2 (not of risks).
    return fd.map_columns(raw.toDF("id", " Issue", "details", "Risk_Classification", "Risk_Tags", "Origin "))


def _text_test_sql(source: str, column: str, key: str) -> str:
    return f"""SELECT {quote(source + '.' + column)} AS name, min(length(v)) > 10 AS is_text
FROM (SELECT {column} AS v FROM {source} WHERE {column} IS NOT NULL ORDER BY {key} LIMIT 10)"""


@query(
    "p9_text_columns",
    " UNION ALL ".join(
        _text_test_sql(*case)
        for case in [
            ("documents", "text", "doc_id"), ("documents", "lang", "doc_id"), ("documents", "source", "doc_id"),
            ("pages", "url", "page_id"), ("pages", "html", "page_id"),
            ("customer", "c_name", "c_custkey"), ("customer", "c_mktsegment", "c_custkey"),
        ]
    ),
)
def p9(spark, sf):
    rows = []
    for source, key in (("documents", "doc_id"), ("pages", "page_id"), ("customer", "c_custkey")):
        df = table(spark, sf, source)
        found = fd.detect_text_columns(df, order_by=key)
        strings = [f.name for f in df.schema if f.dataType.typeName() == "string"]
        rows += [(f"{source}.{c}", c in found) for c in strings]
    return spark.createDataFrame(rows, "name string, is_text boolean")


def context_sql() -> str:
    title, text = clean_sql("Title"), clean_sql("Description")
    primary = (
        f"nullif(concat_ws(chr(10) || chr(10), CASE WHEN {meaningful_sql(title)} THEN 'Finding: ' || {title} END, "
        f"CASE WHEN {meaningful_sql(text)} THEN 'Description: ' || {text} END), '')"
    )
    return f"coalesce({primary}, {part_sql('ORIGIN', 'Origin')})"


@query(
    "p10_findings_context",
    f"SELECT id AS ID, {context_sql()} AS context, {context_sql()} IS NULL AS empty_data FROM {fixture_sql('findings_fx')}",
)
def p10(spark, sf):
    mapped = fd.map_columns(fixture(spark, sf, "findings_fx"))
    context = mapped.select("ID", fd.findings_context(mapped, ["ORIGIN"]).alias("context"))
    return context.withColumn("empty_data", F.col("context").isNull())


@query("p11_dedupe_texts", f"SELECT DISTINCT text FROM documents WHERE {trim_sql('text')} <> ''")
def p11(spark, sf):
    return tt.dedupe_texts(table(spark, sf, "documents"))


@query("p11_dedupe_fixture", f"SELECT DISTINCT text FROM {fixture_sql('pii_lines_fx')} WHERE {trim_sql('text')} <> ''")
def p11_fx(spark, sf):
    return tt.dedupe_texts(fixture(spark, sf, "pii_lines_fx"))


@query(
    "p15_label_format",
    f"""SELECT id, {trim_sql("split_part(l2_category, '.', 1)")} AS l2_key,
{trim_sql("split_part(l2_category, '.', 1)")} || '. ' || risk_a AS label FROM {fixture_sql('claims_fx')}""",
)
def p15(spark, sf):
    key = tx.label_key(F.col("l2_category"))
    return fixture(spark, sf, "claims_fx").select(
        "id", key.alias("l2_key"), tx.format_label(key, F.col("risk_a")).alias("label")
    )


# --------------------------------------------------------------------------
# C: classification
# --------------------------------------------------------------------------


def _route_oracle(source: str, key: str) -> str:
    low = "lower(text)"
    return f"""SELECT {key}, {count_sql(low, cl.ROUTE_RISK_WORDS)} AS risk_score,
{count_sql(low, cl.ROUTE_PII_WORDS)} AS pii_score, {route_sql('text')} AS type FROM {source}"""


def _route(df, key):
    low = F.col("_low")
    risk, pii = cl.route_scores(low)
    scored = df.withColumn("_low", F.lower("text")).withColumns({"risk_score": risk, "pii_score": pii})
    kind = cl.route_by_scores(low, F.col("risk_score"), F.col("pii_score"))
    return scored.select(
        key, F.col("risk_score").cast("bigint").alias("risk_score"),
        F.col("pii_score").cast("bigint").alias("pii_score"), kind.alias("type"),
    )


@query("c1_route_documents", _route_oracle("documents", "doc_id"))
def c1(spark, sf):
    return _route(table(spark, sf, "documents"), "doc_id")


@query("c1_route_fixture", _route_oracle(fixture_sql("pii_fx"), "id"))
def c1_fx(spark, sf):
    return _route(fixture(spark, sf, "pii_fx"), "id")


@query("c2_pc_from_keywords", f"SELECT doc_id, {keyword_pc_sql('text')} AS pc_category FROM documents")
def c2(spark, sf):
    return table(spark, sf, "documents").select("doc_id", cl.pc_from_keywords(F.col("text")).alias("pc_category"))


@query("c2_pc_from_keywords_fixture", f"SELECT id, {keyword_pc_sql('text')} AS pc_category FROM {fixture_sql('pii_fx')}")
def c2_fx(spark, sf):
    return fixture(spark, sf, "pii_fx").select("id", cl.pc_from_keywords(F.col("text")).alias("pc_category"))


def upgrade_sql(pc: str, types: str) -> str:
    return (
        f"CASE WHEN list_has_any({types}, {list_sql(cl.UPGRADE_PC3)}) THEN 'PC3' "
        f"WHEN {pc} = 'PC0' AND list_has_any({types}, {list_sql(cl.UPGRADE_PC1)}) THEN 'PC1' ELSE {pc} END"
    )


@query(
    "c3_pc_upgrade",
    f"""SELECT s.id, {upgrade_sql('k.pc', 's.pii_types')} AS pc_category
FROM ({scan_sql(fixture_sql('pii_fx'))}) s
JOIN (SELECT id, {keyword_pc_sql('text')} AS pc FROM {fixture_sql('pii_fx')}) k ON s.id = k.id""",
)
def c3(spark, sf):
    scanned = tt.scan_texts(fixture(spark, sf, "pii_fx"))
    return scanned.select(
        "id", cl.pc_upgrade(cl.pc_from_keywords(F.col("text")), F.col("pii_types")).alias("pc_category")
    )


def normalise_types_sql(types: str) -> str:
    """C4 as a fold over the list of names: acc is the list of kept types as one |a|b| string."""
    known = list_sql(DEFAULT.pii_types)
    step = (
        f"CASE WHEN list_contains({known}, {trim_sql('x')}) "
        f"THEN CASE WHEN contains(acc, '|' || {trim_sql('x')} || '|') THEN acc ELSE acc || {trim_sql('x')} || '|' END "
        f"ELSE acc || coalesce(list_filter({known}, lambda k: contains(lower({trim_sql('x')}), lower(k)) "
        f"AND NOT contains(acc, '|' || k || '|'))[1] || '|', '') END"
    )
    return f"list_reduce({types}, lambda acc, x: {step}, '|')"


C4_NAMES = "[p_type, p_name, 'Work Email of ' || p_type, 'email', 'Email ', 'customer id / phone', 'SSN', 'ip address']"


@query(
    "c4_normalise_pii_types",
    f"SELECT p_partkey, trim({normalise_types_sql(C4_NAMES)}, '|') AS pii_types FROM part",
)
def c4(spark, sf):
    names = F.array(
        F.col("p_type"), F.col("p_name"), F.concat(F.lit("Work Email of "), F.col("p_type")), F.lit("email"),
        F.lit("Email "), F.lit("customer id / phone"), F.lit("SSN"), F.lit("ip address"),
    )
    kept = F.array_join(cl.normalise_pii_types(names), "|")
    return table(spark, sf, "part").select("p_partkey", kept.alias("pii_types"))


@query("c5_scan_documents", scan_out_sql("documents", "doc_id"))
def c5(spark, sf):
    return _scan_out(tt.scan_texts(table(spark, sf, "documents")), "doc_id")


@query("c5_scan_fixture", scan_out_sql(fixture_sql("pii_lines_fx"), "id"))
def c5_fx(spark, sf):
    return _scan_out(tt.scan_texts(fixture(spark, sf, "pii_lines_fx")), "id")


@query("c5_scan_pages", scan_out_sql("(SELECT page_id, html AS text FROM pages)", "page_id"))
def c5_pages(spark, sf):
    pages = table(spark, sf, "pages").select("page_id", F.col("html").alias("text"))
    return _scan_out(tt.scan_texts(pages), "page_id")


@query(
    "c5a_named_types",
    "SELECT doc_id, array_to_string(list_filter(["
    + ", ".join(f"CASE WHEN contains(lower(text), {quote(t.lower())}) THEN {quote(t)} END" for t in DEFAULT.pii_types)
    + "], lambda t: t IS NOT NULL), '|') AS named FROM documents",
)
def c5a(spark, sf):
    lowered = table(spark, sf, "documents").select("doc_id", F.lower("text").alias("_low"))
    return lowered.select("doc_id", F.array_join(cl.named_types(F.col("_low")), "|").alias("named"))


@query(
    "c5b_pattern_hits",
    "SELECT doc_id, " + ", ".join(f"regexp_matches(text, '{p}') AS {t.lower()}" for t, p in PATTERN_SQL.items())
    + " FROM documents",
)
def c5b(spark, sf):
    hits = cl.pattern_hits(F.col("text"))
    return table(spark, sf, "documents").select("doc_id", *[hit.alias(t.lower()) for t, hit in hits.items()])


@query(
    "c5b_pattern_values",
    rf"""SELECT id, array_to_string(regexp_extract_all(text, '\b\d{{3}}[-.]?\d{{2}}[-.]?\d{{4}}\b'), '|') AS ssn,
array_to_string(regexp_extract_all(text, '\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{{2,}}\b'), '|') AS email
FROM {fixture_sql('pii_fx')}""",
)
def c5b_values(spark, sf):
    text = F.col("text")
    return fixture(spark, sf, "pii_fx").select(
        "id",
        F.array_join(cl.pattern_values(text, "SSN"), "|").alias("ssn"),
        F.array_join(cl.pattern_values(text, "Email"), "|").alias("email"),
    )


@query(
    "c6_pc_from_classification",
    f"""SELECT id, CASE WHEN {any_sql('upper(c)', cl.PUBLIC_TERMS)} THEN 'PC0'
WHEN {any_sql('upper(c)', cl.CONFIDENTIAL_TERMS)} THEN 'PC3' ELSE 'PC1' END AS pc_category
FROM (SELECT id, PRIVACYTYPECLASSIFICATION AS c FROM {fixture_sql('privacy_fx')})""",
)
def c6(spark, sf):
    label = F.col("PRIVACYTYPECLASSIFICATION")
    return fixture(spark, sf, "privacy_fx").select("id", cl.pc_from_classification(label).alias("pc_category"))


@query(
    "c7_label_lookup",
    f"""SELECT k.id, k.pc AS pc_category, p.label AS privacy_label, s.label AS sensitivity_label
FROM (SELECT id, {keyword_pc_sql('text')} AS pc, 'DP' || ((id % 4) * 10) AS dp FROM {fixture_sql('pii_fx')}) k
LEFT JOIN ({values_sql(list(DEFAULT.privacy_labels.items()))}) p(pc, label) ON k.pc = p.pc
LEFT JOIN ({values_sql(list(DEFAULT.sensitivity_labels.items()))}) s(dp, label) ON k.dp = s.dp""",
)
def c7(spark, sf):
    rows = fixture(spark, sf, "pii_fx").select(
        "id", cl.pc_from_keywords(F.col("text")).alias("pc_category"),
        F.concat(F.lit("DP"), ((F.col("id") % 4) * 10).cast("string")).alias("dp"),
    )
    return rows.select(
        "id", "pc_category", cl.privacy_label(F.col("pc_category")).alias("privacy_label"),
        cl.sensitivity_label(F.col("dp")).alias("sensitivity_label"),
    )


C8_DIM = values_sql([(k, p) for k, phrases in DEFAULT.risk_keywords.items() for p in phrases])


@query(
    "c8_keyword_affinity",
    f"""SELECT id, l2_key, CAST(count(*) AS BIGINT) AS hits FROM {fixture_sql('pii_fx')}
JOIN ({C8_DIM}) d(l2_key, phrase) ON contains(lower(text), phrase) GROUP BY id, l2_key""",
)
def c8(spark, sf):
    hits = tt.keyword_affinity(fixture(spark, sf, "pii_fx"), "id")
    return hits.withColumn("hits", F.col("hits").cast("bigint"))


@query(
    "c8_keyword_affinity_documents",
    f"""SELECT doc_id, l2_key, CAST(count(*) AS BIGINT) AS hits FROM documents
JOIN ({C8_DIM}) d(l2_key, phrase) ON contains(lower(text), phrase) GROUP BY doc_id, l2_key""",
)
def c8_docs(spark, sf):
    hits = tt.keyword_affinity(table(spark, sf, "documents"), "doc_id")
    return hits.withColumn("hits", F.col("hits").cast("bigint"))


@query(
    "c9_choose_type",
    f"SELECT id, 'pii' AS forced, 'risk' AS single_task, {route_sql('text')} AS routed FROM {fixture_sql('pii_fx')}",
)
def c9(spark, sf):
    text = F.col("text")
    return fixture(spark, sf, "pii_fx").select(
        "id", cl.choose_type(text, force_type="pii").alias("forced"),
        cl.choose_type(text, task_type="risk").alias("single_task"), cl.choose_type(text).alias("routed"),
    )


def named_types_sql(text: str) -> str:
    cases = ", ".join(
        f"CASE WHEN {any_sql(f'lower({text})', words)} THEN {quote(t)} END" for t, words in cl.RESPONSE_TYPE_WORDS.items()
    )
    return f"list_filter([{cases}], lambda t: t IS NOT NULL)"


@query(
    "c10_types_named_in_response",
    f"SELECT id, array_to_string({named_types_sql('response')}, '|') AS named FROM {fixture_sql('responses_fx')}",
)
def c10(spark, sf):
    named = F.array_join(cl.types_named_in(F.col("response")), "|")
    return fixture(spark, sf, "responses_fx").select("id", named.alias("named"))


@query(
    "flagship_text_analysis",
    f"""SELECT d.doc_id, {route_sql('d.text')} AS type, {keyword_pc_sql('d.text')} AS keyword_pc, s.pc_category,
array_to_string(s.pii_types, '|') AS pii_types, round(s.tenths / 10.0, 2) AS confidence
FROM documents d JOIN ({scan_sql('documents', 'doc_id')}) s ON d.doc_id = s.doc_id""",
)
def flagship(spark, sf):
    """C1 + C2 + C5 over all documents: the model-free analysis."""
    out = tt.classify_texts(table(spark, sf, "documents"))
    return out.select(
        "doc_id", "type", "keyword_pc", "pc_category", F.array_join("pii_types", "|").alias("pii_types"),
        F.round("confidence", 2).alias("confidence"),
    )
