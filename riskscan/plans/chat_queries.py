"""Registered queries for prompts, chats and the split: G1-G8."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskscan.functions import prompts as pr
from riskscan.functions.classify import route_text
from riskscan.operators import chat as ch
from riskscan.operators import ddl as dd
from riskscan.operators import findings as fd
from riskscan.operators.privacy import privacy_examples
from riskscan.plans.fixtures import fixture, fixture_sql
from riskscan.plans.matching_queries import PRIVACY_CTE, labelled_privacy
from riskscan.plans.registry import query, quote, table, trim_sql, values_sql
from riskscan.plans.report_queries import EXAMPLES_SQL
from riskscan.plans.schema_queries import FLAGGED, NAME_SQL, RECOMMENDED, STATEMENTS
from riskscan.plans.text_queries import route_sql
from riskscan.taxonomy import DEFAULT

ALL = pr.render_taxonomy("all")

# --------------------------------------------------------------------------
# Oracle pieces
# --------------------------------------------------------------------------


def json_list_sql(items: str, indent: int) -> str:
    pad, end = " " * (indent + 2), " " * indent
    body = f"array_to_string(list_transform({items}, lambda x: CAST(to_json(x) AS VARCHAR)), ',' || chr(10) || '{pad}')"
    return f"CASE WHEN len({items}) = 0 THEN '[]' ELSE '[' || chr(10) || '{pad}' || {body} || chr(10) || '{end}]' END"


def chat_sql(kind: str, system: str, question: str, text: str, fmt: str, answer: str) -> str:
    """All five messages as role=content, joined by a line of dashes."""
    turns = [
        ("system", quote(system.format(categories=ALL))),
        ("user", f"{quote(question)} || {text} || {quote(pr.KIND_QUESTION)}"),
        ("assistant", quote(pr.KIND_ANSWERS[kind])),
        ("user", quote(fmt)),
        ("assistant", answer),
    ]
    return " || '----' || ".join(f"'{role}=' || ({content})" for role, content in turns)


def _flat(messages: str):
    return F.array_join(F.transform(messages, lambda m: F.concat(m["role"], F.lit("="), m["content"])), "----")


def _examples(spark, sf):
    return fd.raw_to_examples(fixture(spark, sf, "findings_fx"), keep=["id"])


RISK_ANSWER = (
    "'{' || chr(10) || '  \"l2_category\": \"' || l2_category || '\",' || chr(10) || '  \"macro_risks\": ' || "
    + json_list_sql("macro_risks", 0)
    + " || chr(10) || '}'"
)
PII_ANSWER = (
    "'{' || chr(10) || '  \"pc_category\": \"' || pc || '\",' || chr(10) || '  \"pii_types\": ' || "
    + json_list_sql("types", 0)
    + " || chr(10) || '}'"
)


NL = "chr(10)"
G1_SQL = f"""WITH l2(ord, l2_key, name) AS ({values_sql([(i, k, n) for i, (k, n) in enumerate(DEFAULT.l2.items())])}),
risk(ord, l2_key, name) AS ({values_sql([(i, k, r) for k, rs in DEFAULT.macro_risks.items() for i, r in enumerate(rs)])}),
pc(ord, pc_category, description) AS ({values_sql([(i, k, v) for i, (k, v) in enumerate(DEFAULT.protection.items())])}),
pii(ord, name) AS ({values_sql(list(enumerate(DEFAULT.pii_types)))}),
listed AS (SELECT l2.ord, l2.l2_key, any_value(l2.name) AS name, string_agg(risk.name, ', ' ORDER BY risk.ord) AS risks,
  string_agg('   - ' || risk.name, {NL} ORDER BY risk.ord) AS points FROM l2 JOIN risk ON l2.l2_key = risk.l2_key GROUP BY l2.ord, l2.l2_key),
parts AS (SELECT (SELECT string_agg(l2_key || '. ' || name, {NL} ORDER BY ord) FROM l2) AS labels,
  (SELECT string_agg(l2_key || ': ' || risks, {NL} ORDER BY ord) FROM listed) AS risks,
  (SELECT string_agg({NL} || l2_key || '. ' || name || ':' || {NL} || points, {NL} ORDER BY ord) FROM listed) AS points,
  (SELECT string_agg(pc_category || ': ' || description, {NL} ORDER BY ord) FROM pc) AS levels,
  (SELECT string_agg(name, ', ' ORDER BY ord) FROM pii) AS types, (SELECT string_agg('- ' || name, {NL} ORDER BY ord) FROM pii) AS bullets),
rendered AS (
  SELECT 'risk' AS kind, concat_ws({NL}, 'L2 Risk Categories:', labels, '', 'Macro Risks:', risks, '') AS taxonomy FROM parts
  UNION ALL SELECT 'pii', concat_ws({NL}, 'PII Protection Categories:', levels, '', 'Common PII Types: ' || types, '') FROM parts
  UNION ALL SELECT 'all', concat_ws({NL}, 'PART 1: SECURITY RISK CATEGORIES', '', 'L2 Categories:', labels, '',
    'Macro Risks for each L2 Category:', points, '', '', 'PART 2: PII PROTECTION CATEGORIES', '', 'PII Protection Categories:',
    levels, '', 'Common PII Types:', bullets, '') FROM parts),
routed AS (SELECT {route_sql('text')} AS kind FROM documents),
counted AS (SELECT kind, count(*) AS n FROM routed GROUP BY kind UNION ALL SELECT 'all', count(*) FROM routed)
SELECT kind, CAST(n AS BIGINT) AS n, taxonomy FROM counted JOIN rendered USING (kind)"""


@query("g1_render_taxonomy", G1_SQL)
def g1(spark, sf):
    """The categories that go into the prompt of every document, by the kind it is routed to, and of all."""
    routed = table(spark, sf, "documents").select(route_text(F.col("text")).alias("kind"))
    counted = routed.rollup("kind").agg(F.count("*").alias("n")).fillna("all", ["kind"])
    rendered = F.lit(None).cast("string")
    for kind in ("risk", "pii", "all"):
        rendered = F.when(F.col("kind") == kind, F.lit(pr.render_taxonomy(kind))).otherwise(rendered)
    return counted.withColumn("taxonomy", rendered)


@query(
    "g2_risk_chat",
    f"SELECT id, {chat_sql('risk', pr.RISK_SYSTEM, pr.RISK_QUESTION, 'text', pr.RISK_FORMAT, RISK_ANSWER)} AS chat FROM ({EXAMPLES_SQL})",
)
def g2(spark, sf):
    chats = ch.format_chat(_examples(spark, sf))
    return chats.select("id", _flat("messages").alias("chat"))


@query(
    "g3_pii_chat",
    f"""{PRIVACY_CTE} SELECT id AS ID, {chat_sql('pii', pr.PII_SYSTEM, pr.PII_QUESTION, 'text', pr.PII_FORMAT, PII_ANSWER)} AS chat
FROM typed WHERE len(types) > 0""",
)
def g3(spark, sf):
    chats = ch.format_chat(privacy_examples(labelled_privacy(spark, sf), keep=["ID"]))
    return chats.select("ID", _flat("messages").alias("chat"))


@query(
    "g4_ddl_chat",
    f"""{STATEMENTS} SELECT f.stmt_id, CAST(5 AS BIGINT) AS n_messages, {quote(pr.DDL_QUESTION)} || {trim_sql('f.ddl')} || {quote(pr.KIND_QUESTION)} AS question,
{NAME_SQL} AS table_name, overall AS overall_classification, review AS requires_human_review, {FLAGGED} AS flags,
array_to_string({RECOMMENDED}[1:3], '|') AS advice FROM {fixture_sql('ddl_fx')} f JOIN stmt s ON f.stmt_id = s.stmt_id""",
)
def g4(spark, sf):
    """The answer is read back as JSON, so its form is checked as well."""
    analyzed = dd.analyze_ddl(fixture(spark, sf, "ddl_fx"))
    chats = ch.format_chat(dd.ddl_examples(analyzed))
    answer = F.from_json(
        F.col("messages")[4]["content"],
        "table_name string, overall_classification string, requires_human_review boolean, "
        "compliance_flags array<string>, privacy_recommendations array<string>",
    )
    read = chats.withColumn("_a", answer)
    return read.select(
        "stmt_id", F.size("messages").cast("bigint").alias("n_messages"), F.col("messages")[1]["content"].alias("question"),
        "_a.table_name", "_a.overall_classification", "_a.requires_human_review",
        F.array_join("_a.compliance_flags", "|").alias("flags"),
        F.array_join("_a.privacy_recommendations", "|").alias("advice"),
    )


@query(
    "g5_chat_counts",
    f"""{PRIVACY_CTE} SELECT 'risk' AS type, CAST(count(*) AS BIGINT) AS formatted, CAST(0 AS BIGINT) AS dropped FROM ({EXAMPLES_SQL})
UNION ALL SELECT 'pii', CAST(count(*) AS BIGINT), 0 FROM typed WHERE len(types) > 0
UNION ALL SELECT 'ddl', CAST(count(*) AS BIGINT), 0 FROM part
UNION ALL SELECT 'other', 0, CAST(count(*) AS BIGINT) FROM supplier""",
)
def g5(spark, sf):
    unknown = table(spark, sf, "supplier").select(F.lit("other").alias("type"), F.col("s_name").alias("text"))
    examples = ch.union_examples(
        _examples(spark, sf).drop("id"),
        privacy_examples(labelled_privacy(spark, sf)),
        dd.ddl_examples(dd.analyze_ddl(fixture(spark, sf, "ddl_fx"))).drop("stmt_id"),
        unknown,
    )
    return ch.chat_counts(ch.format_chat(examples))


def _render_oracle(separator: str, ending: str) -> str:
    line = (
        f"CASE role WHEN 'system' THEN 'System: ' || text || {separator} WHEN 'user' THEN 'User: ' || text || {separator} "
        f"WHEN 'assistant' THEN 'Assistant: ' || text || {separator} ELSE '' END"
    )
    return f"SELECT conv_id, {ending.format(f'''string_agg({line}, '' ORDER BY turn)''')} AS chat FROM conversations GROUP BY conv_id"


def _conversations(spark, sf):
    turns = table(spark, sf, "conversations")
    listed = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", F.col("text").alias("content")))).alias("t"))
    return listed.select("conv_id", F.transform("t", lambda m: F.struct(m["role"], m["content"])).alias("messages"))


@query("g6_render_chat_training", _render_oracle("chr(10)", "{}"))
def g6_training(spark, sf):
    return _conversations(spark, sf).select("conv_id", pr.render_chat(F.col("messages")).alias("chat"))


@query("g6_render_chat_inference", _render_oracle("chr(10) || chr(10)", trim_sql("{}")))
def g6_inference(spark, sf):
    return _conversations(spark, sf).select("conv_id", pr.render_chat(F.col("messages"), "\n\n").alias("chat"))


RISK_HEAD = "User: " + pr.RISK_PROMPT.format(categories=pr.render_taxonomy("risk"))
PII_HEAD = "User: " + pr.PII_PROMPT.format(categories=pr.render_taxonomy("pii"))


@query(
    "g7_inference_prompts",
    f"""SELECT id, CASE WHEN {route_sql('text')} = 'risk' THEN {quote(RISK_HEAD)} || text || {quote(pr.RISK_PROMPT_END)}
ELSE {quote(PII_HEAD)} || text || {quote(pr.PII_PROMPT_END)} END AS prompt FROM {fixture_sql('pii_fx')}""",
)
def g7(spark, sf):
    routed = fixture(spark, sf, "pii_fx").withColumn("type", route_text(F.col("text")))
    return ch.add_prompts(routed).select("id", "prompt")


@query(
    "g8_split_exact",
    """SELECT 'train' AS split, CAST(floor(count(*) * 0.9) AS BIGINT) AS n, CAST(0 AS BIGINT) AS in_both FROM orders
UNION ALL SELECT 'eval', CAST(count(*) - floor(count(*) * 0.9) AS BIGINT), 0 FROM orders""",
)
def g8(spark, sf):
    split = ch.split_examples(table(spark, sf, "orders").select("o_orderkey"), "o_orderkey", exact=True)
    by_id = split.groupBy("o_orderkey").agg(F.min("split").alias("split"), F.max("split").alias("other"))
    return by_id.groupBy("split").agg(F.count("*").alias("n"), F.count_if(F.col("split") != F.col("other")).alias("in_both"))


@query(
    "g8_split_by_digest",
    """SELECT o_orderkey, CASE WHEN row_number() OVER (ORDER BY substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 15), o_orderkey)
  <= floor(count(*) OVER () * 0.9) THEN 'train' ELSE 'eval' END AS split FROM orders""",
)
def g8_digest(spark, sf):
    """Every id in its part: an exact split in the order of a digest that other engines have too."""
    digest = F.conv(F.substring(F.md5(F.col("o_orderkey").cast("string").cast("binary")), 1, 15), 16, 10).cast("long")
    return ch.split_examples(table(spark, sf, "orders").select("o_orderkey"), "o_orderkey", exact=True, order=digest)


@query("g8_split_hash", "SELECT o_orderkey FROM orders")
def g8_hash(spark, sf):
    """Both parts together are the whole table, without overlap."""
    split = ch.split_examples(table(spark, sf, "orders").select("o_orderkey"), "o_orderkey")
    train, held_out = split.where("split = 'train'"), split.where("split = 'eval'")
    return train.unionAll(held_out).select("o_orderkey")


