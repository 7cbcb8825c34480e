"""Registered queries for matching: F1-F12, and the findings built on it: P12, P13."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskscan.functions import matching as mt
from riskscan.functions import text as tx
from riskscan.functions.similarity import similarity_col
from riskscan.operators import findings as fd
from riskscan.operators import privacy as pv
from riskscan.plans.fixtures import fixture, fixture_sql
from riskscan.plans.registry import SQL_BLANK, SQL_WORD, list_sql, query, quote, table, trim_sql, values_sql, words_sql
from riskscan.plans.text_queries import context_sql, scan_sql
from riskscan.taxonomy import DEFAULT, str_array

# --------------------------------------------------------------------------
# Oracle: the fuzzy scores of distinct string pairs, from their definition
# --------------------------------------------------------------------------

L2_DIM = values_sql([(pos, key, name) for pos, (key, name) in enumerate(DEFAULT.l2.items())])
_RISKS = [(key, risk) for key, risks in DEFAULT.macro_risks.items() for risk in risks]
RISK_DIM = values_sql([(pos, key, risk) for pos, (key, risk) in enumerate(_RISKS)])
TYPE_DIM = values_sql([(pos, name) for pos, name in enumerate(DEFAULT.pii_types)])


def norm_sql(c: str) -> str:
    return f"trim(regexp_replace(lower({c}), '[^{SQL_WORD}]', ' ', 'g'))"


def _lcs_sql(p: str, t: str) -> str:
    """Longest common subsequence by bit rows, one bit per character of ``p`` (at most 62)."""
    full = f"((1::BIGINT << length({p})) - 1)"
    bits = (
        f"CAST(list_sum(list_transform(range(length({p})), lambda k: "
        f"CASE WHEN substr({p}, k + 1, 1) = ch THEN 1::BIGINT << k ELSE 0 END)) AS BIGINT)"
    )
    row = f"list_reduce(list_transform(string_split({t}, ''), lambda ch: {bits}), lambda s, m: ((s + (s & m)) | (s - (s & m))) & {full}, {full})"
    return f"CASE WHEN {p} = '' OR {t} = '' THEN 0 ELSE length({p}) - bit_count({row}) END"


def scores_cte(pairs: str) -> str:
    """scores(q, c, ratio, partial, token_sort, token_set, weighted) for ``pairs(q, c)`` of normalised strings."""
    word = "string_split({}, ' ')"
    words = {c: f"list_filter({word.format(c)}, lambda w: w <> '')" for c in "qc"}
    return f"""
pairs AS (SELECT DISTINCT q, c FROM ({pairs}) WHERE q <> '' AND c <> ''),
tokens AS (SELECT q, c, list_sort({words['q']}) AS qw, list_sort({words['c']}) AS cw FROM pairs),
once AS (SELECT *, list_sort(list_distinct(qw)) AS qd, list_sort(list_distinct(cw)) AS cd FROM tokens),
parts AS (SELECT q, c, array_to_string(qw, ' ') AS qs, array_to_string(cw, ' ') AS cs,
  array_to_string(qd, ' ') AS q1, array_to_string(cd, ' ') AS c1,
  array_to_string(list_filter(qd, lambda w: list_contains(cd, w)), ' ') AS sect,
  array_to_string(list_filter(qd, lambda w: NOT list_contains(cd, w)), ' ') AS qo,
  array_to_string(list_filter(cd, lambda w: NOT list_contains(qd, w)), ' ') AS co FROM once),
windowed AS (SELECT DISTINCT a, b FROM (SELECT q AS a, c AS b FROM parts UNION ALL SELECT qs, cs FROM parts UNION ALL SELECT q1, c1 FROM parts)),
sided AS (SELECT a, b, CASE WHEN length(a) <= length(b) THEN a ELSE b END AS sh, CASE WHEN length(a) <= length(b) THEN b ELSE a END AS lo FROM windowed
  UNION ALL SELECT a, b, b, a FROM windowed WHERE length(a) = length(b)),
windows AS (SELECT a, b, sh, substr(lo, greatest(st, 1), st + length(sh) - greatest(st, 1)) AS w
  FROM (SELECT *, unnest(range(2 - length(sh), length(lo) + 1)) AS st FROM sided)),
needed AS (SELECT DISTINCT p, t FROM (SELECT c AS p, q AS t FROM parts UNION ALL SELECT cs, qs FROM parts UNION ALL SELECT co, qo FROM parts
  UNION ALL SELECT sh, w FROM windows)),
lcs AS (SELECT p, t, {_lcs_sql('p', 't')} AS n FROM needed),
partials AS (SELECT a, b, max(200.0 * n / (length(sh) + length(w))) AS v FROM windows JOIN lcs ON p = sh AND t = w GROUP BY a, b),
single AS (SELECT x.*, 200.0 * l0.n / (length(q) + length(c)) AS ratio, 200.0 * l1.n / (length(qs) + length(cs)) AS token_sort,
  CASE WHEN sect <> '' AND (qo = '' OR co = '') THEN 100.0 ELSE greatest(
    100.0 - 100.0 * (length(qo) + length(co) - 2 * l2.n) / (2 * (length(sect) + CAST(sect <> '' AS BIGINT)) + length(qo) + length(co)),
    CASE WHEN sect <> '' THEN 100.0 - 100.0 * (1 + length(qo)) / (2 * length(sect) + 1 + length(qo)) ELSE 0 END,
    CASE WHEN sect <> '' THEN 100.0 - 100.0 * (1 + length(co)) / (2 * length(sect) + 1 + length(co)) ELSE 0 END) END AS token_set,
  p0.v AS partial, CASE WHEN sect <> '' THEN 100.0 ELSE greatest(p1.v, p2.v) END AS partial_token,
  greatest(length(q), length(c)) * 1.0 / least(length(q), length(c)) AS spread
  FROM parts x JOIN lcs l0 ON l0.p = c AND l0.t = q JOIN lcs l1 ON l1.p = cs AND l1.t = qs JOIN lcs l2 ON l2.p = co AND l2.t = qo
  JOIN partials p0 ON p0.a = q AND p0.b = c JOIN partials p1 ON p1.a = qs AND p1.b = cs JOIN partials p2 ON p2.a = q1 AND p2.b = c1),
scores AS (SELECT q, c, ratio, partial, token_sort, token_set,
  CASE WHEN spread < 1.5 THEN greatest(ratio, 0.95 * greatest(token_sort, token_set))
    ELSE greatest(ratio, (CASE WHEN spread < 8 THEN 0.9 ELSE 0.6 END) * partial,
      0.95 * (CASE WHEN spread < 8 THEN 0.9 ELSE 0.6 END) * partial_token) END AS weighted FROM single)"""


def ranked_cte(name: str, source: str, value: str, dim: str, columns: str, score: str, cutoff: float, k: int | None,
               ) -> str:
    """name(value, ord, ..., score, rk): the best ``k`` rows of ``dim`` for each distinct value; needs ``scores``."""
    limit = f"WHERE rk <= {k}" if k else ""
    return f"""
{name} AS (SELECT * FROM (SELECT v.value, d.*, round({score}, 9) AS score,
  row_number() OVER (PARTITION BY v.value ORDER BY round({score}, 9) DESC, d.ord) AS rk
  FROM (SELECT DISTINCT {value} AS value FROM {source} WHERE {value} IS NOT NULL) v
  CROSS JOIN ({dim}) d({columns}) JOIN scores s ON s.q = {norm_sql('v.value')} AND s.c = {norm_sql('d.name')}
  WHERE round({score}, 9) >= {cutoff}) {limit})"""


def pairs_sql(source: str, value: str, dim: str, columns: str) -> str:
    return (
        f"SELECT {norm_sql('v.value')} AS q, {norm_sql('d.name')} AS c FROM (SELECT DISTINCT {value} AS value FROM {source} "
        f"WHERE {value} IS NOT NULL) v CROSS JOIN ({dim}) d({columns})"
    )


# --------------------------------------------------------------------------
# F1-F4
# --------------------------------------------------------------------------

LABELS = fixture_sql("labels_fx")


@query(
    "f1_similarity",
    f"""WITH {scores_cte(f"SELECT {norm_sql('l2_label')} AS q, {norm_sql('risk_label')} AS c FROM {LABELS}")}
SELECT id, CAST(round(CASE WHEN {norm_sql('l2_label')} = {norm_sql('risk_label')} THEN 1.0 ELSE
  greatest(CASE WHEN ratio >= 65 THEN ratio ELSE 0 END, CASE WHEN partial >= 65 THEN partial ELSE 0 END,
    CASE WHEN token_sort >= 65 THEN token_sort ELSE 0 END, CASE WHEN token_set >= 65 THEN token_set ELSE 0 END,
    CASE WHEN weighted >= 65 THEN weighted ELSE 0 END) / 100 END, 4) AS DOUBLE) AS similarity
FROM {LABELS} JOIN scores ON q = {norm_sql('l2_label')} AND c = {norm_sql('risk_label')}""",
)
def f1(spark, sf):
    score = similarity_col(F.col("l2_label"), F.col("risk_label"))
    return fixture(spark, sf, "labels_fx").select("id", F.round(score, 4).alias("similarity"))


@query(
    "f2_best_matches",
    f"""WITH {scores_cte(pairs_sql(LABELS, 'risk_label', RISK_DIM, 'ord, l2_key, name'))},
{ranked_cte('best', LABELS, 'risk_label', RISK_DIM, 'ord, l2_key, name', 's.weighted', 65, 3)}
SELECT id, rk AS rank, name, CAST(round(score / 100, 4) AS DOUBLE) AS score FROM {LABELS} JOIN best ON value = risk_label""",
)
def f2(spark, sf):
    best = mt.best_matches(F.col("risk_label"), DEFAULT.all_risks)
    rows = fixture(spark, sf, "labels_fx").select("id", F.posexplode(best).alias("pos", "m"))
    return rows.select(
        "id", (F.col("pos") + 1).cast("bigint").alias("rank"), "m.name", F.round("m.score", 4).alias("score")
    )


FINDINGS = fixture_sql("findings_fx")
FINDING_TEXTS = f"(SELECT id, coalesce(Title, Description, Origin) AS text FROM {FINDINGS})"

TEXT_MATCH_SQL = f"""WITH
both_pairs AS ({pairs_sql(FINDING_TEXTS, 'text', L2_DIM, 'ord, l2_key, name')} UNION ALL
  {pairs_sql(FINDING_TEXTS, 'text', RISK_DIM, 'ord, l2_key, name')}),
{scores_cte('SELECT * FROM both_pairs')},
{ranked_cte('best', FINDING_TEXTS, 'text', L2_DIM, 'ord, l2_key, name', 's.weighted', 75, 1)},
{ranked_cte('risks', FINDING_TEXTS, 'text', RISK_DIM, 'ord, l2_key, name', 's.token_set', 65, None)},
joined AS (SELECT b.value, string_agg(r.name, '|' ORDER BY r.ord) AS risks FROM best b
  JOIN risks r ON r.value = b.value AND r.l2_key = b.l2_key GROUP BY b.value)"""


def _finding_texts(spark, sf):
    return fixture(spark, sf, "findings_fx").select("id", F.coalesce("Title", "Description", "Origin").alias("text"))


@query(
    "f3_match_l2",
    f"""{TEXT_MATCH_SQL} SELECT t.id, b.l2_key || '. ' || b.name AS l2_category, CAST(round(coalesce(b.score, 0) / 100, 4) AS DOUBLE) AS score
FROM {FINDING_TEXTS} t LEFT JOIN best b ON b.value = t.text""",
)
def f3(spark, sf):
    matched = _finding_texts(spark, sf).select("id", mt.match_risk_text(F.col("text")).alias("m"))
    return matched.select("id", "m.l2_category", F.round("m.score", 4).alias("score"))


@query(
    "f4_match_macro_risks",
    f"{TEXT_MATCH_SQL} SELECT t.id, coalesce(j.risks, '') AS macro_risks FROM {FINDING_TEXTS} t LEFT JOIN joined j ON j.value = t.text",
)
def f4(spark, sf):
    matched = _finding_texts(spark, sf).select("id", mt.match_risk_text(F.col("text")).alias("m"))
    return matched.select("id", F.array_join("m.macro_risks", "|").alias("macro_risks"))


@query("f3_match_documents")
def f3_documents(spark, sf):
    """Whole texts of any length: too slow as SQL, so checked against brute force on a small table."""
    matched = table(spark, sf, "documents").select("doc_id", mt.match_risk_text(F.col("text")).alias("m"))
    return matched.select(
        "doc_id", "m.l2_category", F.array_join("m.macro_risks", "|").alias("macro_risks"), F.round("m.score", 4).alias("score")
    )


# --------------------------------------------------------------------------
# L2 labels
# --------------------------------------------------------------------------

_VARIANTS: dict[str, str] = {}
for _key, _name in DEFAULT.l2.items():
    for _form in (_key, _name, f"{_key}. {_name}"):
        for _v in (_form.lower(), "".join(ch for ch in _form.lower() if ch.isalnum() or ch in "_ ")):
            _VARIANTS.setdefault(_v, f"{_key}. {_name}")
VARIANT_DIM = values_sql(list(_VARIANTS.items()))


def l2_map_cte(source: str, column: str) -> str:
    """l2_map(label, l2_category, tier) over the distinct labels."""
    low = f"lower({trim_sql('label')})"
    return f"""
l2_labels AS (SELECT DISTINCT {column} AS label FROM {source} WHERE {column} IS NOT NULL),
l2_forms AS (SELECT label, {low} AS low, regexp_replace({low}, '[^{SQL_WORD}{SQL_BLANK}]', '', 'g') AS bare FROM l2_labels),
l2_words AS (SELECT label, unnest({words_sql('bare')}) AS w, generate_subscripts({words_sql('bare')}, 1) AS i FROM l2_forms),
l2_by_word AS (SELECT label, arg_min(target, i) AS target FROM l2_words JOIN ({VARIANT_DIM}) v(variant, target) ON v.variant = w GROUP BY label),
{scores_cte(pairs_sql('l2_labels', 'label', L2_DIM, 'ord, l2_key, name')).strip()},
{ranked_cte('l2_fuzzy', 'l2_labels', 'label', L2_DIM, 'ord, l2_key, name', 's.weighted', 55, 1)},
l2_map AS (SELECT f.label, coalesce(e.target, b.target, w.target, z.l2_key || '. ' || z.name) AS l2_category,
  CASE WHEN e.target IS NOT NULL THEN 'exact' WHEN b.target IS NOT NULL THEN 'stripped' WHEN w.target IS NOT NULL THEN 'word'
    WHEN z.name IS NOT NULL THEN 'fuzzy' ELSE 'none' END AS tier
  FROM l2_forms f LEFT JOIN ({VARIANT_DIM}) e(variant, target) ON e.variant = f.low
  LEFT JOIN ({VARIANT_DIM}) b(variant, target) ON b.variant = f.bare
  LEFT JOIN l2_by_word w ON w.label = f.label LEFT JOIN l2_fuzzy z ON z.value = f.label)"""


@query(
    "f5_normalise_l2",
    f"""WITH {l2_map_cte(LABELS, 'l2_label')} SELECT id, l2_label, l2_category, tier
FROM {LABELS} JOIN l2_map ON label = l2_label""",
)
def f5(spark, sf):
    labels = fixture(spark, sf, "labels_fx").select("id", "l2_label", mt.normalise_l2(F.col("l2_label")).alias("m"))
    return labels.select("id", "l2_label", "m.l2_category", "m.tier")


@query(
    "f5_normalise_l2_exact",
    f"""SELECT id, L2, coalesce(e.target, b.target) AS l2_category FROM (SELECT id, L2, lower({trim_sql('L2')}) AS low,
  regexp_replace(lower({trim_sql('L2')}), '[^{SQL_WORD}{SQL_BLANK}]', '', 'g') AS bare FROM {FINDINGS}) f
LEFT JOIN ({VARIANT_DIM}) e(variant, target) ON e.variant = low LEFT JOIN ({VARIANT_DIM}) b(variant, target) ON b.variant = bare""",
)
def f5_exact(spark, sf):
    exact, stripped, _ = mt.normalise_l2_exact(F.col("L2"))
    return fixture(spark, sf, "findings_fx").select("id", "L2", F.coalesce(exact, stripped).alias("l2_category"))


# --------------------------------------------------------------------------
# risk labels
# --------------------------------------------------------------------------


def split_risks_sql(c: str) -> str:
    """F6 with whole names kept in one piece."""
    cases = " ".join(
        f"WHEN contains(lower({c}), {d}) THEN list_transform(string_split({c}, {d}), lambda p: {trim_sql('p')})"
        for d in ("','", "';'", "chr(10)", "'|'", "'/'", "chr(92)", "'+'", "'&'", "'and'")
    )
    whole = f"list_contains({list_sql([r.lower() for _, r in _RISKS])}, lower({trim_sql(c)}))"
    return f"CASE WHEN {c} IS NULL THEN NULL WHEN {whole} THEN [{trim_sql(c)}] {cases} ELSE [{trim_sql(c)}] END"


SPLIT_SOURCE = f"(SELECT id, coalesce(Risks, Title || ' and ' || L2, 'a/b') AS cell FROM {FINDINGS})"


@query("f6_split_risks", f"SELECT id, array_to_string({split_risks_sql('cell')}, '~') AS items FROM {SPLIT_SOURCE}")
def f6(spark, sf):
    cells = fixture(spark, sf, "findings_fx").select(
        "id", F.coalesce("Risks", F.concat("Title", F.lit(" and "), "L2"), F.lit("a/b")).alias("cell")
    )
    return cells.select("id", F.array_join(mt.split_risks(F.col("cell")), "~").alias("items"))


def risk_map_cte(items: str) -> str:
    """risk_map(item, ord, risk): the taxonomy risks of each distinct item of ``items(item)``."""
    return f"""
risk_items AS (SELECT DISTINCT item FROM ({items}) WHERE item IS NOT NULL AND item <> ''),
risk_exact AS (SELECT item, ord, name AS risk FROM risk_items JOIN ({RISK_DIM}) d(ord, l2_key, name) ON lower(name) = lower(item)),
risk_left AS (SELECT item FROM risk_items WHERE item NOT IN (SELECT item FROM risk_exact)),
{scores_cte(pairs_sql('risk_left', 'item', RISK_DIM, 'ord, l2_key, name')).strip()},
{ranked_cte('risk_fuzzy', 'risk_left', 'item', RISK_DIM, 'ord, l2_key, name', 's.weighted', 55, 2)},
risk_map AS (SELECT item, ord, risk FROM risk_exact UNION ALL SELECT value, ord, name FROM risk_fuzzy)"""


@query(
    "f7_normalise_risk",
    f"""WITH {risk_map_cte(f'SELECT risk_label AS item FROM {LABELS}')},
named AS (SELECT item, string_agg(risk, '|' ORDER BY ord) AS risks FROM risk_map GROUP BY item)
SELECT id, risk_label, coalesce(risks, '') AS risks FROM {LABELS} LEFT JOIN named ON item = risk_label""",
)
def f7(spark, sf):
    risks = F.array_join(mt.normalise_risks(F.array("risk_label")), "|")
    return fixture(spark, sf, "labels_fx").select("id", "risk_label", risks.alias("risks"))


FINDING_ITEMS = f"SELECT id, unnest({split_risks_sql('Risks')}) AS item FROM {FINDINGS} WHERE Risks IS NOT NULL"


@query(
    "f7_normalise_risk_cells",
    f"""WITH cells AS ({FINDING_ITEMS}), {risk_map_cte('SELECT item FROM cells')},
found AS (SELECT DISTINCT id, ord, risk FROM cells JOIN risk_map m ON m.item = cells.item)
SELECT f.id, coalesce(string_agg(risk, '|' ORDER BY ord), '') AS risks FROM {FINDINGS} f LEFT JOIN found ON found.id = f.id GROUP BY f.id""",
)
def f7_cells(spark, sf):
    risks = F.array_join(mt.normalise_risks(mt.split_risks(F.col("Risks"))), "|")
    return fixture(spark, sf, "findings_fx").select("id", risks.alias("risks"))


# --------------------------------------------------------------------------
# F8, F9
# --------------------------------------------------------------------------


def infer_risks_sql(source: str, key: str) -> str:
    """(key, ord, risk) of F8 over source(key, context, l2_key)."""
    words = "list_distinct(string_split(lower(name), ' '))"
    shared = f"len(list_filter({words}, lambda w: list_contains(context_words, w)))"
    return f"""SELECT {key}, ord, name AS risk FROM (SELECT *, list_distinct({words_sql('lower(context)')}) AS context_words FROM {source}) c
JOIN ({RISK_DIM}) d(ord, dim_key, name) ON c.l2_key = d.dim_key
WHERE {shared} >= least(2, len({words})) OR len(list_filter({words}, lambda w: length(w) > 4 AND contains(lower(context), w))) > 0"""


@query(
    "f8_infer_risks",
    f"""WITH hits AS ({infer_risks_sql("(SELECT id, text AS context, CAST(id % 12 + 1 AS VARCHAR) AS l2_key FROM " + fixture_sql('pii_fx') + ")", 'id')})
SELECT f.id, coalesce(string_agg(risk, '|' ORDER BY ord), '') AS risks FROM {fixture_sql('pii_fx')} f LEFT JOIN hits h ON h.id = f.id GROUP BY f.id""",
)
def f8(spark, sf):
    key = (F.col("id") % 12 + 1).cast("string")
    risks = F.array_join(mt.infer_risks(F.col("text"), key), "|")
    return fixture(spark, sf, "pii_fx").select("id", risks.alias("risks"))


@query(
    "f8_infer_risks_documents",
    f"""WITH hits AS ({infer_risks_sql("(SELECT doc_id, text AS context, CAST(doc_id % 12 + 1 AS VARCHAR) AS l2_key FROM documents)", 'doc_id')})
SELECT f.doc_id, coalesce(string_agg(risk, '|' ORDER BY ord), '') AS risks FROM documents f LEFT JOIN hits h ON h.doc_id = f.doc_id GROUP BY f.doc_id""",
)
def f8_documents(spark, sf):
    key = (F.col("doc_id") % 12 + 1).cast("string")
    risks = F.array_join(mt.infer_risks(F.col("text"), key), "|")
    return table(spark, sf, "documents").select("doc_id", risks.alias("risks"))


_PICKS = ["o_orderkey % 58", "o_custkey % 58", "(o_orderkey + 1) % 58", "(o_custkey * 7) % 58"]


@query(
    "f9_infer_l2",
    f"""WITH picked AS (SELECT DISTINCT o_orderkey, unnest([{', '.join(f'({p}) + 1' for p in _PICKS)}]) AS pick FROM orders),
votes AS (SELECT o_orderkey, d.l2_key, count(*) AS n FROM picked JOIN ({RISK_DIM}) d(ord, l2_key, name) ON d.ord = pick - 1 GROUP BY ALL)
SELECT o_orderkey, arg_max(l.l2_key || '. ' || l.name, n * 100 - l.ord) AS l2_category FROM votes v
JOIN ({L2_DIM}) l(ord, l2_key, name) ON l.l2_key = v.l2_key GROUP BY o_orderkey""",
)
def f9(spark, sf):
    names = str_array(DEFAULT.all_risks)
    picks = F.array_distinct(F.array(*[F.element_at(names, F.expr(f"CAST({p} + 1 AS INT)")) for p in _PICKS]))
    return table(spark, sf, "orders").select("o_orderkey", mt.infer_l2(picks).alias("l2_category"))


# --------------------------------------------------------------------------
# F10
# --------------------------------------------------------------------------

PRIVACY = fixture_sql("privacy_fx")
_WEIGHTED_VALUES = f"(SELECT {trim_sql('PRIVACYTYPE')} AS v FROM {PRIVACY} UNION ALL SELECT {trim_sql('PRIVACYTYPENAME')} FROM {PRIVACY})"
PRIVACY_TEXT_SQL = (
    "concat_ws(chr(10), 'Database Column: ' || COLUMNNAME, 'Entity: ' || ENTITYNAME, "
    "'Privacy Description: ' || PRIVACYTYPEDESCRIPTION)"
)
PRIVACY_CTE = f"""WITH
fx AS (SELECT *, {PRIVACY_TEXT_SQL} AS text FROM {PRIVACY}),
type_pairs AS ({pairs_sql(_WEIGHTED_VALUES, 'v', TYPE_DIM, 'ord, name')} UNION ALL {pairs_sql(PRIVACY, 'PRIVACYTYPEDESCRIPTION', TYPE_DIM, 'ord, name')}),
{scores_cte('SELECT * FROM type_pairs')},
{ranked_cte('by_label', _WEIGHTED_VALUES, 'v', TYPE_DIM, 'ord, name', 's.weighted', 75, 2)},
{ranked_cte('by_text', PRIVACY, 'PRIVACYTYPEDESCRIPTION', TYPE_DIM, 'ord, name', 's.token_set', 65, 3)},
matched AS (SELECT fx.id, ord, name FROM fx JOIN by_label ON value = {trim_sql('PRIVACYTYPE')}
  UNION SELECT fx.id, ord, name FROM fx JOIN by_label ON value = {trim_sql('PRIVACYTYPENAME')}
  UNION SELECT fx.id, ord, name FROM fx JOIN by_text ON value = PRIVACYTYPEDESCRIPTION),
matched_lists AS (SELECT id, list(name ORDER BY ord) AS types FROM matched GROUP BY id),
scanned AS ({scan_sql('fx')}),
typed AS (SELECT fx.*, coalesce(m.types, s.pii_types) AS types,
  CASE WHEN PRIVACYTYPECLASSIFICATION IS NULL THEN 'PC1'
    WHEN contains(upper(PRIVACYTYPECLASSIFICATION), 'PUBLIC') OR contains(upper(PRIVACYTYPECLASSIFICATION), 'DP10') OR contains(upper(PRIVACYTYPECLASSIFICATION), 'UNRESTRICTED') THEN 'PC0'
    WHEN contains(upper(PRIVACYTYPECLASSIFICATION), 'CONFIDENTIAL') OR contains(upper(PRIVACYTYPECLASSIFICATION), 'DP30') OR contains(upper(PRIVACYTYPECLASSIFICATION), 'HIGHLY RESTRICTED') OR contains(upper(PRIVACYTYPECLASSIFICATION), 'SENSITIVE') THEN 'PC3'
    ELSE 'PC1' END AS pc FROM fx LEFT JOIN matched_lists m ON m.id = fx.id JOIN scanned s ON s.id = fx.id)"""


def labelled_privacy(spark, sf):
    return pv.label_privacy(fixture(spark, sf, "privacy_fx"))


@query("f10_match_pii_types", f"{PRIVACY_CTE} SELECT id AS ID, array_to_string(types, '|') AS pii_types, len(types) > 0 AS mapped FROM typed")
def f10(spark, sf):
    return labelled_privacy(spark, sf).select("ID", F.array_join("pii_types", "|").alias("pii_types"), "mapped")


@query("p14_privacy_text", f"SELECT id AS ID, {PRIVACY_TEXT_SQL} AS text FROM {PRIVACY}")
def p14(spark, sf):
    raw = fixture(spark, sf, "privacy_fx").withColumnRenamed("id", "ID")
    return raw.select("ID", pv.privacy_text(raw).alias("text"))


@query(
    "f10_privacy_examples",
    f"""{PRIVACY_CTE} SELECT id AS ID, 'pii' AS type, text, pc AS pc_category, array_to_string(types, '|') AS pii_types FROM typed WHERE len(types) > 0""",
)
def f10_examples(spark, sf):
    examples = pv.privacy_examples(labelled_privacy(spark, sf), keep=["ID"]).drop("metadata")
    return examples.withColumn("pii_types", F.array_join("pii_types", "|"))


# --------------------------------------------------------------------------
# F11, F12
# --------------------------------------------------------------------------


def strict_match_cte(claims: str) -> str:
    """strict(id, risks list) of F11 over claims(id, l2_key, item): best risk of the key per item."""
    words = words_sql("low")
    return f"""
claims AS ({claims}),
claim_items AS (SELECT DISTINCT l2_key, item, lower({trim_sql('item')}) AS low FROM claims),
claim_words AS (SELECT *, list_distinct({words}) AS words FROM claim_items),
claim_scores AS (SELECT l2_key, item, ord, name, CASE WHEN low = vlow THEN 100
    WHEN (contains(vlow, low) OR contains(low, vlow)) AND length(low) > 3 AND length(vlow) > 3 THEN 80
    WHEN len(words) > 0 AND shared * 1.0 / least(len(words), len(vwords)) >= 0.7 AND shared * 1.0 / greatest(len(words), len(vwords)) >= 0.5
      THEN floor((shared * 1.0 / least(len(words), len(vwords))) * (shared * 1.0 / greatest(len(words), len(vwords))) * 60) ELSE 0 END AS score
  FROM (SELECT c.l2_key, item, low, words, ord, name, lower(name) AS vlow, list_distinct({words_sql('lower(name)')}) AS vwords,
    len(list_intersect(words, {words_sql('lower(name)')})) AS shared
    FROM claim_words c JOIN ({RISK_DIM}) d(ord, dim_key, name) ON c.l2_key = d.dim_key)),
claim_best AS (SELECT l2_key, item, arg_max(ord, score * 1000 - ord) AS ord, arg_max(name, score * 1000 - ord) AS name, max(score) AS score
  FROM claim_scores GROUP BY l2_key, item),
strict AS (SELECT id, list(name ORDER BY ord) AS risks FROM (SELECT DISTINCT c.id, b.ord, b.name FROM claims c
  JOIN claim_best b ON b.l2_key = c.l2_key AND b.item = c.item WHERE b.score >= 50) GROUP BY id)"""


def loose_match_cte(claims: str) -> str:
    """loose(id, risks list) of F12 over loose_claims(id, l2_key, item): first fitting risk per item."""
    return f"""
loose_claims AS ({claims}),
loose_words AS (SELECT DISTINCT l2_key, item, lower({trim_sql('item')}) AS low, list_distinct({words_sql(f"lower({trim_sql('item')})")}) AS words FROM loose_claims),
loose_first AS (SELECT c.l2_key, item, min(ord) AS ord, arg_min(name, ord) AS name FROM loose_words c
  JOIN ({RISK_DIM}) d(ord, dim_key, name) ON c.l2_key = d.dim_key
  WHERE contains(lower(name), low) OR contains(low, lower(name)) OR (len(words) > 0 AND
    len(list_intersect(words, {words_sql('lower(name)')})) >= greatest(1.0, 0.6 * least(len(words), len(list_distinct({words_sql('lower(name)')})))))
  GROUP BY c.l2_key, item),
loose AS (SELECT id, list(name ORDER BY ord) AS risks FROM (SELECT DISTINCT c.id, f.ord, f.name FROM loose_claims c
  JOIN loose_first f ON f.l2_key = c.l2_key AND f.item = c.item) GROUP BY id)"""


CLAIMS = fixture_sql("claims_fx")
CLAIM_ROWS = f"""SELECT id, {trim_sql("split_part(l2_category, '.', 1)")} AS l2_key, unnest([risk_a, risk_b]) AS item FROM {CLAIMS}"""


@query(
    "f11_filter_risks_by_l2",
    f"""WITH {strict_match_cte(CLAIM_ROWS)} SELECT c.id, CASE WHEN c.l2_category IS NULL THEN c.risk_a || '|' || c.risk_b
ELSE coalesce(array_to_string(s.risks, '|'), '') END AS risks FROM {CLAIMS} c LEFT JOIN strict s ON s.id = c.id""",
)
def f11(spark, sf):
    risks = mt.filter_risks_by_l2(F.col("l2_category"), F.array("risk_a", "risk_b"))
    return fixture(spark, sf, "claims_fx").select("id", F.array_join(risks, "|").alias("risks"))


@query(
    "f12_filter_risks_loose",
    f"""WITH {loose_match_cte(CLAIM_ROWS)} SELECT c.id, CASE WHEN {trim_sql("split_part(c.l2_category, '.', 1)")} IN ({', '.join(quote(k) for k in DEFAULT.l2)})
THEN coalesce(array_to_string(s.risks, '|'), '') END AS risks FROM {CLAIMS} c LEFT JOIN loose s ON s.id = c.id""",
)
def f12(spark, sf):
    risks = mt.filter_risks_loose(tx.label_key(F.col("l2_category")), F.array("risk_a", "risk_b"))
    return fixture(spark, sf, "claims_fx").select("id", F.array_join(risks, "|").alias("risks"))


# --------------------------------------------------------------------------
# Labelled findings: P12, P13 (and the source of A4-A8)
# --------------------------------------------------------------------------

# The score tables of the two label maps live in sub-queries so that their names do not meet.
LABELLED_CTE = f"""
fx AS (SELECT *, {context_sql()} AS context FROM {FINDINGS}),
l2_map AS (SELECT * FROM (WITH {l2_map_cte(FINDINGS, 'L2')} SELECT * FROM l2_map)),
cells AS ({FINDING_ITEMS}),
risk_map AS (SELECT * FROM (WITH {risk_map_cte('SELECT item FROM cells')} SELECT * FROM risk_map)),
given AS (SELECT DISTINCT cells.id, ord, risk FROM cells JOIN risk_map m ON m.item = cells.item),
l2ed AS (SELECT fx.*, m.l2_category, coalesce(m.tier, 'none') AS tier, {trim_sql("split_part(m.l2_category, '.', 1)")} AS l2_key,
  EXISTS (SELECT 1 FROM given g WHERE g.id = fx.id) AS has_given FROM fx LEFT JOIN l2_map m ON m.label = fx.L2),
inferred AS ({infer_risks_sql('(SELECT id, context, l2_key FROM l2ed WHERE NOT has_given AND l2_key IS NOT NULL AND context IS NOT NULL)', 'id')}),
risked AS (SELECT * FROM given UNION ALL SELECT * FROM inferred),
risk_lists AS (SELECT id, list(risk ORDER BY ord) AS risks FROM risked GROUP BY id),
votes AS (SELECT id, d.l2_key, count(*) AS n FROM risked r JOIN ({RISK_DIM}) d(ord, l2_key, name) ON d.name = r.risk GROUP BY ALL),
voted AS (SELECT id, arg_max(l.l2_key || '. ' || l.name, n * 100 - l.ord) AS l2_category FROM votes v
  JOIN ({L2_DIM}) l(ord, l2_key, name) ON l.l2_key = v.l2_key GROUP BY id),
labelled AS (SELECT a.id, a.Title, a.Description, a.L2, a.Risks, a.Origin, a.context,
  CASE WHEN a.context IS NULL THEN 'UNKNOWN' ELSE coalesce(a.l2_category, v.l2_category, 'UNKNOWN') END AS l2_category,
  CASE WHEN a.context IS NULL THEN ['UNSPECIFIED'] ELSE coalesce(r.risks, ['UNSPECIFIED']) END AS macro_risks,
  CASE WHEN a.context IS NULL THEN 'empty_data' WHEN coalesce(a.l2_category, v.l2_category) IS NULL AND r.risks IS NULL THEN 'no_l2|no_risks' ELSE '' END AS reject_reasons
  FROM l2ed a LEFT JOIN risk_lists r ON r.id = a.id LEFT JOIN voted v ON v.id = a.id)"""


def labelled_findings(spark, sf):
    return fd.label_findings(fd.map_columns(fixture(spark, sf, "findings_fx")), text_columns=["ORIGIN"], keep=["ID"])


@query(
    "p13_label_findings",
    f"WITH {LABELLED_CTE} SELECT id AS ID, context, l2_category, array_to_string(macro_risks, '|') AS macro_risks, reject_reasons FROM labelled",
)
def p13(spark, sf):
    return labelled_findings(spark, sf).select(
        "ID", "context", "l2_category", F.array_join("macro_risks", "|").alias("macro_risks"),
        F.array_join("reject_reasons", "|").alias("reject_reasons"),
    )


@query(
    "p13_kept_examples",
    f"""WITH {LABELLED_CTE} SELECT id AS ID, 'risk' AS type, context AS text, l2_category, array_to_string(macro_risks, '|') AS macro_risks
FROM labelled WHERE reject_reasons = ''""",
)
def p13_kept(spark, sf):
    examples = fd.kept(labelled_findings(spark, sf), keep=["ID"]).drop("metadata")
    return examples.withColumn("macro_risks", F.array_join("macro_risks", "|"))


@query(
    "p12_metadata",
    f"""SELECT id AS ID, concat_ws('|', 'id=' || id, 'original_l2=' || L2, 'original_risks=' || Risks, 'origin=' || Origin, 'source=raw_data') AS metadata FROM {FINDINGS}""",
)
def p12(spark, sf):
    mapped = fd.map_columns(fixture(spark, sf, "findings_fx"))
    fixed = {"source": F.lit("raw_data"), "original_l2": F.col("L2"), "original_risks": F.col("MACRO_RISKS")}
    packed = fd.metadata_map(mapped, fixed, ["ID", "ORIGIN"])
    keys = str_array(["id", "original_l2", "original_risks", "origin", "source"])
    lines = F.transform(keys, lambda k: F.concat(k, F.lit("="), F.element_at(packed, k)))
    return mapped.select("ID", F.array_join(lines, "|").alias("metadata"))
