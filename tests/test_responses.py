import pytest
from pyspark.sql import functions as F

from riskscan.functions import responses as rs
from riskscan.operators import report as rp
from riskscan.operators import responses as ro

CASES = [
    ("risk", '{"l2_category":"6. Identity & Access Management","macro_risks":["authentication","Secrets"]}',
     (True, "risk", "6. Identity & Access Management", ["Authentication", "Secrets Management"], "json")),
    ("risk", '{"l2_category":"99. X","macro_risks":["Authorization"]}', (True, "risk", "99. X", [], "json")),
    ("risk", '{"a":{"b":1},"c":2}', (False, "risk", None, [], "text_fallback")),
    ("risk", '"l2_category": "5. Protect Data"', (True, "risk", ":", [], "text_fallback")),
    ("risk", '{"l2_category":null,"macro_risks":["a","b"]}', (True, "risk", None, ["a", "b"], "json")),
    ("risk", '{"l2_category":"5. Protect Data","macro_risks":null}', (False, None, None, None, None)),
    ("risk", "  ", (False, "risk", "Could not determine", [], "empty_response")),
    ("pii", '{"pc_category":"PC1","pii_types":["SSN","Work Email"]}', (True, "pii", "PC3", ["SSN", "Email"], "json")),
    ("pii", '{"pc_category":"PC2","pii_types":[]}', (True, "pii", "PC3", [], "json")),
    ("pii", '{"pc_category":"PC1","pii_types":null}', (False, None, None, None, None)),
    ("pii", "Class PC2 with mobile", (True, "pii", "PC2", ["Phone"], "text_fallback")),
]


@pytest.fixture(scope="module")
def parsed(spark):
    df = spark.createDataFrame([(i, k, r) for i, (k, r, _) in enumerate(CASES)], "i int, type string, response string")
    rows = ro.parse_responses(df.withColumn("text", F.lit("my bank"))).collect()
    return {r["i"]: r["result"] for r in rows}


@pytest.mark.parametrize("i", range(len(CASES)))
def test_result(parsed, i):
    kind, _, expected = CASES[i]
    r = parsed[i]
    label, items = ("l2_category", "macro_risks") if kind == "risk" else ("pc_category", "pii_types")
    assert (r["success"], r["type"], r[label], r[items], r["parsing_method"]) == expected
    assert r["input_text"] == "my bank"


def test_filter_on_a_result_keeps_the_plan_small(spark):
    """A filter over the results must not copy the parsing below them."""
    df = spark.createDataFrame([("risk", "x", "{}")], "type string, text string, response string")
    out = ro.flatten_results(ro.parse_responses(df)).where("type = 'risk' AND parsing_method = 'json'")
    plain = ro.flatten_results(ro.parse_responses(df))
    size = [len(d._jdf.queryExecution().optimizedPlan().toString()) for d in (out, plain)]
    assert size[0] < 1.5 * size[1]


def test_counts_look_for_no_risks_or_types(spark):
    """The batch summary needs how each response was read, not what it says."""
    df = spark.createDataFrame([("risk", "x", "{}")], "type string, text string, response string")
    plan = rp.batch_summary(ro.parsed_fields(df))._jdf.queryExecution().optimizedPlan().toString()
    whole = ro.parsed_fields(df)._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_extract_all" in whole and "regexp_extract_all" not in plan
    assert len(plan) < len(whole) / 3


def test_patterns_run_where_their_fixed_part_occurs(spark):
    fixed = [rs._must_hold(p) for p in rs.RISK_PATTERNS]
    assert fixed == ["macro", "risk", "risk", "risk", "-", "", "issue", "include", "involvin", "with"]
    texts = ["riſk: Data Loss", "rİsk: Data Loss", "RıSK: Data Loss", "RISK: Data Loss", "no part of it", "issue: leaks", "with: Keys", "- Bullet", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    plain = F.concat(*[F.regexp_extract_all("t", F.lit(rs.FLAGS + p), F.lit(1)) for p in rs.RISK_PATTERNS])
    trimmed = F.filter(F.transform(plain, lambda m: F.btrim(m)), lambda m: F.length(m) >= 4)
    for row in df.select(rs.risks_in_text(F.col("t")).alias("found"), trimmed.alias("plain")).collect():
        assert row["found"] == row["plain"]


def test_the_last_of_repeated_names_counts(spark):
    rows = [
        ("risk", '{"l2_category": "1. Operating Model & Risk Management", "l2_category": "5. Protect Data", "macro_risks": ["x"], "macro_risks": ["Data Loss Prevention"]}'),
        ("pii", '{"pc_category": "PC0", "pii_types": [], "pc_category": "PC1"}'), ("pii", '{"pii_types": ["SSN"], "pii_types": null}'),
    ]
    df = spark.createDataFrame([(i, k, r, "t") for i, (k, r) in enumerate(rows)], "i int, type string, response string, text string")
    found = [tuple(r) for r in ro.parsed_fields(df).orderBy("i").select("success", "l2_category", "macro_risks", "pc_category", "pii_types", "parsing_method").collect()]
    assert found[:2] == [
        (True, "5. Protect Data", ["Data Loss Prevention"], None, None, "json"), (True, None, None, "PC1", [], "json"),
    ]
    assert found[2][0] is False and found[2][5] is None  # the last value is null, which is an error
