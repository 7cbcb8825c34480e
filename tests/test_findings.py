import pytest
from pyspark.sql import functions as F

from riskscan.functions.prompts import render_taxonomy
from riskscan.operators import chat as ch
from riskscan.operators import findings as fd
from riskscan.operators import report as rp
from riskscan.taxonomy import DEFAULT


def test_map_columns(spark):
    df = spark.createDataFrame([("a", "b", "c", "d", 1)], [" issue", "Desc", "risk_classification", "tags", "Extra"])
    assert fd.map_columns(df).columns == ["FINDING_TITLE", "FINDING_DESCRIPTION", "L2", "MACRO_RISKS", "EXTRA"]


def test_text_columns_need_a_sample(spark):
    df = spark.createDataFrame([(1, "long enough text", None, "short")], "id int, a string, b string, c string")
    assert fd.detect_text_columns(df, order_by="id") == ["a"]


def test_every_row_is_kept_or_rejected(spark):
    rows = [(1, "SQL injection found", "Protect Data", "zzz"), (2, "##", "7", None), (3, "plain words here", "", ""),
            (4, "network segmentation gap", "7", ""), (5, "some title", None, "Authentication;Removable Media")]
    df = fd.map_columns(spark.createDataFrame(rows, "id int, title string, l2 string, risks string"))
    labelled = fd.label_findings(df, keep=["ID"])
    by_id = {r["ID"]: r for r in labelled.collect()}
    assert by_id[1]["l2_category"] == "5. Protect Data"
    assert by_id[2]["reject_reasons"] == ["empty_data"] and by_id[3]["reject_reasons"] == ["no_l2", "no_risks"]
    assert by_id[4]["macro_risks"] == ["Network Segmentation"]
    assert by_id[5]["l2_category"] == "5. Protect Data"  # one vote each: the lower category
    assert fd.kept(labelled).count() + fd.rejected(labelled).count() == len(rows)
    counts = {r["reason"]: r["n"] for r in rp.reject_counts(labelled).collect()}
    assert counts == {"no_l2": 1, "no_risks": 1, "empty_data": 1, "error": 0, "invalid_format": 0}


def test_empty_fields_are_counted(spark):
    rows = [("", "text"), (None, None), ("title", " "), ("a", "b")]
    df = spark.createDataFrame(rows, "FINDING_TITLE string, FINDING_DESCRIPTION string")
    assert tuple(rp.empty_field_counts(df).first()) == (1, 1, 1)


def test_labels_leak_unless_excluded(spark):
    df = spark.createDataFrame([("Open port", "Network", "a|b")], "Title string, Category string, Risks string")
    assert "Category: Network" in fd.raw_to_examples(df).first()["text"]
    row = fd.raw_to_examples(df, exclude_label_columns=True).first()
    assert row["text"] == "Finding: Open port" and row["l2_category"] == "Network" and row["macro_risks"] == ["a", "b"]


@pytest.mark.parametrize("n", [1, 10, 999])
def test_exact_split(spark, n):
    split = ch.split_examples(spark.range(n), "id", exact=True)
    sizes = {r["split"]: r["count"] for r in split.groupBy("split").count().collect()}
    assert sizes.get("train", 0) == int(n * 0.9) and sum(sizes.values()) == n
    assert split.select("id").distinct().count() == n
    hashes = dict(spark.range(n).select("id", F.xxhash64("id", F.lit(0))).collect())
    order = sorted(hashes, key=lambda i: hashes[i] & (2**64 - 1))
    assert {r["id"] for r in split.where("split = 'train'").collect()} == set(order[:int(n * 0.9)])


def test_exact_split_moves_no_rows(spark):
    plan = ch.split_examples(spark.range(500), "id", exact=True)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


def test_taxonomy_rendering_lists_every_entry():
    whole = render_taxonomy("all", DEFAULT).split("\n")
    assert all(f"   - {r}" in whole for risks in DEFAULT.macro_risks.values() for r in risks)
    assert all(label in whole for label in DEFAULT.l2_labels) and all(f"- {t}" in whole for t in DEFAULT.pii_types)
    assert render_taxonomy("risk").startswith("L2 Risk Categories:\n" + DEFAULT.l2_labels[0])


def test_unknown_types_have_no_chat(spark):
    df = spark.createDataFrame([("risk", "t", "1. A", ["x"]), ("risk", None, "1. A", ["x"]), ("odd", "t", "1. A", [])],
                               "type string, text string, l2_category string, macro_risks array<string>")
    chats = ch.chat_rows(ch.format_chat(df)).collect()
    assert len(chats) == 1 and [m["role"] for m in chats[0]["messages"]] == ["system", "user", "assistant", "user", "assistant"]
    assert chats[0]["messages"][4]["content"] == '{\n  "l2_category": "1. A",\n  "macro_risks": [\n  "x"\n]\n}'
