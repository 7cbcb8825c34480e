"""Cleaning, routing and scanning, against plain Python statements of the rules."""

import re

import pytest
from pyspark.sql import functions as F

from riskscan.functions import classify as cl
from riskscan.functions import text as tx
from riskscan.operators import chat as chats
from riskscan.operators import texts as tt
from riskscan.taxonomy import DEFAULT

TEXTS = [
    "Customer name: Ann Li, mail ann.li@example.org",
    "SSN 123-45-6789 and a credit card",
    "Stored XSS and weak authentication in the portal",
    "call 555.123.4567 today",
    "born 1999-1-2",
    "12 Long Harbor Street",
    "Ärger  mit\tÜber-Zugriff [prod] ( )",
    "___", "ab", "123456", "٣٤٥", "²²²", "", "   ", "()", "a b c", "name\nemail\x1cphone",
    "public marketing brochure", "rename the ip address of 123456789", "x@y.c|", ".a@b.cd", "é1234567890", "é_x1",
]


def _clean(s):
    s = re.sub(r"\s+", " ", s.strip())
    return re.sub(r"\(\s*\)", "", re.sub(r"[^\w\s\-.,;:?!()]", " ", s)).strip()


def _meaningful(s):
    s = s.strip()
    return bool(s) and not re.match(r"^[\s\W]*$", s) and len(s) >= 3 and not s.isdigit()


PY_PATTERNS = {
    "SSN": r"\b\d{3}[-.]?\d{2}[-.]?\d{4}\b",
    "Email": r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b",
    "Phone": r"\b\d{3}[-.]?\d{3}[-.]?\d{4}\b",
    "Address": r"\b\d{1,5}\s+[A-Za-z\s]{2,30}\s+(?:St|Street|Ave|Avenue|Rd|Road|Blvd|Boulevard)\b",
    "DOB": r"\b(?:19|20)\d{2}[-/]\d{1,2}[-/]\d{1,2}\b",
}


@pytest.fixture(scope="module")
def rows(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS], "text string")
    out = tt.classify_texts(df).withColumns(
        {"clean": tx.clean_text(F.col("text")), "ok": tx.is_meaningful(F.col("text")), "one": cl.scan_pii(F.col("text"))}
    )
    return {r["text"]: r for r in out.collect()}


@pytest.mark.parametrize("text", TEXTS)
def test_cleaning_follows_the_rules(rows, text):
    assert rows[text]["clean"] == _clean(text)
    assert rows[text]["ok"] == _meaningful(text)


@pytest.mark.parametrize("text", TEXTS)
def test_scan_follows_the_rules(rows, text):
    low = text.lower()
    named = {t for t in DEFAULT.pii_types if t.lower() in low}
    shaped = {t for t, p in PY_PATTERNS.items() if re.search(p, text)}
    found = [t for t in DEFAULT.pii_types if t in named | shaped]
    tenths = 2 * len(named) + 3 * len(shaped)
    high = set(found) & {"SSN", "Financial", "Health", "DOB"}
    expected = ("PC3", min(10, tenths + 4)) if high else ("PC1", min(10, tenths + 2)) if found else ("PC0", 1)
    row = rows[text]
    assert (row["pc_category"], row["confidence"], row["pii_types"]) == (expected[0], expected[1] / 10, found)
    assert tuple(row["one"]) == (row["pc_category"], row["pii_types"], row["confidence"])


def test_routing(rows):
    assert rows[TEXTS[0]]["type"] == "pii" and rows[TEXTS[0]]["keyword_pc"] == "PC1"
    assert rows[TEXTS[1]]["type"] == "pii" and rows[TEXTS[1]]["keyword_pc"] == "PC3"
    assert rows[TEXTS[2]]["type"] == "risk"
    assert rows[""]["type"] == "risk" and rows[""]["keyword_pc"] == "PC0"


def test_null_text_gives_null_scan(spark):
    df = spark.createDataFrame([(None,)], "text string")
    assert tt.scan_texts(df).first()["pc_category"] is None


def test_normalised_types_are_stateful(spark):
    df = spark.createDataFrame([(["work email", "work email of name", "SSN", "ssn", "nothing"],)], "t array<string>")
    assert df.select(cl.normalise_pii_types(F.col("t")).alias("k")).first()["k"] == ["Email", "Name", "SSN"]


def test_category_never_drops_when_text_grows(spark):
    df = spark.createDataFrame([(a, a + " " + b) for a in TEXTS for b in TEXTS[:6]], "a string, b string")
    rank = {"PC0": 0, "PC1": 1, "PC3": 2}
    for r in df.select(cl.pc_from_keywords(F.col("a")).alias("x"), cl.pc_from_keywords(F.col("b")).alias("y")).collect():
        assert rank[r["x"]] <= rank[r["y"]]


def test_rules_run_on_a_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("weak authentication\nmy ssn\n")
    lines = spark.readStream.text(str(tmp_path / "in")).withColumnRenamed("value", "text")
    run = tt.classify_texts(lines).writeStream.format("memory").queryName("routed").start()
    run.processAllAvailable()
    run.stop()
    assert {(r["text"], r["type"]) for r in spark.table("routed").collect()} == {("weak authentication", "risk"), ("my ssn", "pii")}


def test_exact_split_goes_on_to_further_bits(spark, monkeypatch):
    """Few bits at a time, few rows to order, many equal hashes: the same split as by sorting."""
    monkeypatch.setattr(chats, "RANK_BITS", 3)
    monkeypatch.setattr(chats, "FEW_ROWS", 5)
    df = spark.range(3000).withColumnRenamed("id", "key")
    orders = {
        "hash": F.xxhash64("key", F.lit(0)), "few": F.pmod(F.xxhash64("key"), F.lit(3)) - 1, "one": F.lit(-5).cast("long"),
        "close": (F.col("key") % 700) * 2 + F.lit(1 << 62),
    }
    for name, order in orders.items():
        rows = df.select("key", order.alias("o")).collect()
        ranked = sorted(rows, key=lambda r: (r["o"] % (1 << 64), r["key"]))
        for share in (0.9, 0.31, 0.0005, 1.0):
            split = chats.split_examples(df, "key", share, exact=True, order=order)
            train = {r["key"] for r in split.where("split = 'train'").collect()}
            assert train == {r["key"] for r in ranked[:int(share * 3000)]}, (name, share)
    assert chats.split_examples(df.limit(0), "key", exact=True).count() == 0
