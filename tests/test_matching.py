"""The fuzzy scorer by hand and by brute force, and the matching columns."""

import random
import time

import pytest
from pyspark.sql import functions as F

from riskscan.functions import matching as mt
from riskscan.functions import similarity as sim
from riskscan.operators import privacy as pv
from riskscan.plans import load
from riskscan.taxonomy import DEFAULT


def _lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        diagonal = 0
        for j, y in enumerate(b, 1):
            diagonal, row[j] = row[j], diagonal + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def test_worked_scores():
    assert round(sim.ratio("nan", "name"), 1) == 57.1
    assert sim.weighted("nan", "financial") == 90.0
    assert sim.weighted("data breach in vendor feed", "protect data") == 85.5
    assert sim.token_set("access data", "data access now") == 100.0
    assert sim.partial("abcd", "xxabcyy") == 75.0
    assert sim.similarity(None, "x") == 0.0 and sim.similarity("A-b", "a b") == 1.0


def test_ratio_and_partial_by_brute_force():
    rng = random.Random(1)
    for _ in range(300):
        a, b = ("".join(rng.choice("abc d") for _ in range(rng.randint(1, 12))) for _ in "ab")
        assert sim.ratio(a, b) == 200.0 * _lcs(a, b) / (len(a) + len(b))
        short, long = sorted((a, b), key=len)
        sides = [(short, long)] + ([(long, short)] if len(a) == len(b) else [])
        best = max(
            200.0 * _lcs(s, w) / (len(s) + len(w))
            for s, t in sides
            for w in (t[max(i, 0):i + len(s)] for i in range(1 - len(s), len(t)))
        )
        assert sim.partial(a, b) == best


def test_match_risk_text_equals_brute_force(spark):
    """The length bound of F3 must not lose a match."""
    rng = random.Random(2)
    words = "data breach protect manage incident response network cloud zzz qqq of and".split()
    texts = [" ".join(rng.choice(words) for _ in range(n)) for n in (1, 3, 10, 40, 60, 70, 90, 200) for _ in range(4)]
    texts += ["!!!", "", "Protect Data", "x" * 380 + " protect data"]
    df = spark.createDataFrame([(t,) for t in texts], "text string").select("text", mt.match_risk_text(F.col("text")).alias("m"))
    names = list(DEFAULT.l2.values())
    for row in df.collect():
        query = sim.normalise(row["text"])
        scores = [(sim.weighted(query, sim.normalise(n)), -i) for i, n in enumerate(names)]
        score, pos = max(scores)
        if score < 75:
            assert row["m"]["l2_category"] is None and row["m"]["macro_risks"] == []
        else:
            key = list(DEFAULT.l2)[-pos]
            assert row["m"]["l2_category"] == f"{key}. {names[-pos]}"
            assert row["m"]["macro_risks"] == [
                r for r in DEFAULT.macro_risks[key] if sim.token_set(query, sim.normalise(r)) >= 65
            ]


def test_tie_goes_to_the_earlier_category(spark):
    df = spark.createDataFrame([("data breach in vendor feed",)], "t string")
    assert df.select(mt.match_risk_text(F.col("t")).alias("m")).first()["m"]["l2_category"] == "4. Manage Data"


def test_l2_labels_go_through_the_tiers(spark):
    cases = {
        "5. Protect Data": ("5. Protect Data", "exact"), "identity  access management": ("6. Identity & Access Management", "exact"),
        "Manage Data!": ("4. Manage Data", "stripped"), "see 7 please": ("7. Manage Infrastructure", "word"),
        "Protct Data": ("5. Protect Data", "fuzzy"), "qqqqq": (None, "none"), "": (None, "none"), None: (None, "none"),
    }
    df = spark.createDataFrame([(c,) for c in cases], "label string").select("label", mt.normalise_l2(F.col("label")).alias("m"))
    assert {r["label"]: tuple(r["m"]) for r in df.collect()} == cases


def test_whole_risk_names_are_not_split(spark):
    df = spark.createDataFrame([("Encryption (At Rest, Use, Transit)",)], "r string")
    both = df.select(mt.split_risks(F.col("r")).alias("w"), mt.split_risks(F.col("r"), whole_first=False).alias("s")).first()
    assert len(both["w"]) == 1 and len(both["s"]) == 3


def test_strict_filter(spark):
    df = spark.createDataFrame([("6. Identity & Access Management", ["authentication", "Secrets", "zz"]), ("99. X", ["Authorization"]),
                                (None, ["kept"]), ("6", [])], "l2 string, risks array<string>")
    got = [r[0] for r in df.select(mt.filter_risks_by_l2(F.col("l2"), F.col("risks"))).collect()]
    assert got == [["Authentication", "Secrets Management"], [], ["kept"], []]


def test_missing_privacy_cells_match_nothing(spark):
    """A null name must not become the word "nan" and so match Financial."""
    df = spark.createDataFrame([("c", "Email", None), ("c", None, None)], "COLUMNNAME string, PRIVACYTYPE string, PRIVACYTYPENAME string")
    rows = pv.label_privacy(df).collect()
    assert rows[0]["pii_types"] == ["Email"] and rows[0]["text"] == "Database Column: c"
    assert rows[1]["pii_types"] == [] and not rows[1]["mapped"]


@pytest.mark.parametrize("name,calls", [
    ("f5_normalise_l2", 1), ("p13_label_findings", 2), ("f10_match_pii_types", 1), ("a6_top_l2_values", 0),
    ("a6_top_risk_values", 0),
])
def test_the_scorer_is_called_once_per_label(spark, name, calls):
    df = load().QUERIES[name](spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == calls


def test_a_length_bound_needs_a_high_cutoff():
    with pytest.raises(ValueError):
        mt.within_reach(None, ["name"], 60.0)


def test_scores_from_a_floor_on_are_exact():
    rng = random.Random(7)
    names = [sim.normalise(n) for n in DEFAULT.all_risks]
    words = sorted({w for n in names for w in n.split()})
    for _ in range(2000):
        a = " ".join(rng.choice(words) for _ in range(rng.randint(1, 12)))
        a = sim.normalise("".join(c if rng.random() > 0.1 else rng.choice("abc ") for c in a))
        b, floor = rng.choice(names), rng.choice([55.0, 65.0, 75.0])
        whole, cut = sim.weighted(a, b), sim.weighted(a, b, floor)
        assert cut == whole if whole >= floor else cut < floor
        size = len(min(a, b, key=len))
        longer, shorter = (a, b) if len(a) >= len(b) else (b, a)
        windows = [longer[max(s, 0):s + size] for s in range(1 - size, len(longer))]
        if len(a) != len(b) and size:
            assert sim.partial(a, b) == max(sim.ratio(shorter, w) for w in windows)


def test_scores_of_many_pairs_equal_their_definition():
    """All pairs at once, strings of several 64-bit words and other planes, against the scores one by one."""
    rng = random.Random(11)
    words = ["data", "risk", "access", "ü", "x", "of", "the", "protect", "Incident", "𝒳𝒴", "_a_"]

    def text(longest):
        return " ".join(rng.choice(words) if rng.random() < 0.6 else "".join(rng.choice("abcde ß") for _ in range(rng.randint(1, 8)))
                        for _ in range(rng.randint(0, longest)))

    pairs = [(text(rng.choice([3, 8, 40])), text(rng.choice([3, 8, 90]))) for _ in range(1500)]
    pairs += [(a, a[:len(a) // 2] + text(3)) for a, _ in pairs[:300]] + [(None, "a"), ("", ""), ("same", "SAME"), ("Ä", "ä")]
    lengths = sim.lcs_lengths([(a or "", b or "") for a, b in pairs])
    for at in range(0, len(pairs), 23):
        assert lengths[at] == _lcs(pairs[at][0] or "", pairs[at][1] or "")
    for cutoff in (65.0, 30.0):
        for (a, b), score in zip(pairs, sim.similarities(pairs, cutoff)):
            a, b = sim.normalise(a or ""), sim.normalise(b or "")
            scores = [f(a, b) for f in (sim.ratio, sim.partial, sim.token_sort, sim.token_set, sim.weighted)] if a and b else [0.0]
            expected = 100.0 if a and a == b else max((s for s in scores if s >= cutoff), default=0.0)
            assert score == pytest.approx(expected / 100, abs=1e-9)


@pytest.mark.parametrize("floor", [0.0, 55.0, 75.0])
def test_long_windows_equal_brute_force(monkeypatch, floor):
    monkeypatch.setattr(sim, "LONG", 10)
    rng = random.Random(5)
    for _ in range(60):
        a, b = ("".join(rng.choice("abc ") for _ in range(rng.randint(10, n))) for n in (40, 120))
        if rng.random() < 0.5:
            b = b[:9] + a[3:-2] + b[9:]
        short, long = sorted((a, b), key=len)
        sides = [(short, long)] + ([(long, short)] if len(a) == len(b) else [])
        best = max(
            200.0 * _lcs(s, w) / (len(s) + len(w)) for s, t in sides for w in (t[max(i, 0):i + len(s)] for i in range(1 - len(s), len(t)))
        )
        found = sim.partial(a, b, floor)
        assert found == best if best > floor else found <= floor


def test_two_long_texts_take_a_moment():
    rng = random.Random(9)
    vocabulary = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 9))) for _ in range(3000)]
    a, b = (" ".join(rng.choice(vocabulary) for _ in range(3200))[:n] for n in (20_000, 19_500))
    began = time.monotonic()
    sim.ratio(a, b)
    whole = time.monotonic() - began
    score = sim.similarity(a, b)
    assert whole < 1 and time.monotonic() - began < 10  # 0.05 and 0.3 s alone; the machine may be busy
    assert 0 <= score <= 1
