"""Periodic runs against brute force over all lags: on random words, odd rows, and the query on a whole table."""

import hashlib
import zlib
from fractions import Fraction

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from riskscan.llm import queries, runs

DOCS = "doc_id long, text string, runs string, collapsed string, n_words string"
SF_DIR = "/root/testdata/sf0.001"


def by_brute_force(x, least=24, power=3):
    """All lags, all stretches; the smallest period is tried directly."""
    x, found = np.asarray(x), set()
    for q in range(1, len(x) // power + 1):
        same = np.concatenate([[False], x[:-q] == x[q:], [False]]).astype(int)
        for start, end in zip(np.flatnonzero(np.diff(same) == 1).tolist(), np.flatnonzero(np.diff(same) == -1).tolist()):
            stretch = x[start:end + q]
            if len(stretch) >= max(least, power * q) and not any((stretch[:-p] == stretch[p:]).all() for p in range(1, q)):
                found.add((start, len(stretch), q))
    return sorted(found)


words = st.integers(0, 2)
pieces = st.one_of(
    st.lists(words, max_size=12),
    st.tuples(st.lists(words, min_size=1, max_size=30), st.integers(1, 12), st.integers(0, 5)).map(lambda t: (t[0] * t[1])[t[2]:]),
)


@settings(max_examples=400, deadline=None)
@given(st.lists(pieces, max_size=8), st.sampled_from([(24, 3), (3, 3), (6, 3), (12, 4)]))
def test_runs_equal_brute_force(parts, rule):
    x = sum(parts, [])
    assert runs.runs(np.array(x, dtype=np.int64), *rule) == by_brute_force(x, *rule)


def test_every_class_of_lags_has_its_runs():
    rng = np.random.default_rng(4)
    for period in [*range(1, 40), 63, 64, 65, 100, 127, 128, 129, 1000]:
        for length in (max(24, 3 * period) - 1, max(24, 3 * period), 3 * period + 30):
            inner = np.resize(rng.integers(10, 10_000, period), length)
            x = np.concatenate([rng.integers(20_000, 90_000, 7), inner, rng.integers(20_000, 90_000, 5)])
            assert runs.runs(x) == by_brute_force(x)


@pytest.mark.parametrize("unit", [1, 2, 17, 1000])
def test_long_repeats_cost_pairs_in_proportion(unit, monkeypatch):
    """Every position repeats all others at its lag, yet hardly any pair is extended."""
    calls = []
    end = runs.match_end
    monkeypatch.setattr(runs, "match_end", lambda *a: calls.append(a[2]) or end(*a))
    assert runs.runs(np.arange(60_000) % unit) == [(0, 60_000, unit)]
    assert len(calls) <= 2 * unit + 60


def test_few_than_three_periods_are_refused():
    with pytest.raises(ValueError):
        runs.runs(np.zeros(50, dtype=np.int64), 10, 2)


def test_words_are_numbered_alike_in_pieces(monkeypatch):
    monkeypatch.setattr(runs, "BYTES_AT_ONCE", 7)
    text = "  äöü\tb  c\x0b\x0cäöü \n a" * 9
    numbers = runs.Numbers()
    found = runs.word_numbers(text.encode(), numbers)
    names = list(numbers)
    assert [names[i].decode() for i in found] == [w.decode() for w in text.encode().split()]


def test_odd_rows(spark):
    loop = " ".join(["a", "b"] * 12)
    long = " ".join(f"w{i % 5000}" for i in range(40_000))
    rows = [
        (1, loop), (1, loop), (2, None), (3, ""), (4, " \n\t "), (None, loop + " c"), (None, None), (5, loop[:-2]),
        (6, "x y " * 24), (7, long), (8, "a " * 23), (9, "\n\n".join(["one two three"] * 8) + " four"),
    ]
    docs = spark.createDataFrame([(i, t, "r", "c", "n") for i, t in rows], DOCS).repartition(4)
    found = sorted((r["doc_id"] or -1, r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in runs.find_runs(docs).collect())
    first = " ".join(f"w{i}" for i in range(5000))
    assert found == sorted([
        (1, 24, [(0, 24, 2)], "a b"), (1, 24, [(0, 24, 2)], "a b"), (2, 0, [], ""), (3, 0, [], ""), (4, 0, [], ""),
        (-1, 25, [(0, 24, 2)], "a b c"), (-1, 0, [], ""), (5, 23, [], loop[:-2]), (6, 24, [(0, 24, 1)], "x y"),
        (7, 40_000, [(0, 40_000, 5000)], first), (8, 23, [], ("a " * 23).strip()),
        (9, 25, [(0, 24, 3)], "one two three four"),
    ])
    assert runs.find_runs(spark.createDataFrame([], DOCS)).collect() == []


def test_query_equals_brute_force(spark):
    expected = {}
    for doc, text in duckdb.sql(f"select doc_id, text from '{SF_DIR}/documents.parquet'").fetchall():
        listed = [w.decode() for w in (text or "").encode().split()]
        n, h = len(listed), zlib.crc32(str(doc).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            listed = [w if i < a else listed[a + (i - a) % p] for i, w in enumerate(listed)]
        found = by_brute_force(np.unique(listed, return_inverse=True)[1] if n else [])
        gone = {i for s, length, q in found for i in range(s + q, s + length)}
        best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None,) * 3)
        digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
        expected[doc] = (
            doc, len(found), *best, best[1] and 1000 * best[1] // best[2],
            digest("".join(f"{s},{length},{q}\n" for s, length, q in found)),
            digest(" ".join(w for i, w in enumerate(listed) if i not in gone)),
        )
    rows = queries.QUERIES["op12_periodic_runs"](spark, SF_DIR).collect()
    assert {r["doc_id"]: tuple(r) for r in rows} == expected and len(rows) == len(expected)
    assert sum(r["n_runs"] > 0 for r in rows) >= 10
