"""Best-fit packing: the plan against the least possible number of sequences, and whole tables against the tokenizer."""

import math
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from riskscan.llm import bestfit
from riskscan.llm.common import tokenizer_file

WORDS = "word_bpe_49k.json"
DOCS = "doc_id long, text string, lang string, ids string, length long, _task int"


def sequences_of(plan):
    """The filled spans (offset, tokens) of every sequence of a plan; checks that all pieces are numbered once."""
    used, spans = defaultdict(int), defaultdict(list)
    for length, first, n, sequence, offset, each in plan.rows:
        assert first == used[length] and n % each == 0
        used[length] += n
        for k in range(n // each):
            spans[sequence + k].append((offset, length * each))
    return used, spans


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(0, 300), max_size=30))
def test_plan_places_every_piece_once_without_gaps(histogram):
    plan = bestfit.Plan(histogram, 64)
    used, spans = sequences_of(plan)
    assert used == {length: n for length, n in histogram.items() if n}
    assert sorted(spans) == list(range(plan.sequences))
    for parts in spans.values():
        at = 0
        for offset, tokens in sorted(parts):
            assert offset == at
            at += tokens
        assert at <= 64
    tokens = sum(length * n for length, n in histogram.items())
    assert plan.sequences <= 2 * math.ceil(tokens / 64)


def test_plan_is_near_the_least_number_of_sequences():
    rng = np.random.default_rng(1)
    lengths, counts = np.unique(np.clip(rng.lognormal(6, 1, 50_000), 1, 4096).astype(int), return_counts=True)
    plan = bestfit.Plan(dict(zip(lengths.tolist(), counts.tolist())), 4096)
    assert plan.sequences <= 1.002 * math.ceil((lengths * counts).sum() / 4096)
    huge = bestfit.Plan({length: n * 10**7 for length, n in zip(lengths.tolist(), counts.tolist())}, 4096)
    assert huge.sequences <= 1.002 * math.ceil((lengths * counts).sum() * 10**7 / 4096)
    assert len(huge.rows) < 5 * len(lengths)


def test_patterns_are_fitted_to_the_histogram():
    """Sizes that only go together in one way: least squares finds how often."""
    plan = bestfit.Plan({2048: 30, 1024: 60, 1536: 20, 2560: 20}, 4096)
    assert plan.sequences == 30 + 20
    matrix, target = np.array([[1.0, 0, 2], [1, 1, 0], [0, 3, 1]]), np.array([5.0, 4, 8])
    x = bestfit.least_squares(matrix, target)
    assert (x >= 0).all() and np.allclose(matrix @ x, target)
    held = bestfit.least_squares(np.array([[1.0, -1], [0, 1]]), np.array([1.0, -1]))
    assert np.allclose(held, [1, 0])  # without the bound, the second would be -1


@pytest.fixture(scope="module")
def odd(spark):
    rng = np.random.default_rng(5)
    words = ["alpha", "Beta", "gamma,", "delta.", "é　ß", "中文"]
    rows = [(i, " ".join(rng.choice(words, int(n)))) for i, n in enumerate(rng.integers(1, 200, 120))]
    rows += [(3, rows[3][1]), (None, "no id"), (None, "no id"), (500, None), (501, ""), (502, " \n "), (503, "word " * 700)]
    return spark.createDataFrame([(i, t, "en", "x", 7, 1) for i, t in rows], DOCS).repartition(5), rows


def test_pieces_hold_the_documents_ids(spark, odd):
    docs, rows = odd
    tokenizer = Tokenizer.from_file(tokenizer_file(WORDS))
    tokenizer.encode_special_tokens = True
    whole = sorted(((i is not None, i or 0), [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1]) for i, t in rows)
    packed = bestfit.pack(docs, tokenizer_file(WORDS), capacity=256).collect()
    filled = defaultdict(list)
    for r in packed:
        filled[r["sequence_id"]].append((r["offset"], r["length"]))
        assert 0 < r["length"] <= 256 and r["start"] == 256 * r["piece"] and len(r["ids"]) == 4 * r["length"]
    for spans in filled.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 256
    ids = defaultdict(list)
    for r in sorted(packed, key=lambda r: r["piece"]):
        ids[(r["doc_id"] is not None, r["doc_id"] or 0)].append((r["piece"], np.frombuffer(r["ids"], "<u4").tolist()))
    found = []
    for doc, pieces in ids.items():  # rows that share an id: their pieces stand side by side
        copies = sum(p == 0 for p, _ in pieces)
        heads = [p for p in pieces if p[0] == 0]
        if copies == len(pieces):
            found += [(doc, p) for _, p in heads]
        else:
            assert copies == 1 or len({str(p) for n, p in pieces if n == 0}) == 1
            found += [(doc, sum((p for _, p in pieces[c::copies]), [])) for c in range(copies)]
    assert sorted(found) == whole
    tokens = sum(len(w) for _, w in whole)
    assert len(filled) <= math.ceil(tokens / 256) * 1.05 + 1
    assert packed and set(filled) == set(range(len(filled)))


def test_place_keeps_other_columns(spark, odd):
    docs, _ = odd
    pieces = bestfit.cut(docs, tokenizer_file(WORDS)).withColumn("odd name", F.length("ids")).drop("ids")
    placed = bestfit.place(pieces)
    assert placed.columns == ["doc_id", "piece", "start", "length", "odd name", "sequence_id", "offset"]
    assert placed.where("`odd name` <> 4 * length").isEmpty()


def test_empty_table(spark):
    assert bestfit.pack(spark.createDataFrame([], DOCS), tokenizer_file(WORDS)).collect() == []
