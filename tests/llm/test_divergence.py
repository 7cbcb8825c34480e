"""The source divergence audit: transducers, and the whole audit against plain Python with exact integers."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from riskscan.llm import divergence, transducer

DOCS = "doc_id long, text string, lang string, source string, value long, rank int, _at string"
LETTERS = st.binary(max_size=6).map(lambda b: bytes(b"ab\xc3\x00"[x % 4] for x in b))


@settings(max_examples=200, deadline=None)
@given(st.sets(LETTERS, max_size=60), st.lists(LETTERS, max_size=40))
def test_ordinals_are_places_in_the_sorted_terms(terms, asked):
    held = sorted(terms)
    asked = asked + held
    reader = transducer.Transducer(**transducer.build(held))
    text = np.frombuffer(b"".join(asked) + b"a", dtype=np.uint8)
    ends = np.cumsum([0] + [len(a) for a in asked])
    found = reader.ordinals(text, ends[:-1], ends[1:]).tolist()
    assert found == [held.index(a) if a in terms else -1 for a in asked]


def test_transducers_are_minimal():
    ends = [b"", b"s", b"ed", b"ing"]
    built = transducer.build(sorted(stem + e for stem in (b"walk", b"talk", b"balk") for e in ends))
    # w, t and b lead to one state: a-l-k, then s, e-d and i-n-g
    assert len(built["final"]) == 9 and len(built["code"]) == 12
    with pytest.raises(ValueError):
        transducer.build([b"b", b"a"])


def test_shares_do_not_overflow():
    rng = random.Random(2)
    for total in [1, 2, 999, 10**9 + 7, 9 * 10**15]:
        counts = [0, total - 1] + [rng.randrange(total) for _ in range(50)]
        found = divergence.shares(np.array(counts, dtype=np.int64), total).tolist()
        assert found == [1 + 10**9 * (c + 1) // total for c in counts]


def by_hand(rows, least, top):
    docs = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate({c: c + 32 for c in range(65, 91)})))
            for text, lang, source in rows]
    held, groups = defaultdict(Counter), defaultdict(Counter)
    for lang, source, terms in docs:
        held[lang].update(set(terms))
        groups[lang, source].update(terms)
    out = set()
    for lang in held:
        kept = sorted((t for t, n in held[lang].items() if n >= least), key=str.encode)
        own = {s: [c[t] for t in kept] for (g, s), c in groups.items() if g == lang}
        share = lambda n: [1 + 10**9 * (c + 1) // (sum(n) + len(kept)) for c in n]
        p, q = {s: share(n) for s, n in own.items()}, share([sum(n) for n in zip(*own.values())])
        score = lambda a, b: (a - b) ** 2 // b
        for s in own:
            pairs = sorted((-sum(map(score, p[s], p[o])), o.encode(), o) for o in own if o != s)
            terms = sorted((-score(a, b), i) for i, (n, a, b) in enumerate(zip(own[s], p[s], q)) if n and a > b)
            out |= {(lang, s, "pair", o, -v, i + 1) for i, (v, _, o) in enumerate(pairs)}
            out |= {(lang, s, "term", kept[i], -v, r + 1) for r, (v, i) in enumerate(terms[:top])}
    return out


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(7)
    words = [f"{a}{b}" for a in "abcdéßЖ" for b in ("", "x", "yz", "Q", "ñandú", "zzz")]
    made = []
    for i in range(400):
        lang = rng.choice(["en", "en", "de", None])
        source = rng.choice(["hot"] * 5 + ["s1", "s2", "é", None])
        own = words[: 20 + (len(source or "") * 5)]
        made.append((" ".join(rng.choice(own) + rng.choice(["", ",", "7", "_", "\n"]) for _ in range(rng.randrange(40))), lang, source))
    made += [made[0]] * 3 + [(None, None, None), ("", "fr", "a"), (None, "fr", "b"), ("1 2 3", "fr", None), ("one two", "xx", "only")]
    made += [("z" * 5000 + " tail", "en", s) for s in ("hot", "s1", "s1")]  # one very long term that is kept
    return made


def table(spark, rows):
    return spark.createDataFrame([(i, t, lang, s, 1, 2, "x") for i, (t, lang, s) in enumerate(rows)], DOCS)


def test_audit_equals_plain_python(spark, rows):
    found = {tuple(r) for r in divergence.audit(table(spark, rows).repartition(5)).collect()}
    assert found == by_hand(rows, 3, 200)


def test_small_pieces_rounds_and_tiles_change_nothing(spark, rows, monkeypatch):
    for name, value in {"PIECE_BYTES": 40, "ROUND_EDGES": 60, "BLOCK": 7, "TILE": 2, "GATHERED": 9, "BYTES_AT_ONCE": 300}.items():
        monkeypatch.setattr(divergence, name, value)
    docs = table(spark, rows[:250]).coalesce(2)
    vocabulary = divergence.numbered(divergence.kept_terms(divergence.groups_of(docs), 3))
    pieces = divergence.transducers(vocabulary)
    assert pieces.count() > 5 and len(divergence.rounds_of(pieces)) > 2
    found = {tuple(r) for r in divergence.audit(docs, top=5).collect()}
    assert found == by_hand(rows[:250], 3, 5)


def test_empty_table(spark):
    assert divergence.audit(table(spark, [])).collect() == []
