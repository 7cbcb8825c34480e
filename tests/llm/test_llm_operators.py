"""The training-data operators against brute force, and on odd input."""

import hashlib
import json
import math
import os
import random
import re
import subprocess
import sys
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import corpus_pipeline
import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from riskscan.llm import (
    chat, encoding, iblt, langid, linededup, mixing, packing, resemblance, simhash, tokenfile, topk, urls,
)
from riskscan.llm.common import fresh_path, tokenizer_file
from riskscan.llm.components import connected

DOCS = "doc_id long, text string, lang string, source string, n_chars long, fingerprint string, _range string"
LONG = " ".join(f"word{i % 977}." for i in range(30_000))


def documents(spark, rows):
    """Rows of (doc_id, text, lang, source); with columns whose names the operators use themselves."""
    return spark.createDataFrame(
        [(i, t, lang, s, None if t is None else len(t), "x", "y") for i, t, lang, s in rows], DOCS
    )


@pytest.fixture(scope="module")
def odd(spark):
    return documents(spark, [
        (1, "the quick brown fox jumps over the lazy dog and runs away", "en", "a"),
        (2, "the quick brown fox jumps over the lazy dog and runs away", "en", "a"),
        (2, "the quick brown fox jumps over the lazy dog and runs away", "en", "a"),
        (3, None, None, None), (4, "", "en", "b"), (None, "no id here", "en", "b"), (None, None, None, None),
        (5, " \n\t ", None, "c"), (6, "123 456 !!!", "en", "a"), (7, LONG, "en", "d"), (8, "é\u3000ß 中文 \u0130x", "de", None),
    ])


@pytest.fixture(scope="module")
def empty(spark):
    return documents(spark, [])


# ---------------------------------------------------------------- top-k search


def test_search_equals_brute_force(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(size=16).astype("f4")]) for i in range(300)]
    rows += [(i, rows[i % 7][1]) for i in range(300, 360)]  # copies: ties
    odd = [(1000, None), (1001, [1.0, None]), (1002, [float("nan")] * 16), (1003, [float("inf")] * 16), (None, [1.0] * 16),
           (1050, []), (1100, [0.5])]
    df = spark.createDataFrame([(i, v, 0, "x") for i, v in rows + odd], "vec_id long, embedding array<float>, label int, score string")
    found = topk.search(df, F.col("vec_id") % 50 == 0, k=5, shard_rows=64, block_rows=3).collect()
    whole = {i: [int(np.floor(256 * float(np.float32(x)))) for x in v] for i, v in rows + [(1050, []), (1100, [0.5])]}
    want = set()
    for q in (i for i in whole if i % 50 == 0):
        scored = sorted(((-sum(a * b for a, b in zip(whole[q], v)), i) for i, v in whole.items() if i != q))[:5]
        want |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(scored)}
    assert {tuple(r) for r in found} == want
    assert topk.search(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_search_with_fewer_rows_than_k_and_large_numbers(spark):
    df = spark.createDataFrame([(0, [1e14, 1.0]), (1, [1.0, 2.0]), (2, [-1e14, 0.0])], "vec_id long, embedding array<double>")
    found = topk.search(df, F.col("vec_id") == 1, k=5).collect()
    assert sorted(tuple(r) for r in found) == [(1, 1, 0, 256 * 256 * 10**14 + 512 * 256), (1, 2, 2, -256 * 256 * 10**14)]


# ---------------------------------------------------------------- SimHash


def brute_fingerprint(text, words=4):
    found = (text or "").encode().lower().split()
    if not found:
        return 0
    shingles = [b" ".join(found[i:i + words]) for i in range(max(1, len(found) - words + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


@given(st.one_of(st.none(), st.text(alphabet="aA bé\t\n\u3000İ", max_size=60)))
@settings(max_examples=60, deadline=None)
def test_fingerprint_by_definition(text):
    assert simhash.fingerprint(text) & (2**64 - 1) == brute_fingerprint(text)


def test_links_are_exactly_those_within_four_bits(spark):
    rng = random.Random(5)
    values = {rng.getrandbits(64) for _ in range(40)} | {0, 2**64 - 1}
    for v in list(values)[:20]:
        near = v
        for _ in range(12):
            near ^= sum(1 << b for b in rng.sample(range(64), rng.randint(1, 6)))
            values.add(near)
    values = sorted(values)
    df = spark.createDataFrame([(v - 2**64 if v >> 63 else v,) for v in values], "fp long")
    found = connected(simhash.near_links(df)).collect()
    parent = {v: v for v in values}

    def root(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for i, a in enumerate(values):
        for b in values[i + 1:]:
            if (a ^ b).bit_count() <= 4:
                parent[root(a)] = root(b)
    want, got = defaultdict(set), defaultdict(set)
    for v in values:
        want[root(v)].add(v)
    for r in found:
        got[r["root"]].add(r["node"] & (2**64 - 1))
    assert {frozenset(g) for g in got.values()} == {frozenset(g) for g in want.values() if len(g) > 1}


def test_variants_in_rounds_give_the_same_links(monkeypatch):
    rng = np.random.default_rng(2)
    values = np.unique(np.concatenate([rng.integers(0, 2**63, 30, dtype=np.uint64), np.arange(40, dtype=np.uint64)]))
    balls = simhash.Balls(6, 2)
    def roots(key):  # of the values that are sent to the key
        own = values[np.isin(balls.keys(values) ^ key, list(balls.masks))]
        return simhash.smallest_linked(len(own), *balls.links(own, key, 4)).tolist()

    whole = [roots(key) for key in range(4)]
    monkeypatch.setattr(simhash, "VARIANTS_AT_ONCE", 500)
    assert whole == [roots(key) for key in range(4)]


def test_near_duplicates_on_odd_rows(odd, empty):
    rows = simhash.near_duplicates(odd).collect()
    assert len(rows) == odd.count()
    by_id = defaultdict(set)
    for r in rows:
        by_id[r["doc_id"]].add((r["fingerprint"], r["component_id"]))
    assert by_id[2] == by_id[1] and next(iter(by_id[2]))[1] == 1
    assert by_id[3] == by_id[4] == by_id[5] == {("0" * 16, 3)}
    assert ("0" * 16, 3) in by_id[None]
    assert simhash.near_duplicates(empty).count() == 0
    kept = simhash.one_of_each(odd)
    assert kept.columns == odd.columns
    assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"]) == [1, 3, 6, 7, 8]


def test_near_dedup_stage_finds_four_fifths_of_the_shingles(spark):
    rng = random.Random(8)
    word = lambda: f"w{rng.randrange(10**6)}"
    texts = []
    for _ in range(40):  # copies with 1 to 12 words of 200 changed: five-word similarity from 0.95 to 0.54
        base = [word() for _ in range(200)]
        for changed in [0, *rng.sample(range(1, 13), 3)]:
            copy = base[:]
            for at in rng.sample(range(200), changed):
                copy[at] = word()
            texts.append(" ".join(copy))
    base = [word() for _ in range(100)]
    texts += [" ".join([*base, *(word() for _ in range(rng.randint(1, 60)))]) for _ in range(60)]  # one large mixed group
    texts += ["only three words", "Only  THREE words", "four words are here", "", None]
    rows = list(enumerate(texts))
    found = lambda t: {tuple((t or "").lower().split()[j:j + 5]) for j in range(max(1, len((t or "").split()) - 4))}
    sets = {i: found(t) for i, t in rows}
    alike = {(a, b) for a in sets for b in sets if a < b and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])}
    docs = documents(spark, [(i, t, "en", "a") for i, t in rows])
    kept = {r["doc_id"] for r in corpus_pipeline.near_dedup(spark, docs, "").collect()}
    assert not [(a, b) for a, b in alike if a in kept and b in kept]
    prints = {i: simhash.fingerprint(t) & (2**64 - 1) for i, t in rows}
    linked = alike | {(a, b) for a in sets for b in sets if a < b and (prints[a] ^ prints[b]).bit_count() <= 4}
    assert set(sets) - kept <= {b for _, b in linked} | {a for a, _ in linked}
    assert {i for i in sets if not any(i in pair for pair in linked)} <= kept
    for i in set(sets) - kept:  # what goes is linked, over others, to one that stays
        group, open_ = {i}, [i]
        while open_:
            one = open_.pop()
            more = {a + b - one for a, b in linked if one in (a, b)} - group
            group |= more
            open_ += more
        assert min(group) in kept


def test_near_dedup_stage_on_odd_rows(odd, empty):
    kept = resemblance.one_of_each(odd)
    assert kept.columns == odd.columns
    assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"]) == [1, 3, 6, 7, 8]
    assert resemblance.one_of_each(empty).count() == 0


def test_texts_that_share_a_passage_cost_rows_in_proportion(spark, monkeypatch):
    """200 shared and 50 own words each: no two are alike, and no text meets all others."""
    shared = [f"common{i}" for i in range(200)]
    sizes, compared = (100, 200, 400), []
    written = resemblance.written

    def counting(df, name):
        out = written(df, name)
        compared[-1] += out.count() if name == "tried" else 0
        return out

    monkeypatch.setattr(resemblance, "written", counting)
    for n in sizes:
        rows = [(i, " ".join(shared[:100] + [f"own{i}x{j}" for j in range(50)] + shared[100:]), "en", "a") for i in range(n)]
        compared.append(0)
        docs = documents(spark, rows)
        assert resemblance.similar(docs, resemblance.marks(docs)).isEmpty()
    assert compared[-1] <= 20 * sizes[-1] and compared[-1] <= 2.5 * compared[-2] <= 6.25 * compared[-3]


def test_no_link_between_alike_texts_is_left_to_chance(spark):
    """Families in which each text is alike its parent and few others: all shingles recur, and any link lost parts a family."""
    drawn, texts = random.Random(7), []
    for family in range(8):
        members = [[f"f{family}w{i}" for i in range(60)]]
        while len(members) < 60:
            words = list(drawn.choice(members))
            words[drawn.randrange(60)] = f"f{family}x{drawn.randrange(12)}"
            members.append(words)
        texts += dict.fromkeys(" ".join(m) for m in members)
    texts += ["one two three four five six seven eight", "one two three four five six seven eight nine"]  # 4 shingles of 5
    docs = documents(spark, [(i, t, "en", "a") for i, t in enumerate(texts)])
    marked = resemblance.marks(docs)
    node = {r["shingled"]: r["doc_id"] for r in marked.collect()}
    sets = [set(resemblance.shingles(t).tolist()) for t in texts]
    parent = list(range(len(texts)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    def groups(pairs):
        parent[:] = range(len(texts))
        for a, b in pairs:
            parent[max(root(a), root(b))] = min(root(a), root(b))
        return [root(i) for i in range(len(texts))]

    alike = {(a, b) for a, b in combinations(range(len(texts)), 2) if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])}
    found = {tuple(sorted((node[r["a"]], node[r["b"]]))) for r in resemblance.similar(docs, marked).collect()}
    assert found <= alike
    assert groups(found) == groups(alike)


def test_long_chain_is_one_component(spark):
    links = spark.range(300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    found = connected(links).agg(F.count("*"), F.count_distinct("root")).first()
    assert tuple(found) == (301, 1)


# ---------------------------------------------------------------- URLs

RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]


def page_rows(spark, found):
    return spark.createDataFrame([(i, u, "h", "r") for i, u in enumerate(found)], "page_id long, url string, host string, rule string")


def test_rules_and_parts_of_urls(spark):
    cases = {
        "HTTP://WWW.Example.ORG/es/1?x": ("www.example.org", "/es/1", "example.org/es/", "block"),
        "x://example.org/en/1": ("example.org", "/en/1", "example.org/en/1", "block"),
        "x://example.org/en/2": ("example.org", "/en/2", "org/", "allow"),
        "x://notexample.org/es/": ("notexample.org", "/es/", "org/", "allow"),
        "x://a.com/de/#f": ("a.com", "/de/", "com/de/", "block"),
        "x://a.com?de/": ("a.com", "", None, "allow"),
        "x://b.net/p://c/d": ("b.net", "/p://c/d", None, "allow"),
        "no scheme": ("", "", None, "allow"), None: ("", "", None, "allow"), "": ("", "", None, "allow"),
    }
    rows = urls.judge(page_rows(spark, list(cases)), RULES).collect()
    assert {list(cases)[r["page_id"]]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in rows} == cases
    assert urls.judge(page_rows(spark, []).limit(0), RULES).count() == 0


def test_templates_learn_from_labels(spark):
    bad = [f"x://h.net/spam/{i}" for i in range(40)]
    good = [f"x://h.net/blog/{i}.html" for i in range(40)] + [f"x://h.net/{'abcdefgh'[i % 8]}-post{'x' * i}/q" for i in range(60)]
    found = page_rows(spark, bad + good + bad[:3])
    label = F.when(F.col("page_id") % 2 == 0, F.col("url").contains("/spam/"))
    rows = urls.judge(found, [], label).collect()
    assert len(rows) == 143
    assert all((r["verdict"] == "block") == r["path"].startswith("/spam/") for r in rows)
    assert {r["template"].split("/")[0] for r in rows if "post" in r["path"]} == {"*"}


def test_a_rare_blocked_section_stays_literal(spark):
    """One of sixty sections, under two percent of the urls, is blocked as a whole."""
    sections = [f"sec{a}{b}" for a in "abcdefgh" for b in "abcdefgh"][:60]
    found = page_rows(spark, [f"x://h.net/{s}/{'y' * (i % 7)}x{i}" for s in sections for i in range(100)])
    label = F.when(F.col("page_id") % 2 == 0, F.col("url").contains("/secaa/"))
    rows = urls.judge(found, [], label).collect()
    assert {r["verdict"] for r in rows if "/secaa/" in r["path"]} == {"block"}
    assert {r["verdict"] for r in rows if "/secaa/" not in r["path"]} == {"allow"}


def test_levels_follow_the_deepest_labels(spark):
    found = page_rows(spark, [f"x://h.net/a/b/c/{kind}/{i}" for kind in ("bad", "ok") for i in range(60)])
    label = F.when(F.col("page_id") % 2 == 0, F.col("url").contains("/bad/"))
    rows = urls.judge(found, [], label).collect()
    assert all((r["verdict"] == "block") == ("/bad/" in r["path"]) for r in rows)


def plain_judge(found, min_share=0.02, smoothing=4.0, z=1.96, reject=0.8):
    """The same on a list of (host, path, label), in plain Python: (verdict, template) of each."""
    general = lambda s: "/*" + (re.search(r"(\.[a-z]{1,5})$", s) or [""])[0] if re.search("[0-9]", s) else s
    rows = [(host, tuple(general(s) for s in path.split("/") if s), label) for host, path, label in found]
    kinds = defaultdict(set)
    for host, _, label in rows:
        kinds[host].add(label)
    deep = [len(s) for host, s, label in rows if label is not None and {True, False} <= kinds[host]]
    levels = max([1, *deep])
    shaped = [(h, (*s[:levels], *[""] * (levels - len(s)), "/**" if len(s) > levels else ""), label) for h, s, label in rows]

    def counts(keys):
        out = defaultdict(lambda: [0, 0, 0])
        for key, (_, _, label) in zip(keys, shaped):
            for i, hit in enumerate((True, label is False, label is True)):
                out[key][i] += hit
        return out

    def differs(own, every):
        n, rest = own[1] + own[2], every[1] + every[2] - own[1] - own[2]
        if not n or not rest:
            return False
        pooled = every[2] / (every[1] + every[2])
        return abs(own[2] / n - (every[2] - own[2]) / rest) > z * math.sqrt(pooled * (1 - pooled) * (1 / n + 1 / rest))

    names = [(h,) for h, _, _ in shaped]
    for level in range(levels):
        child, above = counts([(t, s[level]) for t, (_, s, _) in zip(names, shaped)]), counts(names)
        keeps = lambda t, c: (child[t, c][0] >= min_share * above[t][0] or c[:2] == "/*" or c == "" or differs(child[t, c], above[t]))
        names = [(*t, s[level] if keeps(t, s[level]) else "/*") for t, (_, s, _) in zip(names, shaped)]
    names = [(*t, s[levels]) for t, (_, s, _) in zip(names, shaped)]
    labels = counts([0] * len(shaped))[0]
    prior = labels[2] / (labels[1] + labels[2]) if labels[1] + labels[2] else 0.0
    branches = [(t[0],) for t in names]
    of = counts(branches)
    purity = [(of[b][2] + smoothing * prior) / (of[b][1] + of[b][2] + smoothing) for b in branches]
    for level in range(levels + 1):
        child, above = counts([(b, t[level + 1]) for b, t in zip(branches, names)]), counts(branches)
        grown = [(*b, t[level + 1] if differs(child[b, t[level + 1]], above[b]) else "/~") for b, t in zip(branches, names)]
        own = counts(grown)
        for i, (b, g) in enumerate(zip(branches, grown)):
            n = own[g][1] + own[g][2]
            if n != above[b][1] + above[b][2]:
                purity[i] = (own[g][2] + smoothing * purity[i]) / (n + smoothing)
        branches = grown
    shown = lambda t: "/".join(s[1:] if s[:1] == "/" else s for s in t[1:])
    return [("block" if p >= reject else "allow", shown(t), round(p, 9)) for p, t in zip(purity, names)]


@pytest.mark.parametrize("seed", range(3))
def test_templates_equal_a_plain_python_judge(spark, seed):
    rng = random.Random(seed)
    parts = ["a", "b", "*", "**", "~", "c.html", "p7.html", "12", "x9"]
    found = []
    for i in range(600):
        host = rng.choice(["h.net"] * 4 + ["i.com", "j.org"])
        path = "".join("/" + rng.choice(parts if rng.random() < 0.8 else [f"rare{chr(97 + i % 26)}"]) for _ in range(rng.randint(0, 4)))
        likely = 0.9 if path.startswith(("/a", "/~/b")) else 0.1
        label = None if rng.random() < 0.4 or host == "j.org" else rng.random() < likely
        found.append((host, path, label))
    df = spark.createDataFrame([(i, f"x://{h}{p}?q", l) for i, (h, p, l) in enumerate(found)], "page_id long, url string, blocked boolean")
    rows = {r["page_id"]: (r["verdict"], r["template"], round(r["purity"], 9)) for r in urls.judge(df, [], F.col("blocked")).collect()}
    assert [rows[i] for i in range(len(found))] == plain_judge(found)


# ---------------------------------------------------------------- sketches


@given(st.lists(st.integers(0, 60), max_size=40), st.lists(st.integers(0, 60), max_size=40))
@settings(max_examples=80, deadline=None)
def test_sketches_recover_all_differences(a, b):
    left, right = (iblt.digests("\n".join(map(str, x))) for x in (a, b))
    ours, theirs = iblt.recovered(left, right)
    assert sorted(ours) == sorted(set(left.tolist()) - set(right.tolist()))
    assert sorted(theirs) == sorted(set(right.tolist()) - set(left.tolist()))


@given(st.integers(0, 2**64 - 1), st.integers(0, 30))
def test_one_key_and_many_keys_have_the_same_cells(key, salt):
    cells, check = iblt.place_and_check(key, 8, salt)
    many = np.array([key], dtype=np.uint64)
    assert cells == iblt.places(many, 24, salt)[:, 0].tolist() and check == int(iblt.checks(many)[0])


def test_edits_follow_the_order_of_ids(spark, odd, empty):
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choice(["ab.", "cde", "f\n", "gh!"]) for _ in range(rng.randint(0, 60))), "en", "a") for i in range(90)]
    spark.conf.set("spark.sql.shuffle.partitions", "5")
    found = {r["doc_id"]: r for r in iblt.fingerprint_edits(documents(spark, rows)).collect()}
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    order = sorted(rows, reverse=True)
    for n, (i, text, *_) in enumerate(order):
        following = order[(n + 1) % len(order)][1]
        k = len(text) // 3
        edited = text[:len(text) - k] + following[:k]
        a, b, c = (set(iblt.digests(t).tolist()) for t in (text, edited, following))
        r = found[i]
        assert r["n_chars"] == len(text) and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert r["near_edited"] == pytest.approx(len(a & b) / len(a | b))
        assert r["near_next"] == pytest.approx(len(a & c) / len(a | c))
    many = iblt.fingerprint_edits(odd).collect()
    assert len(many) == odd.count() and len({r["fingerprint"] for r in many if r["doc_id"] in (1, 2)}) == 1
    assert iblt.fingerprint_edits(empty).count() == 0
    one = iblt.fingerprint_edits(documents(spark, [(5, "abc def", "en", "a")])).first()
    assert one["near_next"] == 1.0 and one["edited_sha256"] == hashlib.sha256(b"abc dab").hexdigest()


# ---------------------------------------------------------------- languages


def test_languages_are_told_apart_on_held_out_documents(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = langid.identify(df).join(df.select("doc_id", "lang"), "doc_id").where("held_out")
    share = found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.avg(F.col("rejected").cast("int"))).first()
    assert share[0] > 0.97 and share[1] < 0.03


def test_only_letters_tell_a_language():
    assert [langid.letters(t) for t in ("½ ²", "x² ⅷ 三 ٣", "Ⅷ", "a_b1c", "É\u0301t\u00e9")] == ["", "x 三", "", "a b c", "é t\u00e9"]
    assert langid.judge("½ ² ٣ _", (("en", b"the ", (b"the ",)),), 0.01) == ("und", 0.0, True)
    every = "".join(c for c in map(chr, range(0x110000)) if c.isalnum() and not c.isalpha() and not 0xD800 <= ord(c) < 0xE000)
    assert langid.letters(every) == ""


def test_many_languages_share_the_budget(spark):
    """200 languages, and labels that stand once: bounded dictionaries, and every language is told apart."""
    rng = random.Random(8)
    words = {f"l{i:03}": ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6)) for _ in range(40)] for i in range(200)}
    rows = [(i, " ".join(rng.choice(words[lang]) for _ in range(60)), lang, "a") for i, lang in enumerate([*words] * 4)]
    rows += [(5000 + i, "stray label", f"stray{i}", "a") for i in range(100)]
    df = documents(spark, rows)
    lessons = langid.learn(df, F.lit(True), total_bytes=300 * 500, sample_total=600)
    assert len(lessons) == 300 and max(len(words) for _, words, _ in lessons) <= 500
    assert len(langid.learn(df, F.lit(True), sample_total=200)) == 200
    judged = [langid.judge(t, lessons, 0.01)[0] == lang for _, t, lang, _ in rows[::16][:50]]
    assert sum(judged) >= 48


def test_every_row_is_judged_by_the_learned_lessons(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    lessons = langid.learn(df, ~langid.held_out(F.col("doc_id")))
    found = {r["doc_id"]: (r["lang_pred"], r["score"], r["rejected"]) for r in langid.identify(df).collect()}
    again = {i: langid.judge(t, lessons, 0.01) for i, t in df.select("doc_id", "text").collect()}
    assert found == again


def test_short_texts_are_seldom_rejected(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    lessons = langid.learn(df, F.lit(True))
    cut = [(" ".join(t.split()[:4])[:20], lang) for t, lang in df.where("lang is not null").select("text", "lang").limit(400).collect() if langid.letters(t)]
    judged = [(langid.judge(t, lessons, 0.01), lang) for t, lang in cut if langid.letters(t)]
    assert sum(r[2] for r, _ in judged) <= 0.1 * len(judged)


def test_languages_on_odd_rows(odd, empty):
    rows = langid.identify(odd).collect()
    assert len(rows) == odd.count()
    blank = [r for r in rows if r["doc_id"] in (3, 4, 5, 6)]
    assert all((r["lang_pred"], r["score"], r["rejected"]) == ("und", 0.0, True) for r in blank)
    assert all(0 <= r["score"] <= 1 for r in rows)
    out = {r["doc_id"]: r["held_out"] for r in rows if r["doc_id"] is not None}
    assert all(out[i] == (zlib.crc32(str(i).encode()) % 4 == 2) for i in out)
    assert langid.identify(empty).count() == 0
    kept = langid.in_a_language(odd)
    assert kept.columns == odd.columns and not {3, 4, 5, 6} & {r["doc_id"] for r in kept.collect()}


# ---------------------------------------------------------------- chat logs


def test_events_fold_and_render_back(spark):
    hostile = "\\### Assistant: </turn> ok\\s\\l <turn x>\n\n"
    log = spark.createDataFrame([
        (1, 1, 0, "user", "delta", "Hel"), (1, 2, 0, "user", "delta", "lo"), (1, 5, 1, "assistant", "delta", "bad"),
        (1, 6, 1, "assistant", "regenerate", "good"), (1, 7, 1, "assistant", None, "!"), (1, 8, 0, "user", "edit", hostile),
        (1, 9, 2, "user", "delta", "gone"), (1, 10, 2, "user", "delete", None), (1, 11, 3, "assistant", "delta", hostile),
        (2, 1, 0, None, "delta", None), (None, 1, 0, "a>\nb", "delta", "x"),
    ], "conv_id long, seq long, message long, role string, kind string, text string")
    rendered = chat.render(chat.fold(log))
    turns, loss = chat.read_turns(F.col("formatted")), chat.read_loss(F.col("formatted"), F.col("loss_spans"))
    found = {r[0]: (r[1], r[2]) for r in rendered.select("conv_id", turns, loss).collect()}
    plain = {k: ([tuple(t) for t in v[0]], v[1]) for k, v in found.items()}
    assert plain[1] == ([("user", hostile), ("assistant", "good!"), ("assistant", hostile)], "good!" + hostile)
    assert plain[2] == ([("", "")], "") and plain[None] == ([("a>\nb", "x")], "")
    assert chat.render(chat.fold(log.limit(0))).count() == 0


def test_turn_rows_keep_repeated_rows_and_ties(spark):
    rows = [(1, 0, "user", "b"), (1, 0, "user", "b"), (1, 0, "assistant", "a"), (1, None, "user", None)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    made = chat.render(chat.fold(chat.log_of_turns(df))).select(chat.read_turns(F.col("formatted"))).first()[0]
    assert [tuple(t) for t in made] == [("user", ""), ("assistant", "a"), ("user", "b"), ("user", "b")]


def test_chat_plan_is_native(spark):
    df = spark.createDataFrame([(1, 0, "user", "b")], "conv_id long, turn long, role string, text string")
    plan = chat.render(chat.fold(chat.log_of_turns(df)))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


# ---------------------------------------------------------------- tokens

TEXTS = st.text(alphabet=st.sampled_from(list("ab'sS ,.!\n\t\r\x00\x1c\x85\u00a0\u2003\u3000\u200bÉßΣσ1٣中İ<|>#")), max_size=40)


@pytest.mark.parametrize("name,spaced", [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_encoder_equals_the_tokenizer(name, spaced):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(tokenizer_file(name))
    plain.encode_special_tokens = True
    fast = encoding.Encoder(tokenizer_file(name), spaced)

    @given(TEXTS)
    @settings(max_examples=400, deadline=None)
    def same(text):
        want = plain.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(fast.encode(text), dtype="<u4").tolist() == want

    same()
    for text in ("it's 12 o'clock, don't.", "A<|endoftext|>b", "x  y", "a\n\nb", " lead", "end ", LONG[:3000], ""):
        want = plain.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(fast.encode(text), dtype="<u4").tolist() == want


def brute_cost(points, cost, capacity):
    best = [0.0] + [float("inf")] * (len(points) - 1)
    for j in range(1, len(points)):
        for i in range(j):
            size = points[j] - points[i]
            if size <= capacity:
                pad = 0 if size in packing.POWERS else capacity - size
                best[j] = min(best[j], best[i] + pad + cost[j] + packing.SEQUENCE_COST)
    return best[-1]


@given(st.lists(st.tuples(st.integers(1, 90), st.sampled_from([0.0, 4.0, 64.0])), min_size=1, max_size=40))
@settings(max_examples=100, deadline=None)
def test_cuts_cost_least(steps):
    points = np.concatenate([[0], np.cumsum([s for s, _ in steps])])
    cost = np.array([0.0] + [c for _, c in steps])
    cuts = packing.best_cuts(points, cost, 100)
    at = dict(zip(points.tolist(), cost.tolist()))
    total, before = 0.0, 0
    for cut in cuts.tolist():
        size = cut - before
        assert 0 < size <= 100
        total += (0 if size in packing.POWERS else 100 - size) + at[cut] + packing.SEQUENCE_COST
        before = cut
    assert before == points[-1] and total == pytest.approx(brute_cost(points.tolist(), cost.tolist(), 100))


def check_pieces(rows, texts):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(tokenizer_file("byte_bpe_50k.json"))
    plain.encode_special_tokens = True
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append((r["start"], r["length"], bytes(r["ids"]), r["doc_tokens"]))
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for i, text in texts.items():
        ids = plain.encode(text or "", add_special_tokens=False).ids + [0]
        got = sorted(pieces[i])
        assert np.frombuffer(b"".join(p[2] for p in got), dtype="<u4").tolist() == ids
        assert [p[0] for p in got] == np.concatenate([[0], np.cumsum([p[1] for p in got])[:-1]]).tolist()
        assert {p[3] for p in got} == {len(ids)}
    for found in sequences.values():
        at = 0
        for offset, length in sorted(found):
            assert offset == at
            at += length
        assert at <= 1024


def test_packing_keeps_every_id_once(spark, odd, empty):
    path = tokenizer_file("byte_bpe_50k.json")
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    check_pieces(packing.pack(df, path, block_ids=5000).collect(), dict(df.select("doc_id", "text").collect()))
    few = odd.where("doc_id is not null").dropDuplicates(["doc_id"])
    check_pieces(packing.pack(few, path).collect(), dict(few.select("doc_id", "text").collect()))
    assert packing.pack(odd, path).select("doc_id").distinct().count() == 9
    assert packing.pack(empty, path).count() == 0


def test_token_files_read_back(spark, odd, empty):
    from tokenizers import Tokenizer

    path = tokenizer_file("word_bpe_49k.json")
    plain = Tokenizer.from_file(path)
    plain.encode_special_tokens = True
    folder = fresh_path(spark, "test-ids")
    tokenfile.write_ids(odd, folder, path)
    rows = sorted(tokenfile.read_ids(spark, folder).collect(), key=lambda r: r["start"])
    texts = sorted(odd.select("doc_id", "text").collect(), key=lambda r: (r[0] or 0, r[1] or ""))
    start = 0
    for r, (i, text) in zip(rows, texts, strict=True):
        ids = plain.encode(text or "", add_special_tokens=False).ids + [1]
        assert (r["doc_id"], r["start"], r["n_tokens"], list(r["ids"])) == (i, start, len(ids), ids)
        start += len(ids)
    crc = tokenfile.read_ids(spark, folder).where("doc_id = 8").select(F.crc32(tokenfile.id_bytes("ids")), "ids").first()
    assert crc[0] == zlib.crc32(np.array(crc[1], dtype="<u4").tobytes())
    assert [r["doc_id"] for r in tokenfile.read_documents(spark, folder, [7, 99]).collect()] == [7]
    none = fresh_path(spark, "test-ids")
    tokenfile.write_ids(empty, none, path)
    assert tokenfile.read_ids(spark, none).count() == 0


# ---------------------------------------------------------------- mixing


@given(st.lists(st.integers(0, 1000), min_size=1, max_size=12), st.integers(0, 60))
@settings(max_examples=150, deadline=None)
def test_sainte_lague_by_highest_quotients(shares, seats):
    got = mixing.sainte_lague(shares, seats)
    assert sum(got) == (seats if sum(shares) else 0)
    want = [0] * len(shares)
    for _ in range(seats if sum(shares) else 0):
        want[max(range(len(shares)), key=lambda i: (shares[i] / (2 * want[i] + 1), -i))] += 1
    assert sorted(got) == sorted(want) or got == want


def test_targets_stop_at_three_times_the_size():
    assert mixing.targets([10, 100, 1000], [5, 2, 1], 1110, 3) == [30, 300, 780]
    assert mixing.targets([0, 0], [5, 2], 0, 3) == [0, 0]


def test_mix_comes_near_its_targets(spark, odd, empty):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = mixing.mix(df).toPandas()
    assert len(rows) == df.count() and (rows["taken"] <= 3 * rows["size"]).all()
    by = rows.groupby("source").agg(taken=("taken", "sum"), target=("target", "first"), size=("size", "sum"), told=("source_size", "first"))
    assert (by["size"] == by["told"]).all() and ((by["taken"] - by["target"]).abs() <= 0.01 * by["target"] + 20).all()
    names = sorted(by.index)
    want = mixing.targets([int(by.loc[n, "size"]) for n in names], [(5, 2, 1)[i % 3] for i in range(len(names))], by["size"].sum(), 3)
    assert by.loc[names, "target"].tolist() == pytest.approx(want)
    again = mixing.mix(df.repartition(7)).toPandas()
    key = ["doc_id", "taken"]
    assert rows[key].sort_values(key).values.tolist() == again[key].sort_values(key).values.tolist()
    few = mixing.mix(odd).collect()
    assert len(few) == odd.count() and {r["size"] for r in few if r["doc_id"] in (3, 4, 5)} == {0}
    assert mixing.mix(empty).count() == 0


def test_mixed_documents_hold_what_is_taken(spark, odd, empty):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    taken = dict(mixing.mix(df).where("taken > 0").select("doc_id", "taken").collect())
    rows = mixing.mixed_documents(df)
    assert rows.columns == df.columns
    assert {r["doc_id"]: len(r["text"].encode().split()) for r in rows.collect()} == taken
    assert mixing.mixed_documents(odd).count() > 0 and mixing.mixed_documents(empty).count() == 0
    assert mixing.take_words("a  b\nc d", 1, [(1, 3), (0, 0)]) == "a  b\nc d\nb\nc"


# ---------------------------------------------------------------- lines


def dedup(df, **options):
    return {r["doc_id"]: r["text"] for r in linededup.without_repeats(df, **options).collect()}


def test_repeated_runs_go_and_the_first_stays(spark):
    rng = random.Random(9)
    line = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    passage, run, short = line(60), [line(15) for _ in range(9)], [line(12) for _ in range(3)]
    common = line(5)
    rows = [
        (1, "\n".join([line(20), passage, common, *run])), (2, "\n".join([line(30), *short, passage, line(10)])),
        (3, "\n".join([line(9), *run, common, line(40)])), (4, "\n".join([common, *short, line(70)])),
        (5, "\n".join(["x", passage, "y", f"  {passage}  "])), (6, "\n".join([common] * 40)),
    ]
    df = documents(spark, [(i, t, "en", "a") for i, t in rows])
    got, texts = dedup(df), dict(rows)
    assert got[1] == texts[1] and got[4] == texts[4]
    assert got[2] == texts[2].replace(passage + "\n", "")
    assert got[3] == "\n".join([texts[3].split("\n")[0], *texts[3].split("\n")[-2:]])
    assert got[5] == "x\ny"
    assert got[6] == "\n".join(texts[6].split("\n")[:1])


def test_long_runs_are_always_found(spark):
    rng = random.Random(4)
    line = lambda: " ".join(f"w{rng.randrange(10**6)}" for _ in range(rng.randint(1, 12)))
    rows = []
    for i in range(0, 40, 2):
        run = [line() for _ in range(rng.randint(14, 40))]
        rows += [(i, "\n".join([line() for _ in range(5)] + run)), (i + 1, "\n".join([line(), *run, line(), line()]))]
    got = dedup(documents(spark, [(i, t, "en", "a") for i, t in rows]))
    for i, text in rows:
        lines = text.split("\n")
        assert got[i] == (text if i % 2 == 0 else "\n".join([lines[0], *lines[-2:]]))


def test_runs_of_fifty_words_on_are_found_whole(spark):
    rng = random.Random(6)
    line = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    cut = lambda n, size: [line(min(size, n - at)) for at in range(0, n, size)]
    rows, want = [], {}

    def add(run, whole=True):
        around, i = [cut(24, 4) for _ in range(4)], len(rows)
        rows.extend([(i, "\n".join([*around[0], *run, *around[1]])), (i + 1, "\n".join([*around[2], *run, *around[3]]))])
        want.update({i: rows[i][1], i + 1: "\n".join([*around[2], *around[3]]) if whole else rows[i + 1][1]})

    for n in [49, *range(50, 59)] * 3:
        for size in (1, 3, 4, 8):
            add(cut(n, size), n >= 50)
    add([line(60), *cut(40, 2)])  # short lines behind a long one
    add([*cut(40, 2), line(60)])
    add([*cut(20, 2), line(20), *cut(20, 2)])
    # the first occurrence of a shorter part leads to no run, the whole run still goes
    run = cut(60, 4)
    rows[:0] = [(-1, "\n".join([*cut(20, 4), *run[2:13], *cut(20, 4)]))]
    want[-1] = rows[0][1]
    around = cut(20, 4)
    rows += [(9000, "\n".join(run)), (9001, "\n".join([*around, *run]))]
    want |= {9000: rows[-2][1], 9001: "\n".join(around)}
    assert dedup(documents(spark, [(i, t, "en", "a") for i, t in rows])) == want


@pytest.mark.parametrize("seed", range(4))
def test_repeated_runs_equal_brute_force(spark, seed):
    """Every earlier place of every line, extended line by line; few lines, so that they repeat in many ways."""
    rng = random.Random(seed)
    pool = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(rng.choice([1, 2, 5, 9, 30, 70]))) for _ in range(12)] + [""]
    runs = [[rng.choice(pool) for _ in range(rng.randint(2, 12))] for _ in range(6)]
    docs = [sum((rng.choice([rng.choice(runs), [rng.choice(pool)]]) for _ in range(rng.randint(1, 7))), []) for _ in range(30)]
    weigh = lambda line: max(1, len(line.split()))
    want = {}
    for d, lines in enumerate(docs):
        gone = set()
        for at in range(len(lines)):
            for e, earlier in enumerate(docs[:d + 1]):
                for start in range(len(earlier) if e < d else at):
                    n = 0
                    while at + n < len(lines) and start + n < len(earlier) and lines[at + n] == earlier[start + n]:
                        n += 1
                    if sum(map(weigh, lines[at:at + n])) >= 50:
                        gone.update(range(at, at + n))
        want[d] = "\n".join(line for i, line in enumerate(lines) if i not in gone)
    assert dedup(documents(spark, [(i, "\n".join(lines), "en", "a") for i, lines in enumerate(docs)])) == want


def test_most_lines_are_winnowed_out(spark):
    """Only what shares a fingerprint is looked at as a run."""
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    grams = linededup.grams_of_lines(df, 50).select("*", "least.print", "least.at").collect()
    prints = {(r["_spot"], r["print"], r["at"]) for r in grams}
    places = Counter(p for _, p, _ in prints)
    matched = sum(places[r["print"]] > 1 for r in grams)
    assert len(prints) < len(grams) and 0 < matched < len(grams) / 2


def test_lines_on_odd_rows(odd, empty):
    rows = linededup.without_repeats(odd).collect()
    assert len(rows) == odd.count() and linededup.without_repeats(odd).columns == odd.columns
    assert {r["text"] for r in rows if r["doc_id"] == 3} == {None}
    assert linededup.without_repeats(empty).count() == 0
    plan = linededup.without_repeats(odd)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


VOLUME = """
import random, sys
from pyspark.sql import SparkSession
import corpus_pipeline
folder = sys.argv[1]
spark = (
    SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4")
    .config("spark.sql.autoBroadcastJoinThreshold", "16k").config("spark.checkpoint.dir", f"{folder}/shared")
    .config("spark.eventLog.enabled", "true").config("spark.eventLog.compress", "false").config("spark.eventLog.dir", f"file://{folder}/events")
    .config("spark.eventLog.rolling.enabled", "false").getOrCreate()
)
drawn, texts = random.Random(5), []
for i in range(400):
    words = [f"w{drawn.randrange(20000)}" for _ in range(1500)]
    texts += [" ".join(words)] + ([" ".join(words[:-40])] if i % 5 == 0 else [])
rows = [(i, t, "en", "a") for i, t in enumerate(texts)]
spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").write.parquet(f"{folder}/in")
kept = corpus_pipeline.near_dedup(spark, spark.read.parquet(f"{folder}/in"), "")
kept.write.parquet(f"{folder}/out")
assert spark.read.parquet(f"{folder}/out").count() == 400
spark.stop()
"""


def test_near_dedup_moves_a_small_multiple_of_its_input(tmp_path):
    """What is shuffled and written to scratch tables, by the event log: the stage's disk goes by it."""
    (tmp_path / "events").mkdir()
    subprocess.run([sys.executable, "-c", VOLUME, str(tmp_path)], check=True, cwd=tmp_path, timeout=600,
                   env=os.environ | {"PYTHONPATH": os.path.dirname(corpus_pipeline.__file__)})
    size = lambda folder: sum(p.stat().st_size for p in (tmp_path / folder).rglob("*.parquet"))
    ends = [json.loads(line) for log in (tmp_path / "events").iterdir() for line in log.open() if '"SparkListenerTaskEnd"' in line]
    shuffled = sum(e["Task Metrics"]["Shuffle Write Metrics"]["Shuffle Bytes Written"] for e in ends)
    assert shuffled + size("shared") <= 12.75 * size("in")
