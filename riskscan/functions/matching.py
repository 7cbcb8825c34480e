"""Matching free labels and texts against the taxonomy.

The taxonomy side is a handful of fixed names, so it travels as literals and
each row is matched where it lies: no join, no shuffle, nothing that a hot
label could overload.  Exact rules are native expressions; only what they
leave open goes to the fuzzy scorer.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskscan.functions import similarity as sim
from riskscan.functions.text import BLANK, WORD, bind, btrim_u, label_key, split_words
from riskscan.taxonomy import DEFAULT, Taxonomy, literal, str_array

# Order in which a findings file may separate several risks in one cell (F6); fixed values.
RISK_DELIMITERS = [",", ";", "\n", "|", "/", "\\", "+", "&", "and"]

L2_LABEL_CUTOFF = 55.0
RISK_LABEL_CUTOFF = 55.0
L2_TEXT_CUTOFF = 75.0
RISK_TEXT_CUTOFF = 65.0


# --------------------------------------------------------------------------
# Fuzzy matching of queries and whole texts
# --------------------------------------------------------------------------


def best_matches(query: Column, choices: list[str], k: int = 3, cutoff: float = 0.65) -> Column:
    """F2. array<struct<name, score>> (0-1), best first, ties in the order of the choices."""
    hits = sim.best_hits(query, choices, sim.weighted, cutoff * 100, k)
    return F.transform(
        hits,
        lambda h: F.struct(
            F.element_at(str_array(choices), h["ord"] + 1).alias("name"), (h["score"] / 100).alias("score")
        ),
    )


def within_reach(text: Column, names: list[str], cutoff: float) -> Column:
    """The text, or null where it is so long that no weighted score can reach the cutoff.

    From eight times the longest name on, window scores are damped to 60 and whole
    scores stay below 23, so nothing is lost above that; a lower cutoff has no such bound.
    """
    if cutoff <= 100 * sim.FAR_DAMP:
        raise ValueError(f"texts have no length bound at a cutoff of {cutoff}")
    core = F.regexp_replace(text, f"^[^{WORD}]+|[^{WORD}]+$", "")
    limit = int(sim.FAR * max(len(sim.normalise(n)) for n in names))
    return F.when(F.length(core) < limit, text)


def match_risk_text(text: Column, taxonomy: Taxonomy = DEFAULT) -> Column:
    """F3 and F4 in one pass: struct<l2_category, macro_risks, score>.

    The best L2 name (weighted, at least 75), then every macro risk of that L2
    (token set, at least 65) in taxonomy order.  Without an L2: null, [], 0.
    """
    names = list(taxonomy.l2.values())
    risks = [taxonomy.macro_risks.get(key, []) for key in taxonomy.l2]
    hit = sim.nested_hits(within_reach(text, names, L2_TEXT_CUTOFF), names, risks, L2_TEXT_CUTOFF, RISK_TEXT_CUTOFF)
    return F.struct(
        F.get(str_array(taxonomy.l2_labels), hit["ord"]).alias("l2_category"),
        hit["children"].alias("macro_risks"),
        (hit["score"] / 100).alias("score"),
    )


# --------------------------------------------------------------------------
# L2 labels
# --------------------------------------------------------------------------


def _bare(text: str) -> str:
    return "".join(ch for ch in text if ch.isalnum() or ch == "_" or ch.isspace())


def _l2_variants(taxonomy: Taxonomy) -> Column:
    """Literal map: key, name and "key. name", each as written and without punctuation -> label."""
    variants: dict[str, str] = {}
    for key, name in taxonomy.l2.items():
        for form in (key, name, f"{key}. {name}"):
            for variant in (form.lower(), _bare(form.lower())):
                variants.setdefault(variant, f"{key}. {name}")
    return literal(variants, "map<string,string>")


def normalise_l2_exact(label: Column, taxonomy: Taxonomy = DEFAULT) -> tuple[Column, Column, Column]:
    """F5, the exact tiers: (as written, without punctuation, first known word in text order)."""
    known = _l2_variants(taxonomy)
    low = F.lower(btrim_u(label))
    bare = F.regexp_replace(low, f"(?U)[^{WORD}{BLANK}]", "")
    by_word = F.filter(F.transform(split_words(bare), lambda w: F.element_at(known, w)), lambda hit: hit.isNotNull())
    return F.element_at(known, low), F.element_at(known, bare), F.get(by_word, F.lit(0))


def normalise_l2(label: Column, taxonomy: Taxonomy = DEFAULT) -> Column:
    """F5. struct<l2_category, tier>; tier is exact, stripped, word, fuzzy or none."""
    exact, stripped, word = normalise_l2_exact(label, taxonomy)
    settled = F.coalesce(exact, stripped, word)
    left = F.when(settled.isNull(), F.lower(btrim_u(label)))
    hits = sim.best_hits(left, list(taxonomy.l2.values()), sim.weighted, L2_LABEL_CUTOFF, 1)

    def result(found: Column) -> Column:
        fuzzy = F.get(str_array(taxonomy.l2_labels), F.get(found, F.lit(0))["ord"])
        tier = (
            F.when(exact.isNotNull(), "exact")
            .when(stripped.isNotNull(), "stripped")
            .when(word.isNotNull(), "word")
            .when(fuzzy.isNotNull(), "fuzzy")
            .otherwise("none")
        )
        return F.struct(F.coalesce(settled, fuzzy).alias("l2_category"), tier.alias("tier"))

    return bind(hits, result)  # the scorer is called once, though its hits are used twice


# --------------------------------------------------------------------------
# risk labels
# --------------------------------------------------------------------------


def _exact_risk(item: Column, taxonomy: Taxonomy) -> Column:
    return F.element_at(literal({r.lower(): r for r in reversed(taxonomy.all_risks)}, "map<string,string>"), F.lower(item))


def split_risks(cell: Column, taxonomy: Taxonomy = DEFAULT, whole_first: bool = True) -> Column:
    """F6. Split on the first delimiter that occurs; items are trimmed.

    The presence test ignores case but the split does not, and "and" also
    splits inside words.  With ``whole_first`` a cell that is itself a risk
    name (several contain a comma or an ampersand) is kept in one piece.
    """
    low = F.lower(cell)
    trimmed = F.array(btrim_u(cell))
    pieces = F.when(_exact_risk(btrim_u(cell), taxonomy).isNotNull(), trimmed) if whole_first else None
    for delimiter in RISK_DELIMITERS:
        parts = F.transform(F.split(cell, rf"\Q{delimiter}\E"), btrim_u)
        test = F.contains(low, F.lit(delimiter))
        pieces = F.when(test, parts) if pieces is None else pieces.when(test, parts)
    return F.when(cell.isNotNull(), pieces.otherwise(trimmed))


def normalise_risks(items: Column, taxonomy: Taxonomy = DEFAULT) -> Column:
    """F7. array<string> -> taxonomy risks in taxonomy order.

    A case-insensitive exact name maps to itself, anything else to its two best
    weighted matches of at least 55.
    """
    filled = F.filter(items, lambda i: i.isNotNull() & (i != ""))
    exact = F.transform(filled, lambda i: _exact_risk(i, taxonomy))
    left = F.array_distinct(F.filter(filled, lambda i: _exact_risk(i, taxonomy).isNull()))
    fuzzy = sim.best_names_of_each(
        F.when(F.size(left) > 0, left), taxonomy.all_risks, sim.weighted, RISK_LABEL_CUTOFF, 2
    )
    return _in_order(F.array_union(F.coalesce(exact, str_array([])), fuzzy), taxonomy.all_risks)


def _in_order(values: Column, order: list[str]) -> Column:
    return F.array_intersect(str_array(order), values)


# --------------------------------------------------------------------------
# Filling in one label from the other
# --------------------------------------------------------------------------


def _risk_words(taxonomy: Taxonomy) -> Column:
    """Literal map L2 key -> array<struct<risk, words, long_words>>, all lower case."""

    def entry(risk: str) -> dict:
        words = list(dict.fromkeys(risk.lower().split()))
        return {"risk": risk, "words": words, "long_words": [w for w in words if len(w) > 4]}

    return literal(
        {key: [entry(r) for r in risks] for key, risks in taxonomy.macro_risks.items()},
        "map<string,array<struct<risk:string,words:array<string>,long_words:array<string>>>>",
    )


def infer_risks(context: Column, l2_key: Column, taxonomy: Taxonomy = DEFAULT) -> Column:
    """F8. Risks of the L2 whose words occur in the context: two whole words (one
    for a one-word risk), or any word longer than four letters as a substring."""
    candidates = F.element_at(_risk_words(taxonomy), l2_key)

    def fits(risk: Column, seen: Column) -> Column:
        shared = F.size(F.filter(risk["words"], lambda w: F.contains(seen["spaced"], F.concat(F.lit(" "), w, F.lit(" ")))))
        return F.exists(risk["long_words"], lambda w: F.contains(seen["low"], w)) | (
            shared >= F.least(F.lit(2), F.size(risk["words"]))
        )

    def hits(seen: Column) -> Column:
        return F.transform(F.filter(candidates, lambda r: fits(r, seen)), lambda r: r["risk"])

    found = bind(bind(F.lower(context), _spaced_view), hits)
    return F.when(l2_key.isNotNull(), F.coalesce(found, str_array([]))).otherwise(str_array([]))


def _spaced_view(low: Column) -> Column:
    """struct<low, spaced>: a whole word is a substring of ``spaced`` between two spaces,
    so that a long text need not become an array of words."""
    spaced = F.concat(F.lit(" "), F.regexp_replace(low, rf"(?U)[{BLANK}]+", " "), F.lit(" "))
    return F.struct(low.alias("low"), spaced.alias("spaced"))


def infer_l2(risks: Column, taxonomy: Taxonomy = DEFAULT) -> Column:
    """F9. The L2 most of the risks belong to, the first one on a tie; null for none."""
    candidates = literal(
        [
            {"rank": -pos, "label": f"{key}. {taxonomy.l2[key]}", "risks": names}
            for pos, (key, names) in enumerate(taxonomy.macro_risks.items())
        ],
        "array<struct<rank:int,label:string,risks:array<string>>>",
    )
    votes = F.transform(
        candidates, lambda c: F.struct(F.size(F.array_intersect(risks, c["risks"])).alias("n"), c["rank"], c["label"])
    )
    best = F.array_max(votes)
    return F.when(best["n"] > 0, best["label"])


# --------------------------------------------------------------------------
# validating risks against their L2
# --------------------------------------------------------------------------


def _word_sets(taxonomy: Taxonomy) -> Column:
    """Literal map L2 key -> array<struct<rank, risk, low, words>>; rank falls in taxonomy order."""

    def entry(pos: int, risk: str) -> dict:
        low = risk.lower().strip()
        return {"rank": -pos, "risk": risk, "low": low, "words": list(dict.fromkeys(low.split()))}

    return literal(
        {key: [entry(p, r) for p, r in enumerate(risks)] for key, risks in taxonomy.macro_risks.items()},
        "map<string,array<struct<rank:int,risk:string,low:string,words:array<string>>>>",
    )


def filter_risks_by_l2(l2_category: Column, risks: Column, taxonomy: Taxonomy = DEFAULT) -> Column:
    """F11. Replace each risk by the best-fitting risk of the L2, or drop it.

    Equal names score 100, containment of names longer than three letters 80,
    word overlap at most 60; at least 50 is needed and the earlier risk wins a
    tie.  Without an L2 or without risks the input comes back as it is; under
    an unknown L2 nothing is valid.  Output in taxonomy order.
    """
    valid = F.element_at(_word_sets(taxonomy), label_key(l2_category))

    def score(item: Column, v: Column) -> Column:
        shared = F.size(F.array_intersect(item["words"], v["words"]))
        fewer = F.least(F.size(item["words"]), F.size(v["words"]))
        more = F.greatest(F.size(item["words"]), F.size(v["words"]))
        overlap, coverage = shared / fewer, shared / more
        by_words = F.when(
            (fewer > 0) & (overlap >= 0.7) & (coverage >= 0.5), F.floor(overlap * coverage * 60).cast("int")
        ).otherwise(0)
        inside = F.contains(v["low"], item["low"]) | F.contains(item["low"], v["low"])
        long_enough = (F.length(item["low"]) > 3) & (F.length(v["low"]) > 3)
        return F.when(item["low"] == v["low"], 100).when(inside & long_enough, 80).otherwise(by_words)

    def best(item: Column) -> Column:
        scored = F.transform(
            valid, lambda v: F.struct(score(item, v).alias("score"), v["rank"].alias("rank"), v["risk"].alias("risk"))
        )
        return bind(F.array_max(scored), lambda top: F.when(top["score"] >= 50, top["risk"]))

    matched = F.transform(_items_view(risks), best)
    ordered = F.array_intersect(F.transform(valid, lambda v: v["risk"]), matched)
    unfiltered = l2_category.isNull() | (l2_category == "") | risks.isNull() | (F.size(risks) == 0)
    return F.when(unfiltered, risks).otherwise(F.coalesce(ordered, str_array([])))


def _items_view(items: Column) -> Column:
    """array<struct<low, words>> of a list of labels."""
    return F.transform(
        F.transform(items, lambda i: btrim_u(F.lower(i))),
        lambda t: F.struct(t.alias("low"), F.array_distinct(split_words(t)).alias("words")),
    )


def filter_risks_loose(l2_key: Column, risks: Column, taxonomy: Taxonomy = DEFAULT) -> Column:
    """F12. The text-fallback rule: each risk takes the first risk of the L2 that is
    equal, contained either way (any length), or shares at least 60 % of the
    smaller word set.  Taxonomy order; null for an unknown key."""
    valid = F.element_at(_word_sets(taxonomy), l2_key)

    def fits(item: Column, v: Column) -> Column:
        shared = F.size(F.array_intersect(item["words"], v["words"]))
        needed = F.greatest(F.lit(1.0), F.least(F.size(item["words"]), F.size(v["words"])) * 0.6)
        inside = F.contains(v["low"], item["low"]) | F.contains(item["low"], v["low"])
        return inside | ((F.size(item["words"]) > 0) & (shared >= needed))

    def first(item: Column) -> Column:
        return F.get(F.filter(valid, lambda v: fits(item, v)), F.lit(0))["risk"]

    return F.array_intersect(F.transform(valid, lambda v: v["risk"]), F.transform(_items_view(risks), first))
