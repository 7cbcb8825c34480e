"""Routing and privacy classification of text (C1-C10) as column expressions.

Keyword tests are substring tests on the lower-cased text ("name" hits
"rename").  Everything stays a native expression, so Spark can compile it and
no text ever leaves the JVM.
"""

from __future__ import annotations

from functools import reduce
from operator import add, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskscan.functions.text import BLANK, WORD, btrim_u, pick
from riskscan.taxonomy import DEFAULT, Taxonomy, literal, str_array

# --------------------------------------------------------------------------
# They have to be exactly these for results to agree.
# --------------------------------------------------------------------------

ROUTE_RISK_WORDS = [
    "vulnerability", "exploit", "attack", "breach", "security", "unauthorized",
    "malware", "phishing", "injection", "xss", "csrf", "authentication",
    "authorization", "encryption", "patch", "firewall", "intrusion",
    "threat", "risk", "compliance", "audit", "control", "access control",
]
ROUTE_PII_WORDS = [
    "name", "email", "phone", "address", "ssn", "social security",
    "credit card", "bank account", "passport", "driver license",
    "customer", "patient", "employee", "personal", "private",
    "confidential", "sensitive", "dob", "date of birth",
]
ROUTE_PII_OVERRIDE = ["ssn", "social security", "credit card", "bank account", "passport"]

# Types that force PC3 / lift PC0 to PC1 when a category is corrected by its types.
UPGRADE_PC3 = ["SSN", "Financial", "Health", "Credentials", "Biometric", "National ID"]
UPGRADE_PC1 = ["Name", "Email", "Phone", "Address", "DOB", "Customer ID", "Employment"]
# Types that make a scanned text PC3 (C5); deliberately not the same list.
SCAN_PC3 = ["SSN", "Financial", "Health", "DOB"]

PUBLIC_TERMS = ["PUBLIC", "DP10", "UNRESTRICTED"]
CONFIDENTIAL_TERMS = ["CONFIDENTIAL", "DP30", "HIGHLY RESTRICTED", "SENSITIVE"]

# Words in a model response that name a PII type.
RESPONSE_TYPE_WORDS = {
    "SSN": ["ssn", "social security", "social_security"],
    "Name": ["name", "names"],
    "Email": ["email", "e-mail", "mail"],
    "Phone": ["phone", "telephone", "mobile", "cell"],
    "Address": ["address", "location"],
    "Financial": ["credit card", "bank account", "financial"],
    "Health": ["medical", "health", "patient"],
    "Credentials": ["password", "credential"],
    "National ID": ["passport", "driver license", "national id"],
}

# Value patterns (C5b).  EDGE is a word boundary on Unicode word characters.
EDGE = rf"(?:(?<=[{WORD}])(?![{WORD}])|(?<![{WORD}])(?=[{WORD}]))"
DIGIT = r"\p{Nd}"
VALUE_PATTERNS = {
    "SSN": rf"{EDGE}{DIGIT}{{3}}[-.]?{DIGIT}{{2}}[-.]?{DIGIT}{{4}}{EDGE}",
    "Email": rf"{EDGE}[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{{2,}}{EDGE}",
    "Phone": rf"{EDGE}{DIGIT}{{3}}[-.]?{DIGIT}{{3}}[-.]?{DIGIT}{{4}}{EDGE}",
    "Address": (
        rf"(?U){EDGE}{DIGIT}{{1,5}}[{BLANK}]+[A-Za-z{BLANK}]{{2,30}}[{BLANK}]+"
        rf"(?:St|Street|Ave|Avenue|Rd|Road|Blvd|Boulevard){EDGE}"
    ),
    "DOB": rf"{EDGE}(?:19|20){DIGIT}{{2}}[-/]{DIGIT}{{1,2}}[-/]{DIGIT}{{1,2}}{EDGE}",
}
# A necessary condition that is much cheaper than the pattern itself.
PATTERN_GUARDS = {"Email": "@"}


def contains_any(text: Column, words: list[str]) -> Column:
    """True when any word is a substring; the OR stops at the first hit."""
    return reduce(or_, [F.contains(text, F.lit(w)) for w in words])


def count_contained(text: Column, words: list[str]) -> Column:
    """How many of the words occur; each counts once, overlapping ones separately."""
    return reduce(add, [F.contains(text, F.lit(w)).cast("int") for w in words])


def route_scores(low: Column) -> tuple[Column, Column]:
    """(risk score, pii score) of C1 for lower-cased text."""
    return count_contained(low, ROUTE_RISK_WORDS), count_contained(low, ROUTE_PII_WORDS)


def route_by_scores(low: Column, risk: Column, pii: Column) -> Column:
    """C1 from the scores; a few unmistakable words decide for pii at once."""
    return (
        F.when(contains_any(low, ROUTE_PII_OVERRIDE), "pii")
        .when(risk > pii, "risk")
        .when(pii > 0, "pii")
        .otherwise("risk")
    )


def route_text(text: Column) -> Column:
    """C1. ``risk`` or ``pii``."""
    low = F.lower(text)
    return route_by_scores(low, *route_scores(low))


def choose_type(text: Column, force_type: str | None = None, task_type: str | None = None) -> Column:
    """C9. A forced type wins; a single-task set-up always gives its task; otherwise C1."""
    if force_type is not None:
        return F.lit(force_type)
    if task_type is not None:
        return F.lit(task_type)
    return route_text(text)


def pc_from_keywords(text: Column, taxonomy: Taxonomy = DEFAULT) -> Column:
    """C2. Highest category with a keyword hit; PC0 when there is none."""
    return pc_of_lowered(F.lower(text), taxonomy)


def pc_of_lowered(low: Column, taxonomy: Taxonomy = DEFAULT) -> Column:
    """C2 for lower-cased text."""
    return (
        F.when(contains_any(low, taxonomy.pii_keywords["PC3"]), "PC3")
        .when(contains_any(low, taxonomy.pii_keywords["PC1"]), "PC1")
        .otherwise("PC0")
    )


def pc_upgrade(pc: Column, types: Column) -> Column:
    """C3. Correct a category by the types found; PC1 types only lift PC0."""
    return (
        F.when(F.arrays_overlap(types, str_array(UPGRADE_PC3)), "PC3")
        .when((pc == "PC0") & F.arrays_overlap(types, str_array(UPGRADE_PC1)), "PC1")
        .otherwise(pc)
    )


def normalise_pii_types(types: Column, taxonomy: Taxonomy = DEFAULT) -> Column:
    """C4. Map free type names onto the taxonomy, first seen first, no duplicates.

    An exact name is kept.  Any other name takes the first taxonomy type it
    contains that is not in the output yet, so the step is a fold that carries
    its output.
    """
    known = _type_names(taxonomy)
    names = str_array(taxonomy.pii_types)

    def step(kept: Column, item: Column) -> Column:
        contained = F.filter(
            known, lambda k: F.contains(item["low"], k["low"]) & ~F.array_contains(kept, k["name"])
        )
        first = F.transform(F.slice(contained, 1, 1), lambda k: k["name"])
        return F.array_union(kept, F.when(F.array_contains(names, item["name"]), F.array(item["name"])).otherwise(first))

    trimmed = F.transform(F.filter(types, lambda t: t.isNotNull()), btrim_u)
    items = F.transform(trimmed, lambda t: F.struct(t.alias("name"), F.lower(t).alias("low")))
    return F.aggregate(items, str_array([]), step)


def _type_names(taxonomy: Taxonomy) -> Column:
    return literal([{"low": t.lower(), "name": t} for t in taxonomy.pii_types], "array<struct<low:string,name:string>>")


def named_types(low: Column, taxonomy: Taxonomy = DEFAULT) -> Column:
    """C5a. array<string> of the types whose name occurs in lower-cased text."""
    hits = F.transform(F.filter(_type_names(taxonomy), lambda n: F.contains(low, n["low"])), lambda n: n["name"])
    return F.when(low.isNotNull(), hits)


def pattern_hits(text: Column) -> dict[str, Column]:
    """C5b. type -> a value of that shape occurs in the text."""
    digits = text.rlike(DIGIT)
    hits = {}
    for pii_type, pattern in VALUE_PATTERNS.items():
        guard = F.contains(text, F.lit(PATTERN_GUARDS[pii_type])) if pii_type in PATTERN_GUARDS else digits
        hits[pii_type] = guard & text.rlike(pattern)
    return hits


def pattern_values(text: Column, pii_type: str) -> Column:
    """C5b. All matched values of one type."""
    return F.regexp_extract_all(text, F.lit(VALUE_PATTERNS[pii_type]), 0)


def matched_types(text: Column) -> Column:
    """C5b. array<string> of the types a value of which occurs in the text."""
    return pick(pattern_hits(text))


def scan_result(named: Column, matched: Column, taxonomy: Taxonomy = DEFAULT) -> Column:
    """C5c. struct<pc_category, pii_types, confidence> from the two lists.

    A taxonomy name is worth 0.2 and a value pattern 0.3, even when both point
    at the same type; sums run in integer tenths so that no rounding noise
    appears.  Types come in taxonomy order.
    """
    both = F.array_union(named, matched)
    types = F.array_intersect(str_array(taxonomy.pii_types), both)
    high = F.arrays_overlap(both, str_array(SCAN_PC3))
    tenths = F.size(named) * 2 + F.size(matched) * 3
    pc = F.when(high, "PC3").when(tenths > 0, "PC1").otherwise("PC0")
    total = F.when(high, F.least(F.lit(10), tenths + 4)).when(tenths > 0, F.least(F.lit(10), tenths + 2)).otherwise(1)
    result = F.struct(pc.alias("pc_category"), types.alias("pii_types"), (total / 10).alias("confidence"))
    return F.when(both.isNotNull(), result)


def scan_pii(text: Column, taxonomy: Taxonomy = DEFAULT) -> Column:
    """C5 as one expression.  Over large tables prefer ``operators.texts.scan_texts``,
    which binds the lower-cased text and the hits so that nothing is evaluated twice."""
    return scan_result(named_types(F.lower(text), taxonomy), matched_types(text), taxonomy)


def pc_from_classification(classification: Column) -> Column:
    """C6. PC1 unless the label says public (tested first, so NON-PUBLIC is PC0) or confidential."""
    up = F.upper(classification)
    return (
        F.when(contains_any(up, PUBLIC_TERMS), "PC0")
        .when(contains_any(up, CONFIDENTIAL_TERMS), "PC3")
        .otherwise("PC1")
    )


def privacy_label(pc: Column, taxonomy: Taxonomy = DEFAULT) -> Column:
    """C7. PC category -> label, null when unknown."""
    return F.element_at(literal(taxonomy.privacy_labels, "map<string,string>"), pc)


def sensitivity_label(dp: Column, taxonomy: Taxonomy = DEFAULT) -> Column:
    """C7. DP level -> label, null when unknown."""
    return F.element_at(literal(taxonomy.sensitivity_labels, "map<string,string>"), dp)


def l2_keyword_hits(low: Column, taxonomy: Taxonomy = DEFAULT) -> Column:
    """C8. array<struct<l2_key, hits>>: phrases found in lower-cased text per L2, only where there are any."""
    keys = literal(
        [{"l2_key": key, "phrases": phrases} for key, phrases in taxonomy.risk_keywords.items()],
        "array<struct<l2_key:string,phrases:array<string>>>",
    )
    counted = F.transform(
        keys,
        lambda k: F.struct(k["l2_key"], F.size(F.filter(k["phrases"], lambda p: F.contains(low, p))).alias("hits")),
    )
    return F.filter(counted, lambda k: k["hits"] > 0)


def types_named_in(text: Column) -> Column:
    """C10. PII types a response names by one of their usual words."""
    low = F.lower(text)
    return pick({t: contains_any(low, words) for t, words in RESPONSE_TYPE_WORDS.items()})
