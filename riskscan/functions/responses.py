"""Reading model responses (R1-R5): JSON first, patterns on the plain text otherwise."""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskscan.functions.classify import normalise_pii_types, pc_from_keywords, types_named_in
from riskscan.functions.matching import filter_risks_loose
from riskscan.functions.text import bind, btrim_u, label_key
from riskscan.taxonomy import DEFAULT, Taxonomy, str_array

# --------------------------------------------------------------------------
# Fixed patterns, tried in this order; the wanted part is group 1.
# --------------------------------------------------------------------------

L2_PATTERNS = [
    r"""l2[_\s]*category[:\s]*["']?([^"'\n]+)["']?""",
    r"""category[:\s]*["']?(\d+\.?\s*[^"'\n]+)["']?""",
    r"""(\d+\.?\s*[A-Z][^.\n]+)""",
]
RISK_PATTERNS = [
    r"""macro[_\s]*risks?[:\s]*\[([^\]]+)\]""",
    r"""risks?[:\s]*\[([^\]]+)\]""",
    r"""risks?[:\s]*["']([^"']+)["']""",
    r"""risk[:\s]*([A-Z][^,\n]+)""",
    r"""-\s*([A-Z][^,\n]+)""",
    r"""\d+\.\s*([A-Z][^,\n]+)""",
    r"""issues?[:\s]*([^.!?]+)""",
    r"""include[s]?[:\s]*([^.!?]+)""",
    r"""involving?[:\s]*([^.!?]+)""",
    r"""with[:\s]*([A-Z][^.!?]+)""",
]
PC_PATTERNS = [
    r"""pc[_\s]*category[:\s]*["']?(PC[0-3])["']?""",
    r"""(PC[0-3])""",
    r"""protection[_\s]*category[:\s]*["']?(PC[0-3])["']?""",
    r"""category[:\s]*["']?(PC[0-3])["']?""",
    r"""classification[:\s]*["']?(PC[0-3])["']?""",
]
TYPE_PATTERNS = [
    r"""pii[_\s]*types?[:\s]*\[([^\]]+)\]""",
    r"""types?[:\s]*\[([^\]]+)\]""",
    r"""pii[_\s]*types?[:\s]*([^,\n]+)""",
    r"""types?[:\s]*([^,\n]+)""",
    r"""including\s+([^,\n]+)""",
    r"""contains?\s+([^,\n]+)""",
    r"""-\s*([A-Z][^,\n]+)""",
    r""":\s*([A-Z][^,\n]+)""",
]

FLAGS = "(?iU)"
# Long s, dotted capital i, dotless i and the Kelvin sign, and the letters they equal when case is ignored.
ALIKE = ("\u017f\u0130\u0131\u212a", "siik")
MAX_RISKS = 5


def extract_json(response: Column) -> Column:
    """R1. First { to the first } after it (so nested objects come out broken), line
    breaks as spaces; null without braces."""
    return F.nullif(F.regexp_extract(F.replace(response, F.lit("\n"), F.lit(" ")), r"\{[^}]*\}", 0), F.lit(""))


def _must_hold(pattern: str) -> str:
    """The plain characters the pattern starts with, which a text it matches must hold; empty without any."""
    start = re.match(r"[a-z0-9]+|-|:", pattern)
    if start is None:
        return ""
    return start[0][:-1] if pattern[start.end():start.end() + 1] in ("?", "*") else start[0]


def _guarded(view: Column, pattern: str, found: Column, nothing: Column) -> Column:
    """``found`` where the text can match at all; a plain search is cheaper than the pattern."""
    fixed = _must_hold(pattern)
    return F.when(F.contains(view["low"], F.lit(fixed)), found).otherwise(nothing) if fixed else found


def _with_low(text: Column, fn: Callable[[Column], Column]) -> Column:
    """``fn`` of struct<text, low>; patterns without case also match the letters of ALIKE."""
    low = F.lower(F.translate(text, *ALIKE))
    return bind(F.struct(text.alias("text"), low.alias("low")), fn)


def _first_match(text: Column, patterns: list[str]) -> Column:
    def first(view: Column) -> Column:
        hits = [F.nullif(F.regexp_extract(view["text"], FLAGS + p, 1), F.lit("")) for p in patterns]
        return F.coalesce(*[_guarded(view, p, hit, F.lit(None)) for p, hit in zip(patterns, hits)])

    return F.when(text.isNotNull(), _with_low(text, first))


def _listed_items(text: Column, patterns: list[str], min_length: int) -> Column:
    """Everything the patterns capture, cut at commas, without blanks, quotes and short pieces."""

    def every(view: Column) -> Column:
        hits = [F.regexp_extract_all(view["text"], F.lit(FLAGS + p), F.lit(1)) for p in patterns]
        return F.concat(*[_guarded(view, p, hit, str_array([])) for p, hit in zip(patterns, hits)])

    matches = F.when(text.isNotNull(), _with_low(text, every))
    pieces = F.flatten(F.transform(matches, lambda m: F.split(m, ",")))
    bare = F.transform(pieces, lambda p: F.btrim(btrim_u(p), F.lit("\"'")))
    return F.filter(bare, lambda p: F.length(p) >= min_length)


def l2_in_text(text: Column) -> Column:
    """R3, the category: trimmed, null when no pattern hits."""
    return btrim_u(_first_match(text, L2_PATTERNS))


def risks_in_text(text: Column) -> Column:
    """R3, the raw risks in the order of the patterns."""
    return _listed_items(text, RISK_PATTERNS, 4)


def risks_for_l2_text(l2: Column, items: Column, taxonomy: Taxonomy = DEFAULT) -> Column:
    """R3, the check: loose match under a known L2, nothing under an unknown one, all distinct without one."""
    valid = F.coalesce(filter_risks_loose(label_key(l2), items, taxonomy), str_array([]))
    return F.when(l2.isNull() | (l2 == ""), F.array_distinct(items)).otherwise(valid)


def pc_in_text(response: Column, taxonomy: Taxonomy = DEFAULT) -> Column:
    """R5, the category: a stated one (PC2 too), else by keywords."""
    return F.coalesce(F.upper(_first_match(response, PC_PATTERNS)), pc_from_keywords(response, taxonomy))


def types_in_text(response: Column, taxonomy: Taxonomy = DEFAULT) -> Column:
    """R5, the types: captured pieces, then types named by usual words, onto the taxonomy."""
    named = types_named_in(response)
    items = bind(
        _listed_items(response, TYPE_PATTERNS, 3), lambda found: F.concat(found, F.array_except(named, found))
    )
    return normalise_pii_types(items, taxonomy)


# --------------------------------------------------------------------------
# Looking into parsed JSON
# --------------------------------------------------------------------------


class Field:
    """One top-level member of a parsed object and the kind of value it holds.

    The pieces are bound as columns of their own (``with_field``), because the
    rules look at them many times.
    """

    def __init__(self, name: str):
        self.string, self.kind, self.items = (F.col(f"_{name}_{part}") for part in ("string", "kind", "items"))

    def is_a(self, *kinds: str) -> Column:
        return self.kind.isin(*kinds)

    @property
    def falsy(self) -> Column:
        """Missing, null, empty, zero or false."""
        empty = (
            (self.is_a("string") & (self.string == ""))
            | (self.is_a("bool") & (self.string == "false"))
            | (self.is_a("array") & (self.string == "[]"))
            | (self.is_a("object") & (self.string == "{}"))
            | (self.is_a("number") & (self.string.try_cast("double") == 0))
        )
        return self.is_a("missing", "null") | F.coalesce(empty, F.lit(False))

    @property
    def strings(self) -> Column:
        """The members as strings: array items, object keys, nothing for other kinds."""
        return (
            F.when(self.is_a("array"), F.transform(self.items, lambda i: i.cast("string")))
            .when(self.is_a("object"), F.json_object_keys(self.string))
            .otherwise(str_array([]))
        )

    @property
    def only_strings(self) -> Column:
        return ~self.is_a("array") | F.forall(self.items, lambda i: F.schema_of_variant(i) == "STRING")


def any_of(*conditions: Column) -> Column:
    """OR that treats null as false."""
    return reduce(lambda a, b: a | b, [F.coalesce(c, F.lit(False)) for c in conditions])


def with_field(df: DataFrame, parsed: str, name: str) -> tuple[DataFrame, Field]:
    """Adds the string, the kind and the list items of member ``name`` of a parsed column."""
    path = f"$.{name}"
    schema = F.schema_of_variant(F.try_variant_get(parsed, path, "variant"))
    df = df.withColumns({
        f"_{name}_schema": schema,
        f"_{name}_string": F.try_variant_get(parsed, path, "string"),
        f"_{name}_items": F.try_variant_get(parsed, path, "array<variant>"),
    })
    found = F.col(f"_{name}_schema")
    kind = (
        F.when(found.isNull(), "missing")
        .when(found == "VOID", "null")
        .when(found == "STRING", "string")
        .when(found == "BOOLEAN", "bool")
        .when(F.startswith(found, F.lit("ARRAY")), "array")
        .when(F.startswith(found, F.lit("OBJECT")), "object")
        .otherwise("number")
    )
    return df.withColumn(f"_{name}_kind", kind), Field(name)
