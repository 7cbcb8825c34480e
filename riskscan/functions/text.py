"""Cleaning and example-assembly column functions.

Character classes follow Unicode: a word character is a letter, a number or
the underscore, and blank means any Unicode white space plus the four ASCII
separators 0x1c-0x1f.  Java's own ``\\w`` under ``(?U)`` also takes combining
marks, so the class is spelled out.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = r"\p{L}\p{N}_"
BLANK = r"\s\x1c-\x1f"

# Every character that counts as blank when trimming.
BLANK_CHARS = "".join(
    map(chr, [0x20, *range(0x09, 0x0E), *range(0x1C, 0x20), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
              0x2028, 0x2029, 0x202F, 0x205F, 0x3000])
)

TITLE_FIELDS = ["Finding_Title", "Title", "FINDING_TITLE", "TITLE", "Name", "NAME", "Summary", "SUMMARY"]
DESCRIPTION_FIELDS = [
    "Finding_Description", "Description", "FINDING_DESCRIPTION", "DESCRIPTION",
    "Details", "DETAILS", "Content", "CONTENT",
]
L2_FIELDS = ["L2", "Category", "Type", "Classification", "Risk_Category"]
RISK_FIELDS = ["macro_risks", "Risks", "Risk_Types", "Categories"]

UNKNOWN = "UNKNOWN"
UNSPECIFIED = "UNSPECIFIED"


def btrim_u(c: Column) -> Column:
    """Trim all Unicode white space on both sides (Spark's trim only takes spaces)."""
    return F.btrim(c, F.lit(BLANK_CHARS))


def pick(flags: dict[str, Column]) -> Column:
    """array<string> of the names whose flag is true, in dict order (compiles, unlike a lambda)."""
    named = [F.when(flag, F.lit(name)).otherwise(F.lit("")) for name, flag in flags.items()]
    return F.array_remove(F.array(*named), "")


def bind(value: Column, fn: Callable[[Column], Column]) -> Column:
    """``fn`` of a value that is computed once.

    Inside a lambda an outer expression would be evaluated again for every
    element; as a lambda variable it is not.
    """
    return F.get(F.transform(F.array(value), fn), F.lit(0))


def split_words(c: Column) -> Column:
    """White-space separated words, without empty ones."""
    return F.filter(F.split(c, rf"(?U)[{BLANK}]+"), lambda w: w != "")


def clean_text(c: Column) -> Column:
    """P1. The order matters: a removed symbol may leave a double space behind."""
    t = btrim_u(c)
    t = F.regexp_replace(t, rf"(?U)[{BLANK}]+", " ")
    t = F.regexp_replace(t, rf"(?U)[^{WORD}{BLANK}\-.,;:?!()]", " ")
    t = F.regexp_replace(t, rf"(?U)\([{BLANK}]*\)", "")
    return F.coalesce(btrim_u(t), F.lit(""))


def is_meaningful(c: Column) -> Column:
    """P2. Never null."""
    t = btrim_u(c)
    ok = (F.length(t) >= 3) & t.rlike(f"[{WORD}]") & ~t.rlike(r"^[\p{Nd}²³¹⁰⁴-⁹₀-₉]+$")
    return F.coalesce(ok, F.lit(False))


def first_meaningful(cols: list[Column]) -> Column:
    """P3. The first meaningful cell, cleaned; null if there is none."""
    if not cols:
        return F.lit(None).cast("string")
    return F.coalesce(*[F.when(is_meaningful(c), clean_text(c)) for c in cols])


def labelled(label: str, value: Column) -> Column:
    """``label: value``, null when the value is null."""
    return F.concat(F.lit(f"{label}: "), value)


def residual_part(name: str) -> Column:
    """P5. ``<column>: <clean cell>`` for a meaningful string cell, else null."""
    c = F.col(f"`{name}`")
    return F.when(is_meaningful(c), labelled(name, clean_text(c)))


def assemble_text(parts: list[Column]) -> Column:
    """P4. Non-null parts joined by a blank line; null when nothing is left."""
    return F.nullif(F.concat_ws("\n\n", *parts), F.lit(""))


def truthy_string(c: Column, numeric: bool = False) -> Column:
    """The cell as a string, null when it is null, empty or (for a number) zero."""
    if numeric:
        return F.when(c != 0, c.cast("string"))
    return F.nullif(c.cast("string"), F.lit(""))


def raw_label(cols: list[Column]) -> Column:
    """P6. First non-empty label as it stands, ``UNKNOWN`` without one."""
    return F.coalesce(*[truthy_string(c) for c in cols], F.lit(UNKNOWN))


def split_labels(c: Column) -> Column:
    """P7. Split on the first of ``, ; | newline`` (in that order) that occurs; empty parts stay."""

    def parts(regex: str) -> Column:
        return F.transform(F.split(c, regex), btrim_u)

    pieces = (
        F.when(F.contains(c, F.lit(",")), parts(","))
        .when(F.contains(c, F.lit(";")), parts(";"))
        .when(F.contains(c, F.lit("|")), parts(r"\|"))
        .when(F.contains(c, F.lit("\n")), parts("\n"))
        .otherwise(F.array(btrim_u(c)))
    )
    return F.when(c.isNull() | (c == ""), F.array(F.lit(UNSPECIFIED))).otherwise(pieces)


def format_label(key: Column, name: Column) -> Column:
    """P15. ``"<key>. <name>"``."""
    return F.concat(key, F.lit(". "), name)


def label_key(label: Column) -> Column:
    """P15. The part before the first dot, trimmed."""
    return btrim_u(F.substring_index(label, ".", 1))


# Only what the strict parser takes, but for repeated names.
STRICT_JSON = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}


def parse_json(value: Column) -> Column:
    """A JSON text as a VARIANT, null where it is malformed; of names that an object repeats the last one counts.

    The strict parser rejects repeated names.  Only then the members are read one by one and the object is
    written anew without those that come again.  Repeated names further down stay malformed.
    """

    def last_ones(found: Column) -> Column:
        later = lambda e, i: F.exists(F.slice(found, i + 2, F.size(found)), lambda other: other["key"] == e["key"])
        return F.filter(found, lambda e, i: ~later(e, i))

    members = F.map_entries(F.from_json(value, "map<string,variant>", STRICT_JSON))
    again = bind(members, lambda found: bind(last_ones(found), lambda last: F.when(
        F.size(last) < F.size(found), F.to_json(F.map_from_entries(last))
    )))
    return F.coalesce(F.try_parse_json(value), F.try_parse_json(again))
