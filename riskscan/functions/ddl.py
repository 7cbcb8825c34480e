"""Privacy rules for DDL text and column names (D1-D13) as column expressions.

Column rules take a name and a type, so they serve both a table of DDL
statements (columns split out of the text) and a catalog table that already
has one row per column.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskscan.functions.classify import contains_any
from riskscan.functions.text import BLANK, WORD, bind, btrim_u, pick, split_words
from riskscan.taxonomy import literal, str_array

# --------------------------------------------------------------------------
# They have to be exactly these for results to agree.
# --------------------------------------------------------------------------

# Column-name rules in priority order: category -> type -> parts of a name.
NAME_RULES = {
    "PC3": {
        "SSN": ["ssn", "social_security", "social_security_number", "social_sec", "tax_id", "taxpayer_id",
                "national_id", "national_identifier"],
        "Financial": ["credit_card", "cc_number", "card_number", "account_number", "bank_account",
                      "routing_number", "iban", "swift", "salary", "income", "wage"],
        "Health": ["medical_record", "health_id", "patient_id", "diagnosis", "medication", "medical_condition",
                   "health_info", "patient_number"],
        "Credentials": ["password", "passwd", "pwd", "secret", "private_key", "api_key", "token", "auth_token",
                        "session_key"],
        "Biometric": ["fingerprint", "biometric", "facial_recognition", "iris_scan", "voice_print", "dna", "retina"],
    },
    "PC1": {
        "Name": ["first_name", "last_name", "full_name", "name", "fname", "lname", "given_name", "family_name",
                 "surname", "middle_name", "nickname"],
        "Email": ["email", "email_address", "mail", "e_mail", "business_email", "work_email", "contact_email"],
        "Phone": ["phone", "telephone", "phone_number", "mobile", "cell", "contact_number", "work_phone",
                  "home_phone", "mobile_number"],
        "Address": ["address", "street", "city", "state", "zip", "postal_code", "country", "location",
                    "residence", "home_address"],
        "Employment": ["employee_id", "emp_id", "staff_id", "job_title", "position", "department", "manager",
                       "supervisor", "employee_number"],
        "Customer ID": ["customer_id", "client_id", "user_id", "member_id", "account_id", "customer_number",
                        "client_number"],
    },
    "PC0": {
        "Public Info": ["company_name", "business_name", "public_id", "product_id", "category", "description",
                        "status", "type", "public_data"],
    },
}


@dataclass(frozen=True)
class Ambiguity:
    examples: list[str]
    possibility: str
    clues: str


# Name parts that may or may not be personal.
AMBIGUOUS = {
    "name": Ambiguity(
        ["name", "title", "label"],
        "Could be person name (PC1) or product/company name (PC0)",
        "Check if related to users/customers vs products/categories",
    ),
    "id": Ambiguity(
        ["id", "identifier", "ref", "reference"],
        "Could be customer/user ID (PC1) or system/product ID (PC0)",
        "Check table context - user tables vs system tables",
    ),
    "number": Ambiguity(
        ["number", "num", "no"],
        "Could be phone number (PC1) or order/product number (PC0)",
        "Check data type - VARCHAR(15) suggests phone, INT suggests system number",
    ),
    "address": Ambiguity(
        ["address", "addr", "location"],
        "Could be personal address (PC1) or business/IP address (PC0/PC1)",
        "Check if customer/employee table vs system/network table",
    ),
    "code": Ambiguity(
        ["code", "cd", "key"],
        "Could be personal code (PC1) or system code (PC0)",
        "Check if user-specific vs system-wide codes",
    ),
    "info": Ambiguity(
        ["info", "data", "details", "description"],
        "Could contain personal info (PC1/PC3) or public info (PC0)",
        "Check column context and associated table purpose",
    ),
}

# Parts of a data type that hint at a PII type.
TYPE_HINTS = {
    "SSN": ["CHAR(11)", "VARCHAR(11)", "CHAR(9)", "VARCHAR(9)"],
    "Phone": ["CHAR(10)", "VARCHAR(15)", "CHAR(12)"],
    "Credit Card": ["CHAR(16)", "VARCHAR(19)", "CHAR(15)"],
    "Email": ["VARCHAR(255)", "TEXT"],
    "Name": ["VARCHAR(50)", "VARCHAR(100)", "CHAR(50)"],
}

RECOMMENDATIONS = {
    "PC3": [
        "HIGH RISK: This table contains confidential PII data",
        "Implement strong encryption at rest and in transit",
        "Apply strict access controls and authentication",
        "Ensure GDPR/CCPA compliance measures are in place",
        "Implement data loss prevention (DLP) monitoring",
        "Consider data retention policies and right to deletion",
    ],
    "PC1": [
        "MEDIUM RISK: This table contains internal PII data",
        "Implement appropriate access controls",
        "Consider data masking for non-production environments",
        "Document data handling procedures",
        "Monitor access patterns for unusual activity",
    ],
    "AMBIGUOUS": [
        "AMBIGUOUS: This table contains columns that may or may not be PII",
        "HUMAN REVIEW REQUIRED: Manual inspection needed to determine PII status",
        "Review column context and intended use to classify properly",
        "Consider table purpose: user/customer data vs system/product data",
        "Apply precautionary principle: treat as PII until confirmed otherwise",
    ],
    "PC0": ["LOW RISK: No sensitive PII detected in this table"],
}
TYPE_RECOMMENDATIONS = {
    "SSN": "SSN detected: Implement tokenization or format-preserving encryption",
    "Financial": "Financial data detected: Ensure PCI DSS compliance",
    "Health": "Health data detected: Ensure HIPAA compliance",
}
TYPE_FLAGS = {
    "SSN": ["REQUIRES_GDPR_REVIEW", "REQUIRES_CCPA_REVIEW"],
    "Health": ["REQUIRES_HIPAA_REVIEW"],
    "Financial": ["REQUIRES_PCI_DSS_REVIEW"],
}
CLASS_FLAGS = {
    "PC3": ["REQUIRES_DPO_APPROVAL"],
    "AMBIGUOUS": ["REQUIRES_HUMAN_REVIEW", "REQUIRES_PRIVACY_OFFICER_REVIEW"],
}

# Lines of a column list that define no column.
NON_COLUMN_PREFIXES = ["PRIMARY KEY", "FOREIGN KEY", "CONSTRAINT", "INDEX", "KEY"]

QUOTES = "`\"'"
NAME_CONFIDENCE, AMBIGUOUS_CONFIDENCE = 0.9, 0.5


# --------------------------------------------------------------------------
# Statements
# --------------------------------------------------------------------------


def statement_type(ddl: Column) -> Column:
    """D1. By prefix, with exactly one space between the words."""
    up = F.upper(btrim_u(ddl))
    kinds = F.lit(None).cast("string")
    for verb in ("CREATE TABLE", "ALTER TABLE", "CREATE VIEW"):
        kinds = F.coalesce(kinds, F.when(F.startswith(up, F.lit(verb)), verb.replace(" ", "_")))
    return F.coalesce(kinds, F.lit("UNKNOWN"))


def table_name(ddl: Column) -> Column:
    """D2. The word after the verb, in matching quotes or bare."""
    found = [
        F.nullif(F.regexp_extract(ddl, rf"(?iU){a}[{BLANK}]+{b}[{BLANK}]+([`\"']?)([{WORD}]+)\1", 2), F.lit(""))
        for a, b in (("CREATE", "TABLE"), ("ALTER", "TABLE"), ("CREATE", "VIEW"))
    ]
    return F.coalesce(*found, F.lit("unknown_table"))


def column_lines(ddl: Column) -> Column:
    """D3. array<string>: the text between the first ( and the last ), cut at top-level commas.

    The text is cut at every comma and the pieces are glued back together while
    a parenthesis is open, so the fold runs over pieces, not characters.
    """
    body = F.regexp_extract(ddl, r"(?s)\((.*)\)", 1)

    def measured(piece: Column) -> Column:
        opened, closed = (F.length(F.replace(piece, F.lit(p), F.lit(""))) for p in "()")
        return F.struct(piece.alias("text"), (closed - opened).alias("change"))

    start = F.struct(F.lit(0).alias("depth"), F.lit(None).cast("string").alias("open"), str_array([]).alias("done"))

    def glue(state: Column, piece: Column) -> Column:
        line = F.coalesce(F.concat(state["open"], F.lit(","), piece["text"]), piece["text"])
        step = F.struct((state["depth"] + piece["change"]).alias("depth"), line.alias("line"))
        return bind(
            step,
            lambda s: F.struct(
                s["depth"].alias("depth"),
                F.when(s["depth"] != 0, s["line"]).alias("open"),
                F.when(s["depth"] == 0, F.array_append(state["done"], s["line"])).otherwise(state["done"]).alias("done"),
            ),
        )

    def finish(state: Column) -> Column:
        return F.when(state["open"].isNotNull(), F.array_append(state["done"], state["open"])).otherwise(state["done"])

    lines = F.aggregate(F.transform(F.split(body, ","), measured), start, glue, finish)
    return F.filter(F.transform(lines, btrim_u), lambda line: line != "")


def parse_columns(lines: Column) -> Column:
    """D4. array<struct<column_name, data_type, constraints>> from column lines.

    A line that starts with a key word defines no column (also a column whose
    name merely starts with it), nor does a single word.
    """

    def worded(line: Column) -> Column:
        return F.struct(F.upper(line).alias("up"), split_words(line).alias("words"))

    def is_column(line: Column) -> Column:
        keyword = F.exists(str_array(NON_COLUMN_PREFIXES), lambda p: F.startswith(line["up"], p))
        return (F.size(line["words"]) >= 2) & ~keyword

    def parts(line: Column) -> Column:
        words = line["words"]
        return F.struct(
            F.btrim(F.get(words, F.lit(0)), F.lit(QUOTES)).alias("column_name"),
            F.get(words, F.lit(1)).alias("data_type"),
            F.array_join(F.slice(words, F.lit(3), F.greatest(F.size(words) - 2, F.lit(0))), " ").alias("constraints"),
        )

    return F.transform(F.filter(F.transform(lines, worded), is_column), parts)


def columns_of(ddl: Column) -> Column:
    """D3 + D4."""
    return parse_columns(column_lines(ddl))


# --------------------------------------------------------------------------
# Columns
# --------------------------------------------------------------------------


# The rules below run as lambdas over small literal tables rather than as long
# chains of conditions: some 150 tests per column in one compiled method would
# exceed what the JVM is willing to compile.


def name_rule(low: Column) -> Column:
    """D5. struct<pc, kind> of the first rule that hits a lower-case column name; null without one."""
    rules = literal(
        [
            {"pc": pc, "kind": kind, "parts": parts}
            for pc, kinds in NAME_RULES.items()
            for kind, parts in kinds.items()
        ],
        "array<struct<pc:string,kind:string,parts:array<string>>>",
    )
    hits = F.filter(rules, lambda r: F.exists(r["parts"], lambda p: F.contains(low, p)))
    return F.get(hits, F.lit(0))


def type_hints(data_type: Column) -> Column:
    """D6. PII types the data type hints at."""
    up = F.upper(data_type)
    return pick({kind: contains_any(up, parts) for kind, parts in TYPE_HINTS.items()})


def _ambiguous_groups() -> Column:
    return literal(
        [
            {"pos": pos, "group": group, "possibility": a.possibility, "first": a.examples[0], "examples": a.examples}
            for pos, (group, a) in enumerate(AMBIGUOUS.items())
        ],
        "array<struct<pos:int,group:string,possibility:string,first:string,examples:array<string>>>",
    )


def ambiguity_steps(low: Column) -> Column:
    """D7. The groups assigned to a lower-case name one after the other: the first group
    with any example in it, then every later group whose first example is in it."""

    def any_example(g: Column) -> Column:
        return F.exists(g["examples"], lambda e: F.contains(low, e))

    groups = _ambiguous_groups()
    start = F.array_min(F.transform(F.filter(groups, any_example), lambda g: g["pos"]))
    return bind(
        start,
        lambda at: F.filter(groups, lambda g: (g["pos"] == at) | ((g["pos"] > at) & F.contains(low, g["first"]))),
    )


def ambiguity(low: Column) -> Column:
    """D7. The group that stands in the end, or null."""
    return F.try_element_at(ambiguity_steps(low), F.lit(-1))["group"]


def ambiguity_text(group: Column, field: str) -> Column:
    """The fixed explanation (``possibility`` or ``clues``) of an ambiguous group."""
    return F.element_at(literal({g: getattr(a, field) for g, a in AMBIGUOUS.items()}, "map<string,string>"), group)


def reasoning(column_name: Column, data_type: Column, kind: Column) -> Column:
    """D8. One line per accepted name rule (``kind``, null without one), per data-type
    hint and per ambiguity step."""
    named = F.concat(F.lit("Column name '"), column_name, F.lit("' matches "), kind, F.lit(" pattern"))
    parts = literal(
        [{"hint": hint, "part": part} for hint, hint_parts in TYPE_HINTS.items() for part in hint_parts],
        "array<struct<hint:string,part:string>>",
    )
    hints = F.transform(
        bind(F.upper(data_type), lambda up: F.filter(parts, lambda p: F.contains(up, p["part"]))),
        lambda p: F.concat(F.lit("Data type '"), data_type, F.lit("' suggests "), p["hint"]),
    )
    steps = F.transform(
        bind(F.lower(column_name), ambiguity_steps),
        lambda g: F.concat(F.lit("Column name '"), column_name, F.lit("' is ambiguous - "), g["possibility"]),
    )
    return F.when(kind.isNotNull(), F.array(named)).otherwise(F.concat(hints, steps))


def column_rules(column_name: Column) -> Column:
    """D5 and D7 for one column: struct<rule, group>; a name rule leaves no ambiguity."""
    return bind(
        F.lower(column_name), lambda low: F.struct(name_rule(low).alias("rule"), ambiguity(low).alias("group"))
    )


def classify_column(rules: Column, data_type: Column) -> dict[str, Column]:
    """D5-D7 for one column from its bound ``column_rules``.

    A name rule settles the matter (0.9).  Without one an ambiguous name gives
    category AMBIGUOUS (0.5), and else data-type hints are listed under PC0 (0).
    """
    kind, pc = rules["rule"]["kind"], rules["rule"]["pc"]
    group = F.when(kind.isNull(), rules["group"])
    types = (
        F.when(kind.isNotNull(), F.array(kind))
        .when(group.isNotNull(), F.array(F.concat(F.lit("Ambiguous_"), group)))
        .otherwise(type_hints(data_type))
    )
    score = F.when(kind.isNotNull(), NAME_CONFIDENCE).when(group.isNotNull(), AMBIGUOUS_CONFIDENCE).otherwise(0.0)
    return {
        "pii_types": types,
        "pc_category": F.coalesce(pc, F.when(group.isNotNull(), "AMBIGUOUS"), F.lit("PC0")),
        "confidence_score": score,
        "is_ambiguous": group.isNotNull(),
        "ambiguous_type": group,
        "pii_possibility": ambiguity_text(group, "possibility"),
        "context_clues": ambiguity_text(group, "clues"),
    }


# --------------------------------------------------------------------------
# Whole statements
# --------------------------------------------------------------------------


def overall_class(has_pc3: Column, has_pc1: Column, needs_review: Column) -> Column:
    """D10. Highest sensitivity wins; ambiguous columns only rank above PC0."""
    return F.when(has_pc3, "PC3").when(has_pc1, "PC1").when(needs_review, "AMBIGUOUS").otherwise("PC0")


def recommendations(overall: Column, has_type: dict[str, Column]) -> Column:
    """D11. The lines of the overall class, then those of the detected types."""
    base = F.element_at(literal(RECOMMENDATIONS, "map<string,array<string>>"), overall)
    return F.concat(base, pick({line: has_type[kind] for kind, line in TYPE_RECOMMENDATIONS.items()}))


def compliance_flags(overall: Column, has_type: dict[str, Column]) -> Column:
    """D12. Flags of the detected types, then those of the overall class."""
    flags = {flag: has_type[kind] for kind, names in TYPE_FLAGS.items() for flag in names}
    flags |= {flag: overall == c for c, names in CLASS_FLAGS.items() for flag in names}
    return pick(flags)
