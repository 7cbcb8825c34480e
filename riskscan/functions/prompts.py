"""Prompts and chat messages (G1-G4, G6, G7) as column expressions.

The layout of the taxonomy (``render_taxonomy``) and the sentences of KIND_ANSWERS
are fixed values; the other wording is this package's own.  Answers are JSON with
one list entry per line.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskscan.functions.text import btrim_u
from riskscan.taxonomy import DEFAULT, Taxonomy

MESSAGE_TYPE = "array<struct<role:string,content:string>>"
ROLE_NAMES = {"system": "System", "user": "User", "assistant": "Assistant"}


def render_taxonomy(kind: str = "all", taxonomy: Taxonomy = DEFAULT) -> str:
    """G1. ``risk``, ``pii`` or ``all`` (in two parts)."""
    if kind == "risk":
        lines = ["L2 Risk Categories:", *taxonomy.l2_labels, "", "Macro Risks:"]
        lines += [f"{key}: {', '.join(risks)}" for key, risks in taxonomy.macro_risks.items()]
    elif kind == "pii":
        lines = ["PII Protection Categories:", *[f"{k}: {v}" for k, v in taxonomy.protection.items()]]
        lines += ["", f"Common PII Types: {', '.join(taxonomy.pii_types)}"]
    elif kind == "all":
        lines = ["PART 1: SECURITY RISK CATEGORIES", "", "L2 Categories:", *taxonomy.l2_labels]
        lines += ["", "Macro Risks for each L2 Category:"]
        for key, risks in taxonomy.macro_risks.items():
            lines += ["", f"{key}. {taxonomy.l2[key]}:", *[f"   - {risk}" for risk in risks]]
        lines += ["", "", "PART 2: PII PROTECTION CATEGORIES", "", "PII Protection Categories:"]
        lines += [f"{k}: {v}" for k, v in taxonomy.protection.items()]
        lines += ["", "Common PII Types:", *[f"- {t}" for t in taxonomy.pii_types]]
    else:
        raise ValueError(f"unknown kind {kind!r}; use risk, pii or all")
    return "\n".join(lines) + "\n"


# --------------------------------------------------------------------------
# JSON answers
# --------------------------------------------------------------------------


def _quoted(c: Column) -> Column:
    """The string as a JSON string."""
    in_list = F.to_json(F.array(c))
    return F.substring(in_list, F.lit(2), F.length(in_list) - 2)


def _json_list(items: Column, indent: int) -> Column:
    """JSON list with one entry per line; ``indent`` is the depth of the closing bracket."""
    pad = " " * (indent + 2)
    body = F.array_join(F.transform(items, _quoted), f",\n{pad}")
    return F.when(F.size(items) == 0, F.lit("[]")).otherwise(
        F.concat(F.lit(f"[\n{pad}"), body, F.lit("\n" + " " * indent + "]"))
    )


def _labels_answer(category: str, value: Column, list_name: str, items: Column) -> Column:
    return F.concat(
        F.lit(f'{{\n  "{category}": "'), value, F.lit(f'",\n  "{list_name}": '), _json_list(items, 0), F.lit("\n}")
    )


def _ddl_answer(result: Column) -> Column:
    strings = ["table_name", "overall_classification"]
    lists = ["detected_pii_types", "high_risk_columns", "ambiguous_columns"]
    last = ["compliance_flags", "privacy_recommendations"]
    members = [F.concat(F.lit(f'  "{n}": '), _quoted(result[n])) for n in strings]
    members += [F.concat(F.lit(f'  "{n}": '), _json_list(result[n], 2)) for n in lists]
    members += [F.concat(F.lit('  "requires_human_review": '), result["requires_human_review"].cast("string"))]
    members += [F.concat(F.lit(f'  "{n}": '), _json_list(result[n], 2)) for n in last]
    body = members[0]
    for member in members[1:]:
        body = F.concat(body, F.lit(",\n"), member)
    return F.concat(F.lit("{\n"), body, F.lit("\n}"))


# --------------------------------------------------------------------------
# Training chats: system, user, assistant, user, assistant
# --------------------------------------------------------------------------

RISK_SYSTEM = (
    "You review security findings and file them under a fixed risk framework. Use only the categories below.\n\n"
    "{categories}\n"
    "Rules: choose exactly one L2 category, the best fit by its description rather than its number; list every "
    "macro risk of that category the finding shows, and none from another category; do not make up names."
)
RISK_QUESTION = "Name the L2 category and the macro risks of this finding.\n\nText to analyze:\n"
PII_SYSTEM = (
    "You review text for personal data and assign a protection category. Use only the categories below.\n\n"
    "{categories}\n"
    "Rules: PC0 is public and holds no personal data; PC1 is internal, such as names and contact details; PC3 is "
    "confidential, such as identity numbers, money, health, credentials and biometrics. The most sensitive item "
    "decides for the whole text."
)
PII_QUESTION = "Find the personal data in this text and classify it by its most sensitive item.\n\nText to analyze:\n"
DDL_SYSTEM = (
    "You review database definitions for columns that will hold personal data. Use only the categories below.\n\n"
    "{categories}\n"
    "Rules: judge by column names, data types and constraints; the most sensitive column decides for the table; "
    "mark names that could be personal or not for human review; state compliance needs and advice."
)
DDL_QUESTION = "Find the personal data the table of this statement will hold.\n\nDDL Statement:\n"
KIND_QUESTION = "\n\nIs this a security risk finding, a DDL statement for PII analysis, or text with potential PII?"
# What the assistant says first, by kind.
KIND_ANSWERS = {
    "risk": "This is a security risk finding.",
    "pii": "This is text with potential PII.",
    "ddl": "This is a DDL statement for PII analysis.",
}
RISK_FORMAT = "Answer in JSON with 'l2_category' (number and name of one category) and 'macro_risks' (a list of names)."
PII_FORMAT = (
    "Answer in JSON with 'pc_category' (PC3 if anything is confidential, else PC1 if anything is internal, else PC0) "
    "and 'pii_types' (a list of names)."
)
DDL_FORMAT = (
    "Answer in JSON with 'table_name', 'overall_classification' (PC0, PC1, PC3 or AMBIGUOUS), 'detected_pii_types', "
    "'high_risk_columns', 'ambiguous_columns', 'requires_human_review', 'compliance_flags' and "
    "'privacy_recommendations'."
)


def _chat(kind: str, system: str, question: str, text: Column, answer_format: str, answer: Column,
          taxonomy: Taxonomy) -> Column:
    turns = [
        ("system", F.lit(system.format(categories=render_taxonomy("all", taxonomy)))),
        ("user", F.concat(F.lit(question), text, F.lit(KIND_QUESTION))),
        ("assistant", F.lit(KIND_ANSWERS[kind])),
        ("user", F.lit(answer_format)),
        ("assistant", answer),
    ]
    messages = F.array(*[F.struct(F.lit(role).alias("role"), content.alias("content")) for role, content in turns])
    return F.when(text.isNotNull() & answer.isNotNull(), messages)


def risk_chat(text: Column, l2_category: Column, macro_risks: Column, taxonomy: Taxonomy = DEFAULT) -> Column:
    """G2. Null when a field is missing."""
    answer = _labels_answer("l2_category", l2_category, "macro_risks", macro_risks)
    return _chat("risk", RISK_SYSTEM, RISK_QUESTION, text, RISK_FORMAT, answer, taxonomy)


def pii_chat(text: Column, pc_category: Column, pii_types: Column, taxonomy: Taxonomy = DEFAULT) -> Column:
    """G3. Null when a field is missing."""
    answer = _labels_answer("pc_category", pc_category, "pii_types", pii_types)
    return _chat("pii", PII_SYSTEM, PII_QUESTION, text, PII_FORMAT, answer, taxonomy)


def ddl_chat(ddl: Column, result: Column, taxonomy: Taxonomy = DEFAULT) -> Column:
    """G4. Null when a field is missing."""
    return _chat("ddl", DDL_SYSTEM, DDL_QUESTION, ddl, DDL_FORMAT, _ddl_answer(result), taxonomy)


# --------------------------------------------------------------------------
# Rendering and inference prompts
# --------------------------------------------------------------------------


def render_chat(messages: Column, separator: str = "\n") -> Column:
    """G6. ``Role: content`` per message, each followed by the separator; other roles are skipped.

    The one-line form (training) keeps its last separator; a blank-line
    separator (inference) is trimmed off.
    """

    def line(m: Column) -> Column:
        name = F.coalesce(*[F.when(m["role"] == role, F.lit(title)) for role, title in ROLE_NAMES.items()])
        return F.concat(name, F.lit(": "), m["content"], F.lit(separator))

    known = F.filter(messages, lambda m: m["role"].isin(*ROLE_NAMES))
    text = F.array_join(F.transform(known, line), "")
    return text if separator == "\n" else btrim_u(text)


RISK_PROMPT = (
    "Assign this security finding to one L2 category and pick only macro risks of that category.\n\n{categories}\n\nRisk: "
)
RISK_PROMPT_END = (
    "\n\nMacro risks of any other category are wrong.\n\nReply with JSON only, for example:\n"
    '{"l2_category": "8. Manage IT Vulnerabilities & Patching", "macro_risks": ["Patching Completeness"]}'
)
PII_PROMPT = "Classify the personal data in this text; the most sensitive item decides.\n\n{categories}\n\nText: "
PII_PROMPT_END = (
    "\n\nPC3 outranks PC1, which outranks PC0; use PC0 only for public text without personal data."
    '\n\nReply with JSON only, for example:\n{"pc_category": "PC3", "pii_types": ["SSN", "Phone", "Name"]}'
)


def inference_prompt(kind: Column, text: Column, taxonomy: Taxonomy = DEFAULT) -> Column:
    """G7. The rendered one-message prompt for a ``risk`` or ``pii`` text."""
    risk = F.concat(
        F.lit("User: " + RISK_PROMPT.format(categories=render_taxonomy("risk", taxonomy))), text, F.lit(RISK_PROMPT_END)
    )
    pii = F.concat(
        F.lit("User: " + PII_PROMPT.format(categories=render_taxonomy("pii", taxonomy))), text, F.lit(PII_PROMPT_END)
    )
    return F.when(kind == "risk", risk).otherwise(pii)
