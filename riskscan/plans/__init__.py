"""Registered queries; ``load`` imports every family."""

from __future__ import annotations

import importlib

FAMILIES = [
    "text_queries", "schema_queries", "matching_queries", "response_queries", "report_queries", "chat_queries",
    "source_queries",
]


def load():
    """The registry with all families in it."""
    for family in FAMILIES:
        importlib.import_module(f"{__name__}.{family}")
    return importlib.import_module(f"{__name__}.registry")
