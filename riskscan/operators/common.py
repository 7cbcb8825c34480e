"""Helpers shared by the table operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pin(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Adds columns that are computed exactly once per row.

    A later filter on an ordinary derived column is pushed below its
    projection, together with a copy of everything the column is made of.
    Over a chain of dependent columns those copies multiply.  A generated row
    is a boundary for such filters, and generating one row per row is cheap.
    """
    made = F.explode(F.array(F.struct(*[c.alias(name) for name, c in columns.items()]))).alias("_made")
    kept = [F.col(f"`{c}`") for c in df.columns if c not in columns]
    return df.select(*kept, made).select(*kept, *[F.col(f"_made.`{name}`") for name in columns])
