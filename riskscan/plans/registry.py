"""The registered queries and the SQL they are checked against."""

from __future__ import annotations

from collections.abc import Callable
from string import Template

from pyspark.sql import DataFrame, SparkSession

from riskscan.functions.text import BLANK_CHARS

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    """Registers a query; ``oracle`` is the same result in DuckDB SQL."""

    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return dealt_out(df) if name in TEXT_TABLES else df


TEXT_TABLES = {"documents", "pages"}
#: Session setting: deal the driving table out to so many partitions.  Unset, tables are read as they are split.
DEAL_OUT = "riskscan.input.partitions"


def dealt_out(df: DataFrame) -> DataFrame:
    """The table, dealt out anew if the session asks for it, as for files of a single row group (bench.py does)."""
    wanted = df.sparkSession.conf.get(DEAL_OUT, None)
    return df.repartition(int(wanted)) if wanted else df


def spark_sql(spark: SparkSession, sf_dir: str, text: str, names: list[str]) -> DataFrame:
    """Runs SQL whose tables are written ``$name`` over the tables of ``sf_dir``; the first one drives the work."""
    escaped = text.replace("{", "{{").replace("}", "}}")
    statement = Template(escaped).substitute({n: "{" + n + "}" for n in names})
    driving, *others = names
    return spark.sql(
        statement, **{driving: driving_table(spark, sf_dir, driving)}, **{n: table(spark, sf_dir, n) for n in others}
    )


def driving_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = table(spark, sf_dir, name)
    return df if name in TEXT_TABLES else dealt_out(df)


def plain_sql(text: str, names: list[str]) -> str:
    """The same text with plain table names."""
    return Template(text).substitute({n: n for n in names})


# --------------------------------------------------------------------------
# Pieces of oracle SQL
# --------------------------------------------------------------------------

SQL_WORD = r"\p{L}\p{N}_"
SQL_BLANK = (
    r"\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)


def quote(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def trim_sql(expr: str) -> str:
    return f"trim({expr}, {quote(BLANK_CHARS)})"


def any_sql(column: str, words: list[str]) -> str:
    return "(" + " OR ".join(f"contains({column}, {quote(w)})" for w in words) + ")"


def count_sql(column: str, words: list[str]) -> str:
    return "(" + " + ".join(f"CAST(contains({column}, {quote(w)}) AS BIGINT)" for w in words) + ")"


def list_sql(values: list[str]) -> str:
    return "[" + ", ".join(quote(v) for v in values) + "]"


def words_sql(expr: str) -> str:
    """White-space separated words, without empty ones."""
    return rf"list_filter(regexp_split_to_array({expr}, '[{SQL_BLANK}]+'), lambda w: w <> '')"


def values_sql(rows: list[tuple]) -> str:
    """VALUES list of strings, numbers and nulls."""

    def cell(v) -> str:
        return "NULL" if v is None else str(v) if isinstance(v, int | float) else quote(v)

    return "VALUES " + ", ".join("(" + ", ".join(cell(v) for v in row) + ")" for row in rows)
