"""Helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space; everything else belongs to a word.
WORD = r"[^\x20\x09-\x0D]+"


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share.

    It is ``spark.checkpoint.dir`` or the checkpoint folder set on the context.
    Only a local session may go without one and then gets a temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="riskscan-llm-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The same rows as a table in the shared folder: computed once, and safe when executors are lost."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def range_cuts(df: DataFrame, column: str, parts: int) -> list[int]:
    """At most ``parts - 1`` ascending values that cut the column into ranges of about as many rows each."""
    if parts < 2:
        return []
    shares = [i / parts for i in range(1, parts)]
    found = df.agg(F.percentile_approx(column, shares, max(10_000, 20 * parts))).first()[0]
    return sorted(set(found or []))


def range_of(column: Column, cuts: list[int]) -> Column:
    """How many cuts lie at or below the value; nulls count as the smallest value."""
    if not cuts:
        return F.lit(0)
    below = F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c <= column))
    return F.coalesce(F.when(column.isNull(), F.lit(0)).otherwise(below), F.lit(0))


def by_range(df: DataFrame, column: str, bucket: str, parts: int | None = None) -> DataFrame:
    """Deals the rows out by ranges of ``column``; adds the number of the range as ``bucket``.

    Ranges ascend with the column and every row of one value is in one range.
    One shuffle; the cut points are the only thing that passes the driver.
    """
    parts = parts or shuffle_partitions(df.sparkSession)
    cuts = range_cuts(df.select(column), column, parts)
    return df.withColumn(bucket, range_of(F.col(column), cuts)).repartitionById(len(cuts) + 1, F.col(bucket))


def tokenizer_file(name: str) -> str:
    """Where the installed package of public tokenizers keeps a file."""
    from public_tokenizers import path

    return path(name)
