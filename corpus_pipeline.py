"""From raw documents to packed training sequences, stage by stage.

Every stage reads what the one before it wrote: language ID (rejected documents go),
line deduplication, near-deduplication (of documents that are 80 percent alike in five-word
shingles one stays), mixing the sources to target weights, packing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskscan.llm import langid, linededup, mixing, packing, resemblance
from riskscan.llm.common import fresh_path, table, tokenizer_file

#: No SQL: compressed sizes, fingerprints and tokens are beyond it; the stages have tests of their own.
ORACLE_SQL = None


#: Rows that cross to Python at a time, where the session keeps Spark's 10,000: of whole texts that is 50 MB and more a
#: task, several times over in the JVM and the worker.
BATCH_ROWS, BATCH_CONF = 1_000, "spark.sql.execution.arrow.maxRecordsPerBatch"


def in_small_batches(spark: SparkSession) -> None:
    if spark.conf.get(BATCH_CONF) == "10000":
        spark.conf.set(BATCH_CONF, BATCH_ROWS)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    in_small_batches(spark)
    return langid.in_a_language(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return linededup.without_repeats(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    in_small_batches(spark)
    return resemblance.one_of_each(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    in_small_batches(spark)
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    in_small_batches(spark)
    # a smaller memo than op7's: the same workers hold what earlier stages needed
    pieces = packing.pack(docs, tokenizer_file("byte_bpe_50k.json"), memo_parts=200_000)
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


STAGES = [
    ("language", language), ("line_dedup", line_dedup), ("near_dedup", near_dedup), ("mixing", mix), ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of the documents table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = fresh_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
