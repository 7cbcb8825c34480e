"""Token ids as ORC files: run-length coded integers, row indexes, Bloom filters on document ids.

``write_ids`` deals the documents out by ranges of doc_id, so that files, stripes
and rows ascend with the id, and encodes them.  Readers split files by stripe and
skip stripes and row groups by the minimum and maximum of doc_id and by its Bloom
filter.  A row holds the ids of one document and how many ids its range has before
it; ``read_ids`` adds what the ranges before hold, one number per range.

Defined results: a null text is empty and has only the end id; documents with the
same id follow each other by text; a null doc_id comes first; an empty table gives
an empty file set.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from riskscan.llm.common import by_range
from riskscan.llm.encoding import encoder

SCHEMA = "doc_id long, block int, block_start long, n_tokens long, ids array<int>"
OPTIONS = {
    "orc.bloom.filter.columns": "doc_id", "orc.bloom.filter.fpp": "0.01", "orc.row.index.stride": "1000",
    "orc.create.index": "true", "orc.stripe.size": str(64 << 20), "compression": "zstd",
}


def write_ids(docs: DataFrame, path: str, tokenizer: str, end_id: int = 1, spaced: bool = False) -> None:
    """Encodes whole texts, ends each with ``end_id`` and writes them in ascending doc_id order."""
    end = np.array([end_id], dtype="<u4").tobytes()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    dealt = by_range(rows, "doc_id", "_range").sortWithinPartitions("_range", "doc_id", "text")

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, before, current = encoder(tokenizer, spaced).encode, 0, None
        for batch in batches:
            blocks, starts, sizes, found = [], [], [], []
            for text, part in zip(*(batch.column(c).to_pylist() for c in ("text", "_range"))):
                if part != current:
                    current, before = part, 0
                found.append(encode(text) + end)
                sizes.append(len(found[-1]) // 4)
                starts.append(before)
                blocks.append(part)
                before += sizes[-1]
            values = np.frombuffer(b"".join(found), dtype="<u4").astype(np.int32)
            lists = pa.ListArray.from_arrays(
                pa.array(np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)]).astype(np.int32)), pa.array(values)
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(blocks, pa.int32()), pa.array(starts, pa.int64()),
                 pa.array(sizes, pa.int64()), lists],
                ["doc_id", "block", "block_start", "n_tokens", "ids"],
            )

    dealt.mapInArrow(encoded, SCHEMA).write.options(**OPTIONS).orc(path)


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """One row per document: doc_id, start (ids of all documents before it), n_tokens, ids."""
    stored = spark.read.schema(SCHEMA).orc(path)
    # one row per range that was written, so no more than there were tasks
    sizes = sorted(map(tuple, stored.groupBy("block").agg(F.sum("n_tokens")).collect()))
    starts = [0, *accumulate(size for _, size in sizes)]
    offsets = spark.createDataFrame(
        [(block, start) for (block, _), start in zip(sizes, starts)], "block int, _before long"
    )
    return stored.join(F.broadcast(offsets), "block").select(
        "doc_id", (F.col("_before") + F.col("block_start")).alias("start"), "n_tokens", "ids"
    )


def read_documents(spark: SparkSession, path: str, ids: list[int]) -> DataFrame:
    """The stored rows of some documents; stripes and row groups without them are skipped."""
    return spark.read.schema(SCHEMA).orc(path).where(F.col("doc_id").isin(ids)).select("doc_id", "n_tokens", "ids")


@F.arrow_udf(BinaryType())
def id_bytes(ids: pa.Array) -> pa.Array:
    """Ids as little-endian unsigned 32-bit numbers."""
    raw = ids.values.to_numpy(zero_copy_only=False).astype("<u4").tobytes()
    bounds = ids.offsets.to_pylist()
    return pa.array([raw[4 * a:4 * b] for a, b in zip(bounds, bounds[1:])], pa.binary())
