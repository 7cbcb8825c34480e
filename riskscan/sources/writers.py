"""Writing examples, summaries and results."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from riskscan.operators.report import batch_summary, extraction_counts, extraction_summary


def scratch_dir(spark: SparkSession) -> str:
    """A fresh folder under the shared one the session names in spark.checkpoint.dir.

    A session on a single machine may go without the setting and gets a temporary
    folder; on a cluster, executors would not see one another's files, so it is required.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="riskscan-")
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


def write_examples_jsonl(examples: DataFrame, out: str, raw: DataFrame | None = None, mode: str = "errorifexists") -> str:
    """S6. One JSON object per line under ``out``/examples, counted while they are written.

    When there is not a single example the raw rows go to ``out``/raw_backup
    (if given) and an error is raised.
    """
    path, written = f"{out}/examples", Observation()
    examples.observe(written, F.count("*").alias("n")).write.mode(mode).json(path)
    if not written.get["n"]:
        _keep_raw(raw, out, mode)
    return path


def _keep_raw(raw: DataFrame | None, out: str, mode: str) -> None:
    if raw is not None:
        raw.write.mode(mode).json(f"{out}/raw_backup")
    raise ValueError(f"no training examples; raw rows are in {out}/raw_backup" if raw is not None else "no training examples")


def write_extraction_summary(examples: DataFrame, out: str, raw: DataFrame, mode: str = "errorifexists") -> str:
    """S7. One JSON row of counts; files and raw rows are counted in ``raw``, by its ``source_file`` where it has one."""
    path = f"{out}/extraction_summary"
    files = F.count_distinct("source_file") if "source_file" in raw.columns else F.lit(1)
    counts = raw.agg(files.cast("bigint").alias("total_files_processed"), F.count("*").alias("total_raw_entries"))
    summary = counts.crossJoin(extraction_summary(examples))  # one row each
    summary.write.mode(mode).json(path)
    return path


def write_extraction(raw: DataFrame, to_examples: Callable[[DataFrame], DataFrame], out: str,
                     mode: str = "errorifexists") -> tuple[str, str]:
    """S6 and S7 in one pass over ``raw``: (examples path, summary path).

    Rows and files are counted as they go in and examples as they come out, while the
    examples are written.  ``to_examples`` must leave rows where they lie (as `raw_to_examples`
    does), so that a task that is run again is counted once.  A driver-side set holds the names of the files.
    """
    into, outof = Observation(), Observation()
    named = "source_file" in raw.columns
    files = F.collect_set("source_file") if named else F.collect_set(F.lit("raw"))
    seen = raw.observe(into, F.count("*").alias("n"), files.alias("files"))
    examples = to_examples(seen)
    path, summary = f"{out}/examples", f"{out}/extraction_summary"
    examples.observe(outof, *extraction_counts()).write.mode(mode).json(path)
    counts = outof.get
    if not counts["total_training_examples"]:
        _keep_raw(raw, out, mode)
    row = {"total_files_processed": len(into.get["files"]), "total_raw_entries": into.get["n"], **counts}
    raw.sparkSession.createDataFrame([tuple(row.values())], ", ".join(f"{name} long" for name in row)).write.mode(mode).json(summary)
    return path, summary


def write_results(results: DataFrame, out: str, fmt: str = "parquet", mode: str = "errorifexists") -> tuple[str, str]:
    """S8. (results path, summary path): the result table and its one-row count.

    The summary reads the written table, so the results are computed once.
    """
    path, summary = f"{out}/results", f"{out}/metadata"
    results.write.mode(mode).format(fmt).save(path)
    written = results.sparkSession.read.schema(results.schema).format(fmt).load(path)
    batch_summary(written).write.mode(mode).json(summary)
    return path, summary


def write_chat_split(chats: DataFrame, out: str, mode: str = "errorifexists", compression: str = "gzip") -> str:
    """S9. Chat rows as JSON, one sub-folder per split.

    Every row holds its whole prompt, mostly the taxonomy, some kilobytes that are the same in all
    rows; so the files are compressed, which JSON readers see by their names.
    """
    chats.select("split", "messages").write.mode(mode).partitionBy("split").json(out, compression=compression)
    return out
