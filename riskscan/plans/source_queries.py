"""Registered queries for files: S1-S3, S5-S9.

The inputs are written from the given tables into a fresh folder of the shared
checkpoint directory and read back through the sources.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from riskscan.operators import chat as ch
from riskscan.operators import findings as fd
from riskscan.operators import report as rp
from riskscan.operators import responses as ro
from riskscan.plans.fixtures import fixture, fixture_sql
from riskscan.plans.registry import query, table
from riskscan.plans.report_queries import A2_SQL, EXAMPLES_SQL
from riskscan.plans.response_queries import A1_SQL
from riskscan.plans.text_queries import meaningful_sql
from riskscan.sources import readers as rd
from riskscan.sources import writers as wr
from riskscan.sources.json_arrays import entries_of_json_files


@query(
    "s1_discover_files",
    "SELECT c_mktsegment AS folder, 'csv' AS extension, CAST(count(*) AS BIGINT) AS lines FROM customer GROUP BY ALL",
)
def s1(spark, sf):
    folder = wr.scratch_dir(spark)
    customers = table(spark, sf, "customer").select("c_mktsegment", "c_custkey", "c_name")
    customers.write.partitionBy("c_mktsegment").csv(f"{folder}/raw")
    customers.select("c_name").write.text(f"{folder}/raw/notes")
    files = rd.discover_files(spark, f"{folder}/raw")
    lines = spark.read.option("recursiveFileLookup", "true").text(f"{folder}/raw").select(F.col("_metadata.file_path").alias("path"))
    counted = lines.groupBy("path").agg(F.count("*").alias("n"))
    name = F.regexp_extract("path", "c_mktsegment=([^/]+)/", 1)
    found = files.join(counted, "path").groupBy(name.alias("folder"), "extension")
    return found.agg(F.sum("n").alias("lines"))


CSV_TEXT = """CASE id % 3 WHEN 0 THEN 'Zugriff für ' || L2 WHEN 1 THEN 'line one' || chr(10) || 'two, "quoted"' ELSE 'N/A' END"""


def _csv_findings(spark, sf) -> str:
    """UTF-8 files under one folder, Latin-1 files with another set of columns under another."""
    folder = wr.scratch_dir(spark)
    raw = fixture(spark, sf, "findings_fx").withColumn("Note", F.expr(CSV_TEXT))
    even = raw.where("id % 2 = 0")
    odd = raw.where("id % 2 = 1").drop("Origin")
    options = {"header": "true", "escape": '"', "quoteAll": "true"}
    options |= {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    even.write.options(**options, encoding="UTF-8").csv(f"{folder}/a")
    odd.write.options(**options, encoding="ISO-8859-1").csv(f"{folder}/b")
    return folder


CSV_SQL = f"""SELECT id, nullif(Title, '') AS Title, nullif(Description, '') AS Description, nullif(L2, '') AS L2, Risks,
CASE WHEN id % 2 = 0 THEN Origin END AS Origin, nullif({CSV_TEXT}, 'N/A') AS Note FROM {fixture_sql('findings_fx')}"""


@query("s2_read_csv_findings", CSV_SQL)
def s2(spark, sf):
    read = rd.read_csv_findings(spark, _csv_findings(spark, sf))
    assert read.schema["id"].dataType.typeName() == "long"
    return read.select("id", "Title", "Description", "L2", "Risks", "Origin", "Note")


MIXED_SQL = """SELECT o_orderkey AS id, 'order ' || CAST(o_orderkey AS VARCHAR) AS Title,
CASE WHEN o_orderkey % 2 = 0 THEN CAST(o_orderkey AS VARCHAR) ELSE 'ticket ' || CAST(o_orderkey AS VARCHAR) END AS Ref,
CASE WHEN o_orderkey % 2 = 0 THEN 'True' ELSE CAST(o_orderkey AS VARCHAR) || '.5' END AS Mark,
CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey % 3 = 0 END AS Flag,
CASE WHEN o_orderkey % 2 = 1 THEN CAST(o_orderkey AS DOUBLE) / 2 END AS Score,
CASE WHEN o_orderkey % 2 = 0 THEN 'Ref|Mark' ELSE 'Mark' END AS not_text FROM orders"""


@query("s2_mixed_kinds", MIXED_SQL)
def s2_mixed(spark, sf):
    """Columns that are numbers or booleans in some files and text in others."""
    folder, orders = wr.scratch_dir(spark), table(spark, sf, "orders").withColumnRenamed("o_orderkey", "id")
    titled = orders.withColumn("Title", F.concat(F.lit("order "), F.col("id").cast("string")))
    even = titled.where("id % 2 = 0").selectExpr("id", "Title", "id AS Ref", "true AS Mark", "id % 3 = 0 AS Flag")
    odd = titled.where("id % 2 = 1").selectExpr(
        "cast(id AS double) / 2 AS Score", "id", "'ticket ' || id AS Ref", "cast(id AS string) || '.5' AS Mark", "Title"
    )
    even.write.options(header="true").csv(f"{folder}/a")
    odd.write.options(header="true").csv(f"{folder}/b")
    read = rd.read_csv_findings(spark, folder)
    assert {f.name: f.dataType.typeName() for f in read.schema if f.name in ("id", "Flag", "Score", "Ref")} == {
        "id": "long", "Flag": "boolean", "Score": "double", "Ref": "string"
    }
    return read.select("id", "Title", "Ref", "Mark", "Flag", "Score", F.array_join(
        F.array_sort(fd.NOT_TEXT, lambda a, b: F.when(a == "Ref", -1).otherwise(1)), "|").alias("not_text"))


@query(
    "s3_read_examples_jsonl",
    f"""SELECT 'example' AS outcome, CAST(count(*) AS BIGINT) AS n, CAST(count(DISTINCT text) AS BIGINT) AS texts FROM ({EXAMPLES_SQL})
UNION ALL SELECT 'rejected', CAST(count(*) AS BIGINT), CAST(count(DISTINCT s_name) AS BIGINT) FROM supplier""",
)
def s3(spark, sf):
    folder = wr.scratch_dir(spark)
    examples = fd.raw_to_examples(fixture(spark, sf, "findings_fx"))
    broken = table(spark, sf, "supplier").select(F.concat(F.lit('{"type": "risk", "text": '), "s_name").alias("value"))
    lines = examples.select(F.to_json(F.struct("*")).alias("value")).unionAll(broken)
    lines.unionAll(broken.select(F.lit("  ").alias("value"))).write.text(folder)
    good, bad = rd.read_examples_jsonl(spark, folder)
    counted = good.agg(F.count("*").alias("n"), F.count_distinct("text").alias("texts")).select(F.lit("example").alias("outcome"), "*")
    rest = bad.agg(F.count("*").alias("n"), F.count_distinct("value").alias("texts")).select(F.lit("rejected").alias("outcome"), "*")
    return counted.unionAll(rest)


@query(
    "s4c_json_entries",
    """SELECT 'order } "' || CAST(o_orderkey AS VARCHAR) || '" [' AS text FROM orders WHERE o_orderkey % 5 <> 0
UNION ALL SELECT 'note {' || CAST(o_orderkey AS VARCHAR) FROM orders WHERE o_orderkey % 5 = 0""",
)
def s4c_entries(spark, sf):
    """JSON arrays of one line each, with entries that are no objects, cut into their entries where they lie."""
    folder = wr.scratch_dir(spark)
    entry = F.when(F.col("o_orderkey") % 5 != 0, F.to_json(F.struct(
        F.concat(F.lit('order } "'), F.col("o_orderkey").cast("string"), F.lit('" [')).alias("text"),
        F.array(F.struct(F.col("o_orderstatus").alias("status"))).alias("more"),
    ))).otherwise(F.concat(F.lit('5, "}", [{"text": "inner"}], '), F.to_json(F.struct(
        F.concat(F.lit("note {"), F.col("o_orderkey").cast("string")).alias("content")))))
    files = table(spark, sf, "orders").groupBy(F.floor(F.col("o_orderkey") / 2000).alias("file")).agg(
        F.concat(F.lit("["), F.array_join(F.collect_list(entry), ", "), F.lit("]")).alias("value")
    )
    files.write.partitionBy("file").text(folder)  # one line a file
    return rd.texts_from_entries(entries_of_json_files(spark, f"{folder}/*"))


@query(
    "s5_load_examples",
    f"""SELECT CAST(count(*) AS BIGINT) AS n, CAST(count(*) FILTER (WHERE L2 <> '') AS BIGINT) AS with_l2, CAST(count(Risks) AS BIGINT) AS with_risks
FROM ({CSV_SQL}) WHERE {' OR '.join(meaningful_sql(c) for c in ('Title', 'Description', 'L2', 'Risks', 'Origin', 'Note'))}""",
)
def s5(spark, sf):
    summary = rp.extraction_summary(rd.load_examples(spark, _csv_findings(spark, sf)))
    return summary.select(F.col("total_training_examples").alias("n"), "with_l2", "with_risks")


@query(
    "s6_write_examples",
    f"SELECT id, text, l2_category, array_to_string(macro_risks, '~') AS macro_risks FROM ({EXAMPLES_SQL})",
)
def s6(spark, sf):
    raw = fixture(spark, sf, "findings_fx")
    path = wr.write_examples_jsonl(fd.raw_to_examples(raw, keep=["id"]), wr.scratch_dir(spark), raw)
    written = spark.read.schema("id bigint, text string, l2_category string, macro_risks array<string>").json(path)
    return written.withColumn("macro_risks", F.array_join("macro_risks", "~"))


@query(
    "s7_extraction_summary",
    A2_SQL.replace("SELECT ", "SELECT CAST(1 AS BIGINT) AS total_files_processed, (SELECT count(*) FROM orders) AS total_raw_entries, ", 1),
)
def s7(spark, sf):
    raw = fixture(spark, sf, "findings_fx")
    _, path = wr.write_extraction(raw, fd.raw_to_examples, wr.scratch_dir(spark))
    return spark.read.json(path)


@query("s8_write_results", A1_SQL)
def s8(spark, sf):
    results = ro.parsed_fields(fixture(spark, sf, "responses_fx"))
    _, summary = wr.write_results(results, wr.scratch_dir(spark))
    return spark.read.json(summary)


@query(
    "s9_write_chat_split",
    f"""SELECT 'train' AS split, CAST(floor(count(*) * 0.9) AS BIGINT) AS n, CAST(5 AS BIGINT) AS messages FROM ({EXAMPLES_SQL})
UNION ALL SELECT 'eval', CAST(count(*) - floor(count(*) * 0.9) AS BIGINT), 5 FROM ({EXAMPLES_SQL})""",
)
def s9(spark, sf):
    examples = fd.raw_to_examples(fixture(spark, sf, "findings_fx"), keep=["id"])
    chats = ch.chat_rows(ch.format_chat(ch.split_examples(examples, "id", exact=True)))
    folder = wr.write_chat_split(chats, wr.scratch_dir(spark))
    written = spark.read.schema("split string, messages array<struct<role:string,content:string>>").json(folder)
    return written.groupBy("split").agg(F.count("*").alias("n"), F.max(F.size("messages")).cast("bigint").alias("messages"))
