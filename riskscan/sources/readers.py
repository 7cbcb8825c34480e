"""Reading findings, examples and texts.

Each reader is a plain Spark scan plus a transform over its ``value`` column;
the transforms are public so that lines which are already in a table, or
arrive on a stream, go through the same rules.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskscan.functions.text import DESCRIPTION_FIELDS, L2_FIELDS, RISK_FIELDS, TITLE_FIELDS, btrim_u, parse_json
from riskscan.operators import findings as fd
from riskscan.operators.findings import raw_to_examples
from riskscan.operators.texts import dedupe_texts
from riskscan.sources.json_arrays import entries_of_json_files
from riskscan.sources.writers import scratch_dir

RAW_EXTENSIONS = ("xlsx", "xls", "csv")

# Cells that count as missing in a findings file (the usual set of data-frame readers); fixed values.
MISSING_CELLS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA",
    "NULL", "NaN", "None", "n/a", "nan", "null",
]
#: JSON files up to this size are parsed by one task each.
WHOLE_JSON_BYTES = 1 << 25
TEXT_NAME_PARTS = ["text", "description", "content", "finding", "detail"]
TEXT_KEYS = ["text", "description", "content"]
EMPTY_JSON = ["false", "0", "0.0", "[]", "{}"]

EXAMPLE_SCHEMA = (
    "type string, text string, l2_category string, macro_risks array<string>, pc_category string, "
    "pii_types array<string>, metadata map<string,string>, ddl_statement string, "
    "analysis_result struct<table_name:string,overall_classification:string,detected_pii_types:array<string>,"
    "high_risk_columns:array<string>,ambiguous_columns:array<string>,requires_human_review:boolean,"
    "compliance_flags:array<string>,privacy_recommendations:array<string>>"
)


def _any_case(extension: str) -> str:
    return "".join(f"[{ch.lower()}{ch.upper()}]" if ch.isalpha() else ch for ch in extension)


def _extension(path: str) -> str:
    return os.path.splitext(path.rstrip("/"))[1].lower().lstrip(".")


# --------------------------------------------------------------------------
# Findings files
# --------------------------------------------------------------------------


def discover_files(spark: SparkSession, folder: str, extensions: tuple[str, ...] = RAW_EXTENSIONS) -> DataFrame:
    """S1. (path, extension, length) of the matching files at any depth; extensions in any case.

    Only file metadata is read: the content column is pruned.
    """
    glob = "*.{" + ",".join(_any_case(e) for e in extensions) + "}"
    files = spark.read.format("binaryFile").options(recursiveFileLookup="true", pathGlobFilter=glob).load(folder)
    extension = F.lower(F.substring_index("path", ".", -1))
    return files.select("path", extension.alias("extension"), "length")


SOURCE, NOT_TEXT = "source_file", fd.NOT_TEXT
#: Cells of one record at most, and bytes of a table with a row per file up to which it is broadcast.
MAX_CELLS, BROADCAST_BYTES = 1 << 20, 1 << 26
INTEGER = r"^[+-]?\d{1,18}$"
#: What every number looks like (decimal, hexadecimal, infinite or none), and little else: a failed cast costs an exception.
MAYBE_NUMBER = r"^[\x00-\x20]*[+-]?(\.?[0-9]|[iI][nN][fF]|[nN][aA][nN])[\x00-\x20+\-.0-9a-fA-FxXpPiInNtTyY]*$"
TRUE_WORDS, FALSE_WORDS = ["True", "TRUE", "true"], ["False", "FALSE", "false"]


def _csv(spark: SparkSession, paths: list[str] | str, schema: str, multi_line: bool, **options: str) -> DataFrame:
    """The CSV files at any depth, byte for byte as Latin-1 characters."""
    reader = spark.read.options(
        recursiveFileLookup="true", pathGlobFilter=f"*.{_any_case('csv')}", multiLine=str(multi_line).lower(), escape='"',
        encoding="ISO-8859-1", maxColumns=str(MAX_CELLS), **options,
    )
    return reader.schema(schema).csv(paths)


RECORDS = "_c0 string, _record string"


def _record() -> Column:
    """A record as it stands in its file, from a scan of RECORDS: read as one column, every record of two cells and more
    is malformed and comes whole; one of a single cell is that cell."""
    quoted = F.concat(F.lit('"'), F.replace(F.coalesce("_c0", F.lit("")), F.lit('"'), F.lit('""')), F.lit('"'))
    return F.coalesce("_record", quoted)


def _cells_of(record: str, width: int) -> Column:
    """The first ``width`` cells of a record; null where it has fewer."""
    cells = F.from_csv(record, ", ".join(f"c{i} string" for i in range(width)), {"escape": '"', "maxColumns": str(MAX_CELLS)})
    return F.get(F.transform(F.array(cells), lambda c: F.array(*[c[f"c{i}"] for i in range(width)])), F.lit(0))


def _csv_files(spark: SparkSession, paths: list[str] | str, multi_line: bool) -> DataFrame:
    """(_file, _utf8, _header) of every file that has records below its header: the names in its header, and whether
    it is valid UTF-8.  One scan, whose result is written, since each further step needs it.
    Empty names are called by their place, and names that a header has before get a number.
    """
    raw = _csv(spark, paths, RECORDS, multi_line, columnNameOfCorruptRecord="_record")
    at = F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"))
    rows = raw.select(F.col("_metadata.file_path").alias("_file"), at.alias("_at"), _record().alias("_record"))
    valid = F.is_valid_utf8(F.encode("_record", "ISO-8859-1").cast("string"))
    found = rows.groupBy("_file").agg(
        F.min_by("_record", "_at").alias("_first"), F.bool_and(valid).alias("_utf8"), F.count("*").alias("_n")
    )
    path = f"{scratch_dir(spark)}/csv-files"
    found.write.parquet(path)
    files = spark.read.schema(found.schema).parquet(path).where("_n > 1")
    header = F.regexp_replace(_decoded(F.col("_first")), "^\ufeff|^\u00ef\u00bb\u00bf", "")
    bare = F.regexp_replace(header, '"([^"]|"")*"', "")  # commas inside quotes do not count
    files = files.withColumn("_first", header).withColumn("_width", F.size(F.split(bare, ",")))
    width = files.agg(F.max("_width")).first()[0]
    if width is None:
        raise ValueError(f"no CSV file with content under {paths}")
    files = files.select("_file", "_utf8", F.slice(_cells_of("_first", width), F.lit(1), F.col("_width")).alias("_names"))
    named = F.transform("_names", lambda c, i: F.coalesce(F.nullif(c, F.lit("")), F.concat(F.lit("Unnamed: "), i.cast("string"))))

    def unlike(c: Column, i: Column) -> Column:
        before = F.size(F.filter(F.slice("_names", F.lit(1), i), lambda other: other == c))
        return F.when(before > 0, F.concat(c, F.lit("."), before.cast("string"))).otherwise(c)

    return files.withColumn("_names", named).select("_file", "_utf8", F.transform("_names", unlike).alias("_header"))


def _decoded(cell: Column) -> Column:
    return F.when(F.col("_utf8"), F.decode(F.encode(cell, "ISO-8859-1"), "UTF-8")).otherwise(cell)


def _beside(rows: DataFrame, files: DataFrame) -> DataFrame:
    """The rows with what a table with a row per file says of their file.

    The table is broadcast if it is small, by its measured size; otherwise it is joined by
    path, where adaptive execution splits the rows of large files.
    """
    width = F.octet_length("_file") + 64 + sum(
        (F.octet_length(F.to_json(F.struct(f"`{f.name}`"))) for f in files.schema if f.dataType.typeName() in ("array", "struct")), F.lit(0)
    )
    size = files.agg(F.sum(width.cast("long"))).first()[0] or 0
    beside = F.broadcast(files) if size <= BROADCAST_BYTES else files
    return rows.join(beside, F.col(SOURCE) == F.col("_file"))


def _csv_rows(spark: SparkSession, paths: list[str] | str, files: DataFrame, multi_line: bool, whole: bool = False) -> DataFrame:
    """The records below the headers with the columns of ``files``: source_file, _cells (as they stand in the file), and
    with ``whole`` the _record.  There is one cell more than the longest header has."""
    width = files.agg(F.max(F.size("_header"))).first()[0] + 1
    path = F.col("_metadata.file_path").alias(SOURCE)
    if whole:
        raw = _csv(spark, paths, RECORDS, multi_line, header="true", columnNameOfCorruptRecord="_record")
        rows = raw.select(path, _record().alias("_record")).select("*", _cells_of("_record", width).alias("_cells"))
    else:
        raw = _csv(spark, paths, ", ".join(f"_c{i} string" for i in range(width)), multi_line, header="true")
        rows = raw.select(path, F.array(*[f"_c{i}" for i in range(width)]).alias("_cells"))
    return _beside(rows, files)


def _unique_names(names: list[str]) -> dict[str, str]:
    """Names of the files -> column names.  Spark columns do not differ by case alone: of
    such names the known field that counts first keeps its own, else the first by spelling; others get a number."""
    taken: dict[str, int] = {}
    out = {}
    known = [*TITLE_FIELDS, *DESCRIPTION_FIELDS, *L2_FIELDS, *RISK_FIELDS]
    for name in sorted(names, key=lambda n: (known.index(n) if n in known else len(known), n)):
        low = name.lower()
        taken[low] = taken.get(low, 0) + 1
        out[name] = name if taken[low] == 1 else f"{name} ({taken[low]})"
    return out


def read_csv_findings(spark: SparkSession, paths: list[str] | str, infer_numbers: bool = True,
                      multi_line: bool = True) -> DataFrame:
    """S2. Findings files with a header, as one table over the union of their columns, and ``source_file``.

    UTF-8 where a file is valid UTF-8, Latin-1 otherwise.  Missing-value words
    become null.  Names count in their exact case.  With ``infer_numbers`` a
    column's kind is decided file by file: whole numbers, numbers (also whole ones with
    missing cells), booleans or text.  A column of one kind everywhere has that
    type.  One whose kind differs is a string, written as its file would have it
    (``7``, ``7.0``, ``True``), and ``_not_text`` names the columns of a row that
    are no text in its file, so that they do not enter assembled texts.

    The files are scanned once for their headers, once for the kinds, and once by the
    query itself; a table with a row per file carries the findings over.  The width of
    the table comes from the headers alone.  Records with more cells than their header are
    left to ``csv_rejects``; a record of over MAX_CELLS cells is an error.
    ``multi_line=False`` lets Spark split files, for data without line breaks
    inside quotes.  The driver sees the distinct column names, not the files.
    """
    files = _csv_files(spark, paths, multi_line)
    found = files.select(F.explode("_header").alias("name")).distinct()
    names = _unique_names([r["name"] for r in found.collect()])
    listed = F.array(*[F.lit(n) for n in names])
    places = F.transform(listed, lambda n: F.array_position("_header", n).cast("int") - 1)  # -1: not in this file
    rows = _csv_rows(spark, paths, files.withColumn("_places", places), multi_line).where(_fits())

    def cell(i: int, column: str) -> Column:
        place = F.get("_places", F.lit(i))
        value = _decoded(F.when(place >= 0, F.get("_cells", place)))
        return F.when(~value.isin(*MISSING_CELLS), value).alias(column)

    table = rows.select(SOURCE, *[cell(i, column) for i, column in enumerate(names.values())])
    return _typed(table, list(names.values())) if infer_numbers else table


def _fits() -> Column:
    extra = F.slice("_cells", F.size("_header") + 1, F.size("_cells"))
    return ~F.exists(extra, lambda c: c.isNotNull())


def csv_rejects(spark: SparkSession, paths: list[str] | str, multi_line: bool = True) -> DataFrame:
    """S2. The records that have more cells than their file's header: source_file, cells (one more than the longest
    header has, at most), and the whole record as it stands in the file."""
    files = _csv_files(spark, paths, multi_line)
    rows = _csv_rows(spark, paths, files, multi_line, whole=True).where(~_fits())
    cells = F.transform(F.filter("_cells", lambda c: c.isNotNull()), _decoded)
    return rows.select(SOURCE, cells.alias("cells"), _decoded(F.col("_record")).alias("record"))


def _typed(table: DataFrame, names: list[str]) -> DataFrame:
    def kind(name: str) -> Column:
        """Of one file; null for a column without filled cells."""
        c = F.btrim(F.col(f"`{name}`"))
        filled = c.isNotNull()
        every = lambda test: F.bool_and(F.when(filled, test))
        some_missing = F.count_if(~filled) > 0
        return (
            F.when(F.count_if(filled) == 0, None)
            .when(every(c.rlike(INTEGER)) & ~some_missing, "int")
            .when(every(F.when(c.rlike(MAYBE_NUMBER), c.try_cast("double").isNotNull()).otherwise(False)), "float")
            .when(every(c.isin(*TRUE_WORDS, *FALSE_WORDS)) & ~some_missing, "bool")
            .otherwise("text")
        )

    spark = table.sparkSession
    found = table.groupBy(F.col(SOURCE).alias("_file")).agg(*[kind(n).alias(n) for n in names])
    path = f"{scratch_dir(spark)}/csv-kinds"
    found.write.parquet(path)
    kinds = spark.read.schema(found.schema).parquet(path)
    seen = kinds.agg(*[F.sort_array(F.collect_set(f"`{n}`")).alias(n) for n in names]).first().asDict() if names else {}
    types = {"int": "bigint", "float": "double", "bool": "boolean"}
    mixed = [n for n in names if len(seen[n]) > 1]
    plain = {n: F.col(f"`{n}`") for n in names}
    for n in names:
        if len(seen[n]) == 1 and seen[n][0] in types:
            plain[n] = F.btrim(plain[n]).cast(types[seen[n][0]])
    if not mixed:
        return table.select(*[c.alias(n) for n, c in plain.items()], SOURCE)
    marked = _beside(table, kinds.select("_file", F.struct(*[F.col(f"`{n}`") for n in mixed]).alias("_kinds")))
    for n in mixed:
        c, k = F.btrim(F.col(f"`{n}`")), F.col(f"_kinds.`{n}`")
        plain[n] = (
            F.when(k == "int", c.cast("bigint").cast("string")).when(k == "float", c.try_cast("double").cast("string"))
            .when(k == "bool", F.initcap(c)).otherwise(F.col(f"`{n}`"))
        )
    no_text = F.filter(
        F.array(*[F.when(F.col(f"_kinds.`{n}`") != "text", F.lit(n)) for n in mixed]), lambda n: n.isNotNull()
    )
    return marked.select(*[c.alias(n) for n, c in plain.items()], SOURCE, no_text.alias(NOT_TEXT))


# --------------------------------------------------------------------------
# examples
# --------------------------------------------------------------------------


def parse_examples(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """S3 over a ``value`` column: (examples in EXAMPLE_SCHEMA, rejected lines). Blank lines vanish."""
    filled = lines.where(btrim_u(F.col("value")) != "").withColumn("_v", parse_json(F.col("value")))
    is_object = F.coalesce(F.startswith(F.schema_of_variant("_v"), F.lit("OBJECT")), F.lit(False))
    rest = [c for c in lines.columns if c != "value"]
    good = filled.where(is_object).withColumn("_e", F.from_json("value", EXAMPLE_SCHEMA))
    return good.select(*rest, "_e.*"), filled.where(~is_object).select(*rest, "value")


def read_examples_jsonl(spark: SparkSession, paths: list[str] | str) -> tuple[DataFrame, DataFrame]:
    """S3. (examples, rejected lines with their file)."""
    lines = spark.read.option("recursiveFileLookup", "true").text(paths)
    examples, bad = parse_examples(lines.select("value", F.col("_metadata.file_path").alias("source_file")))
    return examples.drop("source_file"), bad


def load_examples(spark: SparkSession, path: str) -> DataFrame:
    """S5. Examples from whatever the path holds: a folder of raw files (searched at
    any depth) or a raw CSV file goes through extraction, anything else is read as
    JSON lines.  Raises when there are none."""
    extension = _extension(path)
    if extension == "csv":
        examples = raw_to_examples(read_csv_findings(spark, path), keep=[SOURCE]).drop(SOURCE)
    elif extension in ("json", "jsonl"):
        examples, _ = read_examples_jsonl(spark, path)
    elif extension:
        raise ValueError(f"cannot tell how to read {path}")
    elif not discover_files(spark, path, ("csv",)).isEmpty():
        examples = raw_to_examples(read_csv_findings(spark, path), keep=[SOURCE]).drop(SOURCE)
    else:
        examples, _ = read_examples_jsonl(spark, path)
    if examples.isEmpty():
        raise ValueError(f"no training examples in {path}")
    return examples


# --------------------------------------------------------------------------
# texts
# --------------------------------------------------------------------------


def texts_from_lines(lines: DataFrame) -> DataFrame:
    """S4a. One text per line, trimmed; blank lines drop out."""
    return lines.select(btrim_u(F.col("value")).alias("text")).where("text <> ''")


def _entry_texts(entries: DataFrame, entry: str) -> DataFrame:
    """The texts of parsed JSON entries: the first of the three keys that is *present*
    counts, even when its value is JSON null, and an empty value gives nothing."""
    value = F.coalesce(*[F.try_variant_get(entry, f"$.{key}", "variant") for key in TEXT_KEYS])
    cells = entries.select(F.schema_of_variant(value).alias("_kind"), value.cast("string").alias("text"))
    empty = F.when(F.col("_kind") == "STRING", F.col("text") == "").otherwise(F.col("text").isin(*EMPTY_JSON))
    return cells.where(F.col("text").isNotNull() & ~empty).select("text")


def texts_from_entries(entries: DataFrame) -> DataFrame:
    """S4c over parsed entries (_e), such as `entries_of_json_files` gives."""
    return _entry_texts(entries, "_e")


def texts_from_jsonl(lines: DataFrame) -> DataFrame:
    """S4b. One object per line; malformed lines and other JSON drop out."""
    return _entry_texts(lines.select(parse_json(F.col("value")).alias("_v")), "_v")


def texts_from_json(documents: DataFrame) -> DataFrame:
    """S4c. Each ``value`` is a whole JSON document: one object or an array of objects."""
    parsed = documents.select(parse_json(F.col("value")).alias("_v"))
    members = F.coalesce(F.try_variant_get("_v", "$", "array<variant>"), F.array("_v"))
    return _entry_texts(parsed.select(F.explode(members).alias("_e")), "_e")


def text_column(columns: list[str]) -> str | None:
    """S4d. The first column whose name contains text, description, content, finding or detail."""
    return next((c for c in columns if any(part in c.lower() for part in TEXT_NAME_PARTS)), None)


def texts_from_table(df: DataFrame) -> DataFrame:
    """S4d. The filled cells of the text column, as strings; empty without such a column."""
    name = text_column(df.columns)
    if name is None:
        return df.select(F.lit(None).cast("string").alias("text")).where(F.lit(False))
    return df.select(F.col(f"`{name}`").cast("string").alias("text")).where(F.col("text").isNotNull())


def read_texts(spark: SparkSession, path: str) -> DataFrame:
    """S4 + P11. Distinct non-blank texts of a .jsonl, .json, .csv or plain text file or folder of such files."""
    extension = _extension(path)
    if extension == "jsonl":
        texts = texts_from_jsonl(spark.read.text(path))
    elif extension == "json":
        # An array may hold entries that are no objects, for which Spark's JSON reader drops the whole
        # file: so a file is one value, or, if it is large, cut into its entries by many tasks.
        size = F.col("_metadata.file_size")
        texts = texts_from_json(spark.read.text(path, wholetext=True).where(size <= WHOLE_JSON_BYTES))
        if not spark.read.format("binaryFile").load(path).where(F.col("length") > WHOLE_JSON_BYTES).select("path").isEmpty():
            texts = texts.unionByName(texts_from_entries(entries_of_json_files(spark, path, WHOLE_JSON_BYTES)))
    elif extension == "csv":
        texts = texts_from_table(read_csv_findings(spark, path, infer_numbers=False).drop(SOURCE))
    else:
        texts = texts_from_lines(spark.read.text(path))
    return dedupe_texts(texts)
