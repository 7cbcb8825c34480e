"""Large JSON files cut into their entries by many tasks.

A JSON file can't be cut at line ends: it may be a single line.  It is cut behind every closing
brace instead, into chunks, wherever Spark splits the file.  Whether a brace lies inside a
string, and how deep it lies, depends on all that stands before; both are prefix sums:

- A chunk is inside a string at its start if an odd number of quotes (not escaped) precedes it.
- How much deeper a chunk leads follows from its brackets outside of strings, so it has one value
  if it starts outside of a string and another if it starts inside.

Each split of a file is summed up for both cases by the task that has it; a row for each split is
enough to find where every split begins, and so every chunk.  A brace that leads back to depth 1 (or 0, if the
file is one object) closes an entry; the chunks up to it are put together and parsed.

A file that is not valid JSON as a whole gives no entries, as with a reader that takes it whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskscan.functions.text import bind, btrim_u, parse_json
from riskscan.sources.writers import scratch_dir


def _written(df: DataFrame, name: str) -> DataFrame:
    path = f"{scratch_dir(df.sparkSession)}/{name}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _brackets(outside: Column) -> Column:
    """How much deeper brackets lead, without the brace behind the chunk."""
    count = lambda ch: F.length(outside) - F.length(F.replace(outside, F.lit(ch), F.lit("")))
    return count("{") + count("[") - count("]")


def _chunks(spark: SparkSession, path: str, larger_than: int) -> DataFrame:
    """(file, block, at, text, closed, quotes, deeper_out, deeper_in) of every chunk; a written table.

    ``closed``: a brace follows.  The two depths are for a start outside and inside of a string.
    """
    size, start = F.col("_metadata.file_size"), F.col("_metadata.file_block_start")
    rows = spark.read.text(path, lineSep="}").where(size > larger_than).select(
        F.col("_metadata.file_path").alias("file"), start.alias("block"), size.alias("_size"),
        F.monotonically_increasing_id().alias("at"), F.col("value").alias("text"),
    )
    # without escaped characters every quote opens or closes a string
    plain = F.replace(F.replace("text", F.lit("\\\\"), F.lit("")), F.lit('\\"'), F.lit(""))
    parts = F.split(plain, '"')

    def read(parts: Column) -> Column:
        outside = lambda odd: F.array_join(F.filter(parts, lambda p, i: i % 2 == odd), "")
        return F.struct(
            (F.size(parts) - 1).alias("quotes"), _brackets(outside(0)).alias("out"), _brackets(outside(1)).alias("inside")
        )

    # the last chunk of a file has a brace behind it if all lengths with one each make the file's length
    in_file = rows.withColumn("_read", bind(parts, read)).withColumn("_bytes", F.octet_length("text").cast("long") + 1)
    return _written(in_file.select("file", "block", "at", "text", "_size", "_bytes", "_read.*"), "json-chunks")


def _placed(chunks: DataFrame) -> DataFrame:
    """(file, place, text, closed, depth, outside, entry): where every chunk ends, and the number of its entry."""
    ends = chunks.groupBy("file").agg(
        F.max(F.struct("block", "at")).alias("_last"), (F.sum("_bytes") == F.max("_size")).alias("_all_closed")
    )
    rows = chunks.join(ends, "file").withColumn("closed", F.col("_all_closed") | (F.struct("block", "at") != F.col("_last")))
    in_split = Window.partitionBy("file", "block").orderBy("at")
    before, to_here = in_split.rowsBetween(Window.unboundedPreceding, -1), in_split.rowsBetween(Window.unboundedPreceding, 0)
    # as if the split began outside of a string (case a) and inside (case b)
    odd = F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1
    ends_odd = F.sum("quotes").over(to_here) % 2 == 1
    change = lambda starts_in, ends_in: F.when(starts_in, F.col("inside")).otherwise(F.col("out")) - (
        F.col("closed") & ~ends_in).cast("int")
    rows = rows.withColumns({"_odd": ends_odd, "_a": change(odd, ends_odd), "_b": change(~odd, ~ends_odd)})
    rows = _written(rows.select("file", "block", "at", "text", "quotes", "closed", "_odd", "_a", "_b"), "json-cases")
    splits = rows.groupBy("file", "block").agg(F.sum("quotes").alias("_quotes"), F.sum("_a").alias("_sum_a"), F.sum("_b").alias("_sum_b"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)  # a row a split
    begins = splits.withColumn("_in", F.coalesce(F.sum("_quotes").over(earlier), F.lit(0)) % 2 == 1)
    deeper = F.when(F.col("_in"), F.col("_sum_b")).otherwise(F.col("_sum_a"))
    begins = begins.select("file", "block", "_in", F.coalesce(F.sum(deeper).over(earlier), F.lit(0)).alias("_depth"))
    step = F.when(F.col("_in"), F.col("_b")).otherwise(F.col("_a"))
    known = rows.join(begins, ["file", "block"]).select(
        "file", "block", "at", "text", "closed", (F.col("_odd") == F.col("_in")).alias("outside"),
        (F.col("_depth") + F.sum(step).over(to_here)).alias("depth"),
    )
    first = chunks.groupBy("file").agg(F.min_by("text", F.struct("block", "at")).alias("_first"))
    opened = first.select("file", F.when(F.startswith(F.ltrim(btrim_u("_first")), F.lit("[")), 1).otherwise(0).alias("_floor"))
    shut = known.join(opened, "file").withColumn("_shuts", F.col("closed") & F.col("outside") & (F.col("depth") == F.col("_floor")))
    shut = _written(shut, "json-depths")
    counts = shut.groupBy("file", "block").agg(F.count_if("_shuts").alias("_n"))
    counted = counts.select("file", "block", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_earlier"))
    here = F.coalesce(F.sum(F.col("_shuts").cast("long")).over(before), F.lit(0))
    return shut.join(counted, ["file", "block"]).withColumn("entry", F.col("_earlier") + here)


def entries_of_json_files(spark: SparkSession, path: str, larger_than: int = -1) -> DataFrame:
    """(_e VARIANT): the entries of the array, or the one object, of every JSON file of more than so many bytes."""
    placed = _placed(_chunks(spark, path, larger_than))
    piece = F.struct("block", "at", F.concat("text", F.when(F.col("closed"), "}").otherwise("")).alias("text"))
    whole = placed.groupBy("file", "entry").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(piece)), lambda p: p["text"]), "").alias("_text"),
        F.max("_floor").alias("_floor"), F.bool_or("_shuts").alias("_shuts"), F.min("depth").alias("_least"),
        F.max_by("depth", F.struct("block", "at")).alias("_depth"), F.max_by("outside", F.struct("block", "at")).alias("_outside"),
    )
    text = btrim_u("_text")
    first, comma = F.col("entry") == 0, F.startswith(text, F.lit(","))
    bare = F.when((F.col("_floor") == 0) & first, text).when((F.col("_floor") == 0) & ~first, None).when(first | comma, btrim_u(F.substring(text, 2, 1 << 30)))
    # what stands behind the last entry: the end of the array, perhaps with entries that are no objects
    rest = F.when(first & (F.col("_floor") == 1), text).when(comma & (bare != "]"), F.concat(F.lit("["), bare)).when(text == "]", "[]")
    members = F.when(
        F.col("_shuts"),
        F.when(F.startswith(bare, F.lit("{")), F.array(parse_json(bare))).otherwise(_array(F.concat(F.lit("["), bare, F.lit("]")))),
    ).when(F.col("_floor") == 1, _array(rest)).when((text == "") & ~first, F.array().cast("array<variant>")).when(
        first, F.array(F.try_parse_json(text)))  # a single value that is neither array nor object
    ended = F.col("_shuts") | (F.col("_outside") & (F.col("_depth") == 0))
    parsed = whole.select("file", "entry", "_floor", "_shuts", F.when(ended & (F.col("_least") >= 0), members).alias("_members"))
    parsed = parsed.withColumn("_bad", F.coalesce(F.exists("_members", lambda m: m.isNull()), F.lit(True)))
    parsed = _written(parsed, "json-entries")
    # a file is bad with any bad part, if its array is not ended, or if anything follows its one object
    last = F.max(F.struct("entry", "_shuts"))
    files = parsed.groupBy("file").agg(F.bool_or("_bad").alias("_bad"), last.alias("_last"), F.max("_floor").alias("_floor"))
    good = files.where(~F.col("_bad") & ((F.col("_floor") == 0) | ~F.col("_last._shuts"))).select("file")
    return parsed.join(good, "file", "left_semi").select(F.explode("_members").alias("_e"))


def _array(text: Column) -> Column:
    """The members of a JSON array, null if the text is none."""
    return F.try_variant_get(F.try_parse_json(text), "$", "array<variant>")
