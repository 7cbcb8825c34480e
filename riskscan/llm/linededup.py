"""Line deduplication by winnowing over line hashes.

A gram is a line and as many lines after it as together hold half of ``min_words`` words.
From each line on, the grams that begin within the other half make a window, and the gram
of least hash in a window is a fingerprint.  A repeated run of ``min_words`` words or more holds the
whole window of its first line, and so of every line from which it still holds ``min_words``
words: its fingerprints are the same wherever the run stands.  Fingerprints that stand at one place only
lead nowhere; most lines go here.

From a fingerprint that stands at several places the match is extended both ways, to runs of ``min_words``
words: forward, a line and as many lines after it as hold them, and backward, the same with the lines
before it, of the windows that have this fingerprint.  Each of these is joined with the first
place where the same lines stand, in order of doc_id and line, and the lines of later ones are deleted.
All lines of a repeated run lie in a forward or backward one inside the run, so runs are found from
``min_words`` on, whole and to the line, whatever stands around them.  (Extending from the first place of a
fingerprint alone would lose runs: there, it may stand in other lines.)

Every occurrence is joined with one first occurrence only, never with all others,
so a passage that a third of all documents share costs one row for each gram; what is joined is
dealt to SALTS parts, so its rows do not go to one task.  DataFrame functions only.

Lines are the units: of a passage that begins or ends inside a line only the whole
lines count, and only if they hold ``min_words`` words.

Defined results: a blank line weighs one word; lines are compared without outer spaces;
a null text stays null; a text whose lines all go is empty; rows
that share doc_id and text are one document and are treated alike; rows that share
only doc_id follow each other by a hash of the text; a null doc_id comes first; an empty
table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from riskscan.llm.common import WORD, written

#: Parts that the rows of one fingerprint or gram are dealt to.
SALTS = 8


def line_rows(docs: DataFrame) -> DataFrame:
    """(id, text hash, row, line number, line hash, words): one row per line."""
    lines = F.transform(
        F.split("text", "\n"),
        lambda line: F.struct(
            F.xxhash64(F.trim(line)).alias("h"), F.greatest(F.lit(1), F.regexp_count(line, F.lit(WORD))).alias("w")
        ),
    )
    rows = docs.where(F.col("text").isNotNull()).select(
        F.col("doc_id").alias("_id"), "text", F.monotonically_increasing_id().alias("_spot")  # numbers rows, not lines
    )
    return rows.select(
        "_id", F.xxhash64("text").alias("_hash"), "_spot", F.posexplode(lines).alias("_n", "_line")
    ).select("_id", "_hash", "_spot", "_n", F.col("_line.h").alias("_h"), F.col("_line.w").cast("long").alias("_w"))


def grams_of_lines(docs: DataFrame, min_words: int) -> DataFrame:
    """The runs of ``min_words`` words (document, row, hash, first and last line) with the fingerprint of the window of
    their first line; a backward one only where no forward one has the same lines."""
    short = min_words // 2
    in_order = Window.partitionBy("_spot").orderBy("_n")
    end = F.sum("_w").over(in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    from_here = Window.partitionBy("_spot").orderBy("_start")
    after, near = from_here.rangeBetween(0, min_words - 1), from_here.rangeBetween(0, max(0, short - 1))
    before = Window.partitionBy("_spot").orderBy("_end").rangeBetween(1 - min_words, 0)

    def gram(covered: Window, least: Column) -> Column:
        return F.when(F.sum("_w").over(covered) >= least, F.struct(
            F.xxhash64(F.collect_list("_h").over(covered)).alias("gram"),
            F.min("_n").over(covered).alias("first"), F.max("_n").over(covered).alias("last"),
            F.first("_least").over(covered).alias("least"),
        ))

    # without its last line, a backward gram of its own still holds min_words: else the forward gram from its first line is the same
    lines = line_rows(docs).withColumn("_end", end).withColumn("_start", F.col("_end") - F.col("_w"))
    short_gram = F.struct(F.xxhash64(F.collect_list("_h").over(near)).alias("print"), F.col("_n").alias("at"))
    winnowed = lines.withColumn("_print", F.when(F.sum("_w").over(near) >= short, short_gram)).withColumn(
        "_least", F.min("_print").over(from_here.rangeBetween(0, min_words - short))
    )
    both = winnowed.withColumn("_on", gram(after, F.lit(min_words))).withColumn("_back", gram(before, F.col("_w") + min_words))
    return both.select("_id", "_hash", "_spot", F.inline(F.array_compact(F.array("_on", "_back"))))


def salted(rows: DataFrame, few: DataFrame, key: str, how: str) -> DataFrame:
    """Joins many rows with a row for each key; a key's rows are dealt to SALTS parts."""
    salt = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt")
    dealt = rows.withColumn("_salt", F.pmod(F.xxhash64("_spot", "first"), F.lit(SALTS)).cast("int"))
    return dealt.join(few.select("*", salt), [key, "_salt"], how).drop("_salt")


def repeated_runs(docs: DataFrame, min_words: int = 50) -> DataFrame:
    """(_id, _hash, runs): the runs of lines (first, last) that each document repeats from before."""
    grams = written(grams_of_lines(docs, min_words).select("*", F.col("least.print").alias("print")), "line-grams")
    place = F.struct("_spot", "least.at")
    recurring = grams.groupBy("print").agg(F.min(place).alias("_a"), F.max(place).alias("_b")).where("_a <> _b").select("print")
    matched = written(salted(grams, recurring, "print", "left_semi").drop("least", "print"), "line-matches")
    firsts = matched.groupBy("gram").agg(
        F.min(F.struct("_id", "_hash", "first")).alias("_f"), F.count("*").alias("_count")
    ).where("_count > 1").select("gram", "_f")
    spans = salted(matched, firsts, "gram", "inner").where(
        ~F.struct("_id", "_hash", "first").eqNullSafe(F.col("_f"))
    ).select("_id", "_hash", "first", "last")
    in_doc = Window.partitionBy("_id", "_hash").orderBy("first", "last")
    reached = F.max("last").over(in_doc.rowsBetween(Window.unboundedPreceding, -1))
    islands = spans.withColumn("_new", F.coalesce((F.col("first") > reached + 1).cast("int"), F.lit(1))).withColumn(
        "_island", F.sum("_new").over(in_doc.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    )
    merged = islands.groupBy("_id", "_hash", "_island").agg(F.min("first").alias("first"), F.max("last").alias("last"))
    return merged.groupBy("_id", "_hash").agg(F.array_sort(F.collect_list(F.struct("first", "last"))).alias("runs"))


def with_runs(docs: DataFrame, min_words: int = 50) -> DataFrame:
    """The documents as they are, and ``_runs`` (first, last) to delete, null if there are none."""
    runs = repeated_runs(docs, min_words).select(F.col("_id").alias("_rid"), F.col("_hash").alias("_rhash"), F.col("runs").alias("_runs"))
    return docs.join(
        runs, F.col("doc_id").eqNullSafe(F.col("_rid")) & (F.xxhash64("text") == F.col("_rhash")), "left"
    ).select(*docs.columns, "_runs")


def kept_text(text: Column, runs: Column) -> Column:
    """The text without the lines of the runs."""
    gone = lambda i: F.exists(runs, lambda r: (r["first"] <= i) & (i <= r["last"]))
    return F.when(runs.isNull(), text).otherwise(
        F.array_join(F.filter(F.split(text, "\n"), lambda line, i: ~gone(i)), "\n")
    )


def without_repeats(docs: DataFrame, min_words: int = 50) -> DataFrame:
    """The documents without repeated runs, with the columns they had; n_chars follows the text."""
    found = with_runs(docs, min_words).withColumn("text", kept_text(F.col("text"), F.col("_runs"))).drop("_runs")
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        found = found.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text")).cast(kind))
    return found.select(*docs.columns)
