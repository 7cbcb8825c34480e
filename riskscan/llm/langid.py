"""Language ID by compression: the language whose dictionary shortens a text most.

Each language has a raw-content zstandard dictionary of the words of a sample, the
frequent ones last, where matches are cheapest, and some running text.  A text's
letters, in lower case, follow that running text, and what the text adds to the
compressed size is its cost in that language.  The smallest cost wins.  Sizes are whole bytes, so
short texts tie easily: where the two best costs lie within ``min_margin`` of each other, the
text is measured again behind AGAIN other running texts of the languages that are so near, and all
costs of a language count together.  A text that stays within the margin is rejected.

Whole texts count: long ones are compressed in stretches, each with the dictionary.

The sample is bounded: ``sample_docs`` labelled documents of a language, chosen by a
hash of doc_id, and ``sample_chars`` code points of each; ``sample_total`` documents and
``total_bytes`` of dictionaries in all, which many languages share evenly.  Of more than
``sample_total`` languages, those with most documents are learned.

Defined results: a null text, or one without a letter, is ``und`` with score 0, and
rejected; so is everything when nothing could be learned; ties go to the first
language by name; rows without lang, text or doc_id teach nothing; rows that share a doc_id
teach once; repeated rows are judged alike; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

NONE = "und"
#: Everything but letters; numbers, marks and signs say little about a language.  Fractions and the like remain.
NO_LETTERS = re.compile(r"[\W\d_]+")
AGAIN = 4
STRETCH = 32_768
LEVEL = 3
RESULT = "lang_pred string, score double, rejected boolean"


def letters(text: str | None) -> str:
    """The text's letters in lower case, words parted by one space."""
    found = NO_LETTERS.sub(" ", (text or "").lower()).strip()
    if found and not found.replace(" ", "").isalpha():  # numbers of other kinds: seldom
        found = " ".join("".join(c if c.isalpha() else " " for c in found).split())
    return found


Lesson = tuple[str, bytes, tuple[bytes, ...]]


def lesson(texts: list[str], running_chars: int, dictionary_bytes: int) -> tuple[bytes, tuple[bytes, ...]]:
    """A language's dictionary and its running texts, of which the first is the usual one."""
    texts = [t for t in (letters(t) for t in dict.fromkeys(texts)) if t]
    words = Counter(w for t in texts for w in t.split())
    ranked = sorted(words, key=lambda w: (words[w], w))
    joined = " ".join(t[:running_chars // 10] for t in texts)
    running = [joined[at:at + running_chars] for at in range(0, running_chars * (1 + AGAIN), running_chars)]
    return (" ".join(ranked) + " ").encode()[-dictionary_bytes:], tuple((r + " ").encode() for r in running)


@lru_cache(maxsize=4)
def coders(lessons: tuple[Lesson, ...]) -> dict[str, tuple[zstandard.ZstdCompressor, list[tuple[bytes, int]]]]:
    """By language: its coder, and its running texts with the size of each alone; once per worker process."""
    out = {}
    for lang, words, running in lessons:
        dictionary = zstandard.ZstdCompressionDict(words, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        dictionary.precompute_compress(level=LEVEL)
        coder = zstandard.ZstdCompressor(dict_data=dictionary)
        out[lang] = coder, [(r, len(coder.compress(r))) for r in running]
    return out


def judge(text: str | None, lessons: tuple[Lesson, ...], min_margin: float) -> tuple[str, float, bool]:
    """(language, margin over the second best as a share of its cost, rejected)."""
    data = letters(text).encode()
    if not data or not lessons:
        return NONE, 0.0, True
    known = coders(lessons)

    def cost(lang: str, turn: int) -> int:
        coder, running = known[lang]
        behind, alone = running[turn]
        return sum(max(1, len(coder.compress(behind + data[at:at + STRETCH])) - alone) for at in range(0, len(data), STRETCH))

    costs = sorted((cost(lang, 0), lang) for lang in known)
    if len(costs) == 1:
        return costs[0][1], 1.0, False
    if 1 - costs[0][0] / costs[1][0] < min_margin:
        near = [(c, lang) for c, lang in costs if 1 - costs[0][0] / c < min_margin]
        costs = sorted((c + sum(cost(lang, turn) for turn in range(1, 1 + AGAIN)), lang) for c, lang in near)
    score = 1 - costs[0][0] / costs[1][0]
    return costs[0][1], score, score < min_margin


def learn(
    docs: DataFrame, teaches: Column, sample_docs: int = 400, sample_chars: int = 2_000, running_chars: int = 2_000,
    dictionary_bytes: int = 1 << 16, sample_total: int = 25_600, total_bytes: int = 1 << 22,
) -> tuple[Lesson, ...]:
    """(language, dictionary, running texts) from labelled documents for which ``teaches`` holds."""
    wanted = docs.where(teaches & F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull())
    labelled = wanted.select(F.col("doc_id").cast("long").alias("_id"), F.col("lang").cast("string").alias("_lang"))
    # at most sample_total rows
    often = labelled.groupBy("_lang").agg(F.count("*").alias("_often")).orderBy(F.desc("_often"), "_lang").limit(sample_total)
    langs = sorted(r["_lang"] for r in often.collect())
    if not langs:
        return ()
    sample_docs, dictionary_bytes = min(sample_docs, sample_total // len(langs)), min(dictionary_bytes, total_bytes // len(langs))
    spark = docs.sparkSession
    listed = spark.createDataFrame([(lang,) for lang in langs], "_lang string")
    place = F.row_number().over(Window.partitionBy("_lang").orderBy(F.xxhash64("_id"), "_id"))
    chosen = labelled.join(F.broadcast(listed), "_lang", "left_semi").withColumn("_place", place).where(F.col("_place") <= sample_docs)
    names = spark.createDataFrame(sorted({(r["_id"],) for r in chosen.collect()}), "_id long")
    rows = wanted.join(F.broadcast(names), wanted["doc_id"] == names["_id"], "left_semi").select(
        F.col("doc_id").alias("_id"), F.col("lang").cast("string").alias("_lang"),
        F.substring("text", 1, sample_chars).alias("_text"),
    ).join(F.broadcast(listed), "_lang", "left_semi")
    # rows that share an id are sampled once
    texts: dict[str, list[str]] = {}
    for r in sorted(rows.dropDuplicates(["_id", "_lang"]).collect(), key=lambda r: (r["_lang"], r["_id"])):
        texts.setdefault(r["_lang"], []).append(r["_text"])
    lessons = ((lang, *lesson(found, running_chars, dictionary_bytes)) for lang, found in sorted(texts.items()))
    return tuple(x for x in lessons if x[1].strip())


def predicted(text: Column, lessons: tuple[Lesson, ...], spark, min_margin: float = 0.01) -> Column:
    """A struct of lang_pred, score and rejected for each text."""
    taught = spark.sparkContext.broadcast(lessons)  # at most total_bytes of dictionaries and the sample's running texts

    @F.pandas_udf(RESULT)
    def best(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in texts:
            found = [judge(t, taught.value, min_margin) for t in batch]
            yield pd.DataFrame(found, columns=["lang_pred", "score", "rejected"])

    return best(text)


def held_out(doc_id: Column, parts: int = 4, part: int = 2) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % parts == part, F.lit(False))


def identify(docs: DataFrame, min_margin: float = 0.01) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score, rejected."""
    out = held_out(F.col("doc_id"))
    lessons = learn(docs, ~out)
    judged = docs.select(
        F.col("doc_id"), out.alias("held_out"), predicted(F.col("text"), lessons, docs.sparkSession, min_margin).alias("_r")
    )
    return judged.select("doc_id", "held_out", "_r.lang_pred", "_r.score", "_r.rejected")


def in_a_language(docs: DataFrame, min_margin: float = 0.01) -> DataFrame:
    """The documents that are not rejected, with the columns they had."""
    lessons = learn(docs, F.lit(True))
    verdict = predicted(F.col("text"), lessons, docs.sparkSession, min_margin)
    return docs.where(~verdict["rejected"])
