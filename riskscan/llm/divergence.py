"""Source divergence audit: how the sources of a language differ in their use of its vocabulary.

1. Tasks gather how many documents of a language hold each term, and terms held by
   enough documents are kept.
2. The kept terms are sorted by ranges and numbered, which gives lexicographic ordinals per
   language, and cut into pieces of at most PIECE_BYTES of terms; a task builds the
   minimal acyclic transducer of each piece (see `transducer`).
3. The texts are streamed through the transducers, which gives (language, source,
   ordinal) counts, summed in the task before they are shuffled.  The transducers travel
   by broadcast, ROUND_EDGES edges at a time at most (or one piece): a vocabulary
   with more of them takes another pass over the texts for each further round.
4. From here on terms are ordinals only: shares, scores, and ties, which go to the
   smaller ordinal.  Only reported terms get their strings back.
5. Pairs of sources are compared over blocks of ordinals and tiles of sources, so that a
   task holds at most 2 * TILE * BLOCK counts; what a task sends on is one number a pair.

All arithmetic is exact: shares are divided digit by digit in base 1000, so counts up to
9 * 10^15 do not overflow.

Defined results: null text, lang and source are ''; every (lang, source) that occurs is a
group, also without terms; a language without kept terms gives pairs of value 0 and no
term rows; repeated rows count each; an empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskscan.llm.common import written
from riskscan.llm.transducer import Transducer, build

#: By byte: lower-cased if A-Z, itself if a letter or beyond ASCII, else a space.
TERM_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
SHARE = 1_000_000_000
#: Entries that a task gathers before it sends them on; bytes of text that it works on at a time.
GATHERED, BYTES_AT_ONCE = 1 << 18, 1 << 22
PIECE_BYTES, ROUND_EDGES = 1 << 21, 1 << 21
BLOCK, TILE = 4096, 64


def groups_of(docs: DataFrame) -> DataFrame:
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    return docs.select(blank("lang"), blank("source"), F.coalesce("text", F.lit("")).cast("binary").alias("text"))


def kept_terms(texts: DataFrame, least: int) -> DataFrame:
    """(lang, term) of the terms in at least so many documents of the language."""

    def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter] = {}
        size = 0

        def sent() -> pa.RecordBatch:
            langs = [lang for lang, terms in held.items() for _ in terms]
            terms = pa.array([t for terms in held.values() for t in terms], pa.binary()).cast(pa.string())
            docs = pa.array([n for terms in held.values() for n in terms.values()], pa.int64())
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), terms, docs], ["lang", "term", "docs"])

        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
                terms = held.setdefault(lang, Counter())
                before = len(terms)
                terms.update(set(text.as_py().translate(TERM_BYTES).split()))
                size += len(terms) - before
                if size >= GATHERED:
                    yield sent()
                    size = 0
        if size:
            yield sent()

    found = texts.select("lang", "text").mapInArrow(gathered, "lang string, term string, docs long")
    return found.groupBy("lang", "term").agg(F.sum("docs").alias("docs")).where(F.col("docs") >= least).select("lang", "term")


def numbered(terms: DataFrame) -> DataFrame:
    """The terms with their lexicographic ordinal and the number of their piece, by language; a written table."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, lang, nth, size = TaskContext.get().partitionId(), None, 0, 0
        for batch in batches:
            nths, sizes = [], []
            for here, term in zip(batch.column("lang").to_pylist(), batch.column("term")):
                if here != lang:
                    lang, nth, size = here, 0, 0
                nths.append(nth)
                sizes.append(size)
                nth += 1
                size += term.as_buffer().size
            out = batch.append_column("_part", pa.array([part] * batch.num_rows, pa.int32()))
            yield out.append_column("_nth", pa.array(nths, pa.int64())).append_column("_size", pa.array(sizes, pa.int64()))

    ranged = terms.repartitionByRange("lang", "term").sortWithinPartitions("lang", "term")
    rows = written(ranged.mapInArrow(counted, "lang string, term string, _part int, _nth long, _size long"), "terms")
    totals = rows.groupBy("lang", "_part").agg(
        F.count("*").alias("_n"), F.sum(F.octet_length("term").cast("long")).alias("_bytes")
    )
    before = Window.partitionBy("lang").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    based = totals.select("lang", "_part", *[
        F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}_before") for c in ("_n", "_bytes")
    ])
    return written(rows.join(based, ["lang", "_part"]).select(
        "lang", "term", (F.col("_n_before") + F.col("_nth")).alias("ordinal"),
        F.floor((F.col("_bytes_before") + F.col("_size")) / PIECE_BYTES).alias("piece"),
    ), "vocabulary")


def transducers(vocabulary: DataFrame) -> DataFrame:
    """One transducer a piece: lang, piece, first (ordinal), edges, and its arrays as bytes; a written table."""

    def made(keys: tuple, rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("ordinal")
        arrays = build(rows.column("term").cast(pa.binary()).to_pylist())
        return pa.table({
            "lang": pa.array([keys[0].as_py()], pa.string()), "piece": pa.array([keys[1].as_py()], pa.int64()),
            "first": pa.array([rows.column("ordinal")[0].as_py()], pa.int64()),
            "edges": pa.array([len(arrays["code"])], pa.int64()),
            **{name: pa.array([a.tobytes()], pa.binary()) for name, a in arrays.items()},
        })

    schema = "lang string, piece long, first long, edges long, code binary, target binary, output binary, final binary, start binary"
    return written(vocabulary.groupBy("lang", "piece").applyInArrow(made, schema), "transducers")


DTYPES = {"code": "i8", "target": "i4", "output": "i8", "final": "?", "start": "i8"}


def rounds_of(pieces: DataFrame) -> list[list[tuple[str, int]]]:
    """Which pieces are read together: ROUND_EDGES edges at most, or a single piece."""
    rounds, size = [], ROUND_EDGES
    for row in pieces.select("lang", "piece", "edges").orderBy("lang", "piece").toLocalIterator():
        if size + row["edges"] > ROUND_EDGES:
            rounds.append([])
            size = 0
        rounds[-1].append((row["lang"], row["piece"]))
        size += row["edges"]
    return rounds


def recounted(texts: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(lang, source, ordinal, count) of the kept terms that occur, counted by the transducers; a written table."""
    pieces = transducers(vocabulary)
    found = texts.sparkSession.createDataFrame([], "lang string, source string, ordinal long, count long")
    for these in rounds_of(pieces):
        low, high = these[0], these[-1]
        key = F.struct("lang", "piece")
        bound = lambda p: F.struct(F.lit(p[0]).alias("lang"), F.lit(p[1]).cast("long").alias("piece"))
        held: dict[str, list] = {}
        for row in pieces.where((key >= bound(low)) & (key <= bound(high))).orderBy("piece").collect():
            arrays = {name: np.frombuffer(row[name], dtype=t) for name, t in DTYPES.items()}
            held.setdefault(row["lang"], []).append((row["first"], arrays))
        found = found.unionByName(streamed(texts, texts.sparkSession.sparkContext.broadcast(held)))
    return written(found.groupBy("lang", "source", "ordinal").agg(F.sum("count").alias("count")), "term-counts")


def streamed(texts: DataFrame, sent) -> DataFrame:
    """The texts through the transducers that were sent: lang -> [(first ordinal, arrays)]."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        readers = {lang: [(first, Transducer(**a)) for first, a in held] for lang, held in sent.value.items()}
        names: dict[tuple[str, str], int] = {}
        codes, counts, size = [], [], 0

        def summed() -> None:
            nonlocal codes, counts, size
            each, at = np.unique(np.concatenate(codes), return_inverse=True)
            total = np.zeros(len(each), dtype=np.int64)
            np.add.at(total, at, np.concatenate(counts))
            codes, counts, size = [each], [total], len(each)

        def flushed() -> pa.RecordBatch:
            nonlocal codes, counts, size
            summed()
            pairs = list(names)
            owner = [pairs[i] for i in (codes[0] >> 40).tolist()]
            out = pa.RecordBatch.from_arrays([
                pa.array([p[0] for p in owner], pa.string()), pa.array([p[1] for p in owner], pa.string()),
                pa.array(codes[0] & (1 << 40) - 1), pa.array(counts[0]),
            ], ["lang", "source", "ordinal", "count"])
            codes, counts, size = [], [], 0
            return out

        def read(lang: str, rows: list[tuple[int, bytes]]) -> None:
            """Streams the texts (group, bytes) of one language."""
            nonlocal size
            text = b" ".join(t for _, t in rows).translate(TERM_BYTES)
            stops = np.cumsum([len(t) + 1 for _, t in rows])
            group = np.array([g for g, _ in rows], dtype=np.int64)
            data = np.frombuffer(text, dtype=np.uint8)
            inside = np.concatenate([[False], data != 32, [False]])
            edges = np.flatnonzero(inside[1:] != inside[:-1])
            starts, ends = edges[::2], edges[1::2]
            for first, reader in readers[lang]:
                ordinal = reader.ordinals(data, starts, ends)
                hit = np.flatnonzero(ordinal >= 0)
                owner = group[np.searchsorted(stops, starts[hit], side="right")]
                each, n = np.unique(owner << 40 | (first + ordinal[hit]), return_counts=True)
                codes.append(each)
                counts.append(n)
                size += len(each)

        waiting: dict[str, list[tuple[int, bytes]]] = {}
        held = 0
        for batch in batches:
            for lang, source, text in zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), batch.column("text")):
                if lang not in readers:
                    continue
                text = text.as_py()
                waiting.setdefault(lang, []).append((names.setdefault((lang, source), len(names)), text))
                held += len(text)
                if held >= BYTES_AT_ONCE:
                    for each, rows in waiting.items():
                        read(each, rows)
                    waiting, held = {}, 0
                    if size >= 4 * GATHERED:
                        summed()
                    if size >= 2 * GATHERED:
                        yield flushed()
        for each, rows in waiting.items():
            read(each, rows)
        if size:
            yield flushed()

    return texts.mapInArrow(counted, "lang string, source string, ordinal long, count long")


def share_sql(count: str, total: str) -> str:
    """SQL for 1 + floor(SHARE * (count + 1) / total), in three digits of base 1000; count < total."""
    digit, rest, parts = f"(({count}) + 1) div ({total})", f"(({count}) + 1) % ({total})", []
    parts.append(f"({digit}) * {SHARE}L")
    for scale in (1_000_000, 1_000, 1):
        parts.append(f"(({rest}) * 1000L div ({total})) * {scale}L")
        rest = f"({rest}) * 1000L % ({total})"
    return "1L + " + " + ".join(parts)


def shares(counts: np.ndarray, total: int) -> np.ndarray:
    """The same for an array."""
    out, rest = (counts + 1) // total * SHARE, (counts + 1) % total
    for scale in (1_000_000, 1_000, 1):
        out += rest * 1000 // total * scale
        rest = rest * 1000 % total
    return out + 1


def term_rows(counts: DataFrame, totals: DataFrame, vocabulary: DataFrame, top: int) -> DataFrame:
    """The terms that a source uses more than its language, by score."""
    whole = Window.partitionBy("lang", "ordinal")
    rows = counts.withColumn("_all", F.sum("count").over(whole)).join(totals, ["lang", "source"])
    scored = rows.withColumn("_p", F.expr(share_sql("count", "_total"))).withColumn("_q", F.expr(share_sql("_all", "_lang_total")))
    scored = scored.where("_p > _q").withColumn("value", F.expr("(_p - _q) * (_p - _q) div _q"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "ordinal")
    best = scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return best.join(vocabulary.select("lang", "ordinal", F.col("term").alias("item")), ["lang", "ordinal"]).select(
        "lang", "source", F.lit("term").alias("part"), "item", "value", "rank"
    )


def pair_rows(counts: DataFrame, totals: DataFrame) -> DataFrame:
    """All ordered pairs of sources of a language, by the sum of their scores over all kept terms."""
    by_source = Window.partitionBy("lang").orderBy("source")
    placed = totals.withColumn("_at", F.row_number().over(by_source) - 1).withColumn(
        "_tiles", F.floor((F.count("*").over(Window.partitionBy("lang")) - 1) / TILE)  # the last tile's number
    ).withColumn("_tile", F.floor(F.col("_at") / TILE))
    spread = F.array_distinct(F.flatten(F.transform(
        F.sequence(F.lit(0).cast("long"), F.col("_tiles")),
        lambda t: F.array(F.struct(F.col("_tile").alias("i"), t.alias("j")), F.struct(t.alias("i"), F.col("_tile").alias("j"))),
    )))
    last_block = F.greatest(F.lit(0).cast("long"), F.floor((F.col("_kept") - 1) / BLOCK))
    heads = placed.select(
        "lang", F.explode(F.sequence(F.lit(0).cast("long"), last_block)).alias("_block"), "_at", "source",
        F.lit(None).cast("long").alias("_within"), F.col("_total").alias("_count"), "_kept", spread.alias("_units"),
    )
    cells = counts.join(placed.select("lang", "source", "_at", "_tile", "_tiles", "_kept"), ["lang", "source"]).select(
        "lang", F.floor(F.col("ordinal") / BLOCK).alias("_block"), "_at", F.lit(None).cast("string").alias("source"),
        (F.col("ordinal") % BLOCK).alias("_within"), F.col("count").alias("_count"), "_kept", spread.alias("_units"),
    )
    units = heads.unionByName(cells).select("*", F.explode("_units").alias("_unit")).select(
        "lang", "_block", F.col("_unit.i").alias("_i"), F.col("_unit.j").alias("_j"), "_at", "source", "_within", "_count", "_kept"
    )

    def compared(keys: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        lang, block, i, j = keys
        width = int(max(0, min(BLOCK, rows["_kept"].iloc[0] - block * BLOCK)))
        head = rows[rows["_within"].isna()]
        cell = rows[rows["_within"].notna()]
        held = {at: np.zeros(width, dtype=np.int64) for at in head["_at"]}
        for at, part in cell.groupby("_at"):
            held[at][part["_within"].to_numpy().astype(np.int64)] = part["_count"].to_numpy()
        share = {at: shares(held[at], int(total)) if width else held[at] for at, total in zip(head["_at"], head["_count"])}
        named = dict(zip(head["_at"], head["source"]))
        out = []
        for a in (at for at in named if at // TILE == i):
            for b in (at for at in named if at // TILE == j and at != a):
                apart = share[a] - share[b]
                out.append((lang, named[a], named[b], int((apart * apart // share[b]).sum())))
        return pd.DataFrame(out, columns=["lang", "source", "item", "value"])

    parts = units.groupBy("lang", "_block", "_i", "_j").applyInPandas(compared, "lang string, source string, item string, value long")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return parts.groupBy("lang", "source", "item").agg(F.sum("value").alias("value")).select(
        "lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(order).alias("rank")
    )


def audit(docs: DataFrame, least: int = 3, top: int = 200) -> DataFrame:
    """lang, source, part ('pair' or 'term'), item, value and rank."""
    texts = groups_of(docs)
    vocabulary = numbered(kept_terms(texts, least))
    counts = recounted(texts, vocabulary)
    groups = texts.select("lang", "source").distinct()
    kept = vocabulary.groupBy("lang").agg(F.count("*").alias("_kept"))
    total = counts.groupBy("lang", "source").agg(F.sum("count").alias("_n"))
    whole = F.sum(F.coalesce("_n", F.lit(0))).over(Window.partitionBy("lang"))
    sized = groups.join(total, ["lang", "source"], "left").join(kept, "lang", "left").withColumn("_kept", F.coalesce("_kept", F.lit(0)))
    totals = written(sized.select(
        "lang", "source", "_kept", (F.coalesce("_n", F.lit(0)) + F.col("_kept")).alias("_total"),
        (whole + F.col("_kept")).alias("_lang_total"),
    ), "source-totals")
    return term_rows(counts, totals, vocabulary, top).unionByName(pair_rows(counts, totals))
