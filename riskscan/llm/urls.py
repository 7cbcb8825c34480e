"""URL filter by a path-template tree learned per host.

Fixed rules come first: the longest rule whose host and path prefix fit decides.
The other urls are judged by the templates of their host.  Variable segments
(those with digits) become wildcards by shape, and so do segments that are
rare among their siblings and whose labels do not differ significantly from theirs.  The tree is as deep
as the deepest labelled path of a host that has labels of both kinds; below that no label
tells anything apart, and what is left of a path is one wildcard.
Level by level, sibling branches whose share of blocked urls does not differ
significantly from that of the other siblings are merged into one.  Every branch has a
purity, the share of its labelled urls that are blocked, smoothed towards that of
the branch above it (and the host's towards the whole table's); a template is
rejected when its purity reaches ``reject``.  Labels are what the rules say of the
urls that they fit, or a label column.

Everything is counted by (host, path shape) first, so a host with a third of all
urls costs one row per task and shape.  Wildcards hold a slash inside, which no segment does.

Defined results: a url that is null or has no ``://`` has empty host and path, fits
no rule and is judged as the host ''; nulls in labels are unlabelled; without labels
everything else is allowed; repeated rows count as often and are judged alike; an
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskscan.llm.common import checkpointed, written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WILD, DEEP, MERGED, NOTHING = "/*", "/**", "/~", ""


def host_of(url: Column) -> Column:
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(found, UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def fits(rule: str, host: Column, path: Column) -> Column:
    name, slash, rest = rule.partition("/")
    return ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)


def rule_of(rules: Sequence[tuple[str, str]], host: Column, path: Column) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, nulls if none does; the first of equally long ones."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for decision, text in sorted(rules, key=lambda r: len(r[1])):
        fit = fits(text, host, path)
        rule, verdict = F.when(fit, text).otherwise(rule), F.when(fit, decision).otherwise(verdict)
    return rule, verdict


def segments_of(path: Column) -> Column:
    """The path's segments, those with digits as wildcards that keep their ending, as in ``*.html``."""
    return F.transform(
        F.filter(F.split(path, "/"), lambda s: s != ""),
        lambda s: F.when(s.rlike(r"\d"), F.concat(F.lit(WILD), F.regexp_extract(s, r"(\.[a-z]{1,5})$", 1))).otherwise(s),
    )


def shape(segments: Column, levels: int) -> Column:
    """Exactly ``levels`` + 1 segments: missing levels are empty, the last one stands for all below."""
    short = F.transform(F.sequence(F.lit(1), F.lit(levels)), lambda i: F.coalesce(F.get(segments, i - 1), F.lit(NOTHING)))
    rest = F.when(F.size(segments) > levels, F.lit(DEEP)).otherwise(F.lit(NOTHING))
    return F.concat(short, F.array(rest))


def levels_of(counts: DataFrame) -> int:
    """How deep labels reach (1 at least), in hosts that have good and bad ones; from (host, segments, good, bad)."""
    labelled = counts.where("good + bad > 0").groupBy("host").agg(
        F.max(F.size("segments")).alias("_deep"), F.sum("good").alias("_g"), F.sum("bad").alias("_b")
    )
    return max(1, labelled.where("_g > 0 AND _b > 0").agg(F.max("_deep")).first()[0] or 1)


def differs(good: Column, bad: Column, all_good: Column, all_bad: Column, z: float) -> Column:
    """Is a branch's share of bad labels significantly unlike that of its siblings?  One
    without labels, or with all of them, has nothing to differ from."""
    n, rest = good + bad, all_good + all_bad - good - bad
    pooled = all_bad / (all_good + all_bad)
    spread = F.sqrt(pooled * (1 - pooled) * (1 / n + 1 / rest))
    return F.when((n > 0) & (rest > 0), F.abs(bad / n - (all_bad - bad) / rest) > z * spread).otherwise(False)


def templates(shapes: DataFrame, levels: int, min_share: float, z: float) -> DataFrame:
    """Adds ``template`` to rows of (host, shape, n, good, bad): segments that are rare and like their siblings are wildcards."""
    rows = shapes.withColumn("template", F.array().cast("array<string>"))
    for level in range(levels):
        child = F.get("shape", F.lit(level))
        sums = lambda *names: [F.sum(c).alias(name) for c, name in zip(("n", "good", "bad"), names)]
        counted = rows.groupBy("host", "template", child.alias("_child")).agg(*sums("_n", "_g", "_b"))
        total = counted.groupBy(F.col("host").alias("_h"), F.col("template").alias("_t")).agg(
            F.sum("_n").alias("_all"), F.sum("_g").alias("_ag"), F.sum("_b").alias("_ab")
        )
        own = (
            (F.col("_n") >= min_share * F.col("_all")) | F.col("_child").startswith(WILD) | (F.col("_child") == NOTHING)
            | differs(F.col("_g"), F.col("_b"), F.col("_ag"), F.col("_ab"), z)
        )
        common = (
            counted.join(total, (F.col("host") == F.col("_h")) & (F.col("template") == F.col("_t")))
            .where(own).select("_h", "_t", "_child")
        )
        rows = (
            rows.withColumn("_seg", child)
            .join(
                common,
                (F.col("host") == F.col("_h")) & (F.col("template") == F.col("_t")) & (F.col("_seg") == F.col("_child")),
                "left",
            )
            .withColumn("template", F.concat("template", F.array(F.coalesce("_child", F.lit(WILD)))))
            .drop("_h", "_t", "_child", "_seg")
        )
        rows = checkpointed(rows)  # each level reads the one above it several times
    return rows.withColumn("template", F.concat("template", F.slice("shape", levels + 1, 1)))


def purities(counted: DataFrame, levels: int, smoothing: float, z: float) -> DataFrame:
    """(host, template, branch, purity) from rows of (host, template, good, bad)."""
    base = counted.groupBy("host", "template").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"))
    whole = base.agg(F.sum("bad").alias("bad"), F.sum(F.col("good") + F.col("bad")).alias("n")).first()
    prior = (whole["bad"] or 0) / whole["n"] if whole["n"] else 0.0
    hosts = base.groupBy(F.col("host").alias("_h")).agg(F.sum("good").alias("_g"), F.sum("bad").alias("_b"))
    rows = (
        base.join(hosts, F.col("host") == F.col("_h"))
        .withColumn("purity", (F.col("_b") + smoothing * prior) / (F.col("_g") + F.col("_b") + smoothing))
        .withColumn("branch", F.array().cast("array<string>")).drop("_h", "_g", "_b")
    )
    for level in range(levels + 1):
        seg = F.get("template", F.lit(level))
        child = rows.groupBy("host", "branch", seg.alias("_seg")).agg(F.sum("good").alias("_g"), F.sum("bad").alias("_b"))
        above = child.groupBy(F.col("host").alias("_h"), F.col("branch").alias("_t")).agg(
            F.sum("_g").alias("_ag"), F.sum("_b").alias("_ab")
        )
        own = differs(F.col("_g"), F.col("_b"), F.col("_ag"), F.col("_ab"), z)
        named = child.join(above, (F.col("host") == F.col("_h")) & (F.col("branch") == F.col("_t"))).select(
            "_h", "_t", "_seg", "_g", "_b", (F.col("_ag") + F.col("_ab")).alias("_above"), F.when(own, F.col("_seg")).otherwise(F.lit(MERGED)).alias("_name")
        )
        named = checkpointed(named)
        stats = named.groupBy(F.col("_h").alias("_h2"), F.col("_t").alias("_t2"), F.col("_name").alias("_name2")).agg(
            F.sum("_g").alias("_sg"), F.sum("_b").alias("_sb")
        )
        joined = named.select("_h", "_t", F.col("_seg").alias("_s"), "_name", "_above").join(
            stats, (F.col("_h") == F.col("_h2")) & (F.col("_t") == F.col("_t2")) & (F.col("_name") == F.col("_name2"))
        ).select("_h", "_t", "_s", "_name", "_above", "_sg", "_sb")
        found = F.col("_sg") + F.col("_sb")
        # a branch that holds all labels of the one above it has the same purity: they count once
        purity = F.when(found == F.col("_above"), F.col("purity")).otherwise(
            (F.col("_sb") + smoothing * F.col("purity")) / (found + smoothing)
        )
        rows = (
            rows.withColumn("_seg", seg)
            .join(joined, (F.col("host") == F.col("_h")) & (F.col("branch") == F.col("_t")) & (F.col("_seg") == F.col("_s")))
            .withColumn("purity", purity)
            .withColumn("branch", F.concat("branch", F.array("_name")))
            .drop("_h", "_t", "_s", "_seg", "_name", "_above", "_sg", "_sb")
        )
        rows = checkpointed(rows)
    return rows.select("host", "template", "branch", "purity")


def judge(
    pages: DataFrame, rules: Sequence[tuple[str, str]], label: Column | None = None,
    min_share: float = 0.02, smoothing: float = 4.0, z: float = 1.96, reject: float = 0.8,
) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, template, branch, purity.

    ``label`` (true: blocked) adds to what the rules say where it is not null.
    """
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    rule, decided = rule_of(rules, host, path)
    blocked = F.coalesce(decided == "block", label if label is not None else F.lit(None).cast("boolean"))
    read = pages.select(
        F.col("page_id"), host.alias("host"), path.alias("path"), rule.alias("rule"), decided.alias("_decided"),
        segments_of(path).alias("segments"), blocked.alias("_blocked"),
    )
    counts = written(read.groupBy("host", "segments").agg(
        F.count("*").alias("n"), F.count_if(F.col("_blocked")).alias("bad"), F.count_if(~F.col("_blocked")).alias("good")
    ), "url-paths")
    levels = levels_of(counts)
    shapes = counts.groupBy("host", shape(F.col("segments"), levels).alias("shape")).agg(
        *[F.sum(c).alias(c) for c in ("n", "bad", "good")]
    )
    known = written(templates(shapes, levels, min_share, z), "url-templates")
    judged = written(purities(known, levels, smoothing, z), "url-purities")
    by_shape = known.join(judged, ["host", "template"]).select(
        F.col("host").alias("_h"), F.col("shape").alias("_s"), "template", "branch", "purity"
    )
    verdict = F.coalesce("_decided", F.when(F.col("purity") >= reject, "block").otherwise("allow"))
    shown = lambda name: F.array_join(F.transform(name, lambda s: F.regexp_replace(s, "^/", "")), "/").alias(name)
    return read.join(by_shape, (F.col("host") == F.col("_h")) & (shape(F.col("segments"), levels) == F.col("_s"))).select(
        "page_id", "host", "path", "rule", verdict.alias("verdict"), shown("template"), shown("branch"), "purity",
    )
