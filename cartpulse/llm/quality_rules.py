r"""Quality filter: a learned decision list over text statistics.

The statistics are Spark expressions. Sequential covering learns an ordered
list of threshold conjunctions that mark bad documents: a rule is grown on the
growing part of the labelled rows by the condition of largest information gain,
its last conditions are pruned on the pruning part, an accepted rule's rows are
taken out, and the next rule is grown. Each step is one aggregation of the
labelled rows to counts by (statistic, bin, label); only those counts reach the
driver. The list is emitted as one ordered CASE expression.

Defined results: null or empty text has zero statistics and fails the base
rules (fewer than ten words); without usable labels the list is empty and only
the base rules decide; labels that are null or contradict each other for one
document are not used; extra columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartpulse.llm.common import NOT_SPACE, crc32_unsigned, saved, words

WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20

# Statistics the rules may test.
FEATURES = ["symbols_per_word", "bangs_per_word", "capitals_share", "digits_share",
            "chars_per_word", "words_per_line", "dup_line_share", "repeat_share",
            "distinct_share", "n_words"]


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id, the base statistics and the rule statistics of every text."""
    def ratio(a: str, b: str) -> Column:
        return F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(0.0)

    def count_of(chars: str) -> Column:
        return F.length(F.regexp_replace("text", f"[^{chars}]+", "")).cast("long")

    base = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    base = (base.withColumn("w", words(F.col("text")))
            .withColumn("lines", F.filter(F.split("text", "\n"), lambda x: x.rlike(NOT_SPACE)))
            .withColumn("wh", F.transform("w", lambda w: F.xxhash64(w)))
            .withColumn("n_words", F.size("w").cast("long")))
    base = base.select(
        "doc_id", "n_words", "wh",
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        count_of("#*$%&|<>").alias("n_symbols"),
        count_of("!").alias("bangs"), count_of("A-Z").alias("capitals"),
        count_of("0-9").alias("digits"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size(F.array_distinct("wh")).alias("distinct_words"))
    base = repeat_words(base, "wh")
    return base.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        ratio("n_symbols", "n_words").alias("symbols_per_word"),
        ratio("bangs", "n_words").alias("bangs_per_word"),
        ratio("capitals", "word_chars").alias("capitals_share"),
        ratio("digits", "word_chars").alias("digits_share"),
        ratio("word_chars", "n_words").alias("chars_per_word"),
        ratio("n_words", "n_lines").alias("words_per_line"),
        ratio("n_dup_lines", "n_lines").alias("dup_line_share"),
        ratio("n_repeat_words", "n_words").alias("repeat_share"),
        ratio("distinct_words", "n_words").alias("distinct_share"))


def repeat_words(df: DataFrame, hashes: str) -> DataFrame:
    """Add ``n_repeat_words``: words inside windows of five that occur twice or
    more in the text. Texts without a repeated window skip the sort."""
    def window_hash(i: Column) -> Column:
        return F.xxhash64(*[F.get(F.col(hashes), i + j) for j in range(WINDOW)])

    df = df.withColumn("_win", F.when(
        F.size(hashes) > WINDOW,
        F.transform(F.sequence(F.lit(0), F.size(hashes) - WINDOW), window_hash)))
    df = df.withColumn("_sorted", F.when(
        F.size(F.array_distinct("_win")) < F.size("_win"),
        F.array_sort(F.transform("_win", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))

    def repeated(s: Column, j: Column) -> Column:
        # position -1 and the one past the end give null
        return (F.coalesce(s["h"] == F.get(F.col("_sorted"), j - 1)["h"], F.lit(False))
                | F.coalesce(s["h"] == F.get(F.col("_sorted"), j + 1)["h"], F.lit(False)))

    starts = F.array_sort(F.transform(F.filter("_sorted", repeated), lambda s: s["i"]))
    covered = F.aggregate(
        starts, F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda acc, p: F.struct((acc["n"] + p + WINDOW - F.greatest(acc["end"], p)).alias("n"),
                                (p + WINDOW).alias("end")),
        lambda acc: acc["n"])
    return (df.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long"))
            .drop("_win", "_sorted"))


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def column(self) -> Column:
        c = F.col(self.feature)
        return c > self.threshold if self.above else c <= self.threshold


Rule = list[Condition]


def holds(rule: Rule) -> Column:
    cond = F.lit(True)
    for c in rule:
        cond = cond & c.column()
    return cond


def verdict(rules: list[Rule]) -> Column:
    """The decision list as an ordered conditional: true keeps the document."""
    if not rules:
        return F.lit(True)
    case = F
    for rule in rules:
        case = case.when(holds(rule), F.lit(False))
    return case.otherwise(F.lit(True))


def learn(spark: SparkSession, labelled: DataFrame, n_bins: int = 24, max_rules: int = 8,
          max_conditions: int = 3, min_precision: float = 0.9, min_rows: int = 5) -> list[Rule]:
    """Learn the list from rows of FEATURES plus ``bad`` (1 bad, 0 good).

    ``labelled`` also has ``grow`` (boolean): whether a row grows rules or
    prunes them. All labelled rows are used. A rule is accepted if, on the
    pruning rows, its precision (with one added error) reaches
    ``min_precision`` and it marks ``min_rows`` bad rows or more in all.
    """
    probs = [i / n_bins for i in range(1, n_bins)]
    cuts = labelled.select(*[F.percentile_approx(f, probs, 1000).alias(f) for f in FEATURES]).first()
    cuts = {f: sorted(set(cuts[f] or [])) for f in FEATURES}
    binned = F.array(*[
        F.struct(F.lit(f).alias("feature"),
                 sum((F.when(F.col(f) > t, 1).otherwise(0) for t in cuts[f]), F.lit(0)).alias("bin"))
        for f in FEATURES])
    rows = saved(spark, labelled.withColumn("_bins", binned), "quality-labelled")
    bad, good = F.sum("bad").alias("bad"), F.sum(1 - F.col("bad")).alias("good")

    rules: list[Rule] = []
    left = F.lit(True)
    while len(rules) < max_rules:
        rule: Rule = []
        for _ in range(max_conditions):
            counts = (rows.where(left & F.col("grow") & holds(rule))
                      .select(F.explode("_bins").alias("b"), "bad")
                      .groupBy("b.feature", "b.bin").agg(bad, good).collect())
            best = best_condition(counts, cuts)
            if best is None:
                break
            rule.append(best)
        if not rule:
            break
        rule = prune(rows.where(left), rule)
        found = rows.where(left & holds(rule)).agg(
            F.sum(F.when(~F.col("grow"), F.col("bad"))).alias("p"),
            F.sum(F.when(~F.col("grow"), 1 - F.col("bad"))).alias("n"),
            F.sum("bad").alias("all")).first()
        p, n = found["p"] or 0, found["n"] or 0
        if p < (p + n + 1) * min_precision or (found["all"] or 0) < min_rows:
            break
        rules.append(rule)
        left = left & ~holds(rule)
    return rules


def best_condition(counts: list, cuts: dict[str, list[float]]) -> Condition | None:
    """The condition of largest information gain, from counts by bin."""
    per: dict[str, list[list[int]]] = {f: [[0, 0] for _ in range(len(t) + 1)]
                                       for f, t in cuts.items()}
    for r in counts:
        per[r["feature"]][r["bin"]] = [r["bad"], r["good"]]
    best, best_gain = None, 1e-9
    for f, bins in per.items():
        p0, n0 = sum(b[0] for b in bins), sum(b[1] for b in bins)
        if not p0 or not n0:
            continue
        info = math.log2(p0 / (p0 + n0))
        p_low = n_low = 0
        for t, (p, n) in zip(cuts[f], bins):
            p_low, n_low = p_low + p, n_low + n
            for above, pp, nn in ((False, p_low, n_low), (True, p0 - p_low, n0 - n_low)):
                gain = pp * (math.log2(pp / (pp + nn)) - info) if pp else 0.0
                if gain > best_gain:
                    best, best_gain = Condition(f, above, float(t)), gain
    return best


def prune(rows: DataFrame, rule: Rule) -> Rule:
    """The prefix of the rule with the best (bad - good) / covered on pruning rows."""
    heads = range(1, len(rule) + 1)
    found = rows.where(~F.col("grow")).agg(*[
        a for k in heads for a in (
            F.sum(F.when(holds(rule[:k]), F.col("bad"))).alias(f"p{k}"),
            F.sum(F.when(holds(rule[:k]), 1 - F.col("bad"))).alias(f"n{k}"))]).first()

    def worth(k: int) -> float:
        p, n = found[f"p{k}"] or 0, found[f"n{k}"] or 0
        return (p - n) / (p + n) if p + n else -1.0

    return rule[:max(heads, key=lambda k: (worth(k), -k))]


def base_failed() -> Column:
    return ((F.col("n_words") < MIN_WORDS)
            | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))


def filter_documents(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Statistics, ``base_failed`` and ``kept`` of every document; the list is
    learned from ``labels.quality`` (1 good, 0 bad)."""
    stats = saved(spark, statistics(docs), "quality-stats").withColumn("base_failed", base_failed())
    marks = (labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
             .groupBy("doc_id").agg(F.min("quality").alias("_low"), F.max("quality").alias("_high"))
             .where("_low = _high").select("doc_id", (1 - F.col("_high")).alias("bad")))
    labelled = (stats.where(~F.col("base_failed")).join(marks, "doc_id")
                .select(*FEATURES, "bad",
                        (F.pmod(crc32_unsigned(F.concat(F.lit("grow/"), F.col("doc_id").cast("string"))),
                                F.lit(3)) > 0).alias("grow")))
    rules = learn(spark, labelled)
    return stats.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                        "n_repeat_words", "base_failed",
                        (~F.col("base_failed") & verdict(rules)).alias("kept"))
