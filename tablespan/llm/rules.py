"""Quality rules as a learned decision list, in DataFrame functions throughout.

Statistics of whole texts are computed once for each document. From those of labelled documents,
sequential covering learns an ordered list of rules, each a conjunction of thresholds that marks bad
documents: a rule grows by the condition with the largest gain in precision, weighted by what it
covers, and is then pruned on documents it has not seen. What a rule covers is taken out before the next one
grows. The list becomes one conditional expression, so applying it is a projection.

Every step of growing is one aggregate over (feature, bin), so the driver gets a fixed number of
counts whatever the number of documents. Labels may be sampled down to a documented number of rows;
statistics and the rules' application cover all documents.

A NULL text has no words, and with fewer words than the base rule wants it fails. Equal rows are documents of
their own. Labels of a document that has several are averaged; NULL labels are left out. Without labels no
rule is learned. Other columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablespan.llm.registry import query, read
from tablespan.sources.shared import kept

#: Fixed values of the base rules.
BLANK = r"[\x20\x09-\x0D]"
BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
LEAST_WORDS = 50
REPEATED_PERCENT = 50
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
DIGITS = "0123456789"

TRAIN_ROWS = 50_000  # labelled documents that rules are learned from, by the smallest hash of the id
BINS = 40
MOST_RULES = 12
MOST_CONDITIONS = 3
LEAST_PRECISION = 0.9  # of a rule, on documents that it was not grown on
LEAST_COVERED = 3  # bad documents among those

FEATURES = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "mean_word", "symbol_share", "dup_line_share",
    "repeat_share", "upper_share", "digit_share", "distinct_share", "exclaim_share", "line_words",
)


def _signs(text: Column, signs: str) -> Column:
    """How many characters of a text are among the signs."""
    return (F.length(text) - F.length(F.translate(text, signs, ""))).cast("long")


def _repeated(hashes: Column) -> Column:
    """The number of words in three-word windows whose hash occurs more than once.

    Windows are sorted by hash; those equal to a neighbour are put back in order of place, and each
    adds the words up to the next one, three at most.
    """
    windows = F.sort_array(
        F.transform(F.sequence(F.lit(0), F.size(hashes) - 3), lambda i: F.struct(F.xxhash64(hashes[i], hashes[i + 1], hashes[i + 2]).alias("h"), i.alias("i")))
    )
    return F.when(F.size(hashes) >= 3, windows)


def _places(windows: Column) -> Column:
    n = F.size(windows)
    same = F.filter(
        F.sequence(F.lit(0), n - 1),
        lambda j: ((j > 0) & (windows[F.greatest(j - 1, F.lit(0))]["h"] == windows[j]["h"]))
        | ((j < n - 1) & (windows[F.least(j + 1, n - 1)]["h"] == windows[j]["h"])),
    )
    return F.sort_array(F.transform(same, lambda j: windows[j]["i"]))


def _covered(places: Column) -> Column:
    """Words covered by windows of three at sorted places."""
    return F.aggregate(
        places,
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end")),
        lambda s, p: F.struct((s["n"] + p + 3 - F.greatest(p, s["end"])).cast("long").alias("n"), (p + 3).alias("end")),
        lambda s: s["n"],
    )


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id and all features of each document."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    rows = rows.select(
        "doc_id",
        F.filter(F.split("text", BLANK + "+"), lambda w: w != "").alias("words"),
        F.filter(F.split("text", "\n"), lambda line: F.trim(F.translate(line, BLANKS, " ")) != "").alias("lines"),
        F.length(F.translate("text", BLANKS, "")).cast("long").alias("word_chars"),
        _signs(F.col("text"), SYMBOLS).alias("n_symbols"),
        _signs(F.col("text"), UPPER).alias("upper"),
        _signs(F.col("text"), DIGITS).alias("digits"),
        _signs(F.col("text"), "!").alias("exclaims"),
    )
    rows = rows.select(
        "doc_id", "word_chars", "n_symbols", "upper", "digits", "exclaims",
        F.size("words").cast("long").alias("n_words"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"),
    )
    kept_columns = ["doc_id", "word_chars", "n_symbols", "upper", "digits", "exclaims", "n_words", "n_lines", "n_dup_lines"]
    rows = rows.select(*kept_columns, F.size(F.array_distinct("hashes")).alias("distinct"), _repeated(F.col("hashes")).alias("windows"))
    rows = rows.select(*kept_columns, "distinct", _places(F.col("windows")).alias("places"))
    rows = rows.withColumn("n_repeat_words", F.coalesce(_covered(F.col("places")), F.lit(0).cast("long"))).drop("places")
    share = lambda part, whole: F.coalesce(F.col(part) / F.greatest(F.col(whole), F.lit(1)), F.lit(0.0))
    return rows.select(
        "doc_id",
        *FEATURES[:5],
        share("word_chars", "n_words").alias("mean_word"),
        share("n_symbols", "n_words").alias("symbol_share"),
        share("n_dup_lines", "n_lines").alias("dup_line_share"),
        share("n_repeat_words", "n_words").alias("repeat_share"),
        share("upper", "word_chars").alias("upper_share"),
        share("digits", "word_chars").alias("digit_share"),
        share("distinct", "n_words").alias("distinct_share"),
        share("exclaims", "n_words").alias("exclaim_share"),
        share("n_words", "n_lines").alias("line_words"),
    )


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool  # feature > threshold, else feature <= threshold
    threshold: float

    def column(self) -> Column:
        value = F.col(self.feature).cast("double")
        return value > self.threshold if self.above else value <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:g}"


Rule = tuple[Condition, ...]


def holds(rule: Rule) -> Column:
    out = F.lit(True)
    for condition in rule:
        out = out & condition.column()
    return out


def verdict(rules: list[Rule]) -> Column:
    """True for documents to keep: the first rule that holds decides, and every rule drops."""
    if not rules:
        return F.lit(True)
    out = F.when(holds(rules[0]), False)
    for rule in rules[1:]:
        out = out.when(holds(rule), False)
    return out.otherwise(True)


def _gain(bad: int, good: int, bad_before: int, good_before: int) -> float:
    """FOIL's gain of a condition: bits saved on each bad document that stays covered."""
    if not bad:
        return 0.0
    return bad * (math.log2(bad / (bad + good)) - math.log2(bad_before / (bad_before + good_before)))


def _grown(rows: DataFrame, thresholds: dict[str, list[float]]) -> Rule:
    """A conjunction over the rows (features' bins and `bad`), grown condition by condition."""
    rule: list[Condition] = []
    for _ in range(MOST_CONDITIONS):
        cells = rows.filter(holds(tuple(rule))).select(
            "bad", F.explode(F.array(*(F.struct(F.lit(f).alias("feature"), F.col(f"bin_{f}").alias("bin")) for f in thresholds))).alias("c")
        )
        counts = cells.groupBy("c.feature", "c.bin").agg(F.sum("bad").alias("bad"), F.sum(1 - F.col("bad")).alias("good")).collect()
        by_feature: dict[str, dict[int, tuple[int, int]]] = {}
        for r in counts:
            by_feature.setdefault(r.feature, {})[r.bin] = (r.bad, r.good)
        best, choice, precision = 0.0, None, 0.0
        for feature, cuts in sorted(thresholds.items()):
            have = by_feature.get(feature, {})
            all_bad, all_good = (sum(x[i] for x in have.values()) for i in (0, 1))
            if not all_bad or not all_good:
                continue
            bad = good = 0
            for k, cut in enumerate(cuts):  # bin k: values up to cut k
                b, g = have.get(k, (0, 0))
                bad, good = bad + b, good + g
                for above, x, y in ((False, bad, good), (True, all_bad - bad, all_good - good)):
                    if (gain := _gain(x, y, all_bad, all_good)) > best + 1e-9:
                        best, choice, precision = gain, Condition(feature, above, cut), x / (x + y)
        if choice is None:
            break
        rule.append(choice)
        if precision >= 0.995:
            break
    return tuple(rule)


def _pruned(rule: Rule, rows: DataFrame) -> tuple[Rule, int, int]:
    """The shortest prefix of a rule that is as precise on the rows as any, with what it covers there."""
    cuts = range(1, len(rule) + 1)
    counts = rows.agg(
        *(F.sum(F.when(holds(rule[:k]), F.col("bad")).otherwise(0)).alias(f"bad{k}") for k in cuts),
        *(F.sum(F.when(holds(rule[:k]), 1 - F.col("bad")).otherwise(0)).alias(f"good{k}") for k in cuts),
    ).first()
    best = max(cuts, key=lambda k: ((counts[f"bad{k}"] or 0) / ((counts[f"bad{k}"] or 0) + (counts[f"good{k}"] or 0) + 1), -k))
    return rule[:best], counts[f"bad{best}"] or 0, counts[f"good{best}"] or 0


def training_rows(features: DataFrame, labels: DataFrame, most: int = TRAIN_ROWS) -> DataFrame:
    """Features with `bad` (0 or 1) of at most `most` labelled documents, those with the smallest hashes."""
    marks = labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    marks = marks.agg((F.avg("quality") < 0.5).cast("long").alias("bad"))
    return features.join(marks, "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)


def _bin(value: Column, cuts: list[float]) -> Column:
    """How many of the cuts are below the value."""
    return F.size(F.filter(F.array(*map(F.lit, cuts)), lambda cut: cut < value))


def learn(spark: SparkSession, rows: DataFrame, most_rules: int = MOST_RULES) -> list[Rule]:
    """An ordered list of rules from training rows; two thirds grow rules, the others prune them."""
    rows = kept(spark, rows)
    values = [F.col(f).cast("double").alias(f) for f in FEATURES]
    at = [i / BINS for i in range(1, BINS)]
    cuts = rows.select(*values).agg(*(F.percentile_approx(f, at, 10_000).alias(f) for f in FEATURES)).first()
    thresholds = {f: sorted(set(cuts[f] or [])) for f in FEATURES}
    thresholds = {f: cut for f, cut in thresholds.items() if cut}
    bins = [_bin(F.col(f).cast("double"), cut).alias(f"bin_{f}") for f, cut in thresholds.items()]
    rows = kept(spark, rows.select("*", *bins, (F.pmod(F.xxhash64("doc_id", F.lit("prune")), F.lit(3)) == 0).alias("prune")))
    rules: list[Rule] = []
    while thresholds and len(rules) < most_rules:
        left = rows.filter(verdict(rules))
        rule = _grown(left.filter(~F.col("prune")), thresholds)
        if not rule:
            break
        rule, bad, good = _pruned(rule, left.filter("prune"))
        if bad < LEAST_COVERED or bad < LEAST_PRECISION * (bad + good):
            break
        rules.append(rule)
    return rules


@query()
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = kept(spark, statistics(read(spark, sf_dir, "documents")))
    rules = learn(spark, training_rows(features, read(spark, sf_dir, "labels")))
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEATED_PERCENT * F.col("n_words"))
    return features.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"),
        (~failed & verdict(rules)).alias("kept"),
    )
