"""Quality rules: text statistics, and a decision list learned from labelled statistics.

Everything is DataFrame expressions. Sequential covering grows a conjunction of thresholds on
two thirds of the labelled rows, one aggregation per condition over *all* of them (counts per
statistic and bin; the driver sees that bounded table only), and prunes it on the last third.
Rows that a rule covers leave; the rules found become one ordered conditional expression.
Every rule is grown on thirds of its own, so what the last third of one lacks the next one sees.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cadentia.session import materialise

GAP = r"[\x20\x09-\x0D]+"
SOLID = r"[^\x20\x09-\x0D]"
SYMBOLS = "#*$%&|<>"
LEAST_WORDS, MOST_REPEATED = 50, 50

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
#: Statistics that conditions may use, over the counted columns.
FEATURES = {
    "words": "cast(n_words as double)",
    "word_length": "word_chars / greatest(n_words, 1)",
    "symbols": "n_symbols / greatest(n_words, 1)",
    "dup_lines": "n_dup_lines / greatest(n_lines, 1)",
    "repeated": "n_repeat_words / greatest(n_words, 1)",
    "capitals": "n_capitals / greatest(word_chars, 1)",
    "digits": "n_digits / greatest(word_chars, 1)",
    "marks": "n_marks / greatest(n_words, 1)",
    "line_words": "n_words / greatest(n_lines, 1)",
}

#: Bounds of the learned list.
BINS, MOST_RULES, MOST_CONDITIONS = 32, 12, 4
#: Splits tried in a row without a rule before the list ends.
MOST_FAILURES = 3
#: A rule must hold this precision on the rows it is pruned with, and cover so many of them.
LEAST_PRECISION, LEAST_COVERED = 0.9, 5


def statistics(docs: DataFrame) -> DataFrame:
    """``docs`` with the counts of every whole text; a null or empty text has no words.

    Row by row: repeated rows and null ids are counted like any other, an empty table stays empty. Columns of
    ``docs`` that have the name of a count, or begin with ``_q_``, are replaced; ``clean`` keeps all as they were.
    """
    text = F.coalesce("text", F.lit(""))
    left = lambda pattern: F.char_length(F.regexp_replace(text, pattern, "")).cast("long")
    solid_lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(SOLID))
    step = docs.withColumns(
        {
            "_q_words": F.array_remove(F.split(text, GAP), ""),
            "_q_lines": solid_lines,
            "n_symbols": left(f"[^{SYMBOLS}]+"),
            "n_capitals": left(r"\P{Lu}+"),
            "n_digits": left(r"[^0-9]+"),
            "n_marks": left(r"[^.,;:!?]+"),
        }
    )
    step = step.withColumns(
        {
            "n_words": F.size("_q_words").cast("long"),
            "word_chars": F.char_length(F.array_join("_q_words", "")).cast("long"),
            "n_lines": F.size("_q_lines").cast("long"),
            "n_dup_lines": (F.size("_q_lines") - F.size(F.array_distinct("_q_lines"))).cast("long"),
            "_q_hash": F.transform("_q_words", lambda w: F.xxhash64(w)),
        }
    ).drop("_q_words", "_q_lines")
    # hashes of three-word windows, in text order
    two = "zip_with(_q_hash, slice(_q_hash, 2, size(_q_hash)), (a, b) -> xxhash64(a, b))"
    three = f"zip_with({two}, slice(_q_hash, 3, size(_q_hash)), (a, b) -> xxhash64(a, b))"
    step = step.withColumn("_q_window", F.expr(f"slice({three}, 1, greatest(size(_q_hash) - 2, 0))")).drop("_q_hash")
    return _repeated_words(step).drop("_q_window", "_q_sorted", "_q_placed", "_q_starts")


def _repeated_words(step: DataFrame) -> DataFrame:
    """Adds ``n_repeat_words``, the words inside windows found twice or more.

    Sorting the windows puts equal ones side by side. Only a text that has such a pair sorts
    them again with their positions; the distinct positions, in order, cover three words each,
    or fewer where the next one begins.
    """
    neighbours = "zip_with({0}, slice({0}, 2, size({0})), (a, b) -> {1})"
    step = step.withColumn("_q_sorted", F.expr("sort_array(_q_window)"))
    pair = f"exists({neighbours.format('_q_sorted', 'coalesce(a = b, false)')}, x -> x)"
    placed = "sort_array(transform(_q_window, (h, i) -> struct(h, i)))"
    step = step.withColumn("_q_placed", F.expr(f"if({pair}, {placed}, null)"))
    equal = neighbours.format("_q_placed", "if(a.h = b.h, array(a.i, b.i), null)")
    step = step.withColumn(
        "_q_starts", F.expr(f"sort_array(array_distinct(flatten(filter({equal}, x -> x is not null))))")
    )
    reach = neighbours.format("_q_starts", "least(3, coalesce(b - a, 3))")
    covered = f"aggregate({reach}, 0L, (total, x) -> total + x)"
    return step.withColumn("n_repeat_words", F.expr(f"coalesce({covered}, 0L)"))


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def column(self) -> Column:
        value = F.expr(FEATURES[self.feature])
        return value >= self.threshold if self.above else value < self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.above else '<'} {self.threshold:.6g}"


Rule = tuple[Condition, ...]


def _all(rule: Rule) -> Column:
    out = F.lit(True)
    for condition in rule:
        out &= condition.column()
    return out


def rejected_by(rules: list[Rule]) -> Column:
    """Number, from 1, of the first rule of the list that covers a row; null if none does."""
    out = F.lit(None).cast("int")
    for number, rule in reversed(list(enumerate(rules, 1))):
        out = F.when(_all(rule), F.lit(number)).otherwise(out)
    return out


def learn(stats: DataFrame, labels: DataFrame, label: str = "quality") -> list[Rule]:
    """Ordered rules that reject rows like those labelled 0.

    Learns from every row of ``stats(doc_id, counts)`` that passes the base test and whose
    doc_id has a label (the least one, if labels repeat; null labels don't count). Without
    rows of both labels the list is empty.
    """
    known = labels.filter(F.col(label).isin(0, 1)).groupBy("doc_id").agg(F.min(label).alias("_label"))
    rows = stats.filter(~base_failed()).join(known, "doc_id")
    rows = materialise(
        rows.select(
            *COUNTS, "n_lines", "n_capitals", "n_digits", "n_marks",
            (F.col("_label") == 0).alias("bad"), F.xxhash64("doc_id").alias("row"),
        ),
        "labelled",
    )
    cuts = _cuts(rows)
    rules: list[Rule] = []
    left = F.lit(True)
    split = failures = 0
    while cuts and len(rules) < MOST_RULES and failures < MOST_FAILURES:
        grow = F.pmod(F.xxhash64("row", F.lit(split)), F.lit(3)) < 2
        grown = _grow(rows.filter(left & grow), cuts)
        # a kind too rare for its last third to tell is judged on all rows left, and then without a fault
        rule = _prune(rows.filter(left & ~grow), grown) or _prune(rows.filter(left), grown, 1)
        split += 1
        if rule:
            rules.append(rule)
            left &= ~_all(rule)
        failures = 0 if rule else failures + 1
    return rules


def _cuts(rows: DataFrame) -> dict[str, list[float]]:
    """Candidate thresholds of each statistic: quantiles of either label and of all rows."""
    share = [i / BINS for i in range(1, BINS)]
    found = (
        rows.groupBy("bad").agg(*[F.percentile_approx(F.expr(e), share, 2000).alias(f) for f, e in FEATURES.items()])
        .collect()
    )  # at most two rows
    if len(found) < 2:
        return {}
    return {f: sorted({v for r in found for v in r[f] if v is not None and math.isfinite(v)}) for f in FEATURES}


def _counts(rows: DataFrame, cuts: dict[str, list[float]]) -> dict[str, list[list[int]]]:
    """For each statistic the rows per bin, ``[bad, good]``: one aggregation for all statistics."""
    def number(feature: str) -> Column:
        value = F.expr(FEATURES[feature])
        return F.size(F.filter(F.array(*[F.lit(c) for c in cuts[feature]]), lambda c: c <= value))

    bins = [F.struct(F.lit(f).alias("feature"), number(f).alias("bin")) for f, cut in cuts.items() if cut]
    each = rows.select("bad", F.explode(F.array(*bins)).alias("b"))
    out = {f: [[0, 0] for _ in range(len(cut) + 1)] for f, cut in cuts.items()}
    for f, b, bad, good in each.groupBy("b.feature", "b.bin").agg(F.count_if("bad"), F.count_if(~F.col("bad"))).collect():
        out[f][b] = [bad, good]
    return out


def _grow(rows: DataFrame, cuts: dict[str, list[float]]) -> Rule:
    """The conjunction found by adding the condition of the largest information gain, again and again."""
    rule: Rule = ()
    while len(rule) < MOST_CONDITIONS:
        counts = _counts(rows.filter(_all(rule)), cuts)
        some = next(iter(counts.values()))
        bad, good = (sum(b[i] for b in some) for i in (0, 1))
        if not bad or not good:
            break
        before, best, gain = math.log2(bad / (bad + good)), None, 0.0
        for f, cut in cuts.items():
            below = [0, 0]
            for at, c in enumerate(cut):
                below = [x + y for x, y in zip(below, counts[f][at], strict=True)]
                for above, (p, n) in ((False, below), (True, (bad - below[0], good - below[1]))):
                    if p and (g := p * (math.log2(p / (p + n)) - before)) > gain + 1e-9:
                        best, gain = Condition(f, above, c), g
        if best is None:
            break
        # a closer threshold of the same kind takes the place of the earlier one
        rule = (*(c for c in rule if (c.feature, c.above) != (best.feature, best.above)), best)
    return rule


def _prune(rows: DataFrame, rule: Rule, least_precision: float = LEAST_PRECISION) -> Rule:
    """The start of the rule that is worth most on rows it was not grown on, if it is good enough."""
    if not rule:
        return ()
    starts = [rule[:n] for n in range(1, len(rule) + 1)]
    found = rows.agg(
        *[F.count_if(_all(r) & F.col("bad")) for r in starts], *[F.count_if(_all(r) & ~F.col("bad")) for r in starts]
    ).first()
    scored = []
    for i, r in enumerate(starts):
        p, n = found[i], found[i + len(starts)]
        if p + n >= LEAST_COVERED and p >= least_precision * (p + n):
            scored.append(((p - n) / (p + n), p, -len(r), r))
    return max(scored, key=lambda s: s[:3])[-1] if scored else ()


def judged(stats: DataFrame, rules: list[Rule]) -> DataFrame:
    """``stats`` with ``base_failed``, ``rule`` (the first that rejects, or null) and ``kept``.

    Row by row, whatever the id; columns of these three names are replaced. Counts are never null.
    """
    rule = rejected_by(rules)
    return stats.withColumns({"base_failed": base_failed(), "rule": rule}).withColumn(
        "kept", ~F.col("base_failed") & F.col("rule").isNull()
    )


def clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the base test and the learned list keep, all columns as they were."""
    names = [f"_q{i}" for i in range(len(docs.columns))]  # so that no column of docs clashes with a count
    text = docs.columns.index("text")
    held = docs.toDF(*names)
    stats = held.withColumns({"text": F.col(names[text]), "doc_id": F.col(names[docs.columns.index("doc_id")])})
    stats = materialise(statistics(stats).drop("text"), "statistics")
    kept = judged(stats, learn(stats.drop(*names), labels)).filter("kept")
    return kept.select(*names).toDF(*docs.columns)


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    stats = materialise(statistics(docs.select("doc_id", "text")).drop("text"), "statistics")
    return judged(stats, learn(stats, labels)).select("doc_id", *COUNTS, "base_failed", "kept", "rule")
