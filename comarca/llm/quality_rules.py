"""Quality rules as a learned decision list, in DataFrame expressions only.

Sequential covering: a rule against low quality is grown, condition by condition, by FOIL gain on
two thirds of the labelled statistics, pruned on the other third and kept while it is precise
there; then the documents that it covers are set aside and the next one is grown. A condition
compares one statistic with a threshold. The list becomes one conditional expression.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from comarca.llm.common import labelled_sample, staged
from comarca.llm.statistics import RATIOS, with_counts, with_ratios

SAMPLE = 40_000
CUTS = 24
MOST_RULES = 8
MOST_CONDITIONS = 3
# A rule is kept if at least this share of what it covers in the pruning part is of low quality.
PRECISION = 0.9
FEATURES = ("n_words", *RATIOS, "repeats")


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def column(self) -> Column:
        value, limit = F.col(self.feature), F.lit(self.threshold)
        return value > limit if self.above else value <= limit

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:g}"


Rule = tuple[Condition, ...]


def statistics(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """The documents with the counts, and the ratios that rules may use."""
    counted = with_ratios(with_counts(docs, text_column))
    share = F.try_divide(F.col("n_repeat_words").cast("double"), F.col("n_words"))
    return counted.withColumn("repeats", F.coalesce(share, F.lit(0.0)))


def matches(rule: Rule) -> Column:
    return reduce(Column.__and__, [condition.column() for condition in rule])


def kept_by(rules: list[Rule]) -> Column:
    """The list as an ordered conditional expression: false at the first rule that matches."""
    column = F.lit(True)
    for rule in reversed(rules):
        column = F.when(matches(rule), F.lit(False)).otherwise(column)
    return column


def _thresholds(sample: DataFrame) -> dict[str, list[float]]:
    """Quantiles of every statistic among the good and among the bad."""
    steps = [k / CUTS for k in range(CUTS)] + [1.0]
    found: dict[str, set[float]] = {name: set() for name in FEATURES}
    rows = sample.groupBy("label").agg(
        *[F.percentile_approx(F.col(name).cast("double"), steps, 10_000).alias(name) for name in FEATURES]
    )
    for row in rows.collect():
        for name in FEATURES:
            found[name].update(row[name] or [])
    return {name: sorted(values) for name, values in found.items()}


def _bin(name: str, cuts: list[float]) -> Column:
    """The number of thresholds below a statistic: bin k holds cuts[k - 1] < x <= cuts[k]."""
    thresholds = F.array(*[F.lit(float(cut)) for cut in cuts])
    return F.size(F.filter(thresholds, lambda cut: cut < F.col(name)))


def _best(histogram: dict, cuts: dict[str, list[float]], bad: int, good: int) -> Condition | None:
    """The condition with the largest FOIL gain, the first in order of equal ones."""
    best, most = None, 1e-9
    before = math.log2(bad / (bad + good)) if bad else 0.0
    for number, name in enumerate(FEATURES):
        below = [0, 0]
        for at, threshold in enumerate(cuts[name]):
            for label in (0, 1):
                below[label] += histogram.get((number, at, label), 0)
            for above in (False, True):
                p = bad - below[0] if above else below[0]
                n = good - below[1] if above else below[1]
                if p:
                    gain = p * (math.log2(p / (p + n)) - before)
                    if gain > most:
                        best, most = Condition(name, above, threshold), gain
    return best


def learn_rules(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    id_column: str = "doc_id",
    text_column: str = "text",
    limit: int = SAMPLE,
) -> list[Rule]:
    """Learn the list from at most ``limit`` labelled documents (0: low quality). Runs jobs.

    Each step is one aggregation of the sample's binned statistics, of which a few hundred counts come
    to the driver. Without labels of both kinds there are no rules.
    """
    sample = staged(
        statistics(labelled_sample(docs, labels, label, limit, id_column, text_column)).select(
            "id", "label", *FEATURES
        ),
        "rule-sample",
    )
    cuts = _thresholds(sample)
    bins = F.array(*[_bin(name, cuts[name]) for name in FEATURES])
    if not all(cuts.values()):
        return []
    grow = F.pmod(F.xxhash64("id", F.lit(5)), F.lit(3)) < 2
    sample = staged(sample.select("label", *FEATURES, bins.alias("bins"), grow.alias("grow")), "rule-bins")

    def counted(where: Column) -> tuple[int, int]:
        row = sample.where(where).agg(F.count_if(F.col("label") == 0), F.count_if(F.col("label") != 0)).first()
        return row[0], row[1]

    rules: list[Rule] = []
    while len(rules) < MOST_RULES:
        open_ = kept_by(rules)
        rule: Rule = ()
        while len(rule) < MOST_CONDITIONS:
            covered = open_ & F.col("grow") & (matches(rule) if rule else F.lit(True))
            exploded = sample.where(covered).select("label", F.posexplode("bins").alias("feature", "bin"))
            counts = exploded.groupBy("feature", "bin", "label").count().collect()
            histogram = {(row["feature"], row["bin"], min(row["label"], 1)): row["count"] for row in counts}
            bad = sum(n for (feature, _, kind), n in histogram.items() if feature == 0 and kind == 0)
            good = sum(n for (feature, _, kind), n in histogram.items() if feature == 0 and kind == 1)
            found = _best(histogram, cuts, bad, good) if bad and good else None
            if found is None or found in rule:
                break
            rule = (*rule, found)
        if not rule:
            break
        # Prune: the shortest beginning of the rule that is as good as any on the other part.
        scored = []
        for length in range(1, len(rule) + 1):
            p, n = counted(open_ & ~F.col("grow") & matches(rule[:length]))
            scored.append(((p - n) / (p + n) if p + n else -1.0, -length, p, n))
        worth, length, p, n = max(scored)
        if p == 0 or p < PRECISION * (p + n):
            break
        rules.append(rule[:-length])  # the length is negative
    return rules


def judge_quality(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    limit: int = SAMPLE,
    rules: list[Rule] | None = None,
) -> DataFrame:
    """Which documents the base rules and the learned list keep. One row per row of ``docs``.

    Columns: id, the counts, base_failed (fewer than 50 words, or more than half of them in
    3-word windows found twice or more), kept, and rule (the number of the first learned rule that
    matches, from 1, else null). Null and empty texts have no words and fail. Repeated rows
    are judged each. Null ids and null labels teach nothing. An empty table gives no rows.
    Other columns are not looked at. Learns the rules when called, unless they are given.
    """
    if rules is None:
        rules = learn_rules(docs, labels, "quality", id_column, text_column, limit)
    picked = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    judged = statistics(picked).drop("text")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    number = F.lit(None).cast("int")
    for k in range(len(rules), 0, -1):
        number = F.when(matches(rules[k - 1]), k).otherwise(number)
    return judged.withColumns(
        {"base_failed": failed, "kept": ~failed & kept_by(rules), "rule": number}
    )
