"""Quality rules: an ordered list of learned threshold rules.

Sequential covering: a rule against the label grows condition by condition, each
time by the threshold with the best information gain, is pruned back to the
prefix that does best on rows kept aside, and joins the list; the rows it covers
leave, and the next rule grows on the rest. All the driver sees per step is a
table of counts by (feature, bin), at most features x bins rows at any data size.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce
from math import log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import one_label
from corpusloom.llm.text_stats import COUNTS, FEATURES, with_features
from corpusloom.session import cut_lineage

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50


@dataclass(frozen=True)
class Condition:
    feature: str
    at_least: bool
    threshold: float

    def column(self) -> Column:
        value = F.col(self.feature)
        return value >= F.lit(self.threshold) if self.at_least else value < F.lit(self.threshold)

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.at_least else '<'} {self.threshold:.6g}"


@dataclass
class RuleList:
    """Rules in order; the first that holds rejects, a text under none is kept."""

    rules: list[list[Condition]] = field(default_factory=list)

    def rule_number(self) -> Column:
        """Number of the first rule that holds, 0 for none."""
        chosen = None
        for number, rule in enumerate(self.rules, 1):
            holds = reduce(lambda a, b: a & b, [c.column() for c in rule])
            chosen = F.when(holds, number) if chosen is None else chosen.when(holds, number)
        return F.lit(0) if chosen is None else chosen.otherwise(F.lit(0))

    def __str__(self) -> str:
        return "\n".join(f"{i}: reject if " + " and ".join(map(str, r)) for i, r in enumerate(self.rules, 1))


def _bin(value: Column, edges: list[float]) -> Column:
    """How many of the ascending edges the value reaches."""
    if not edges:
        return F.lit(0)
    return F.size(F.filter(F.array(*map(F.lit, edges)), lambda edge: edge <= value))


def _step_counts(rows: DataFrame, left: Column) -> dict[tuple[int, int], tuple[int, int, int, int]]:
    """(feature, bin) -> bad and good rows to grow on, bad and good rows to prune on."""
    cells = rows.where(left).select("bad", "aside", "n", F.posexplode("bins").alias("feature", "bin"))

    def count(bad: bool, aside: bool) -> Column:
        return F.sum(F.when((F.col("bad") == bad) & (F.col("aside") == aside), F.col("n")).otherwise(0))

    sums = cells.groupBy("feature", "bin").agg(
        count(True, False).alias("a"), count(False, False).alias("b"),
        count(True, True).alias("c"), count(False, True).alias("d"),
    )
    return {(r["feature"], r["bin"]): (r["a"], r["b"], r["c"], r["d"]) for r in sums.collect()}


def _best_step(counts: dict, cuts: list[list[float]]):
    """Best (gain, feature, at_least, cut, counts covered): the first-order information gain per covered bad row."""
    total = [sum(v[k] for (f, _), v in counts.items() if f == 0) for k in range(4)]
    if not total[0]:
        return None
    before = log2(total[0] / (total[0] + total[1]))
    best = None
    for feature, edges in enumerate(cuts):
        below = [0, 0, 0, 0]
        for cut in range(len(edges)):
            below = [x + y for x, y in zip(below, counts.get((feature, cut), (0, 0, 0, 0)))]
            above = [x - y for x, y in zip(total, below)]
            for at_least, side in ((True, above), (False, below)):
                if side[0]:
                    gain = side[0] * (log2(side[0] / (side[0] + side[1])) - before)
                    # Among equals, the one with fewer good rows kept aside.
                    better = best is None or gain > best[0] + 1e-9 or (gain > best[0] - 1e-9 and side[3] < best[4][3])
                    if gain > 1e-9 and better:
                        best = (gain, feature, at_least, cut, side)
    return best


def learn_rules(
    rows: DataFrame, features: list[str], bins: int = 64, max_rules: int = 12, max_conditions: int = 4, precision: float = 0.8
) -> RuleList:
    """Rules against rows of (label 0 or 1, features as doubles); label 0 is what they reject.

    Every labelled row counts. A rule is taken if, on the rows kept aside and on
    all, its Laplace-corrected share of bad rows is at least ``precision`` (on few
    rows kept aside: at least a half); the first that is not ends the list.
    No labels, or none of one kind, give an empty list.
    """
    steps = [i / bins for i in range(1, bins)]
    asked = F.struct(*[F.percentile_approx(f, steps, 10_000).alias(f) for f in features])
    found = rows.agg(asked.alias("q")).collect()[0]["q"]
    cuts = [sorted(set(found[f] or [])) for f in features]
    binned = F.array(*[_bin(F.col(f), edges) for f, edges in zip(features, cuts)])
    aside = F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(3)) == 0
    cells = rows.select(binned.alias("bins"), (F.col("label") == 0).alias("bad"), aside.alias("aside"))
    cells = cut_lineage(cells.groupBy("bins", "bad", "aside").agg(F.count("*").alias("n")))

    def inside(rule) -> Column:
        each = [F.get("bins", f) > cut if at_least else F.get("bins", f) <= cut for f, at_least, cut in rule]
        return reduce(lambda a, b: a & b, each, F.lit(True))

    learned, left = RuleList(), F.lit(True)
    while len(learned.rules) < max_rules:
        rule, trail = [], []
        while len(rule) < max_conditions:
            step = _best_step(_step_counts(cells, left & inside(rule)), cuts)
            if step is None:
                break
            _, feature, at_least, cut, side = step
            rule.append((feature, at_least, cut))
            trail.append(side)
            if side[1] == 0:
                break
        if not rule:
            break
        worth = [(c - d) / (c + d) if c + d else -1.0 for _, _, c, d in trail]
        length = worth.index(max(worth)) + 1
        a, b, c, d = trail[length - 1]
        few = c + d < 20
        if (c + 1) / (c + d + 2) < (0.5 if few else precision) or (a + c + 1) / (a + b + c + d + 2) < precision:
            break
        rule = rule[:length]
        learned.rules.append([Condition(features[f], at_least, cuts[f][cut]) for f, at_least, cut in rule])
        left = left & ~inside(rule)
    return learned


def quality_rules(docs: DataFrame, labels: DataFrame, **options) -> tuple[DataFrame, RuleList]:
    """Verdicts on (doc_id, text) by rules learned from (doc_id, quality), and the rules.

    One row per input row: doc_id, the counts, base_failed, rule (number of the
    rule that rejects, 0 for none), kept. Missing and empty texts have no words and
    fail the base rule; missing ids learn nothing but are judged; repeated rows are
    judged each; other columns are ignored; empty tables give no rows or no rules.
    """
    measured = cut_lineage(with_features(docs))
    known = one_label(labels, "quality", F.lit(True))
    learned = learn_rules(measured.join(known, "doc_id"), FEATURES, **options)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    judged = measured.select("doc_id", *COUNTS, failed.alias("base_failed"), learned.rule_number().alias("rule"))
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("rule") == 0)), learned
