"""Quality rules: text statistics and a learned decision list, in Spark expressions only.

``learn`` grows rules against bad texts by sequential covering. A step counts the
labelled rows that no earlier rule covers between quantiles of every statistic,
by one grouped count, takes the statistic and quantile of the largest information
gain, and zooms in on it until every value between its neighbours has been looked
at. Conditions are added while a condition gains more bits than it takes to state
it. A finished rule is pruned back to the prefix that does best on rows held out
for pruning; if bad texts are not clearly in the majority there, the next best
start is tried, with another statistic or direction. Covering ends when no start
is left: neither rules nor conditions have a set number. All labelled rows take
part; only grouped counts of bounded number reach the driver. ``verdict`` emits
the rules as one ordered conditional expression.

Defined results: null and empty texts have statistics of zero; shares without a
denominator are zero; null labels and labels without a document teach nothing;
without labelled rows of both kinds the list is empty and keeps everything;
repeated rows count as often as they come. Columns with the names of the
statistics are replaced. Windows of words are told apart by a 64-bit hash.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakegauge.llm.common import stored

BLANK = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
WINDOW = 3
STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_marks", "n_capitals", "n_lines", "n_distinct_words")
CUTS = 24  # quantiles a step divides the rows of each kind by
LISTED = 2000  # so many values are looked at one by one; more are divided again
LEAST_COVERED = 5
LEAST_PRECISION = 0.7


def _without(text: Column, letters: str) -> Column:
    return F.length(F.translate(text, letters, ""))


def statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without its text, with the statistics of every whole text."""
    kept = [c for c in docs.columns if c != text and c.lower() not in STATISTICS]
    t = F.col("__text")
    rows = docs.select(*kept, F.coalesce(F.col(text), F.lit("")).alias("__text"))
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    rows = rows.select(
        *kept,
        F.array_remove(F.split(t, BLANK), "").alias("__w"),
        lines.alias("__lines"),
        _without(t, " \t\n\x0b\x0c\r").cast("long").alias("word_chars"),
        (F.length(t) - _without(t, SYMBOLS)).cast("long").alias("n_symbols"),
        (F.length(t) - _without(t, "!?")).cast("long").alias("n_marks"),
        F.regexp_count(t, F.lit(r"\p{Lu}")).cast("long").alias("n_capitals"),
    )
    w, n = F.col("__w"), F.size("__w")
    windows = F.when(n >= WINDOW, F.transform(F.sequence(F.lit(0), n - WINDOW), lambda i: F.struct(F.xxhash64(*(F.get(w, i + k) for k in range(WINDOW))).alias("h"), i.alias("i"))))
    rows = rows.select(
        *kept, "word_chars", "n_symbols", "n_marks", "n_capitals",
        n.cast("long").alias("n_words"),
        F.size("__lines").cast("long").alias("n_lines"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        F.size(F.array_distinct(w)).cast("long").alias("n_distinct_words"),
        F.sort_array(windows).alias("__sorted"),
    )
    s = F.col("__sorted")
    found_again = F.filter(s, lambda x, k: (F.get(s, k + 1)["h"] == x["h"]) | F.coalesce(F.get(s, k - 1)["h"] == x["h"], F.lit(False)))
    rows = rows.withColumn("__at", F.sort_array(F.transform(found_again, lambda x: x["i"]))).drop("__sorted")
    at = F.col("__at")
    # a window covers its words up to the next one found
    words = F.aggregate(F.transform(at, lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get(at, k + 1) - p, F.lit(WINDOW)))), F.lit(0), lambda a, x: a + x)
    return rows.select(*kept, *(F.coalesce(words, F.lit(0)).cast("long").alias(c) if c == "n_repeat_words" else F.col(c) for c in STATISTICS))


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def measures() -> dict[str, Column]:
    """The numbers that rules set thresholds on, from the statistics."""

    def share(a: str, b: str) -> Column:
        return F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0)).cast("double")

    return {
        "words": F.col("n_words").cast("double"), "letters_a_word": share("word_chars", "n_words"), "symbols_a_word": share("n_symbols", "n_words"),
        "dup_line_share": share("n_dup_lines", "n_lines"), "repeat_share": share("n_repeat_words", "n_words"), "marks_a_word": share("n_marks", "n_words"),
        "capital_share": share("n_capitals", "word_chars"), "words_a_line": share("n_words", "n_lines"), "distinct_share": share("n_distinct_words", "n_words"),
    }


@dataclass(frozen=True)
class Condition:
    measure: str
    at_least: bool
    threshold: float

    def holds(self, of: dict[str, Column]) -> Column:
        return of[self.measure] >= self.threshold if self.at_least else of[self.measure] < self.threshold

    def __str__(self) -> str:
        return f"{self.measure} {'>=' if self.at_least else '<'} {self.threshold:.6g}"


Rule = tuple[Condition, ...]


def _all(rule: Rule, of: dict[str, Column]) -> Column:
    out = F.lit(True)
    for condition in rule:
        out = out & condition.holds(of)
    return out


def _any(rules: list[Rule], of: dict[str, Column]) -> Column:
    out = F.lit(False)
    for rule in rules:
        out = out | _all(rule, of)
    return out


def verdict(rules: list[Rule]) -> Column:
    """The first rule that holds, in words; null if none does. An ordered conditional expression over the statistics."""
    of, out = measures(), None
    for rule in rules:
        said = F.lit(" AND ".join(map(str, rule)))
        out = F.when(_all(rule, of), said) if out is None else out.when(_all(rule, of), said)
    return F.lit(None).cast("string") if out is None else out


def _gain(p: int, n: int, all_p: int, all_n: int) -> float:
    return p * (math.log2(p / (p + n)) - math.log2(all_p / (all_p + all_n))) if p else 0.0


def learn(stats: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "quality") -> list[Rule]:
    """Rules against texts labelled 0; ``stats`` holds the statistics (a stored table, as it is read once a step)."""
    names = list(measures())
    known = labels.select(F.col(key).alias("__key"), F.col(label).alias("__label")).where("__label IS NOT NULL").groupBy("__key").agg(F.max("__label").alias("__label"))
    rows = stats.join(known, stats[key] == known["__key"]).where(~base_failed()).select(
        (F.col("__label") == 0).alias("bad"), (F.pmod(F.xxhash64("__key", F.lit("prune")), F.lit(3)) == 0).alias("held"), *(m.alias(name) for name, m in measures().items()))
    rows = stored(rows, "rule-rows")
    of = {name: F.col(name) for name in names}
    rules: list[Rule] = []
    while rule := _next_rule(rows, names, of):
        rules.append(rule)
        rows = stored(rows.where(~_all(rule, of)), "rule-rows")
    return rules


def _quantiles(value: str) -> Column:
    return F.percentile_approx(value, [k / CUTS for k in range(1, CUTS)], 2000)


def _step(value: str, cuts: list[float]) -> Column:
    """How many of the cuts are not above a value."""
    return F.size(F.filter(F.array(*map(F.lit, cuts)), lambda cut: cut <= F.col(value)))


def _next_rule(rows: DataFrame, names: list[str], of: dict[str, Column]) -> Rule:
    """The first rule that pruning lets pass; none if there is none."""
    found = rows.where("NOT held").groupBy("bad").agg(*(_quantiles(name).alias(name) for name in names)).collect()
    if len(found) < 2:
        return ()
    cuts = {name: sorted({x for row in found for x in row[name]}) for name in names}
    binned = stored(rows.select("*", F.array(*(F.struct(F.lit(name).alias("measure"), _step(name, cuts[name]).alias("step")) for name in names)).alias("steps")), "rule-bins")
    barred: set[tuple[str, bool]] = set()
    while True:
        rule: Rule = ()
        more = True
        while more:
            condition, more = _condition(binned.where("NOT held").where(_all(rule, of)), cuts, set() if rule else barred)
            rule = (*rule, condition) if condition else rule
        if not rule:
            return ()
        passed = _pruned(binned.where("held"), rule, of)
        if passed:
            return passed
        barred.add((rule[0].measure, rule[0].at_least))


@dataclass
class _Cut:
    gain: float
    at: int
    at_least: bool
    good: int
    below: list[tuple[int, int]]


def _best_cut(points: list[tuple[float, int, int]], below: tuple[int, int], total: tuple[int, int], directions: list[bool]) -> _Cut | None:
    """The cut of the largest gain among points of (cut, bad, good), counted from that cut up to the next; ``below`` the first one lie so many."""
    sums, best = [below], None
    for k, (_, p, n) in enumerate(points):
        under = sums[-1]
        for at_least in directions:
            covered = (total[0] - under[0], total[1] - under[1]) if at_least else under
            gain = _gain(*covered, *total)
            if sum(covered) >= LEAST_COVERED and (best is None or gain > best.gain):
                best = _Cut(gain, k, at_least, covered[1], sums)
        sums.append((under[0] + p, under[1] + n))
    return best


def _condition(rows: DataFrame, cuts: dict[str, list[float]], barred: set[tuple[str, bool]]) -> tuple[Condition | None, bool]:
    """The condition of the largest gain that is worth stating, and whether good rows are left to shut out."""
    counted = rows.select("bad", F.inline("steps")).groupBy("measure", "step").agg(F.count_if("bad").alias("p"), F.count_if(~F.col("bad")).alias("n")).collect()
    counts = {(r["measure"], r["step"]): (r["p"], r["n"]) for r in counted}
    cost = math.log2(2 * sum(map(len, cuts.values())))
    best, choice, total = None, "", (0, 0)
    for name, own in cuts.items():
        steps = [counts.get((name, k), (0, 0)) for k in range(len(own) + 1)]
        total = (sum(p for p, _ in steps), sum(n for _, n in steps))
        if not all(total):
            return None, False
        found = _best_cut([(cut, *steps[k + 1]) for k, cut in enumerate(own)], steps[0], total, [d for d in (False, True) if (name, d) not in barred])
        if found and (best is None or found.gain > best.gain):
            best, choice = found, name
    if best is None:
        return None, False
    best, threshold = _zoomed(rows, choice, cuts[choice], best, total)
    return (Condition(choice, best.at_least, threshold), best.good > 0) if best.gain > cost else (None, False)


def _zoomed(rows: DataFrame, name: str, cuts: list[float], best: _Cut, total: tuple[int, int]) -> tuple[_Cut, float]:
    """The best cut between the neighbours of a cut: ranges of many values are divided again, until each value is looked at."""
    values = rows.groupBy(F.col(name).alias("x")).agg(F.count_if("bad").alias("p"), F.count_if(~F.col("bad")).alias("n"))
    while True:
        low, below = (cuts[best.at - 1], best.below[best.at - 1]) if best.at else (-math.inf, (0, 0))
        high = cuts[best.at + 1] if best.at + 1 < len(cuts) else math.inf
        inside = values.where((F.col("x") >= low) & (F.col("x") < high))
        listed = inside.limit(LISTED + 1).collect()
        done = len(listed) <= LISTED
        if done:
            points = sorted((r["x"], r["p"], r["n"]) for r in listed)
        else:
            edges = sorted(set(inside.agg(_quantiles("x").alias("q")).first()["q"]))
            summed = {r["s"]: (r["p"], r["n"]) for r in inside.groupBy(_step("x", edges).alias("s")).agg(F.sum("p").alias("p"), F.sum("n").alias("n")).collect()}
            first = summed.get(0, (0, 0))
            below = (below[0] + first[0], below[1] + first[1])
            points = [(edge, *summed.get(k + 1, (0, 0))) for k, edge in enumerate(edges)]
        found = _best_cut(points, below, total, [best.at_least])
        if done:
            return (found, points[found.at][0]) if found and found.gain >= best.gain else (best, cuts[best.at])
        if found is None:
            return best, cuts[best.at]
        # the range's own ends bound the next one
        cuts, best = [low, *(x for x, _, _ in points), high], _Cut(found.gain, found.at + 1, found.at_least, found.good, [(below[0] - first[0], below[1] - first[1]), *found.below])


def _pruned(rows: DataFrame, rule: Rule, of: dict[str, Column]) -> Rule:
    """The prefix of a rule with the best balance on held rows; none if bad texts are not clearly in the majority there."""
    if not rule:
        return ()
    prefixes = [rule[:k] for k in range(1, len(rule) + 1)]
    sums = [F.count_if(_all(p, of) & (F.col("bad") if bad else ~F.col("bad"))) for p in prefixes for bad in (True, False)]
    counts = list(rows.agg(*(s.alias(f"c{k}") for k, s in enumerate(sums))).first())
    worth = [((p - n) / (p + n) if p + n else -1.0, -k) for k, (p, n) in enumerate(zip(counts[::2], counts[1::2], strict=True))]
    best = -max(worth)[1]
    p, n = counts[2 * best], counts[2 * best + 1]
    return prefixes[best] if p and p >= LEAST_PRECISION * (p + n) else ()
