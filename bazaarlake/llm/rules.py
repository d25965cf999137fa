"""Quality rules: text statistics and a decision list learned from labelled rows."""

from __future__ import annotations

import operator
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlake.llm.common import SPACE, let, no_columns_missing, split_words, stage

WINDOW = 5
LEAST_WORDS = 10
MOST_REPEATED_PERCENT = 20
# Rules are learned from at most this many labelled rows, those with the smallest key hashes.
SAMPLE_ROWS = 20_000
CUTS = 16
MOST_RULES = 6
MOST_CONDITIONS = 3
LEAST_COVER, LEAST_HELD = 5, 3
LEAST_PRECISION = 0.95

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
# What conditions may ask about: the counts that are kept for all rows, as shares of the words.
FEATURES = {
    "length": "cast(n_words as double)",
    "mean_word": "word_chars / greatest(n_words, 1)",
    "symbol_share": "n_symbols / greatest(n_words, 1)",
    "repeated_lines": "cast(n_dup_lines as double)",
    "repeat_share": "n_repeat_words / greatest(n_words, 1)",
}


# --- statistics -----------------------------------------------------------------------------


def _repeated_words(words: Column) -> Column:
    """Words inside any window of five that occurs twice or more in the text."""

    def window(i: Column) -> Column:
        return F.xxhash64(*[F.get(words, i + j) for j in range(WINDOW)])

    def covered(pairs: Column) -> Column:
        # Sorted (hash, place) pairs: a window repeats when a neighbour has its hash.
        def again(p: Column, i: Column) -> Column:
            before = (i > 0) & (F.get(pairs, i - 1)["h"] == p["h"])
            after = F.coalesce(F.get(pairs, i + 1)["h"] == p["h"], F.lit(False))
            return F.when(before | after, p["at"])

        places = F.sort_array(F.filter(F.transform(pairs, again), lambda at: at.isNotNull()))
        start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-WINDOW).alias("last"))
        return F.aggregate(
            places,
            start,
            lambda s, at: F.struct(
                (s["n"] + F.least(F.lit(WINDOW), at - s["last"])).cast("long").alias("n"),
                at.cast("int").alias("last"),
            ),
            lambda s: s["n"],
        )

    def from_hashes(hashes: Column) -> Column:
        pairs = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.cast("int").alias("at")))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("long")).otherwise(
            let(F.sort_array(pairs), covered)
        )

    windows = F.transform(F.sequence(F.lit(0), F.size(words) - WINDOW), window)
    return F.when(F.size(words) < WINDOW, F.lit(0).cast("long")).otherwise(let(windows, from_hashes))


def _dup_lines(text: Column) -> Column:
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(f"[^{SPACE}]"))
    return let(lines, lambda found: F.size(found) - F.size(F.array_distinct(found)))


def with_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds the five counts and ``base_failed``; null texts count as empty.

    All windows of a row are compared inside the row: nothing is shuffled, and a text of any
    length costs its own sort only.
    """
    whole = F.coalesce(F.col(text), F.lit(""))

    def of_words(words: Column) -> Column:
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.char_length(F.array_join(words, "")).cast("long").alias("word_chars"),
            _repeated_words(words).alias("n_repeat_words"),
        )

    found = docs.drop(*COUNTS, "base_failed").withColumn(
        "_found", let(split_words(whole, SPACE), of_words)
    )
    failed = (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words")
    )
    return (
        found.withColumn("n_words", F.col("_found.n_words"))
        .withColumn("word_chars", F.col("_found.word_chars"))
        .withColumn("n_symbols", F.regexp_count(whole, F.lit("[#*$%&|<>]")).cast("long"))
        .withColumn("n_dup_lines", _dup_lines(whole).cast("long"))
        .withColumn("n_repeat_words", F.col("_found.n_repeat_words"))
        .withColumn("base_failed", failed)
        .drop("_found")
    )


# --- learning -------------------------------------------------------------------------------


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    cut: float

    def column(self) -> Column:
        value = F.expr(FEATURES[self.feature])
        return value > self.cut if self.above else value <= self.cut


@dataclass(frozen=True)
class Rule:
    """Rows that meet all conditions are of low quality."""

    conditions: tuple[Condition, ...]

    def column(self) -> Column:
        return reduce(operator.and_, [c.column() for c in self.conditions])


@dataclass(frozen=True)
class DecisionList:
    rules: tuple[Rule, ...]

    def rejects(self) -> Column:
        """The first rule that fires decides; without one the row is kept."""
        verdict = None
        for rule in self.rules:
            when = F.when if verdict is None else verdict.when
            verdict = when(rule.column(), F.lit(True))
        return F.lit(False) if verdict is None else verdict.otherwise(F.lit(False))

    def fired(self) -> Column:
        """Number of the rule that fired, from 1; null without one."""
        numbered = [F.when(rule.column(), n) for n, rule in enumerate(self.rules, 1)]
        return F.coalesce(*numbered) if numbered else F.lit(None).cast("int")


def labelled_sample(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """Counts of labelled rows with ``low`` (quality 0); a bounded sample when there are more.

    Rows with the smallest key hashes are taken, so the sample does not depend on partitions.
    Labels that contradict each other, or are null, are left out.
    """
    known = (
        no_columns_missing(labels, doc_id="long", quality="int")
        .filter("doc_id is not null and quality is not null")
        .groupBy("doc_id")
        .agg(F.min("quality").alias("_q"), F.max("quality").alias("_most"))
        .filter("_q = _most")
        .select("doc_id", (F.col("_q") == 0).alias("low"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rows)
    )
    # The sample is bounded by ``rows``, so it can be broadcast instead of moving the texts.
    return with_statistics(docs.select("doc_id", "text").join(F.broadcast(known), "doc_id"))


def learn(sample: DataFrame) -> DecisionList:
    """Sequential covering: grow a conjunction, prune it on rows set aside, drop what it covers.

    Every step is one grouped count over the sample: low-quality and other rows per feature and
    interval between cuts, for the rows to grow on and those set aside. Only these counts reach
    the driver, and their running sums score all conditions at once. A rule stays when it is
    precise on the rows set aside. Without usable labels the list is empty.
    """
    held = F.pmod(F.xxhash64(F.lit("prune"), "doc_id"), F.lit(3)) == 0
    values = [F.expr(e).alias(f) for f, e in FEATURES.items()]
    rows = stage(sample.select("doc_id", "low", held.alias("held"), *COUNTS, *values), "rules")
    grades = [k / (CUTS + 1) for k in range(1, CUTS + 1)]
    # Cuts lie at quantiles of both classes, so a rare class has cuts of its own.
    found = rows.groupBy("low").agg(*[F.percentile_approx(f, grades, 10_000).alias(f) for f in FEATURES])
    cuts: dict[str, set[float]] = {f: set() for f in FEATURES}
    for row in found.collect():
        for feature in FEATURES:
            cuts[feature].update(float(v) for v in row[feature] or [])
    ordered = {f: sorted(values) for f, values in cuts.items()}
    rules: list[Rule] = []
    left = rows
    while len(rules) < MOST_RULES:
        grown = _grow(left.filter("not held"), ordered)
        rule = _prune(left.filter("held"), grown) if grown else None
        if rule is None:
            break
        rules.append(rule)
        left = left.filter(~rule.column())
    return DecisionList(tuple(rules))


def _interval(feature: str, cuts: list[float]) -> Column:
    """Number of cuts below the value."""
    marks = F.array(*[F.lit(cut) for cut in cuts]).cast("array<double>")
    return F.size(F.filter(marks, lambda cut: F.col(feature) > cut))


def _scored(rows: DataFrame, cuts: dict[str, list[float]]) -> list[tuple[int, int, Condition]]:
    """Low-quality and other rows that meet each condition, in one pass."""
    places = F.array(
        *[F.struct(F.lit(f).alias("feature"), _interval(f, c).alias("interval")) for f, c in cuts.items()]
    )
    counted = (
        rows.select("low", F.explode(places).alias("p"))
        .groupBy("p.feature", "p.interval", "low")
        .count()
        .collect()
    )
    scored = []
    for feature, marks in cuts.items():
        per = {(r["interval"], r["low"]): r["count"] for r in counted if r["feature"] == feature}
        for number, cut in enumerate(marks):
            for above in (True, False):
                # A value lies above a cut when more cuts than its number are below it.
                sums = [
                    sum(n for (i, low), n in per.items() if low == kind and (i > number) == above)
                    for kind in (True, False)
                ]
                scored.append((*sums, Condition(feature, above, cut)))
    return scored


def _grow(rows: DataFrame, cuts: dict[str, list[float]]) -> Rule | None:
    """Adds the condition that is worth most, until none adds to the worth."""
    chosen: tuple[Condition, ...] = ()
    best = float("-inf")
    while len(chosen) < MOST_CONDITIONS:
        inside = rows.filter(Rule(chosen).column()) if chosen else rows
        scored = [(_worth(p, n), p, c) for p, n, c in _scored(inside, cuts) if p >= LEAST_COVER]
        if not scored:
            break
        worth, _, condition = max(
            scored, key=lambda s: (s[0], s[1], s[2].feature, s[2].above, s[2].cut)
        )
        if worth <= best:
            break
        best, chosen = worth, (*chosen, _centred(inside, condition))
    return Rule(chosen) if chosen else None


def _centred(rows: DataFrame, condition: Condition) -> Condition:
    """The cut half-way between the values on its two sides."""
    value = F.col(condition.feature)
    low, high = rows.agg(
        F.max(F.when(value <= condition.cut, value)), F.min(F.when(value > condition.cut, value))
    ).first()
    if low is None or high is None:
        return condition
    return Condition(condition.feature, condition.above, (low + high) / 2)


def _worth(low: int, other: int) -> float:
    """Low rows gained, each row of the other class costing what precision asks for."""
    return low - other * LEAST_PRECISION / (1 - LEAST_PRECISION)


def _prune(rows: DataFrame, rule: Rule) -> Rule | None:
    """The shortest front part of the rule that is worth most on rows set aside."""
    fronts = [Rule(rule.conditions[: k + 1]) for k in range(len(rule.conditions))]
    tests = []
    for k, front in enumerate(fronts):
        tests.append(F.count_if(front.column() & F.col("low")).alias(f"p{k}"))
        tests.append(F.count_if(front.column() & ~F.col("low")).alias(f"n{k}"))
    row = rows.agg(*tests).first()
    worth, _, best = max((_worth(row[f"p{k}"], row[f"n{k}"]), -k, k) for k in range(len(fronts)))
    return fronts[best] if worth > 0 and row[f"p{best}"] >= LEAST_HELD else None


def apply_rules(docs: DataFrame, rules: DecisionList) -> DataFrame:
    """Every row with its counts, ``base_failed``, ``rule`` and ``kept``.

    Null and empty texts have no words, so the base rules reject them. Rows that repeat are
    judged one by one. An empty table gives no rows; other columns stay, those with the names of
    added ones are replaced.
    """
    judged = with_statistics(docs.drop("rule", "kept"))
    return judged.withColumn("rule", rules.fired()).withColumn(
        "kept", ~F.col("base_failed") & ~rules.rejects()
    )


def quality_rules(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Learns the list from the labelled rows of ``docs`` and applies it to all."""
    return apply_rules(docs, learn(labelled_sample(docs, labels)))
