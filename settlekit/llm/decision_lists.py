"""Quality rules: learned decision lists over document statistics.

Statistics of whole texts are DataFrame expressions. Sequential covering learns
an ordered list of rules for one class (label 0: reject): a rule grows one
threshold condition at a time by the largest information gain on the growing
rows, is pruned from its end on the pruning rows, and the rows it covers are
set aside; the list ends when a pruned rule is no longer precise enough. Cuts
are then moved halfway to the nearest labelled value on their other side. Every
step counts labels per feature and bin with one grouped aggregation over the
binned labelled rows; the driver sees those counts only. The list is emitted as
one ordered CASE expression.

DataFrame functions only, and all labelled rows of the learning fold are used.

Defined results: a null text has no words and all-zero statistics; such rows
fail the base rule. A null id counts as held out (never learned from). Rows
that repeat a doc_id are judged one each; a label counts for each of its rows.
Without labels, or with one class only, the list is empty and the base rule
decides alone. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from settlekit.llm import folds
from settlekit.session import stage_table

WORD_GAP = r"[\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"

MIN_WORDS = 50          # base rule
REPEAT_SHARE = 50       # percent of words in repeated windows

BINS = 32
MAX_RULES = 12
MAX_CONDITIONS = 4
LEAST_COVER = 8         # labelled rows a rule must cover while growing
LEAST_PRECISION = 0.7   # of a pruned rule, on the pruning rows

# ratios the rules speak about, from the columns of ``statistics``
FEATURES = {
    "words": "n_words",
    "word_length": "word_chars / greatest(n_words, 1)",
    "symbols_per_word": "n_symbols / greatest(n_words, 1)",
    "bangs_per_word": "n_bangs / greatest(n_words, 1)",
    "bars_per_word": "n_bars / greatest(n_words, 1)",
    "stops_per_word": "n_stops / greatest(n_words, 1)",
    "upper_share": "n_upper / greatest(word_chars, 1)",
    "digit_share": "n_digits / greatest(word_chars, 1)",
    "dup_line_share": "n_dup_lines / greatest(n_lines, 1)",
    "repeat_share": "n_repeat_words / greatest(n_words, 1)",
    "distinct_share": "n_distinct_words / greatest(n_words, 1)",
    "words_per_line": "n_words / greatest(n_lines, 1)",
    "longest_word": "longest_word",
}


def _without(text: Column, chars: str) -> Column:
    """Characters of ``chars`` in the text."""
    return F.char_length(text) - F.char_length(F.translate(text, chars, ""))


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once for each row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def repeated_words(words: Column) -> Column:
    """Words that lie in a 3-word window found twice or more in the array (first ones included)."""
    def covered(sorted_windows):
        same = F.filter(sorted_windows, lambda x, k: (F.get(sorted_windows, k - 1)["h"] == x["h"])
                        | (F.get(sorted_windows, k + 1)["h"] == x["h"]))
        return F.size(F.array_distinct(F.flatten(F.transform(
            same, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2)))))

    windows = F.transform(F.sequence(F.lit(0), F.size(words) - 3), lambda i: F.struct(
        F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)).alias("h"), i.alias("i")))
    return F.when(F.size(words) < 4, 0).otherwise(_let(F.sort_array(windows), covered))


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id and counts of every row; whole texts, no shuffle."""
    text = F.coalesce("text", F.lit(""))

    def of_words(words):
        return F.struct(F.size(words).alias("n_words"), repeated_words(words).alias("n_repeat_words"),
                        F.size(F.array_distinct(words)).alias("n_distinct_words"),
                        F.coalesce(F.array_max(F.transform(words, F.char_length)), F.lit(0)).alias("longest_word"))

    def of_lines(lines):
        return F.struct(F.size(lines).alias("n_lines"),
                        (F.size(lines) - F.size(F.array_distinct(lines))).alias("n_dup_lines"))

    words = F.filter(F.split(text, WORD_GAP, -1), lambda w: w != "")
    lines = F.filter(F.split(text, "\n", -1), lambda line: F.translate(line, SPACES, "") != "")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), _let(words, of_words).alias("w"), _let(lines, of_lines).alias("l"),
        F.char_length(F.translate(text, SPACES, "")).alias("word_chars"), _without(text, SYMBOLS).alias("n_symbols"),
        _without(text, "!").alias("n_bangs"), _without(text, "|").alias("n_bars"), _without(text, ".,").alias("n_stops"),
        _without(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ").alias("n_upper"), _without(text, "0123456789").alias("n_digits"))
    counts = ["w.n_words", "word_chars", "n_symbols", "l.n_dup_lines", "w.n_repeat_words", "w.n_distinct_words",
              "w.longest_word", "l.n_lines", "n_bangs", "n_bars", "n_stops", "n_upper", "n_digits"]
    return rows.select("doc_id", *[F.col(c).cast("long").alias(c.split(".")[-1]) for c in counts])


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_SHARE * F.col("n_words"))


# -- rules ---------------------------------------------------------------------


@dataclass(frozen=True)
class Condition:
    """feature > cut, or feature <= cut."""

    feature: str
    cut: float
    above: bool

    def column(self) -> Column:
        value = F.expr(FEATURES[self.feature])
        return value > self.cut if self.above else value <= self.cut

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.cut:.6g}"


@dataclass(frozen=True)
class Rule:
    conditions: tuple[Condition, ...]
    precision: float

    def column(self) -> Column:
        out = F.lit(True)
        for c in self.conditions:
            out = out & c.column()
        return out


def verdict(rules: list[Rule]) -> Column:
    """Number of the first rule that rejects the row, 0 for none: an ordered CASE."""
    out = None
    for k, r in enumerate(rules, 1):
        out = F.when(r.column(), k) if out is None else out.when(r.column(), k)
    return F.lit(0) if out is None else out.otherwise(0)


def _binned(rows: DataFrame, cuts: dict[str, list[float]]) -> DataFrame:
    """y, part (grow or prune) and each feature's bin: the number of cuts below its value."""
    bins = []
    for name, c in cuts.items():
        value = F.expr(FEATURES[name])
        bins.append(sum(((value > x).cast("int") for x in c), F.lit(0)).alias(name))
    return rows.select("y", (F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(3)) > 0).alias("grow"), *bins)


def _counts(rows: DataFrame, names: list[str]) -> dict:
    """{(feature, grow): [(bin, rejected, all)]} of the rows, one grouped aggregation."""
    long = rows.select("y", "grow", F.explode(F.array(*[
        F.struct(F.lit(n).alias("feature"), F.col(n).alias("bin")) for n in names])).alias("x"))
    got = (long.groupBy("x.feature", "grow", "x.bin")
           .agg(F.sum(1 - F.col("y")).alias("bad"), F.count("*").alias("n")).collect())
    out: dict = {}
    for r in got:
        out.setdefault((r.feature, r.grow), []).append((r.bin, r.bad, r.n))
    return out


def _best(counts: dict, cuts: dict, bad: int, n: int) -> tuple | None:
    """(gain, feature, cut number, above, bad, n) of the best next condition on the growing rows (FOIL gain)."""
    before = math.log2(max(bad, 1e-9) / n)
    best = None
    for name, c in cuts.items():
        rows = sorted(counts.get((name, True), []))
        for k in range(len(c)):
            below = [r for r in rows if r[0] <= k]   # value <= cuts[k]
            p, m = sum(r[1] for r in below), sum(r[2] for r in below)
            for above, p1, m1 in ((False, p, m), (True, bad - p, n - m)):
                if m1 < LEAST_COVER or m1 == n or not p1:
                    continue
                gain = p1 * (math.log2(p1 / m1) - before)
                if best is None or gain > best[0] + 1e-9:
                    best = (gain, name, k, above, p1, m1)
    return best if best and best[0] > 1e-6 else None


def learn(stats: DataFrame, labels: DataFrame, label: str = "quality") -> list[Rule]:
    """Decision list that rejects label 0, learned on the labelled rows of the learning fold that pass the base rule."""
    y = labels.select("doc_id", F.col(label).cast("int").alias("y")).filter(
        F.col("y").isin(0, 1) & F.col("doc_id").isNotNull() & ~folds.held_out())
    rows = stage_table(stats.join(y, "doc_id").filter(~base_failed()), "rules-labelled")
    shares = [F.percentile_approx(F.expr(e).cast("double"), [k / BINS for k in range(1, BINS)], 10_000).alias(n)
              for n, e in FEATURES.items()]
    quantiles = rows.agg(*shares).first()
    cuts = {n: sorted(set(quantiles[n] or [])) for n in FEATURES}
    left = stage_table(_binned(rows, cuts), "rules-binned")
    rules: list[Rule] = []
    while len(rules) < MAX_RULES:
        covered = left
        steps: list[tuple[Condition, int, bool]] = []
        scores = []   # (bad, n) on the pruning rows after 0, 1, 2 ... conditions
        while True:
            counts = _counts(covered, list(cuts))
            some = next(iter(cuts))
            bad, n = (sum(r[k] for r in counts.get((some, True), [])) for k in (1, 2))
            scores.append(tuple(sum(r[k] for r in counts.get((some, False), [])) for k in (1, 2)))
            if not n or bad in (0, n) or len(steps) == MAX_CONDITIONS:
                break
            best = _best(counts, cuts, bad, n)
            if best is None:
                break
            _, name, k, above, _, _ = best
            steps.append((Condition(name, cuts[name][k], above), k, above))
            covered = covered.filter(F.col(name) > k if above else F.col(name) <= k)
        # prune from the end: the shortest prefix with the best (bad - good) / all on the pruning rows
        worth = [(2 * b - m) / m if m else -1.0 for b, m in scores]
        size = max(range(1, len(worth)), key=lambda k: (worth[k], -k), default=0)
        if not size or (worth[size] + 1) / 2 < LEAST_PRECISION:
            break
        rule = Rule(tuple(s[0] for s in steps[:size]), (worth[size] + 1) / 2)
        rules.append(rule)
        hit = F.lit(True)
        for c, k, above in steps[:size]:
            hit = hit & (F.col(c.feature) > k if above else F.col(c.feature) <= k)
        left = left.filter(~hit)
    return _centred(rules, rows)


def _centred(rules: list[Rule], rows: DataFrame) -> list[Rule]:
    """The rules with each cut halfway between the labelled values on either side of it."""
    every = [c for r in rules for c in r.conditions]
    if not every:
        return rules
    value = {c: F.expr(FEATURES[c.feature]).cast("double") for c in every}
    ends = rows.agg(*[x for k, c in enumerate(every) for x in (
        F.max(F.when(value[c] <= c.cut, value[c])).alias(f"lo{k}"),
        F.min(F.when(value[c] > c.cut, value[c])).alias(f"hi{k}"))]).first()
    moved = {}
    for k, c in enumerate(every):
        lo, hi = ends[f"lo{k}"], ends[f"hi{k}"]
        moved[c] = c if lo is None or hi is None else Condition(c.feature, (lo + hi) / 2, c.above)
    return [Rule(tuple(moved[c] for c in r.conditions), r.precision) for r in rules]


def judge(stats: DataFrame, rules: list[Rule]) -> DataFrame:
    """The statistics of every row with base_failed, kept and the number of the rejecting rule (0: none)."""
    return stats.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed().alias("base_failed"), (~base_failed() & (verdict(rules) == 0)).alias("kept"),
        verdict(rules).alias("rule"))
