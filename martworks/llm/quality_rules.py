"""Quality rules: text statistics in one pass, and a decision list learned from labelled statistics.

The list is learned by sequential covering. A rule is a conjunction of thresholds on statistics: it is grown on two
thirds of the labelled rows by information gain, cut back on the other third, and kept only while it is precise
there; the rows it covers leave, and the next rule is grown. The result is an ordered conditional expression.
Thresholds come from fixed grids, so that the same rows give the same rules in any order. Every growing step is one
grouped count over the labelled rows; what reaches the driver are at most features x grid cells counts.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from .common import BLANK, BLANKS, SHINGLE, computed, shielded, shingle_hashes, stored, text_of, words_of

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20

_SHARES = [0.01, 0.02, 0.03, 0.05, 0.08, 0.1, 0.15, 0.2, 0.25, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]
#: Statistic to its expression over the counted columns, and the thresholds tried.
FEATURES: dict[str, tuple[str, list[float]]] = {
    "n_words": ("n_words", [10, 15, 20, 30, 50, 75, 100, 150, 200, 300, 500, 1000, 2000, 5000, 10000]),
    "mean_word": ("word_chars / n_words", [2, 2.5, 3, 3.5, 4, 4.5, 5, 5.5, 6, 6.5, 7, 8, 9, 10, 12, 15]),
    "symbols_per_word": ("n_symbols / n_words", [*_SHARES, 1.0, 1.5, 2.0, 3.0]),
    "bangs_per_word": ("n_bangs / n_words", [*_SHARES, 1.0, 1.5, 2.0, 3.0]),
    "upper_share": ("n_upper / word_chars", _SHARES),
    "digit_share": ("n_digits / word_chars", _SHARES),
    "repeat_share": ("n_repeat_words / n_words", _SHARES),
    "dup_line_share": ("n_dup_lines / n_lines", _SHARES),
}


def with_statistics(docs: DataFrame, text: str = "text", prefix: str = "") -> DataFrame:
    """Add the counts of each whole text: n_words, word_chars, n_symbols, n_lines (with a word), n_dup_lines,
    n_repeat_words, n_upper, n_digits, n_bangs; ``prefix`` keeps them apart from columns of the same names.

    A null text counts as empty: all counts are 0. A line counts as repeated when an earlier line is equal and has a
    word. A word counts as repeated when it lies in a window of five words that occurs twice or more.
    """
    t, w, lines, hashes, ordered = (f"_q_{n}" for n in ("text", "words", "lines", "hashes", "ordered"))
    col, repeated, places = F.col, "_q_repeated", "_q_places"
    out = computed(docs.withColumn(t, text_of(text)), **{
        w: words_of(col(t)),
        lines: F.filter(F.split(col(t), "\n"), lambda x: x.rlike(f"[^{BLANK[1:-2]}]")),
    })
    windows = F.when(F.size(w) >= SHINGLE, shingle_hashes(col(w))).otherwise(F.array().cast("array<bigint>"))
    out = computed(out, **{hashes: windows})
    out = computed(out, **{ordered: F.sort_array(hashes)})
    n = F.size(ordered)
    equal = F.zip_with(F.slice(ordered, 2, n), F.slice(ordered, 1, n - 1), lambda a, b: (a == b) & a.isNotNull())
    out = out.withColumn(repeated, (n > 1) & F.exists(equal, lambda x: x))
    # Only texts with a repeated window pay for the sort with places.
    placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    out = computed(out, _q_placed=F.when(col(repeated), placed))
    m = F.size("_q_placed")
    twins = F.flatten(F.zip_with(
        F.slice("_q_placed", 2, m), F.slice("_q_placed", 1, m - 1),
        lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])).otherwise(F.array().cast("array<int>"))))
    out = computed(out, **{places: F.when(col(repeated), F.sort_array(F.array_distinct(twins)))})
    k = F.size(places)
    steps = F.zip_with(F.slice(places, 2, k), F.slice(places, 1, k - 1), lambda a, b: F.least(a - b, F.lit(SHINGLE)))
    covered = F.aggregate(steps, F.lit(SHINGLE), lambda total, x: total + F.coalesce(x, F.lit(0)))
    def count_of(signs: str) -> Column:
        return (F.length(t) - F.length(F.translate(col(t), signs, ""))).cast("long")
    counts = {
        "n_words": F.size(w).cast("long"),
        "word_chars": F.length(F.translate(col(t), BLANKS, "")).cast("long"),
        "n_symbols": count_of(SYMBOLS),
        "n_lines": F.size(lines).cast("long"),
        "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
        "n_repeat_words": F.when(col(repeated), covered).otherwise(F.lit(0)).cast("long"),
        "n_upper": F.length(F.regexp_replace(col(t), r"\P{Lu}+", "")).cast("long"),
        "n_digits": count_of("0123456789"),
        "n_bangs": count_of("!?"),
    }
    out = computed(out, **{prefix + name: made for name, made in counts.items()})
    return out.drop(t, w, lines, hashes, ordered, repeated, "_q_placed", places)


def base_failed(prefix: str = "") -> Column:
    n, r = F.col(f"{prefix}n_words"), F.col(f"{prefix}n_repeat_words")
    return (n < MIN_WORDS) | (r * 100 > n * MAX_REPEAT_PERCENT)


def feature(name: str, prefix: str = "") -> Column:
    over, _, under = FEATURES[name][0].partition(" / ")
    top = F.col(prefix + over).cast("double")
    return top if not under else F.when(F.col(prefix + under) > 0, top / F.col(prefix + under)).otherwise(0.0)


@dataclass(frozen=True)
class Condition:
    """``name`` at least the threshold, or below it."""

    name: str
    at_least: bool
    threshold: float

    def column(self, prefix: str = "") -> Column:
        value = feature(self.name, prefix)
        return value >= self.threshold if self.at_least else value < self.threshold

    def binned(self) -> Column:
        cell = FEATURES[self.name][1].index(self.threshold) + 1
        return F.col(self.name) >= cell if self.at_least else F.col(self.name) < cell

    def __str__(self) -> str:
        return f"{self.name} {'>=' if self.at_least else '<'} {self.threshold:g}"


def _all(conditions, by=lambda c: c.binned()) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & by(c)
    return out


def learn_rules(labelled: DataFrame, *, max_rules: int = 8, max_conditions: int = 3, min_precision: float = 0.9,
                min_covered: int = 8) -> list[list[Condition]]:
    """Rules for rows to reject, in order, from rows with the counted columns, ``doc_id`` and ``bad`` (boolean).

    A rule has to cover ``min_covered`` bad rows while growing, and at least one on the pruning third, there with at
    least ``min_precision`` bad rows among those covered; otherwise learning ends. No labelled row: no rule.
    """
    cells = {name: sum(((feature(name) >= g).cast("int") for g in grid), F.lit(0)).alias(name)
             for name, (_, grid) in FEATURES.items()}
    prune = (F.pmod(F.xxhash64(F.lit("prune"), F.col("doc_id")), F.lit(3)) == 0).alias("prune")
    rows = stored(labelled.select(F.col("bad").cast("int").alias("bad"), prune, *cells.values())
                  .groupBy("bad", "prune", *FEATURES).agg(F.count("*").alias("n")), "quality-labelled")
    left, rules = F.lit(True), []
    for _ in range(max_rules):
        rule: list[Condition] = []
        while len(rule) < max_conditions:
            best = _best(rows.filter(~F.col("prune") & left & _all(rule)), rule, min_covered)
            if best is None:
                break
            rule.append(best[0])
            if best[1] == 0:  # covers no good row any more
                break
        rule = _cut(rows.filter(F.col("prune") & left), rule, min_precision)
        if not rule:
            break
        rules.append(rule)
        left = left & ~_all(rule)
    return rules


def _best(rows: DataFrame, rule: list[Condition], least: int):
    """The condition of the highest gain and the good rows it leaves; None if none gains."""
    long = rows.select("bad", "n", F.explode(F.array(*[
        F.struct(F.lit(name).alias("name"), F.col(name).alias("cell")) for name in FEATURES])).alias("f"))
    counts: dict[str, dict[int, list[int]]] = {name: {} for name in FEATURES}
    for r in long.groupBy("f.name", "f.cell", "bad").agg(F.sum("n").alias("n")).collect():
        counts[r["name"]].setdefault(r["cell"], [0, 0])[r["bad"]] += r["n"]
    found = None
    for name, by in counts.items():
        good, bad = (sum(v[k] for v in by.values()) for k in (0, 1))
        if not bad:
            return None
        before = math.log2(bad / (bad + good))
        for cell, threshold in enumerate(FEATURES[name][1], 1):
            for at_least in (True, False):
                g, b = (sum(v[k] for c, v in by.items() if (c >= cell) == at_least) for k in (0, 1))
                if b < least or (g, b) == (good, bad):
                    continue
                gain = b * (math.log2(b / (b + g)) - before)
                if gain > 1e-9 and (found is None or gain > found[0] + 1e-9):
                    found = gain, Condition(name, at_least, threshold), g
    return found and found[1:]


def _cut(rows: DataFrame, rule: list[Condition], min_precision: float) -> list[Condition]:
    """The start of the rule that separates best on rows it was not grown on; empty if none is precise enough."""
    if not rule:
        return []
    sums = [F.coalesce(F.sum(F.when(_all(rule[:k]) & (F.col("bad") == b), F.col("n"))), F.lit(0)).alias(f"_{k}_{b}")
            for k in range(1, len(rule) + 1) for b in (0, 1)]
    r = rows.agg(*sums).first()
    best = max(range(1, len(rule) + 1),
               key=lambda k: ((r[f"_{k}_1"] - r[f"_{k}_0"]) / max(1, r[f"_{k}_1"] + r[f"_{k}_0"]), r[f"_{k}_1"], -k))
    bad, good = r[f"_{best}_1"], r[f"_{best}_0"]
    return rule[:best] if bad and bad >= min_precision * (bad + good) else []


def verdict(rules: list[list[Condition]], prefix: str = "") -> Column:
    """The rules as one ordered conditional expression: true where no rule rejects."""
    out = None
    for rule in rules:
        hit = _all(rule, lambda c: c.column(prefix))
        out = F.when(hit, F.lit(False)) if out is None else out.when(hit, F.lit(False))
    return F.lit(True) if out is None else out.otherwise(F.lit(True))


def labelled_statistics(counted: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows past the base rules that have a label. Several labels of an id: the worst holds. Null ids and null labels
    are no labels."""
    bad = (labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
           .groupBy("doc_id").agg((F.min("quality") < 1).alias("bad")))
    needed = sorted({part for e, _ in FEATURES.values() for part in e.split(" / ")} | {"n_repeat_words"})
    return counted.filter(~base_failed()).select("doc_id", *needed).join(bad, "doc_id")


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document its counts, ``base_failed`` and ``kept``.

    Texts are read once; the counts alone are stored and used for learning and for the verdict. Null texts have no
    words and fail the base rules. Repeated rows are judged alike, one result each. No labels: the base rules alone.
    """
    counted = stored(with_statistics(docs.select("doc_id", "text")).drop("text"), "quality-counts")
    rules = learn_rules(labelled_statistics(counted, labels))
    return counted.withColumn("base_failed", base_failed()).withColumn("kept", ~base_failed() & verdict(rules))


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that pass, with their own columns; learning reads the texts once, the filter once more, and no
    text is shuffled."""
    prefix = "_quality_"
    rules = learn_rules(labelled_statistics(
        stored(with_statistics(docs.select("doc_id", "text")).drop("text"), "quality-counts"), labels))
    hidden, back = shielded(docs, "text")
    judged = with_statistics(hidden, prefix=prefix)
    return back(judged.filter(~base_failed(prefix) & verdict(rules, prefix)))
