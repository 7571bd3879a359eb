"""Quality rules as a short-circuit cascade, in DataFrame expressions only.

Each rule rejects a text.  A sample gives each rule's cost and the share of
texts that it rejects; the rules then run by rejections per cost, and a text
meets the rules only up to the first that rejects it.  The order decides the
time, never the verdict.

Null texts count as empty: no words, rejected by ``few_words``.  Ties and
repeated rows are judged one by one; columns of the input stay as they are,
and an empty table gives an empty one.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gapweave.llm.shared import fresh, let, words

WINDOW = 8
SYMBOLS = "#*$%&|<>"
#: Rows on which cost and selectivity of the rules are measured; more would not change any verdict.
SAMPLE_ROWS = 400


def word_chars(found: Column) -> Column:
    """Code points in words."""
    return F.char_length(F.array_join(found, "")).cast("long")


def symbol_count(text: Column) -> Column:
    return F.char_length(F.regexp_replace(F.coalesce(text, F.lit("")), f"[^{SYMBOLS}]+", "")).cast("long")


def lines_with_words(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))


def duplicate_lines(lines: Column) -> Column:
    """Lines equal to an earlier line."""
    return (F.size(lines) - F.size(F.array_distinct(lines))).cast("long")


def stutters(found: Column) -> Column:
    """Words equal to the word before."""
    return F.size(F.filter(found, lambda w, i: (i > 0) & (w == F.get(found, i - 1)))).cast("long")


def repeated_words(found: Column, width: int = WINDOW) -> Column:
    """Words inside windows of ``width`` words that the text holds twice or more.

    Most texts repeat no window: distinct hashes prove it.  The others sort
    their windows (hash, words, place), mark equal neighbours, and add up what
    the marked places cover.  No window is compared with all others.
    """
    last = F.size(found) - F.lit(width - 1)
    places = F.when(last >= 1, F.sequence(F.lit(1), F.greatest(last, F.lit(1)))).otherwise(
        F.array().cast("array<int>")
    )

    def window(i: Column) -> Column:
        return F.slice(found, i, F.lit(width))

    def marked(rows: Column) -> Column:
        def same(x: Column, k: Column) -> Column:
            other = F.get(rows, k)
            return F.coalesce((other["h"] == x["h"]) & (other["w"] == x["w"]), F.lit(False))

        # below zero and beyond the end get() gives NULL
        twice = F.filter(rows, lambda x, k: same(x, k - 1) | same(x, k + 1))
        return F.array_sort(F.transform(twice, lambda x: x["i"]))

    def covered(at: Column) -> Column:
        steps = F.transform(at, lambda p, k: F.least(F.lit(width), F.coalesce(F.get(at, k + 1) - p, F.lit(width))))
        return F.aggregate(steps, F.lit(0), lambda total, n: total + n)

    def exact() -> Column:
        rows = F.array_sort(
            F.transform(places, lambda i: F.struct(F.xxhash64(window(i)).alias("h"), window(i).alias("w"), i.alias("i")))
        )
        return let(rows, lambda s: let(marked(s), covered))

    hashes = F.transform(places, lambda i: F.xxhash64(window(i)))
    repeats = let(hashes, lambda h: F.size(F.array_distinct(h)) < F.size(h))
    return F.when(repeats, exact()).otherwise(F.lit(0)).cast("long")


@dataclass(frozen=True)
class Rule:
    """``rejects(text, words)`` is true for texts to drop."""

    name: str
    rejects: Callable[[Column, Column], Column]


#: Bounds of the rules; a text on a bound stays.
FEWEST_WORDS = 20
MOST_REPEATED = 30  # per cent of words in repeated windows
MOST_SYMBOLS = 10  # per 100 words
MOST_DUPLICATE_LINES = 50  # per cent of lines
MOST_STUTTERS = 30  # per cent of words
SHORTEST_MEAN, LONGEST_MEAN = 2, 40  # characters per word

BASE_RULES = (
    Rule("few_words", lambda text, w: F.size(w) < FEWEST_WORDS),
    Rule("repeated_words", lambda text, w: repeated_words(w) * 100 > F.size(w) * MOST_REPEATED),
)
RULES = (
    *BASE_RULES,
    Rule("symbols", lambda text, w: symbol_count(text) * 100 > F.size(w) * MOST_SYMBOLS),
    Rule(
        "duplicate_lines",
        lambda text, w: let(
            lines_with_words(text), lambda x: duplicate_lines(x) * 100 > F.size(x) * MOST_DUPLICATE_LINES
        ),
    ),
    Rule("stutters", lambda text, w: stutters(w) * 100 > F.size(w) * MOST_STUTTERS),
    Rule(
        "word_length",
        lambda text, w: let(
            word_chars(w), lambda n: (n < F.size(w) * SHORTEST_MEAN) | (n > F.size(w) * LONGEST_MEAN)
        ),
    ),
)


@dataclass(frozen=True)
class Measured:
    rule: Rule
    seconds: float
    rejected: float

    @property
    def gain(self) -> float:
        return self.rejected / max(self.seconds, 1e-9)


def measure(df: DataFrame, text: str = "text", rules: Sequence[Rule] = RULES, rows: int = SAMPLE_ROWS) -> list[Measured]:
    """Cost (seconds for the sample) and rejected share of each rule, best first; ties by name."""
    sample = df.select(F.col(text).alias("t")).limit(rows).persist()
    try:
        total = sample.count()

        def run(condition: Column) -> tuple[float, int]:
            start = time.perf_counter()
            hits = sample.agg(F.count(F.when(condition, 1))).first()[0]
            return time.perf_counter() - start, hits

        idle = run(F.size(words(F.col("t"))) < 0)[0]
        out = []
        for rule in rules:
            seconds, hits = run(let(words(F.col("t")), lambda w, r=rule: r.rejects(F.col("t"), w)))
            out.append(Measured(rule, max(seconds - idle, 1e-4), hits / total if total else 0.0))
    finally:
        sample.unpersist()
    return sorted(out, key=lambda m: (-m.gain, m.rule.name))


def first_rejection(text: Column, found: Column, ordered: Sequence[Rule]) -> Column:
    """Name of the first rule that rejects the text, NULL if none does; later rules do not run."""
    out = F.lit(None).cast("string")
    for rule in reversed(ordered):
        out = F.when(rule.rejects(text, found), F.lit(rule.name)).otherwise(out)
    return out


def apply_rules(df: DataFrame, text: str = "text", rules: Sequence[Rule] = RULES, sample_rows: int = SAMPLE_ROWS,
                into: str = "rejected_by") -> DataFrame:
    """The rows with ``into``: the rule that rejects them, or NULL."""
    ordered = [m.rule for m in measure(df, text, rules, sample_rows)]
    return df.withColumn(into, let(words(F.col(text)), lambda w: first_rejection(F.col(text), w, ordered)))


def keep_good(df: DataFrame, text: str = "text", rules: Sequence[Rule] = RULES,
              sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The rows that no rule rejects, with the columns of the input."""
    into = fresh("rejected", df)
    return apply_rules(df, text, rules, sample_rows, into).filter(F.col(into).isNull()).drop(into)


def quality_table(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Measures and verdict of each text: the measures serve the base rules, so only the others are left to run."""
    ordered = [m.rule for m in measure(df, text) if m.rule not in BASE_RULES]
    t = F.col("t")

    def stats(w: Column) -> Column:
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            word_chars(w).alias("word_chars"),
            symbol_count(t).alias("n_symbols"),
            duplicate_lines(lines_with_words(t)).alias("n_dup_lines"),
            repeated_words(w).alias("n_repeat_words"),
        )

    def verdict(w: Column) -> Column:
        def judged(s: Column) -> Column:
            base = (s["n_words"] < FEWEST_WORDS) | (s["n_repeat_words"] * 100 > s["n_words"] * MOST_REPEATED)
            rejected = F.when(base, F.lit(True)).otherwise(first_rejection(t, w, ordered).isNotNull())
            return F.struct(s.alias("s"), base.alias("base_failed"), (~rejected).alias("kept"))

        return let(stats(w), judged)

    out = df.select(F.col(key), F.col(text).alias("t")).select(key, let(words(t), verdict).alias("v"))
    return out.select(key, "v.s.*", "v.base_failed", "v.kept")
