"""Quality rules by weak supervision.

Each rule looks at one measure of a text and votes good, bad, or abstains. Expectation-maximisation over the
counts of vote patterns estimates how each rule votes on good and on bad texts, without labels, and a
text's posterior probability of being good replaces the test that every rule must pass. Only built-in
expressions are used; the measures are array functions within a row, so nothing but counts is shuffled.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakewarden.llm.common import SPACE, WORD, named
from lakewarden.session import stage

# Fixed values of the base rules.
SYMBOLS = "[#*$%&|<>]"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_BLANKS = " \t\n\x0b\f\r"


def measured(df: DataFrame, text_col: str, carry: list[str] | None = None) -> DataFrame:
    """``_row`` with the columns of ``df`` (or those to ``carry``), the five measures, and the further counts that rules use.

    Words in windows of five: the windows' hashes are sorted with their places, equal neighbours mark
    their places, and each marked place adds the words that the next one does not cover already. Texts
    without a repeated window, by far the most, skip that.
    """
    kept = df.columns if carry is None else carry
    rows = df.select(F.struct(*[named(df, c) for c in kept]).alias("_row"), named(df, text_col).alias("_text"))
    trimmed = F.btrim("_text", F.lit(_BLANKS))
    rows = rows.withColumn("_words", F.when(F.length(trimmed) > 0, F.split(trimmed, SPACE + "+")).otherwise(F.array().cast("array<string>")))
    lines = F.filter(F.split("_text", "\n"), lambda line: line.rlike(WORD))

    def count(pattern: str) -> Column:
        return F.coalesce(F.regexp_count("_text", F.lit(pattern)), F.lit(0)).cast("bigint")

    words = F.col("_words")
    rows = rows.select(
        "_row",
        F.size(F.coalesce(words, F.array().cast("array<string>"))).cast("bigint").alias("n_words"),
        F.coalesce(F.length(F.array_join(words, "")), F.lit(0)).cast("bigint").alias("word_chars"),
        count(SYMBOLS).alias("n_symbols"),
        count(SYMBOLS + "+").alias("_runs"),
        count("[A-Z]").alias("_upper"),
        count("!").alias("_shouts"),
        count(r"[.?!](?=[\x20\x09-\x0D]|$)").alias("_ends"),
        lines.alias("_lines"),
        F.transform(words, lambda w, i: F.xxhash64(w, *[F.get(words, i + k) for k in range(1, WINDOW)])).alias("_hashes"),
    )
    n_lines = F.coalesce(F.size("_lines"), F.lit(0)).cast("bigint")
    n_windows = F.greatest(F.size("_hashes") - (WINDOW - 1), F.lit(0))
    rows = rows.select(
        "_row", "n_words", "word_chars", "n_symbols", "_runs", "_upper", "_shouts", "_ends",
        F.greatest(n_lines, F.lit(0)).alias("_n_lines"),
        F.greatest(F.coalesce(F.size("_lines") - F.size(F.array_distinct("_lines")), F.lit(0)), F.lit(0)).cast("bigint").alias("n_dup_lines"),
        F.slice("_hashes", F.lit(1), n_windows).alias("_windows"),
    )
    windows = F.col("_windows")
    placed = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    rows = rows.withColumn("_placed", F.when(F.size(F.array_distinct(windows)) < F.size(windows), placed))
    # Compared with both neighbours.
    there = F.col("_placed")
    twice = F.filter(there, lambda s, j: (F.get(there, j + 1)["h"] == s["h"]) | F.when(
        j > 0, F.get(there, j - 1)["h"] == s["h"]).otherwise(False))
    rows = rows.withColumn("_marks", F.sort_array(F.transform(twice, lambda s: s["i"])))
    marks = F.col("_marks")
    covered = F.aggregate(
        F.transform(marks, lambda m, j: F.least(F.lit(WINDOW), F.coalesce(F.get(marks, j + 1) - m, F.lit(WINDOW)))),
        F.lit(0), lambda total, n: total + n)
    return rows.select(
        "_row", *[c for c in MEASURES if c != "n_repeat_words"],
        F.coalesce(covered, F.lit(0)).cast("bigint").alias("n_repeat_words"),
        "_runs", "_upper", "_shouts", "_ends", "_n_lines")


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def _vote(bad: Column, good: Column) -> Column:
    return F.when(bad, -1).when(good, 1).otherwise(0).cast("int")


def votes() -> dict[str, Column]:
    """Each rule's vote: 1 good, -1 bad, 0 abstains."""
    words = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    chars = F.greatest(F.col("word_chars"), F.lit(1)).cast("double")
    lines = F.greatest(F.col("_n_lines"), F.lit(1)).cast("double")
    mean = F.col("word_chars") / words
    symbols, repeats = F.col("n_symbols") / words, F.col("n_repeat_words") / words
    dup, upper, shouts, ends = F.col("n_dup_lines") / lines, F.col("_upper") / chars, F.col("_shouts") / words, F.col("_ends") / words
    long_enough = F.col("n_words") >= 30
    return {
        "v_length": _vote(F.col("n_words") < MIN_WORDS, F.col("n_words") >= 40),
        "v_word_size": _vote((mean < 2) | (mean > 15), mean.between(3, 11)),
        "v_symbols": _vote(symbols > 0.1, symbols <= 0.02),
        "v_symbol_runs": _vote(F.col("_runs") / words > 0.1, F.col("_runs") / words <= 0.02),
        "v_dup_lines": _vote(dup > 0.3, (F.col("n_dup_lines") == 0) & (F.col("_n_lines") > 1)),
        "v_repeats": _vote(repeats > 0.2, repeats <= 0.05),
        "v_capitals": _vote(upper > 0.4, upper <= 0.15),
        "v_shouting": _vote(shouts > 0.3, shouts <= 0.05),
        "v_sentences": _vote(long_enough & (ends < 0.004), ends.between(0.02, 0.25)),
    }


RULES = ("v_length", "v_word_size", "v_symbols", "v_symbol_runs", "v_dup_lines", "v_repeats", "v_capitals", "v_shouting",
         "v_sentences")
OUTCOMES = (-1, 0, 1)
# Where the estimate starts, and what the pseudo votes say: outcomes bad, abstain, good.
ON_GOOD, ON_BAD, GOOD_SHARE = (0.01, 0.19, 0.8), (0.3, 0.1, 0.6), 0.8
# However the counts fall, no rule is taken to call more good texts bad than this.
MOST_FALSE = 0.02


@dataclass(frozen=True)
class VoteModel:
    """Share of good texts, and per rule the chances of its three outcomes on good and on bad ones."""

    good: float
    on_good: tuple[tuple[float, ...], ...]
    on_bad: tuple[tuple[float, ...], ...]

    def posterior(self, rules: tuple[str, ...] = RULES) -> Column:
        """The numbers are one array, which lies beside the compiled code, so that all models share that code."""
        ratios = [math.log(g / b) for good, bad in zip(self.on_good, self.on_bad) for g, b in zip(good, bad)]
        share = math.log(self.good / (1 - self.good))
        known = F.lit([share + x if i < len(OUTCOMES) else x for i, x in enumerate(ratios)])
        said = [F.get(known, F.coalesce(F.signum(rule), F.lit(0)).cast("int") + (len(OUTCOMES) * i + 1)) for i, rule in enumerate(rules)]
        odds = sum(said[1:], said[0])
        return 1 / (1 + F.exp(-odds))


def fit_votes(voted: DataFrame, rules: tuple[str, ...] = RULES, rounds: int = 40, tolerance: float = 1e-4,
              pseudo: float = 10.0) -> VoteModel:
    """Expectation-maximisation on the counts of vote patterns, of which there are at most 3^rules.

    ``pseudo`` votes as at the start keep every chance above zero, and a rule's false alarms stay below
    ``MOST_FALSE``, so good and bad cannot change places. Each round is one aggregate over the patterns, by rule and
    outcome; its code is the same in all rounds and compiled once.
    """
    patterns = stage(voted.groupBy(*rules).agg(F.count(F.lit(1)).alias("_n")).coalesce(1), "votes")
    model = VoteModel(GOOD_SHARE, (ON_GOOD,) * len(rules), (ON_BAD,) * len(rules))
    n, q = F.col("_n").cast("double"), F.col("_q")
    # Of each pattern what every rule says, and once more all patterns under one name.
    cast = [F.struct(F.lit("all").alias("rule"), F.lit(0).alias("vote")), *(
        F.struct(F.lit(str(i)).alias("rule"), F.col(r).alias("vote")) for i, r in enumerate(rules))]
    for _ in range(rounds):
        # In one partition, so that a round is one task and needs no shuffle.
        scored = patterns.coalesce(1).withColumn("_q", model.posterior(rules))
        found = scored.select(n.alias("n"), (n * q).alias("good"), (n * (1 - q)).alias("bad"), F.inline(F.array(*cast)))
        sums = {(r["rule"], r["vote"]): r for r in found.groupBy("rule", "vote").agg(
            F.sum("n").alias("all"), F.sum("good").alias("good"), F.sum("bad").alias("bad")).collect()}
        if not sums:
            return model
        got = sums["all", 0]

        def chances(side: str, i: int, start: tuple[float, ...], whole: float) -> tuple[float, ...]:
            there = [sums.get((str(i), v)) for v in OUTCOMES]
            return tuple(((x[side] if x else 0.0) + pseudo * s) / (whole + pseudo) for x, s in zip(there, start))

        def trusted(c: tuple[float, ...]) -> tuple[float, ...]:
            against = min(c[0], MOST_FALSE)
            total = against + c[1] + c[2]
            return (against / total, c[1] / total, c[2] / total)

        new = VoteModel(
            min(max(got["good"] / got["all"], 0.01), 0.99),
            tuple(trusted(chances("good", i, ON_GOOD, got["good"])) for i in range(len(rules))),
            tuple(chances("bad", i, ON_BAD, got["all"] - got["good"]) for i in range(len(rules))))
        moved = max(abs(a - b) for x, y in zip((*new.on_good, *new.on_bad), (*model.on_good, *model.on_bad)) for a, b in zip(x, y))
        moved = max(moved, abs(new.good - model.good))
        model = new
        if moved < tolerance:
            break
    return model


def score_quality(df: DataFrame, text_col: str = "text", keep_at: float = 0.5,
                  carry: list[str] | None = None) -> DataFrame:
    """``_row`` (the columns of ``df``, or those to ``carry``), the measures, the votes, ``base_failed``, ``quality`` and ``kept``.

    A NULL or empty text has no words, so its base rule fails. Repeated rows are judged alike, each in its own
    row; NULLs elsewhere pass through; an empty table gives no rows; no column name of ``df`` can clash, as
    they stay inside ``_row``. A text's verdict depends on the votes of all texts in ``df``.
    """
    seen = measured(df, text_col, carry)
    voted = stage(seen.select("_row", *MEASURES, *[v.alias(r) for r, v in votes().items()]), "quality")
    model = fit_votes(voted)
    return voted.withColumn("base_failed", base_failed()).withColumn("quality", model.posterior()).withColumn(
        "kept", ~F.col("base_failed") & (F.col("quality") >= keep_at))


def keep_good(df: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``df`` that are kept, with its columns."""
    return score_quality(df, text_col).filter("kept").select("_row.*")
