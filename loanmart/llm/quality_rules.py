"""Quality rules as a short-circuit cascade, ordered by rejections per cost measured on a sample.

Everything is built-in column expressions. ``with_measures`` adds what rules look at; ``cascade``
tests one rule after another in a single CASE expression, whose later branches are evaluated only for rows that
passed the earlier ones. The order changes the time, never the verdict.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from loanmart.llm.shared import forget, written

WORD = r"[^\x20\x09-\x0D]+"
SPACE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
SAMPLE_ROWS = 1000  # expected rows of the sample that orders the rules


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Column


def _count(text: Column, characters: str) -> Column:
    return (F.length(text) - F.length(F.translate(text, characters, ""))).cast("long")


def with_measures(docs: DataFrame, text_col: str) -> DataFrame:
    """``docs`` with ``n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words``.

    A null text counts as empty, so all measures are 0. ``n_lines`` counts lines with a word.
    Columns of these names are replaced.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    own = [F.col(f"`{c}`") for c in docs.columns if c not in MEASURES]
    split = docs.select(
        *own,
        F.regexp_extract_all(text, F.lit(WORD), F.lit(0)).alias("_words"),
        F.filter(F.split(text, "\n", -1), lambda l: l.rlike(WORD)).alias("_lines"),
    )
    windows = F.transform(
        F.sequence(F.lit(0), F.size("_words") - 5),
        lambda i: F.xxhash64(*[F.get(F.col("_words"), i + k) for k in range(5)]),
    )
    hashed = split.select(
        "*", F.when(F.size("_words") >= 5, windows).otherwise(F.array().cast("array<bigint>")).alias("_windows")
    )
    # most texts repeat no window; only the others pay for sorting theirs
    repeats = F.size(F.array_distinct("_windows")) < F.size("_windows")
    placed = F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    sorted_ = hashed.select("*", F.when(repeats, placed).alias("_sorted"))
    twice = F.filter(
        "_sorted",
        lambda x, i: (F.get(F.col("_sorted"), i - 1)["h"] == x["h"]) | (F.get(F.col("_sorted"), i + 1)["h"] == x["h"]),
    )
    found = sorted_.select("*", F.sort_array(F.transform(twice, lambda x: x["i"])).alias("_at"))
    steps = F.transform("_at", lambda p, i: F.least(F.lit(5), F.coalesce(F.get(F.col("_at"), i + 1) - p, F.lit(5))))
    covered = F.aggregate(steps, F.lit(0).cast("long"), lambda total, step: total + step)
    return found.select(
        *own,
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.translate(text, SPACE, "")).cast("long").alias("word_chars"),
        _count(text, SYMBOLS).alias("n_symbols"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
    )


MEASURES = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def standard_rules(text_col: str) -> list[Rule]:
    """Rules over the measures and the text."""
    text, words = F.coalesce(F.col(text_col), F.lit("")), F.col("n_words")
    return [
        Rule("mean_word_length", (F.col("word_chars") < 2 * words) | (F.col("word_chars") > 15 * words)),
        Rule("symbols", 10 * F.col("n_symbols") > words),
        Rule("duplicate_lines", 100 * F.col("n_dup_lines") > 30 * F.col("n_lines")),
        Rule("digits", 100 * _count(text, "0123456789") > 30 * F.col("word_chars")),
        Rule("long_word", text.rlike(r"[^\x20\x09-\x0D]{201}")),
    ]


def order(
    docs: DataFrame, rules: list[Rule], rows: int = SAMPLE_ROWS, seed: int = 1,
    measure: Callable[[DataFrame], DataFrame] = lambda sample: sample,
) -> list[Rule]:
    """Rules by falling rejections per cost on a random sample of about ``rows`` rows.

    ``measure`` adds what rules look at and ``docs`` lacks, to the sampled rows only. The cost of a rule is the time
    to evaluate it over the sample beyond that of a trivial one.
    """
    total = docs.count()
    if not total or len(rules) < 2:
        return rules
    sample = written(measure(docs.sample(min(1.0, rows / total), seed)))

    def timed(test: Column) -> tuple[float, int]:
        frame = sample.agg(F.count_if(test).alias("n"))
        frame.first()  # compiled and warm
        began = time.perf_counter()
        n = frame.first()["n"]
        return time.perf_counter() - began, n

    idle, _ = timed(F.col(sample.columns[0]).isNull())
    worth = {}
    for rule in rules:
        seconds, rejected = timed(rule.rejects)
        worth[rule.name] = rejected / max(seconds - idle, 1e-3)
    forget(sample)
    return sorted(rules, key=lambda r: -worth[r.name])


def cascade(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """Adds ``rejected_by``: the name of the first rule, in the given order, that rejects a row, else null."""
    verdict = F.lit(None).cast("string")
    for rule in reversed(rules):
        verdict = F.when(rule.rejects, F.lit(rule.name)).otherwise(verdict)
    return docs.withColumn("rejected_by", verdict)


def judge(docs: DataFrame, text_col: str) -> DataFrame:
    """Adds the measures, ``base_failed``, ``rejected_by`` and ``kept`` to every row.

    Rules are ordered on a sample of the rows. Null, empty and blank texts have no words and fail the base rule;
    repeated rows are judged each; an empty table stays empty. ``rejected_by`` is null for rows that fail the base rule.
    """
    measured = with_measures(docs, text_col).withColumn("base_failed", base_failed())
    rules = order(docs, standard_rules(text_col), measure=lambda sample: with_measures(sample, text_col))
    judged = cascade(measured, [Rule("base", F.col("base_failed")), *rules])
    return judged.withColumn("kept", F.col("rejected_by").isNull()).withColumn(
        "rejected_by", F.when(~F.col("base_failed"), F.col("rejected_by"))
    )
