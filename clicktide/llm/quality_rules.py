"""Quality rules: a threshold table compiled into one Spark projection, without user functions.

A rule bounds one measure of a text: length, symbol, stop-word or line ratios. The measures are array and
string expressions over the row, so a text is judged where it is read; nothing is shuffled.

Null and empty texts have no words and fail the shortest-length rule. Repeated rows and null ids are judged
like others. Extra columns stay; the measures live in one struct column whose name the caller chooses.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clicktide.llm.common import space_words

SYMBOLS = "[#*$%&|<>]"
#: Frequent function words of the four languages the corpus is written in.
STOP_WORDS = {
    "de": "der die und in das den von zu mit sich des auf für ist im nicht ein eine als auch",
    "en": "the of and to in is that for it with as on by be this are was at from or an have not but",
    "es": "de la que el en y a los del se las por un para con una su al lo como",
    "fr": "le la de et les des en un une du dans que qui pour par sur est au avec il ne",
}


@dataclass(frozen=True)
class Rule:
    """`measure` must lie between `low` and `high` (None: open; a null measure passes)."""

    measure: str
    low: float | None = None
    high: float | None = None

    def passes(self, measures: Column) -> Column:
        value = measures[self.measure]
        held = F.lit(True)
        if self.low is not None:
            held = held & (value >= F.lit(self.low))
        if self.high is not None:
            held = held & (value <= F.lit(self.high))
        return F.coalesce(held, F.lit(True))


#: The threshold table of production.
RULES = (
    Rule("n_words", low=50),
    Rule("repeat_ratio", high=0.5),
    Rule("mean_word_chars", low=3.0, high=10.0),
    Rule("symbol_ratio", high=0.1),
    Rule("stop_ratio", low=0.06),
    Rule("dup_line_ratio", high=0.5),
)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate `value` once and use it many times within `body`."""
    return F.transform(F.array(value), body)[0]


def repeated_words(words: Column) -> Column:
    """Words inside a 3-word window that occurs twice or more, first occurrence included.

    Windows are compared by a 64-bit hash: sorting (hash, place) puts equal ones side by side.
    """
    windows = F.when(
        F.size(words) >= 3,
        F.transform(
            F.sequence(F.lit(0), F.size(words) - 3),
            lambda i: F.struct(F.xxhash64(words[i], words[i + 1], words[i + 2]).alias("h"), i.alias("i")),
        ),
    )

    def places(found: Column) -> Column:
        twice = F.filter(
            found, lambda x, j: F.get(found, j - 1)["h"].eqNullSafe(x["h"]) | F.get(found, j + 1)["h"].eqNullSafe(x["h"])
        )
        return F.array_sort(F.transform(twice, lambda x: x["i"]))

    covered = F.aggregate(
        let(F.array_sort(windows), places),
        F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last")),
        lambda a, i: F.struct((a["n"] + F.least(F.lit(3), i - a["last"])).alias("n"), i.alias("last")),
    )["n"]
    return F.coalesce(covered, F.lit(0))


def measures(text: Column) -> Column:
    """A struct of all measures of one text."""
    text = F.coalesce(text, F.lit(""))
    stop = sorted({w for words in STOP_WORDS.values() for w in words.split()})
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))

    def of_words(words: Column) -> Column:
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
            repeated_words(words).cast("long").alias("n_repeat_words"),
            F.size(F.filter(words, lambda w: F.lower(w).isin(stop))).cast("long").alias("n_stop_words"),
        )

    counts = F.struct(
        let(space_words(text), of_words).alias("w"),
        let(lines, lambda x: F.struct(F.size(x).alias("n"), F.size(F.array_distinct(x)).alias("kinds"))).alias("l"),
        (F.length(text) - F.length(F.regexp_replace(text, SYMBOLS, ""))).cast("long").alias("symbols"),
    )

    def ratios(c: Column) -> Column:
        n = F.nullif(c["w"]["n_words"], F.lit(0)).cast("double")
        return F.struct(
            c["w"]["n_words"].alias("n_words"),
            c["w"]["word_chars"].alias("word_chars"),
            c["symbols"].alias("n_symbols"),
            (c["l"]["n"] - c["l"]["kinds"]).cast("long").alias("n_dup_lines"),
            c["w"]["n_repeat_words"].alias("n_repeat_words"),
            c["w"]["n_stop_words"].alias("n_stop_words"),
            (c["w"]["word_chars"] / n).alias("mean_word_chars"),
            (c["symbols"] / n).alias("symbol_ratio"),
            (c["w"]["n_stop_words"] / n).alias("stop_ratio"),
            (c["w"]["n_repeat_words"] / n).alias("repeat_ratio"),
            ((c["l"]["n"] - c["l"]["kinds"]) / F.nullif(c["l"]["n"], F.lit(0))).alias("dup_line_ratio"),
        )

    return let(counts, ratios)


def judge(documents: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text", into: str = "quality") -> DataFrame:
    """All rows and columns with a struct `into`: the measures, `failed` (names of the rules) and `kept`."""
    judged = documents.withColumn(into, measures(F.col(text)))
    failed = [F.when(~rule.passes(F.col(into)), F.lit(rule.measure)) for rule in rules]
    failed = F.array_compact(F.array(*failed)) if failed else F.array().cast("array<string>")
    return judged.withColumn(into, F.col(into).withField("failed", failed)).withColumn(
        into, F.col(into).withField("kept", F.size(F.col(into)["failed"]) == 0)
    )


def accepted(text: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """Whether a text passes the base limits and every rule, as one expression for a filter.

    A filter on a column of `judge` would be pushed below it and measure the text once per reference.
    """

    def verdict(found: Column) -> Column:
        held = ~base_failed(found)
        for rule in rules:
            held = held & rule.passes(found)
        return held

    return let(measures(text), verdict)


def base_failed(into: Column) -> Column:
    """Too short, or more than half of the words in repeated windows, in whole numbers."""
    return (into["n_words"] < 50) | (100 * into["n_repeat_words"] > 50 * into["n_words"])
