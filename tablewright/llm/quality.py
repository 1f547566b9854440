"""Quality rules: a table of thresholds compiled into one projection of built-in functions."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import SPACES, column

WINDOW = 8  # words of a window that counts as repeated
# The characters that count as symbols.
SYMBOLS = "#*$%&|<>"
# Frequent function words of English, French, German and Spanish.
STOP_WORDS = (
    "the of and to in a that is was for it with as on be at by this from or are an "
    "de la le les et un une des du en que est dans pour sur par au qui "
    "der die und den von zu das mit sich ist im ein eine nicht auf dem "
    "el los las y se del por con su una es lo para"
).split()


class Rule(NamedTuple):
    """Bounds on ``counted`` for each thousand of ``among``, two measures of a text."""

    name: str
    counted: str
    among: str
    least: int | None = None
    most: int | None = None


RULES = (
    Rule("word_length", "word_chars", "n_words", 2500, 12000),
    Rule("symbols", "n_symbols", "n_words", None, 100),
    Rule("stop_words", "n_stop_words", "n_words", 50, None),
    Rule("repeated_lines", "n_dup_lines", "n_lines", None, 500),
    Rule("lines", "n_lines", "n_words", None, 300),
)
MEASURES = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_lines",
    "n_dup_lines",
    "n_stop_words",
    "n_repeat_words",
)


def judged(
    docs: DataFrame,
    rules: Sequence[Rule] = RULES,
    text: str = "text",
    least_words: int = 20,
    most_repeated: int = 30,
) -> DataFrame:
    """All columns of ``docs`` and, in place of such columns of the input, the measures (long),
    ``base_failed``, ``failed_rules`` (names, in the rules' order) and ``kept``.

    ``base_failed``: fewer than ``least_words`` words, or more than ``most_repeated`` percent of
    them in windows of 8 words that the text holds twice. ``kept``: neither that nor any rule
    failed. A NULL text is judged like an empty one and keeps its NULL. A rule is stated with
    whole numbers, so no rounding decides, and is met where its denominator is zero.
    """
    added = [*MEASURES, "base_failed", "failed_rules", "kept"]
    unknown = {m for r in rules for m in (r.counted, r.among)} - set(MEASURES)
    if unknown:
        raise ValueError(f"rules name unknown measures: {sorted(unknown)}")
    docs = docs.drop(*[c for c in added if c != text])
    measured = docs.select("*", F.inline(F.array(_measures(F.coalesce(column(text), F.lit(""))))))
    base = (F.col("n_words") < least_words) | (
        F.col("n_repeat_words") * 100 > F.col("n_words") * most_repeated
    )
    failed = F.array_compact(
        F.array(*[F.when(_broken(r), F.lit(r.name)) for r in rules]).cast("array<string>")
    )
    return measured.withColumn("base_failed", base).withColumn("failed_rules", failed).withColumn(
        "kept", ~F.col("base_failed") & (F.size("failed_rules") == 0)
    )


def _broken(rule: Rule) -> Column:
    counted, among = F.col(rule.counted) * 1000, F.col(rule.among)
    broken = F.lit(False)
    if rule.least is not None:
        broken = broken | (counted < among * rule.least)
    if rule.most is not None:
        broken = broken | (counted > among * rule.most)
    return broken & (among > 0)


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, however often and deep it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _measures(text: Column) -> Column:
    def blanked(characters: str) -> Column:
        return F.array_remove(
            F.split(F.translate(text, characters, " " * len(characters)), " "), ""
        )

    words = blanked(SPACES)
    lines = F.filter(F.split(text, "\n"), lambda x: F.translate(x, SPACES, "") != "")
    plain = F.array_remove(
        F.split(F.translate(F.lower(text), SPACES + ".,;:", " " * (len(SPACES) + 4)), " "), ""
    )
    stops = F.size(F.filter(plain, lambda w: w.isin(STOP_WORDS)))
    taken = {
        "word_chars": F.length(F.translate(text, SPACES, "")),
        "n_symbols": F.length(text) - F.length(F.translate(text, SYMBOLS, "")),
        "n_stop_words": stops,
    }
    measured = _let(
        words,
        lambda w: F.struct(
            F.size(w).alias("n_words"),
            _repeated_words(w).alias("n_repeat_words"),
        ),
    )
    counted = _let(
        lines,
        lambda x: F.struct(
            F.size(x).alias("n_lines"),
            (F.size(x) - F.size(F.array_distinct(x))).alias("n_dup_lines"),
        ),
    )
    return _let(
        F.struct(measured.alias("w"), counted.alias("l")),
        lambda m: F.struct(
            m["w"]["n_words"].cast("long").alias("n_words"),
            taken["word_chars"].cast("long").alias("word_chars"),
            taken["n_symbols"].cast("long").alias("n_symbols"),
            m["l"]["n_lines"].cast("long").alias("n_lines"),
            m["l"]["n_dup_lines"].cast("long").alias("n_dup_lines"),
            taken["n_stop_words"].cast("long").alias("n_stop_words"),
            m["w"]["n_repeat_words"].cast("long").alias("n_repeat_words"),
        ),
    )


def _repeated_words(words: Column) -> Column:
    """Words in windows that occur twice or more. Hashes tell most texts to have none; in the
    others the windows themselves are compared."""
    places = F.sequence(F.lit(1), F.size(words) - (WINDOW - 1))
    hashes = F.transform(places, lambda p: F.xxhash64(F.slice(words, p, WINDOW)))
    twice = _let(hashes, lambda h: F.size(F.array_distinct(h)) < F.size(h))
    return F.when(
        F.size(words) >= WINDOW, F.when(twice, _covered(_repeats(words, places))).otherwise(0)
    ).otherwise(0)


def _repeats(words: Column, places: Column) -> Column:
    """The sorted places of windows that are found twice or more."""
    windows = F.array_sort(
        F.transform(
            places,
            lambda p: F.struct(
                F.xxhash64(F.slice(words, p, WINDOW)).alias("h"),
                F.array_join(F.slice(words, p, WINDOW), " ").alias("w"),
                p.alias("p"),
            ),
        )
    )

    def marked(sorted_windows: Column) -> Column:
        def same(i: Column, j: Column) -> Column:
            other = F.get(sorted_windows, j)
            own = F.get(sorted_windows, i)
            return F.coalesce((other["h"] == own["h"]) & (other["w"] == own["w"]), F.lit(False))

        return F.filter(
            F.transform(
                sorted_windows,
                lambda x, i: F.when(same(i, i - 1) | same(i, i + 1), x["p"]),
            ),
            lambda p: p.isNotNull(),
        )

    return F.array_sort(_let(windows, marked))


def _covered(places: Column) -> Column:
    """How many words the windows from these sorted places cover."""
    none = F.struct(F.lit(0).alias("n"), F.lit(1).alias("end"))
    total = F.aggregate(
        places,
        none,
        lambda s, p: F.struct(
            (s["n"] + p + WINDOW - F.greatest(s["end"], p)).alias("n"),
            (p + WINDOW).alias("end"),
        ),
    )
    return total["n"]
