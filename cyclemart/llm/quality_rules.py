"""Quality rules: a table of thresholds compiled into one Spark projection.

Measures are built-in column expressions over the whole text; a rule keeps a
measure between two bounds; the table of rules becomes one conjunction and the list of
the rules that a row breaks. No user function is involved.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WHITE_SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"

#: Frequent words of four languages.
STOP_WORDS = (
    "the of and to a in is that it for was on with as by be this are at from "
    "de la le et les des en du un que pour une est qui dans par sur au pas avec "
    "der die und in den das von zu mit des sich auf für nicht dem ist im ein eine als "
    "de la que el en y los las del se un no por con su para una es al lo"
).split()


@dataclass(frozen=True)
class Rule:
    """``measure`` must lie between ``low`` and ``high`` (None: no bound on that side)."""

    name: str
    measure: str
    low: float | None = None
    high: float | None = None


#: Symbols and line measures of prose are small; listed or repeated words are not prose.
PROSE_RULES = (
    Rule("length", "n_words", low=10),
    Rule("word_length", "mean_word_length", low=2.5, high=12.0),
    Rule("symbols", "symbols_per_word", high=0.1),
    Rule("stop_words", "stop_word_share", low=0.02),
    Rule("twin_words", "twin_word_share", high=0.2),
    Rule("repeated_passages", "repeat_share", high=0.2),
    Rule("repeated_lines", "dup_line_share", high=0.4),
    Rule("unended_lines", "ended_line_share", low=0.3),
)


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` worked out once."""
    return F.transform(F.array(value), use)[0]


def _n_repeat_words(words: Column, window: int) -> Column:
    """Words covered by word windows that occur more than once.

    Windows with unequal hashes differ, so most texts end there. For the others the
    windows themselves are sorted, which brings equal ones together.
    """
    n, none = F.size(words), F.lit(0).cast("long")
    starts = F.sequence(F.lit(0), n - window)

    def parts(array: Column, i: Column) -> list[Column]:
        return [F.get(array, i + k) for k in range(window)]

    def window_hashes(word_hashes: Column) -> Column:
        return F.transform(starts, lambda i: F.xxhash64(*parts(word_hashes, i)))

    hashes = _let(F.transform(words, lambda w: F.xxhash64(w)), window_hashes)
    placed = F.sort_array(F.transform(starts, lambda i: F.struct(F.concat_ws(" ", *parts(words, i)).alias("w"), i.alias("i"))))

    def repeated(at: Column) -> Column:
        def start(k: Column) -> Column:
            text = F.get(at, k)["w"]
            return F.when((text == F.get(at, k - 1)["w"]) | (text == F.get(at, k + 1)["w"]), F.get(at, k)["i"])

        found = F.transform(F.sequence(F.lit(0), F.size(at) - 1), start)
        return F.sort_array(F.filter(found, lambda i: i.isNotNull()))

    def covered(at: Column) -> Column:
        gaps = F.zip_with(at, F.slice(at, 2, F.greatest(F.size(at), F.lit(1))), lambda i, j: F.coalesce(F.least(j - i, F.lit(window)), F.lit(window)))
        return F.aggregate(gaps, none, lambda total, gap: total + gap)

    exact = _let(_let(placed, repeated), covered)
    return F.when(n <= window, none).when(
        _let(hashes, lambda h: F.size(F.array_distinct(h)) == F.size(h)), none
    ).otherwise(exact)


def measured(docs: DataFrame, text: str = "text", window: int = 5, stop_words: list[str] | None = None) -> DataFrame:
    """``docs`` with the measures; a null text has no words.

    n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (longs) and, as shares,
    mean_word_length, symbols_per_word, stop_word_share, twin_word_share, repeat_share,
    dup_line_share, ended_line_share. Shares of nothing are 0.
    """
    value = F.coalesce(F.col(text), F.lit(""))
    stops = sorted({form for w in stop_words or STOP_WORDS for form in (w, w.capitalize(), w.upper())})
    with_words = docs.withColumn(
        "_words", F.filter(F.split(value, WHITE_SPACE), lambda w: w != "")
    ).withColumn(
        "_lines", F.filter(F.split(value, "\n"), lambda line: F.translate(line, " \t\x0b\x0c\r", "") != "")
    )
    words, lines = F.col("_words"), F.col("_lines")
    n_words = F.size(words).cast("long")
    twins = F.zip_with(words, F.slice(words, 2, F.greatest(F.size(words), F.lit(1))), lambda a, b: F.when(a == b, True))
    # Empty strings of an absent last line are no lines, so sizes count lines with a word.
    counts = {
        "n_words": n_words,
        "word_chars": F.length(F.translate(value, " \t\n\x0b\x0c\r", "")).cast("long"),
        "n_symbols": (F.length(value) - F.length(F.translate(value, SYMBOLS, ""))).cast("long"),
        "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
        "n_repeat_words": _n_repeat_words(words, window),
        "_stops": F.size(F.filter(words, lambda w: w.isin(stops))),
        "_twins": F.size(F.filter(twins, lambda same: same.isNotNull())),
        "_ended": F.size(F.filter(lines, lambda line: line.rlike(r"[.!?:;\x{2026}\x{3002}\"')\x{bb}\x{201d}][ \t\r\x0b\x0c]*$"))),
    }
    counted = with_words.withColumns(counts).withColumn("_lines", F.size("_lines")).drop("_words")

    def share(part: str, whole: str) -> Column:
        return F.when(F.col(whole) > 0, F.col(part) / F.col(whole)).otherwise(0.0)

    return counted.withColumns({
        "mean_word_length": share("word_chars", "n_words"),
        "symbols_per_word": share("n_symbols", "n_words"),
        "stop_word_share": share("_stops", "n_words"),
        "twin_word_share": share("_twins", "n_words"),
        "repeat_share": share("n_repeat_words", "n_words"),
        "dup_line_share": share("n_dup_lines", "_lines"),
        "ended_line_share": share("_ended", "_lines"),
    }).drop("_lines", "_stops", "_twins", "_ended")


def judged(measures: DataFrame, rules: tuple[Rule, ...] = PROSE_RULES) -> DataFrame:
    """Adds broken_rules (names, in the table's order) and kept (none is broken)."""
    broken = []
    for rule in rules:
        bounds = []
        if rule.low is not None:
            bounds.append(F.col(rule.measure) < rule.low)
        if rule.high is not None:
            bounds.append(F.col(rule.measure) > rule.high)
        broken.append(F.when(reduce(lambda a, b: a | b, bounds, F.lit(False)), rule.name))
    names = F.array_compact(F.array(*broken)) if broken else F.array().cast("array<string>")
    return measures.withColumn("broken_rules", names).withColumn("kept", F.size("broken_rules") == 0)


def quality_rules(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = PROSE_RULES) -> DataFrame:
    """``docs`` with measures, broken_rules and kept. Columns of ``docs`` that carry one of
    these names are replaced."""
    return judged(measured(docs, text), rules)


def passing(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = PROSE_RULES) -> DataFrame:
    """Rows of ``docs`` that break no rule, with the columns of ``docs``.

    The partition's number stands beside the verdict because Spark pushes no filter below
    a projection that holds it; pushed down, the measures would be worked out again for every
    use, and the words again for each of them.
    """
    judged_rows = quality_rules(docs, text, rules).withColumn("_partition", F.spark_partition_id())
    return judged_rows.filter("kept AND _partition >= 0").select(*docs.columns)
