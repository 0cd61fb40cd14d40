"""Quality rules: a threshold table compiled into one projection.

`measures` turns a text into counts, `RULES` bounds ratios of those counts, and `judge` compiles
the table into boolean columns of a single projection. All of it is built-in functions, evaluated
where the rows lie: no shuffle, no Python.

Defined results: a null text counts as empty (all counts zero, rejected for its length); repeated
rows are judged each for itself; other columns, also of the same names as the counts, pass
through `judge` unread, as the counts live in one struct column whose name the caller chooses.

`RULES` is a plain table. `CORPUS_RULES` decide what a corpus keeps: words of over
LONG_WORD characters (tokens, keys, data URIs) count by their share of the text and not in the mean
word length, and stop words count in any case, and only where the list knows the language: not
where `lang` names another one, nor where letters foreign to the list's languages are common.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import BLANKS, words

#: Words of a window that counts as a passage.
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

#: Frequent short words of the languages that the rules know (fixed values).
STOP_WORDS = (
    "the of and to a in is that it for was on with as be by are this at from "
    "der die und in den von zu das sich mit auf des für ist im nicht dem ein eine als "
    "de la que el en y los las se del un por con no una su para es al lo "
    "le et les des du une pour est par avec qui dans sur pas au ou"
).split()
STOP_WORDS = tuple(dict.fromkeys(STOP_WORDS))


class Rule(NamedTuple):
    """Bounds on numerator / denominator, both names of counts; a zero denominator passes."""

    name: str
    numerator: str
    denominator: str
    least: float | None
    most: float | None


RULES = (
    Rule("word_length", "word_chars", "n_words", 2.0, 12.0),
    Rule("symbols", "n_symbols", "n_words", None, 0.25),
    Rule("stop_words", "n_stop_words", "n_words", 0.02, None),
    Rule("repeated_lines", "n_dup_lines", "n_lines", None, 0.4),
    Rule("longest_word", "longest_word", "one", None, 400.0),
)


#: Characters of a word above which it is no word of a language.
LONG_WORD = 400
#: The stop words' languages, their letters, and the share of other letters that no such text has.
LANGUAGES = ("en", "de", "es", "fr")
LETTERS = "A-Za-zÄÖÜäöüßẞÀÂÆÇÉÈÊËÎÏÔŒÙÛŸàâæçéèêëîïôœùûÿÁÍÓÚÑáíóúñªº"
FOREIGN_PERCENT = 2

CORPUS_RULES = (
    Rule("word_length", "ordinary_chars", "n_words", 2.0, 12.0),
    Rule("symbols", "n_symbols", "n_words", None, 0.25),
    Rule("stop_words", "n_stop_words_any_case", "n_words_of_known_language", 0.02, None),
    Rule("repeated_lines", "n_dup_lines", "n_lines", None, 0.4),
    Rule("long_words", "long_word_chars", "word_chars", None, 0.5),
)


def _windows(hashes: Column) -> Column:
    """One hash for each run of WINDOW words; none for shorter texts."""
    size = F.size(hashes)
    starts = F.sequence(F.lit(1), size - (WINDOW - 1))
    return F.when(
        size >= WINDOW,
        F.transform(
            starts, lambda i: F.xxhash64(*(F.element_at(hashes, i + k) for k in range(WINDOW)))
        ),
    ).otherwise(F.array().cast("array<bigint>"))


def _placed(windows: Column) -> Column:
    """Hash and position of each window, equal hashes next to each other; empty if all differ."""
    placed = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return F.when(F.size(F.array_distinct(windows)) < F.size(windows), placed)


def _found(placed: Column) -> Column:
    """Positions, in order, of the windows whose hash occurs again."""

    def again(entry: Column, j: Column) -> Column:
        return (F.get(placed, j - 1)["h"] == entry["h"]) | (F.get(placed, j + 1)["h"] == entry["h"])

    again_somewhere = F.filter(placed, lambda entry, j: F.coalesce(again(entry, j), F.lit(False)))
    return F.sort_array(F.transform(again_somewhere, lambda entry: entry["i"]))


def _covered(found: Column) -> Column:
    """Words inside those windows, each once: a window covers the words up to the next one."""
    steps = F.transform(
        found,
        lambda at, j: F.least(F.coalesce(F.get(found, j + 1) - at, F.lit(WINDOW)), F.lit(WINDOW)),
    )
    return F.coalesce(F.aggregate(steps, F.lit(0), lambda total, step: total + step), F.lit(0))


def _corpus_counts(words: str, source: Column, lang: str | None) -> dict[str, Column]:
    w, chars = F.col(words), F.length(F.array_join(words, ""))
    long_words = F.filter(w, lambda word: F.length(word) > LONG_WORD)
    long_chars = F.length(F.array_join(long_words, ""))
    foreign = F.length(F.regexp_replace(source, rf"[\P{{L}}{LETTERS}]+", ""))
    known = 100 * foreign <= FOREIGN_PERCENT * chars
    if lang is not None:
        named = F.lower(F.regexp_extract(F.col(lang).cast("string"), r"^\s*(\p{L}*)", 1))
        known = known & F.coalesce(named.isin("", "und", *LANGUAGES), F.lit(True))
    return {
        "long_word_chars": long_chars,
        "ordinary_chars": chars - long_chars,
        "n_stop_words_any_case": F.size(F.filter(w, lambda word: F.lower(word).isin(*STOP_WORDS))),
        "n_words_of_known_language": F.when(known, F.size(w)).otherwise(0),
    }


def measure(
    df: DataFrame, text: str, into: str, corpus: bool = False, lang: str | None = None
) -> DataFrame:
    """Add a struct column `into` with the counts of the column `text`; corpus: also those that
    only CORPUS_RULES read, with the column `lang` if there is one."""
    # Each array that a lambda reads is a column of its own, so that it is made once a row.
    w, h, win, placed, found, lines = (
        f"{into}__{name}" for name in ("w", "h", "win", "placed", "found", "lines")
    )
    source = F.coalesce(F.col(text), F.lit(""))
    has_word = lambda line: F.btrim(line, F.lit(BLANKS)) != ""
    listed = df.withColumns(
        {w: words(F.col(text)), lines: F.filter(F.split(source, "\n"), has_word)}
    )
    hashed = listed.withColumn(h, F.transform(F.col(w), lambda word: F.xxhash64(word)))
    windowed = hashed.withColumn(win, _windows(F.col(h)))
    sought = windowed.withColumn(placed, _placed(F.col(win)))
    sought = sought.withColumn(found, _found(F.col(placed)))
    counts = {
        "n_words": F.size(w),
        "word_chars": F.length(F.array_join(w, "")),
        "n_symbols": F.length(F.regexp_replace(source, r"[^#*$%&|<>]+", "")),
        "n_lines": F.size(lines),
        "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
        "n_stop_words": F.size(F.filter(w, lambda word: word.isin(*STOP_WORDS))),
        "longest_word": F.coalesce(
            F.array_max(F.transform(w, lambda word: F.length(word))), F.lit(0)
        ),
        "n_repeat_words": _covered(F.col(found)),
        "one": F.lit(1),
    }
    if corpus:
        counts |= _corpus_counts(w, source, lang)
    packed = F.struct(*(count.cast("long").alias(name) for name, count in counts.items()))
    return sought.withColumn(into, packed).drop(w, h, win, placed, found, lines)


def base_failed(counts: Column) -> Column:
    return (counts["n_words"] < MIN_WORDS) | (
        100 * counts["n_repeat_words"] > MAX_REPEAT_PERCENT * counts["n_words"]
    )


def compile_rules(counts: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """The table as one struct of booleans, true where a rule is kept.

    Products stand for the ratios: no division by zero, and whole-number bounds stay exact.
    """

    def holds(rule: Rule) -> Column:
        top, bottom = counts[rule.numerator], counts[rule.denominator]
        kept = F.lit(True)
        if rule.least is not None:
            kept = kept & (top >= rule.least * bottom)
        if rule.most is not None:
            kept = kept & (top <= rule.most * bottom)
        return kept

    return F.struct(*(holds(rule).alias(rule.name) for rule in rules))


def judge(
    df: DataFrame,
    text: str = "text",
    into: str = "quality",
    rules: tuple[Rule, ...] = RULES,
    lang: str | None = None,
) -> DataFrame:
    """Add a struct `into`: the counts, base_failed, each rule's outcome and kept."""
    if into in df.columns:
        raise ValueError(f"there is a column {into!r} already")
    measured = measure(df, text, into, rules is not RULES, lang)
    counts = F.col(into)
    outcome = compile_rules(counts, rules)
    kept = ~base_failed(counts)
    for rule in rules:
        kept = kept & outcome[rule.name]
    verdict = F.struct(
        counts.alias("counts"),
        base_failed(counts).alias("base_failed"),
        outcome.alias("rules"),
        kept.alias("kept"),
    )
    # Generated from an array of one, so that no filter on the verdict is pushed below the counts:
    # there it would be put together from their expressions, and arrays made anew for each element.
    return measured.withColumn(into, F.explode(F.array(verdict)))
