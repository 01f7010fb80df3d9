"""Quality rules: one table of thresholds, compiled into one projection.

``measures`` computes the counts of a text with built-in functions only;
``RULES`` is a table of (name, numerator, denominator, low, high); ``verdict``
turns the table into one boolean expression without division (``low * d <= n
<= high * d``), so no text, however odd, divides by zero.

Defined results: a null text counts as empty; an empty text has zero of
everything and is rejected by the length rule. The result has one row for each
input row, so repeated rows and null ids come back as often as they went in.
Where a column ``lang`` names a language without a list of stop words, that rule
is not asked, nor is the mean word length where it is written without spaces;
a text without a named language is asked everything.
Repeated 3-word windows are recognised by a 64-bit hash of their words, which
is compared inside one document only.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import SPACE_CHARS, rows_where, text_or_empty, words_of

SYMBOLS = "#*$%&|<>"

#: Frequent function words of the four languages of the corpus.
STOP_WORDS = (
    "the and of to in is that it for on as with was be by at are this "
    "de la le et les des un en du une que est pour dans qui au "
    "der die und das den von zu mit ist ein nicht auf für im "
    "el los y las se del por con una para su al es").split()

#: Languages that ``STOP_WORDS`` lists, codes that name none, and languages written without spaces.
LISTED, UNNAMED = ("en", "fr", "de", "es"), ("", "und", "unknown")
UNSPACED = ("zh", "ja", "th", "lo", "km", "my", "bo")


class Rule(NamedTuple):
    """Keep if ``low * denominator <= numerator <= high * denominator``;
    a bound of None is open."""
    name: str
    numerator: str
    denominator: str
    low: float | None
    high: float | None


#: Lengths, symbols, stop words and lines; counts are those of ``measures``.
RULES: tuple[Rule, ...] = (
    Rule("length", "n_words", "one", 50, 1_000_000_000),
    Rule("mean_word_length", "word_chars", "n_words", 2, 16),
    Rule("symbols_per_word", "n_symbols", "n_words", None, 0.5),
    Rule("stop_words", "n_stop_words", "n_words", 0.01, None),
    Rule("shouted_words", "n_upper_words", "n_words", None, 0.5),
    Rule("repeated_lines", "n_dup_lines", "n_lines", None, 0.5),
    Rule("repeated_windows", "n_repeat_words", "n_words", None, 0.5),
    Rule("fenced_words", "n_bar_words", "n_words", None, 0.3),
)

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _chars_in(text: Column, chars: str) -> Column:
    return (F.length(text) - F.length(F.translate(text, chars, ""))).cast("long")


def _repeat_words(words: str) -> Column:
    """Words inside 3-word windows that occur twice or more (array column ``words``)."""
    n = F.size(words)
    w = F.col(words)
    pairs = F.zip_with(F.slice(w, F.lit(1), n - 2), F.slice(w, F.lit(2), n - 2),
                       lambda a, b: F.xxhash64(a, b))
    return F.zip_with(pairs, F.slice(w, F.lit(3), n - 2), lambda p, c: F.xxhash64(p, c))


def _covered(grams: str) -> Column:
    """Positions covered by the repeated windows of the array ``grams`` of hashes."""
    m = F.size(grams)
    tagged = F.array_sort(F.transform(F.col(grams), lambda g, i: F.struct(g.alias("g"), i.alias("i"))))
    # each window beside its neighbours in hash order
    same_next = F.zip_with(F.slice(F.col("_t"), F.lit(1), m - 1), F.slice(F.col("_t"), F.lit(2), m - 1),
                           lambda a, b: F.when(a["g"] == b["g"], F.array(a["i"], b["i"])))
    starts = F.array_sort(F.array_distinct(F.flatten(F.filter(same_next, lambda x: x.isNotNull()))))
    return tagged, starts


def measures(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` as the struct ``row`` beside the counts of its text."""
    text = text_or_empty(text_col)
    df = docs.select(F.struct("*").alias("row"), text.alias("_x"))
    df = df.select("row", "_x", words_of(F.col("_x")).alias("_w"),
                   F.filter(F.split(F.col("_x"), "\n"), lambda s: s.rlike(r"[^\x20\x09-\x0D]")).alias("_lines"))
    df = df.select(
        "row", "_w", "_lines",
        F.size("_w").cast("long").alias("n_words"),
        (F.length("_x") - (F.length("_x") - F.length(F.translate("_x", SPACE_CHARS, "")))).cast("long").alias("word_chars"),
        _chars_in(F.col("_x"), SYMBOLS).alias("n_symbols"),
        F.when(F.size("_w") >= 4, _repeat_words("_w")).otherwise(F.array().cast("array<bigint>")).alias("_g"))
    df = df.select(
        "row", "n_words", "word_chars", "n_symbols", "_g",
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.size(F.filter("_w", lambda w: F.lower(w).isin(STOP_WORDS))).cast("long").alias("n_stop_words"),
        F.size(F.filter("_w", lambda w: (F.length(w) > 1) & (w == F.upper(w)) & (w != F.lower(w))))
        .cast("long").alias("n_upper_words"),
        F.size(F.filter("_w", lambda w: w == "|")).cast("long").alias("n_bar_words"))
    tagged, starts = _covered("_g")
    repeats = F.size(F.array_distinct("_g")) < F.size("_g")
    df = df.withColumn("_t", F.when(repeats, tagged)).withColumn("_s", F.when(repeats, starts))
    k = F.size("_s")
    gaps = F.zip_with(F.slice("_s", F.lit(2), k - 1), F.slice("_s", F.lit(1), k - 1),
                      lambda b, a: F.least(b - a, F.lit(3)))
    covered = F.aggregate(gaps, F.lit(3), lambda acc, x: acc + x)
    return (df.withColumn("n_repeat_words", F.when(repeats, covered).otherwise(F.lit(0)).cast("long"))
            .withColumn("one", F.lit(1)).drop("_g", "_t", "_s"))


def verdict(rules: Sequence[Rule] = RULES, lang: Column | None = None) -> Column:
    """The table as one expression over the columns of ``measures``; ``lang``
    (a code as in 'en' or 'pt-BR') spares languages the rules not made for them."""
    spared = {}
    if lang is not None:
        code = F.lower(F.regexp_extract(F.coalesce(lang, F.lit("")), "^[A-Za-z]*", 0))
        spared = {"stop_words": ~code.isin(*LISTED, *UNNAMED), "mean_word_length": code.isin(*UNSPACED)}
    tests = [F.lit(True)]
    for r in rules:
        n, d, spare = F.col(r.numerator), F.col(r.denominator), spared.get(r.name, F.lit(False))
        if r.low is not None:
            tests.append(spare | (n >= F.lit(r.low) * d))
        if r.high is not None:
            tests.append(spare | (n <= F.lit(r.high) * d))
    return reduce(lambda a, b: a & b, tests)


def score(docs: DataFrame, text_col: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """``row``, the measures, ``base_failed`` and ``kept``."""
    df = measures(docs, text_col)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    lang = F.col("row.lang") if dict(docs.dtypes).get("lang") == "string" else None
    return df.withColumn("base_failed", failed).withColumn("kept", ~failed & verdict(rules, lang))


def filter_documents(docs: DataFrame, text_col: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with their columns."""
    return rows_where(score(docs, text_col, rules), F.col("kept"))
