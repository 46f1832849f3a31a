"""Quality rules by line-first cleaning, in DataFrame expressions only.

Every line is held against punctuation, navigation and boilerplate rules; lines
that fail are removed, and a document that loses too much of its text is
rejected. Counts of the whole text give a second, base verdict.
"""

from __future__ import annotations

import re
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACES, extra_columns, n_word_chars, quoted, without, word_array

SYMBOLS = "#*$%&|<>"
NOISE = SYMBOLS + "!?=~^{}[]\\_"
#: Marks that end sentences or clauses: Latin and Greek, CJK, Arabic and Urdu, Indic, Armenian, Ethiopic, Burmese, Khmer, Tibetan.
STOPS = ".!?:;…;。！？｡．؟۔؛।॥։።፧၊။។៕།"
#: What may stand after such a mark at the end of a line: blanks, closing quotes and brackets.
CLOSERS = " \t\x0b\f\r\"'”’»)]"
#: Marks between the items of a menu.
SEPARATORS = "|>»•·"
#: Fixed phrases of page furniture, in lower case.
BOILERPLATE = (
    "all rights reserved",
    "cookie policy",
    "privacy policy",
    "terms of use",
    "terms of service",
    "enable javascript",
    "click here",
    "read more",
    "sign in",
    "log in",
    "subscribe to our newsletter",
    "share this",
    "skip to content",
)
MIN_WORDS = 50


WORD_CHAR = r"[^\x20\x09-\x0D]"


def line_passes(line: Column, furnished: Column) -> Column:
    """Whether a line stays; furnished: whether a boilerplate phrase stands anywhere in its text.

    A line without a word passes: it holds no text to remove.
    """
    bare = F.length(without(line, SPACES))
    noise = F.regexp_count(line, F.lit("[" + re.escape(NOISE) + "]"))
    marks = F.regexp_count(line, F.lit("[" + re.escape(SEPARATORS) + "]"))
    # The last character before closers, without a pattern that would be tried from every place of the line.
    open_ = F.rtrim(line, F.lit(CLOSERS))
    punctuation = (open_ != "") & F.lit(STOPS).contains(F.right(open_, F.lit(1))) & (noise * 10 <= bare)
    navigation = marks * 40 >= F.greatest(bare, F.lit(120))
    return ~line.rlike(WORD_CHAR) | (punctuation & ~navigation & ~(furnished & _has_phrase(line)))


def _has_phrase(text: Column) -> Column:
    low = F.lower(text)
    return reduce(or_, (low.contains(phrase) for phrase in BOILERPLATE))


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def quality(df: DataFrame, text: str = "text", min_left: float = 0.5) -> DataFrame:
    """df with counts of the whole text, the cleaned text and the verdict.

    Adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (long),
    base_failed, cleaned_text and kept; such columns of df are replaced. A null
    or empty text has no words, fails (n_words < 50) and cleans to an empty
    text. Rows are judged one by one, so repeated rows, ties and nulls in other
    columns change nothing, and an empty table gives an empty result. The cost
    of a very long text is that of sorting its word triples.
    """
    made = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "cleaned_text", "kept")
    # All of the row is held in one column meanwhile, so that no name of its own can clash.
    given = [quoted(c) for c in extra_columns(df, *made)]
    rest = ["_cv_row"]
    one = df.select(F.struct(*given).alias("_cv_row"), F.coalesce(quoted(text), F.lit("")).alias("_cv_t"))
    # The outer lambda binds the flag once for all lines of a text.
    cleaned = F.transform(
        F.array(_has_phrase(F.col("_cv_t"))), lambda furnished: F.array_join(F.filter(_lines(F.col("_cv_t")), lambda x: line_passes(x, furnished)), "\n")
    )
    two = one.select(
        "*",
        word_array(F.col("_cv_t")).alias("_cv_w"),
        F.filter(_lines(F.col("_cv_t")), lambda x: x.rlike(WORD_CHAR)).alias("_cv_lines"),
        F.get(cleaned, F.lit(0)).alias("cleaned_text"),
    )
    # Word triples with their places, sorted, so that equal triples are neighbours.
    n = "greatest(size(_cv_w) - 2, 0)"
    triples = f"arrays_zip(slice(_cv_w, 1, {n}), slice(_cv_w, 2, {n}), slice(_cv_w, 3, {n}), slice(sequence(0, size(_cv_w)), 1, {n}))"
    three = two.select(
        *rest,
        "_cv_t",
        "cleaned_text",
        F.size("_cv_w").cast("long").alias("n_words"),
        (F.size("_cv_lines") - F.size(F.array_distinct("_cv_lines"))).cast("long").alias("n_dup_lines"),
        F.sort_array(F.expr(triples)).alias("_cv_sorted"),
    )
    near = "(get(_cv_sorted, i {o} 1).`2` = x.`2` AND get(_cv_sorted, i {o} 1).`1` = x.`1` AND get(_cv_sorted, i {o} 1).`0` = x.`0`)"
    same = f"coalesce({near.format(o='-')}, false) OR coalesce({near.format(o='+')}, false)"
    four = three.select(
        *rest,
        "_cv_t",
        "cleaned_text",
        "n_words",
        "n_dup_lines",
        F.expr(f"sort_array(transform(filter(_cv_sorted, (x, i) -> {same}), x -> x.`3`))").alias("_cv_at"),
    )
    covered = "aggregate(zip_with(_cv_at, slice(_cv_at, 2, size(_cv_at)), (a, b) -> least(3, coalesce(b - a, 3))), 0L, (s, x) -> s + x)"
    # A generator, below which no later filter on the verdict is pushed: there it would evaluate the arrays anew for each of their elements.
    whole = F.struct(
        *rest,
        F.col("cleaned_text"),
        F.col("n_words"),
        n_word_chars(F.col("_cv_t")).alias("word_chars"),
        (F.length("_cv_t") - F.length(without(F.col("_cv_t"), SYMBOLS))).cast("long").alias("n_symbols"),
        F.col("n_dup_lines"),
        F.expr(covered).alias("n_repeat_words"),
    )
    five = four.select(F.inline(F.array(whole)))
    failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)
    left = n_word_chars(F.col("cleaned_text")) >= F.col("word_chars") * F.lit(min_left)
    return five.select("_cv_row.*", *made[:5], failed.alias("base_failed"), "cleaned_text", (~failed & left).alias("kept"))
