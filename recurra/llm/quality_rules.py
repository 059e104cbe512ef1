"""Quality rules, line by line first.

Every line of a text is judged by itself:

* punctuation: a line of fewer than ``LONG_LINE`` words must end in a closing
  mark, and marks must not crowd the words (symbols, or runs of ! and ?);
* navigation: chains of short pieces between separators, menu words;
* boilerplate: licence, copyright, cookie and script lines.

Failing lines are removed, and a document that loses more than ``MAX_LOSS`` of
its word characters is rejected. Statistics of the whole text come with it, and
with them the base verdict, which rejects on its own: fewer than ``MIN_WORDS``
words, or too many words in five-word windows that the text repeats.

All of it is built-in column functions in one scan, without a shuffle.

Rows: a null, empty or blank text has no word and no line, and is rejected. A
line without a word is neither kept nor lost. Very long texts are judged whole.
Repeated rows give equal results, an empty table an empty one. Other columns are
not read, and kept as they are, but for columns named like the results.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recurra.llm.common import BLANKS, let, words

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 10
WINDOW = 5
MAX_REPEAT_PERCENT = 20
LONG_LINE = 20        # words; running text may be cut off anywhere
MAX_LOSS = 0.5        # of the word characters

RESULTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_passing_lines",
           "kept_chars", "base_failed", "kept", "cleaned")

# Patterns of one line, blanks trimmed.
CLOSED = "[.!?:;…。！？][\"'”’»)\\]]*$"
CROWDED = "(?:[!?]{2,}.*){3,}"
NAVIGATION = ("(?i)^(?:home|menu|back|next|previous|top|login|log in|sign in|sign up|search|contact|about|sitemap|share)"
              "(?:\\W+\\w+){0,4}\\W*$")
BOILERPLATE = ("(?i)all rights reserved|copyright \\(c\\)|©|\\blicen[sc]ed under\\b|terms of (?:use|service)|"
               "privacy policy|cookie (?:policy|settings)|uses? cookies|enable javascript|subscribe to our newsletter|"
               "click here to|powered by ")
# A lower-case text with a boilerplate line has one of these. None has an i, whose lower case depends on the locale.
TRACES = ("ghts reserved", "ght (c)", "©", "ed under", "terms of ", "vacy pol", "cook", "enable javascr",
          "be to our newsletter", "ck here to", "powered by ")


def _count(text: Column, characters: str) -> Column:
    bare = text
    for c in characters:        # a search for one character is far cheaper than a translation of each
        bare = F.replace(bare, F.lit(c), F.lit(""))
    return F.length(text) - F.length(bare)


def _word_chars(text: Column) -> Column:
    return F.length(F.translate(text, BLANKS, ""))


def _traced(text: Column) -> Column:
    """Whether a text may have a boilerplate line."""
    return let(F.lower(text), lambda t: reduce(or_, [t.contains(x) for x in TRACES]))


def _n_words(line: Column) -> Column:
    """Words of a trimmed line: one more than its runs of blanks."""
    return F.when(line == "", 0).otherwise(F.size(F.split(line, "[\\x20\\x09-\\x0D]+")))


def line_passes(line: Column, traced: Column | None = None) -> Column:
    """Whether a trimmed line with a word passes the punctuation, navigation and boilerplate rules.

    ``traced``: whether its text may have a boilerplate line; without it the line is searched at any rate.
    """
    n, chars = _n_words(line), F.greatest(_word_chars(line), F.lit(1))
    symbols = _count(line, SYMBOLS)
    dense = let(symbols, lambda s: (s > 0) & (s * 20 > chars))      # word characters are counted where there are symbols
    punctuation = (line.rlike(CLOSED) | (n >= LONG_LINE)) & ~dense & ~line.rlike(CROWDED)
    pieces = _count(line, "|»›•")
    navigation = let(pieces, lambda p: (p >= 2) & (n <= 5 * (p + 1))) | line.rlike(NAVIGATION)
    boilerplate = line.rlike(BOILERPLATE)
    return punctuation & ~navigation & ~(boilerplate if traced is None else traced & boilerplate)


def lines_with_word(text: Column) -> Column:
    """The lines of a text that have a word, blanks trimmed."""
    lines = F.transform(F.split(text, "\n"), lambda x: F.trim(x, F.lit(BLANKS)))
    return F.filter(lines, lambda x: x != "")


def clean_lines(text: Column) -> Column:
    """The lines of a text that pass, blanks trimmed."""
    text = F.coalesce(text, F.lit(""))
    return let(_traced(text), lambda traced: F.filter(lines_with_word(text), lambda x: line_passes(x, traced)))


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0), lambda a, x: a + x)


def _window_hashes(w: Column) -> Column:
    """One hash for each window of words, made of the hashes of its words."""
    return let(F.transform(w, lambda x: F.xxhash64(x)), lambda h: F.when(F.size(h) >= WINDOW, F.transform(
        F.slice(h, F.lit(1), F.size(h) - (WINDOW - 1)),
        lambda x, i: F.xxhash64(x, *[F.get(h, i + k) for k in range(1, WINDOW)]))).otherwise(F.array().cast("array<bigint>")))


def _repeat_words(hashes: Column) -> Column:
    """Words covered by the windows, given by one hash each, that occur twice or more."""
    def starts(p: Column) -> Column:
        again = F.filter(p, lambda x, i: F.coalesce(F.get(p, i - 1)["h"] == x["h"], F.lit(False))
                         | F.coalesce(F.get(p, i + 1)["h"] == x["h"], F.lit(False)))
        return F.array_sort(F.transform(again, lambda x: x["i"]))

    def covered(s: Column) -> Column:
        return _sum(F.transform(s, lambda at, i: F.least(F.lit(WINDOW), F.coalesce(F.get(s, i + 1) - at, F.lit(WINDOW)))))

    # sort_array of plain structs: no comparison function, which would be called for every two of them
    placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(
        let(placed, lambda p: let(starts(p), covered)))


def judge(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The kept columns of every row and its verdict, with the cleaned text (passing lines joined by newlines)."""
    row = F.struct(*[F.col(f"`{c}`") for c in (docs.columns if keep is None else keep) if c not in RESULTS]).alias("row")
    held = docs.select(row, F.coalesce(F.col(text), F.lit("")).alias("t"))
    held = held.withColumn("w", words(F.col("t")))
    held = held.select("row", "t", F.size("w").alias("n"), F.length(F.array_join("w", "")).alias("chars"),
                       _window_hashes(F.col("w")).alias("h"))
    blank = F.lit(BLANKS)
    held = (held.withColumn("with_word", F.filter(F.split("t", "\n"), lambda x: F.trim(x, blank) != ""))
            .withColumn("passing", clean_lines(F.col("t"))))
    kept_chars = F.when(F.size("passing") == F.size("with_word"), F.col("chars")).otherwise(
        _word_chars(F.array_join("passing", "")))
    out = held.select(
        "row", F.col("n").cast("long").alias("n_words"), F.col("chars").cast("long").alias("word_chars"),
        _count(F.col("t"), SYMBOLS).cast("long").alias("n_symbols"),
        (F.size("with_word") - F.size(F.array_distinct("with_word"))).cast("long").alias("n_dup_lines"),
        _repeat_words(F.col("h")).cast("long").alias("n_repeat_words"),
        F.size("with_word").cast("long").alias("n_lines"), F.size("passing").cast("long").alias("n_passing_lines"),
        kept_chars.cast("long").alias("kept_chars"), F.array_join("passing", "\n").alias("cleaned"))
    base = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)
    lost = F.col("kept_chars") < (1 - MAX_LOSS) * F.col("word_chars")
    return out.withColumn("base_failed", base).withColumn("kept", ~base & ~lost).select("row.*", *RESULTS)
