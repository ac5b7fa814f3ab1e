"""Quality rules, lines first (DataFrame functions only).

Every line is judged by three rules and failing lines are removed:

* punctuation -- marks that prose rarely uses (``! | # * $ % & < > { } = ~``
  and such) are at least ``max_marks`` per word;
* navigation -- separators of menus (``|``, ``>>``, bullets) split the line
  into pieces of at most three words on average;
* boilerplate -- the line holds one of ``BOILERPLATE``.

A document is then rejected if removal costs it more than ``max_loss`` of
its words, or if it fails the base rules: fewer than ``min_words`` words,
or more than ``max_repeat`` percent of its words in three-word windows
that occur twice or more.

Defined cases: null text has no words (base rules fail); an empty or
blank line has no words and is no duplicate of another; lines without
words are kept as they are; repeated rows keep their rows; other columns
are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]+"
SYMBOL = r"[#*$%&|<>]"
#: Marks prose rarely uses, and separators of menus.
MARK = r"[!|#*$%&<>{}\[\]=~^@_\\]"
SEPARATOR = r"(?:\||>>|»|•|·|::)"
# Phrases of licences, notices and page furniture.
BOILERPLATE = ("all rights reserved", "licensed under", "is licensed", "terms of use", "terms of service",
               "privacy policy", "cookie policy", "uses cookies", "enable javascript", "subscribe to our",
               "sign up for", "click here", "read more", "lorem ipsum", "spdx-license-identifier",
               "without warranty of any kind")


def split_words(text: Column) -> Column:
    """Maximal runs of non-space characters (ASCII white space separates)."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE, -1), "")


def _repeat_words(w: str) -> Column:
    """Words that lie in three-word windows occurring twice or more.

    Windows are sorted with their place, so equal ones stand together; the
    places of repeated windows are then merged in order.  Time grows with
    n log n in the words of the text.
    """
    n = F.array_size(w)
    grams = F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.struct(
        F.xxhash64(F.get(F.col(w), i), F.get(F.col(w), i + 1), F.get(F.col(w), i + 2)).alias("h"), i.alias("i")))
    return F.when(n >= 4, grams)


def _repeated_places(s: str) -> Column:
    c = F.col(s)
    hit = F.filter(c, lambda x, k: (F.get(c, k - 1)["h"] == x["h"]) | (F.get(c, k + 1)["h"] == x["h"]))
    return F.sort_array(F.transform(hit, lambda x: x["i"]))


def _merged(places: str) -> Column:
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))
    return F.aggregate(F.col(places), zero, lambda a, i: F.struct(
        (i + 3).alias("end"), (a["n"] + F.least(F.lit(3), i + 3 - a["end"])).alias("n")), lambda a: a["n"])


def _line_fails(line: Column, max_marks: float) -> Column:
    """Why a line with words is removed: punctuation, navigation, boilerplate or null."""
    n = F.array_size(split_words(line))
    marks = F.regexp_count(line, F.lit(MARK))
    pieces = F.regexp_count(line, F.lit(SEPARATOR)) + 1
    low = F.lower(line)
    phrase = F.lit(False)
    for p in BOILERPLATE:
        phrase = phrase | F.contains(low, F.lit(p))
    return (F.when(n == 0, F.lit(None))
            .when((pieces > 2) & (n <= 3 * pieces), F.lit("navigation"))
            .when(marks >= max_marks * n, F.lit("punctuation"))
            .when(phrase, F.lit("boilerplate")))


def apply_rules(docs: DataFrame, min_words: int = 50, max_repeat: int = 50, max_marks: float = 0.5,
                max_loss: float = 0.5) -> DataFrame:
    """(doc_id, text) -> counts, base_failed, kept, and the cleaned text.

    Columns: doc_id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, n_lines_removed, n_words_kept, cleaned,
    kept.
    """
    d = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    d = d.withColumn("w", split_words(F.col("text"))).withColumn("lines", F.split("text", "\n", -1))
    d = d.withColumn("worded", F.filter("lines", lambda x: F.rlike(x, F.lit(r"[^\x20\x09-\x0D]"))))
    d = d.withColumn("good", F.filter("lines", lambda x: _line_fails(x, max_marks).isNull()))
    d = d.withColumn("cleaned", F.array_join("good", "\n"))
    d = d.withColumn("s", F.sort_array(_repeat_words("w")))
    d = d.select(
        "doc_id", F.array_size("w").cast("long").alias("n_words"),
        F.char_length(F.array_join("w", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(SYMBOL)).cast("long").alias("n_symbols"),
        (F.array_size("worded") - F.array_size(F.array_distinct("worded"))).cast("long").alias("n_dup_lines"),
        _repeated_places("s").alias("places"),
        (F.array_size("lines") - F.array_size("good")).cast("long").alias("n_lines_removed"),
        F.when(F.array_size("good") == F.array_size("lines"), F.array_size("w"))
        .otherwise(F.array_size(split_words(F.col("cleaned")))).cast("long").alias("n_words_kept"),
        "cleaned")
    d = d.withColumn("n_repeat_words", F.coalesce(_merged("places"), F.lit(0).cast("long")))
    base = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat * F.col("n_words"))
    lost = F.col("n_words") - F.col("n_words_kept") > max_loss * F.col("n_words")
    return d.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                    base.alias("base_failed"), "n_lines_removed", "n_words_kept", "cleaned",
                    (~base & ~lost).alias("kept"))
