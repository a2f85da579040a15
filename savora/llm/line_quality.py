"""Quality rules, line first: each line is judged alone, failing lines go, and a document that
loses too much of its text goes with them.  Columns only: one pass over the rows, no shuffle.

Line rules (a line without a word is neither kept nor lost):
* punctuation: over a tenth of its characters are symbols ``# * $ % & | < >``; more doubled
  exclamation marks than a quarter of its words; or ten and more Latin capitals and no small letter
* navigation: three and more ``|`` with at most five words to each, or up to three words
  without a closing ``. ! ? : ; " )``
* boilerplate: under 25 words and one of the phrases of web page furniture

Document rules on the text as it came: fewer than 20 words, or over 30 of 100 words inside
repeated windows of eight words.

Defined cases: a null text has no words and fails; lines and windows are compared inside one row,
so repeated rows are judged alike and apart; other columns pass through.  Window equality is equality of
64-bit hashes within one text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from savora.llm.common import let

WHITE = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
CLOSING = (".", "!", "?", ":", ";", '"', ")")
BOILERPLATE = ("cookie", "javascript", "privacy policy", "terms of use", "terms of service", "click here", "sign up for",
               "log in to", "subscribe to our", "skip to content", "back to top", "share this", "read more", "lorem ipsum")
WINDOW = 8
MAX_LOST = 0.5
LINE_WORDS = 25

ADDED = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
         "n_lines", "n_lines_removed", "lost_chars", "clean_text")


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")


def without(text: Column, letters: str) -> Column:
    return F.translate(text, letters, "")


def count_of(text: Column, letters: str) -> Column:
    return F.length(text) - F.length(without(text, letters))


def line_fails(line: Column, boilerplate: tuple[str, ...] = BOILERPLATE) -> Column:
    """Whether a line with a word breaks one of the line rules."""
    lowered = F.translate(line, CAPITALS, SMALL)
    chars = F.length(without(line, WHITE))
    words = F.size(words_of(line))
    pipes = count_of(line, "|")
    shouts = (F.length(line) - F.length(F.replace(line, F.lit("!!"), F.lit("")))) / 2
    ends = F.substring(F.trim(F.translate(line, WHITE, " " * len(WHITE))), -1, 1)  # trim() knows blanks only
    phrases = F.lit(False)
    for phrase in boilerplate:
        phrases = phrases | F.contains(lowered, F.lit(phrase))
    return let(words, lambda n: (
        (count_of(line, SYMBOLS) * 10 > chars) | (shouts * 4 > n)
        | ((count_of(line, SMALL) == 0) & (count_of(line, CAPITALS) >= 10))
        | ((pipes >= 3) & (n <= pipes * 5)) | ((n <= 3) & ~ends.isin(*CLOSING))
        | ((n < LINE_WORDS) & phrases)))


def repeated_words(windows: Column) -> Column:
    """Words inside windows found twice or more, from the hashes of all windows in order."""
    def covered(pairs: Column) -> Column:
        twice = F.filter(pairs, lambda x, i: (F.get(pairs, i - 1)["h"] == x["h"]) | (F.get(pairs, i + 1)["h"] == x["h"]))
        starts = F.array_sort(F.transform(twice, lambda x: x["i"]))
        state = F.struct(F.lit(0).alias("end"), F.lit(0).alias("total"))
        return F.aggregate(starts, state, lambda acc, i: F.struct(
            (i + WINDOW).alias("end"), (acc["total"] + F.least(F.lit(WINDOW), i + WINDOW - acc["end"])).alias("total")),
            lambda acc: acc["total"])
    sorted_pairs = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return F.when(F.size(F.array_distinct(windows)) < F.size(windows), let(sorted_pairs, covered)).otherwise(F.lit(0))


def judge(docs: DataFrame, max_lost: float = MAX_LOST, text: str = "text") -> DataFrame:
    """Add the columns ``ADDED``; columns of these names are replaced."""
    rows = docs.drop(*ADDED).withColumn("_text", F.coalesce(F.col(text), F.lit("")))
    rows = rows.withColumn("_hashes", F.transform(words_of(F.col("_text")), lambda w: F.xxhash64(w)))
    windows = F.when(F.size("_hashes") >= WINDOW, F.transform(
        F.sequence(F.lit(0), F.size("_hashes") - WINDOW),
        lambda i: F.xxhash64(*[F.get(F.col("_hashes"), i + k) for k in range(WINDOW)]))).otherwise(F.array().cast("array<bigint>"))
    lines = F.filter(F.split("_text", "\n"), lambda line: F.length(without(line, WHITE)) > 0)
    rows = rows.withColumns({"_windows": windows, "_lines": lines})
    rows = rows.withColumn("_judged", F.transform("_lines", lambda line: F.struct(
        line.alias("line"), line_fails(line).alias("fails"), F.length(without(line, WHITE)).alias("chars"))))
    # a filter on the verdict, pushed below a projection, would compute all of it again, parts of it for every word;
    # it cannot pass a generator that makes what it tests
    found = F.struct(
        F.size("_hashes").cast("long").alias("n_words"),
        F.length(without(F.col("_text"), WHITE)).cast("long").alias("word_chars"),
        count_of(F.col("_text"), SYMBOLS).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("_windows")).cast("long").alias("n_repeat_words"),
        F.size("_lines").cast("long").alias("n_lines"),
        F.size(F.filter("_judged", lambda x: x["fails"])).cast("long").alias("n_lines_removed"),
        F.aggregate("_judged", F.lit(0).cast("long"), lambda acc, x: acc + F.when(x["fails"], x["chars"]).otherwise(0)).alias("lost_chars"),
        F.array_join(F.transform(F.filter("_judged", lambda x: ~x["fails"]), lambda x: x["line"]), "\n").alias("clean_text"))
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in ADDED]
    rows = rows.select(*rest, F.explode(F.array(found)).alias("_found")).select(*rest, "_found.*")
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return (rows.withColumn("base_failed", failed)
            .withColumn("kept", ~F.col("base_failed") & (F.col("lost_chars") <= F.lit(max_lost) * F.col("word_chars")))
            .select(*rest, *ADDED))
