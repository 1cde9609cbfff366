"""Line-first quality rules.

Two verdicts per document, both from built-in functions alone:

* base figures: characters in words, symbols, lines equal to an earlier line, and
  words inside 5-word windows that occur at least twice in the text. A document
  fails the base if it has under ``MIN_WORDS`` words or if more than
  ``MAX_REPEAT_PERCENT`` percent of its words are repeated;
* line cleaning: each line is judged on punctuation, navigation and boilerplate,
  failing lines go (``cleaned`` gives what is left), and a document that loses more than
  ``MAX_LOST_PERCENT`` percent of its characters is rejected.

Everything is computed inside the document's own row: no shuffle, so neither hot
sources nor groups of copies matter, and the cost grows with the text.

Defined cases: a null or blank text has no words and fails the base; blank lines
carry no text and are kept; repeated rows are judged separately.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeflow.llm.common import BLANKS, NOT_BLANK, carry, settle, unpack

MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
MAX_LOST_PERCENT = 50
WINDOW = 5

SYMBOLS = "[#*$%&|<>]"
# A line of fewer words than this needs a closing mark to count as prose.
SHORT_LINE = 10
CLOSING = "[.!?…:;\"'”’»)\\]。！？]" + BLANKS + "*$"
# Menus and trails: several short segments between separators.
SEPARATOR = "[|›»·•]|::|>>| > "
NAVIGATION = ("^" + BLANKS + "*(home|menu|login|log in|sign in|sign up|register|next|previous|back to top|search|"
              "sitemap|contact us|about us|share|print|read more|more)" + BLANKS + "*[.:>»]*" + BLANKS + "*$")
# Phrases of a short line that is not prose, in lower case.
BOILERPLATE = ("lorem ipsum", "enable javascript", "javascript is disabled", "use cookies", "uses cookies", "cookie policy",
               "all rights reserved", "terms of use", "terms of service", "privacy policy", "subscribe to our newsletter",
               "click here", "powered by", "{{", "}}", "function(", "function (")


def with_lower(lines: Column) -> Column:
    """Each line beside its lower-case form, computed once."""
    return F.transform(lines, lambda x: F.struct(x.alias("line"), F.lower(x).alias("low")))


def line_ok(x: Column) -> Column:
    """Whether a line with text, as ``with_lower`` gives it, passes the punctuation, navigation and boilerplate rules."""
    line, low = x["line"], x["low"]
    n_words = F.regexp_count(line, F.lit("[^ \\t-\\r]+"))
    symbols = F.regexp_count(line, F.lit(SYMBOLS))
    unpunctuated = (n_words < SHORT_LINE) & ~F.rlike(line, F.lit(CLOSING))
    symbolic = symbols * 10 > F.char_length(line)
    separators = F.regexp_count(line, F.lit(SEPARATOR))
    menu = ((separators >= 3) & (separators * 5 >= n_words - separators)) | F.rlike(low, F.lit(NAVIGATION))
    phrases = F.contains(low, F.lit(BOILERPLATE[0]))
    for p in BOILERPLATE[1:]:
        phrases = phrases | F.contains(low, F.lit(p))
    return ~(unpunctuated | symbolic | menu | ((n_words < 4 * SHORT_LINE) & phrases))


def split_words(text: Column) -> Column:
    """Words of a text: runs of characters outside blanks, in order."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), BLANKS + "+"), lambda w: w != "")


def quality_report(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                   keep: tuple[str, ...] = (), cleaned: bool = False) -> DataFrame:
    """One row per document: the base figures, the line verdict and ``kept``; ``keep`` names input columns to carry.
    ``cleaned`` adds ``clean_text``, the text without its failing lines, and ``removed_lines``, their numbers from 0."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    base = docs.select(F.col(f"`{id_col}`").alias("doc_id"),
                       carry(keep),
                       text.alias("t"), *([F.col(f"`{text_col}`").alias("raw")] if cleaned else []))
    if cleaned:
        every = F.transform(F.split("t", "\n"), lambda x, i: F.struct(x.alias("line"), F.lower(x).alias("low"), i.alias("i")))
        base = settle(base, every=F.transform(every, lambda x: F.struct(
            x["line"].alias("line"), x["i"].alias("i"), (F.rlike(x["line"], F.lit(NOT_BLANK)) & ~line_ok(x)).alias("bad"))))
        lines = lambda bad: F.filter("every", lambda x: x["bad"] if bad else ~x["bad"])
        base = settle(base, removed_lines=F.transform(lines(True), lambda x: x["i"]),
                      bad_chars=F.aggregate(lines(True), F.lit(0).cast("long"), lambda a, x: a + F.char_length(x["line"])),
                      clean_text=F.when(F.col("raw").isNotNull(), F.array_join(F.transform(
                          lines(False), lambda x: x["line"]), "\n"))).drop("every", "raw")
    base = settle(base, words=split_words(F.col("t")),
                  lines=F.filter(F.split(F.col("t"), "\n"), lambda x: F.rlike(x, F.lit(NOT_BLANK))))
    w = F.col("words")
    n = F.size(w)
    windows = F.when(n >= WINDOW, F.transform(
        F.sequence(F.lit(1), n - (WINDOW - 1)),
        lambda i: F.xxhash64(*[F.element_at(w, (i + k).cast("int")) for k in range(WINDOW)]))
    ).otherwise(F.array().cast("array<bigint>"))
    base = settle(base, grams=windows)
    has_repeats = F.size(F.array_distinct("grams")) < F.size("grams")
    placed = F.when(has_repeats, F.array_sort(F.transform(
        "grams", lambda g, i: F.struct(g.alias("g"), i.alias("i"))))).otherwise(
        F.array().cast("array<struct<g:bigint,i:int>>"))
    base = settle(base, placed=placed)
    p, m = F.col("placed"), F.size("placed")
    same = lambda a, b: F.get(p, a)["g"].eqNullSafe(F.get(p, b)["g"])
    starts = F.array_sort(F.transform(
        F.filter(p, lambda x, j: ((j > 0) & same(j, j - 1)) | ((j < m - 1) & same(j, j + 1))), lambda x: x["i"]))
    base = settle(base, starts=starts)
    s = F.col("starts")
    covered = F.aggregate(
        F.transform(s, lambda x, j: F.least(F.lit(WINDOW), F.coalesce(F.get(s, j + 1) - x, F.lit(WINDOW)))),
        F.lit(0).cast("long"), lambda a, x: a + x)
    line_chars = F.aggregate("lines", F.lit(0).cast("long"), lambda a, x: a + F.char_length(x))
    good_chars = line_chars - F.col("bad_chars") if cleaned else F.aggregate(
        F.filter(with_lower(F.col("lines")), line_ok), F.lit(0).cast("long"), lambda a, x: a + F.char_length(x["line"]))
    out = settle(
        base,
        n_words=n.cast("long"),
        word_chars=F.char_length(F.array_join("words", "")).cast("long"),
        n_symbols=F.regexp_count("t", F.lit(SYMBOLS)).cast("long"),
        n_dup_lines=(F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"),
        n_repeat_words=covered,
        line_chars=line_chars, good_line_chars=good_chars)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    lines_ok = 100 * (F.col("line_chars") - F.col("good_line_chars")) <= MAX_LOST_PERCENT * F.col("line_chars")
    return unpack(out.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "line_chars",
        "good_line_chars", failed.alias("base_failed"), (~failed & lines_ok).alias("kept"),
        *(("clean_text", "removed_lines") if cleaned else ()), "carried"), keep)
