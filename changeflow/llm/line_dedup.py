"""Line deduplication by winnowing over line hashes.

A run is a sequence of consecutive lines of one document (lines without a word are
passed over) with at least ``min_words`` words. A line goes if it belongs to a run
that also starts at an earlier place, earlier document id first; so of every repeated
run the first occurrence stays and later ones are deleted, however far they extend.

1. Every line starts the shortest window of lines that reaches ``min_words``, and
   ends the shortest one that does. A run covers each of its lines by such a window,
   so these windows stand for runs of any length.
2. Winnowing: the smallest line hash of a window is its fingerprint. Two equal windows
   select the same line, so a fingerprint found at one place only rules out all windows
   that selected it, before they are shuffled.
3. The remaining places are joined on fingerprint and window. All but the first of
   each window are repeats; the windows on both sides of a shared fingerprint extend the match
   left and right up to its full length. The lines under them are deleted.

Scale: no pair of copies is ever built: a window that occurs a million times is one
aggregate row and a million joined rows. That join can be split by adaptive execution.
Hot lines are combined in the map tasks. A document's lines are sorted in one task,
which is bounded by the document.

Defined cases: null text stays null and loses nothing; an empty text has one empty line;
blank lines always stay; rows equal in id and text are one place and have
equal results; null ids come first. Line identity is a 64-bit hash of the trimmed line.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from changeflow.llm.common import WORD, carry, materialize, unpack

MIN_WORDS = 25
_TRIM = " \t\n\x0b\x0c\r"


def line_windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 min_words: int = MIN_WORDS) -> DataFrame:
    """(doc, th, a, b, window, fingerprint): the shortest windows, by their first and last line number."""
    text = F.col(f"`{text_col}`")
    lines = docs.select(F.col(f"`{id_col}`").alias("doc"), F.xxhash64(text).alias("th"),
                        F.posexplode(F.split(text, "\n")).alias("line", "content"))
    lines = lines.select("doc", "th", "line", F.xxhash64(F.trim("content", F.lit(_TRIM))).alias("h"),
                         F.regexp_count("content", F.lit(WORD)).alias("n")).where("n > 0")
    one = Window.partitionBy("doc", "th")
    # Rows equal in id and text give each line several times; it counts once.
    lines = lines.withColumn("again", F.lag("line").over(one.orderBy("line")).eqNullSafe(F.col("line")))
    lines = lines.where(~F.col("again")).drop("again")
    until = one.orderBy("line").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    lines = lines.withColumn("end", F.sum("n").over(until)).withColumn("start", F.col("end") - F.col("n"))
    ahead = one.orderBy("start").rangeBetween(0, min_words - 1)
    back = one.orderBy("end").rangeBetween(-(min_words - 1), 0)

    def window(name: str, frame) -> dict:
        return {f"{name}_a": F.min("line").over(frame), f"{name}_b": F.max("line").over(frame),
                f"{name}_w": F.xxhash64(F.collect_list("h").over(frame)), f"{name}_f": F.min("h").over(frame)}

    lines = lines.withColumns(window("x", ahead) | {"reach": F.max("end").over(ahead) - F.col("start")})
    lines = lines.withColumns(window("y", back) | {"depth": F.col("end") - F.min("start").over(back)})
    pick = lambda n, ok: F.struct(ok.alias("ok"), *[F.col(f"{n}_{c}").alias(c) for c in "abwf"])
    # A window that is shortest both ways is already there as its first line's.
    forms = F.array(pick("x", F.col("reach") >= min_words), pick("y", F.col("depth") - F.col("n") >= min_words))
    out = lines.select("doc", "th", F.explode(forms).alias("w")).where("w.ok")
    return out.select("doc", "th", F.col("w.a").alias("a"), F.col("w.b").alias("b"), F.col("w.w").alias("window"),
                      F.col("w.f").alias("fingerprint"))


def repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   min_words: int = MIN_WORDS) -> DataFrame:
    """(doc, th, gone): the numbers of the lines under later repeats, for documents that have any."""
    windows = materialize(line_windows(docs, id_col, text_col, min_words), "line-windows")
    # A fingerprint's place is the window it was selected in; one place has one hash.
    place = F.xxhash64("doc", "th", "a", "b")
    # Aggregates are written before they are joined: a join with one cannot be split where a fingerprint is hot.
    shared = windows.groupBy("fingerprint").agg(F.min(place).alias("p"), F.max(place).alias("q")).where("p <> q")
    shared = materialize(shared.select("fingerprint"), "line-shared")
    posts = materialize(windows.join(shared, "fingerprint", "left_semi"), "line-posts")
    spot = F.struct(F.col("doc").isNotNull().alias("known"), "doc", "th", "a")
    firsts = materialize(posts.groupBy("fingerprint", "window").agg(
        F.min(spot).alias("spot"), F.count("*").alias("n")).where("n > 1"), "line-firsts")
    later = posts.join(firsts, ["fingerprint", "window"]).where(spot != F.col("spot"))
    under = later.select("doc", "th", F.explode(F.sequence("a", "b")).alias("line")).distinct()
    return under.groupBy("doc", "th").agg(F.collect_list("line").alias("gone"))


def dedup_lines(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS,
                keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: ``id_col``, ``n_lines``, ``n_removed``, ``kept_text`` and the ``keep`` columns."""
    gone = repeated_lines(docs, id_col, text_col, min_words).select(
        F.col("doc").alias("gone_doc"), F.col("th").alias("gone_th"), "gone")
    text = F.col(f"`{text_col}`")
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.xxhash64(text).alias("th"), text.alias("t"),
                       carry(keep))
    rows = rows.join(gone, (F.col("th") == F.col("gone_th")) & F.col("id").eqNullSafe(F.col("gone_doc")), "left")
    lines = F.split("t", "\n")
    numbers = F.sequence(F.lit(0), F.size(lines) - 1)
    rows = rows.select("id", "t", "gone", "carried", F.coalesce(F.size(lines), F.lit(0)).alias("n"),
                       F.inline(F.array(F.struct(F.when(F.col("gone").isNotNull(), lines).alias("lines"),
                                                 F.when(F.col("gone").isNotNull(),
                                                        F.array_except(numbers, "gone")).alias("left")))))
    kept = F.array_join(F.transform("left", lambda i: F.get("lines", i)), "\n")
    return unpack(rows.select(
        F.col("id").alias(id_col), F.greatest("n", F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_removed"),
        F.when(F.col("gone").isNull(), F.col("t")).otherwise(kept).alias("kept_text"),
        "carried"), keep)
