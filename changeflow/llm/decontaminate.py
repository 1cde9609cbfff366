"""Benchmark decontamination over a positional inverted index.

1. The training frequency of every benchmark term is counted over all documents.
2. In each window of ``window`` benchmark words the rarest term is the pivot. Only
   the posting lists (document, position) of pivots are needed: a window that occurs
   anywhere has its pivot there.
3. A posting and a pivot's place in an item fix the offset between the two word
   sequences. The lists of the neighbouring terms are intersected at that offset, to
   the left and to the right, which gives the exact phrase around the pivot; a run
   of at least a window is a hit.
4. A window that most of whose distinct terms stand within a few words more than a window, in any order, is a proximity
   match. If ``k`` terms may be missing, any match holds at least two of the window's ``k + 2`` rarest: the postings of
   these that another one of the same window follows within a span are all that is looked at, and no match is lost.
   Here terms are told apart by 64-bit hashes.

Scale: word counts are combined in the map tasks. Pivots are rare terms, so postings
are a small part of the corpus, and no window is paired with all documents. Postings
carry the words around them and are picked in the document's own row, so texts are never
shuffled; what picks them is a bit field of fixed size, whatever the benchmark's. A passage shared by a third of the documents costs its own postings once.

Defined cases: null and word-less texts have no words and no hits; an item without
words is no window; an item of fewer words than a window is one window; rows equal in id
and text have equal results; a repeated item id counts once, and an item without an id
marks words but is not listed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from changeflow.llm.common import ascii_lower, carry, materialize, settle, unpack

WINDOW = 10
# Letters A-Z are lower-cased after the split, so they count as word characters here.
SEPARATORS = "[\\x00-/:-@\\[-`{-\\x7F]+"
FILTER_BITS = (1 << 16, 1 << 20)      # least and most, powers of two
# A proximity match: this share of a window's distinct terms within so many words more than the window; windows of fewer
# distinct terms have none, as a few words in any order say little.
NEAR_SHARE = 0.8
NEAR_SLACK = 5
NEAR_TERMS = 5
# So many of a window's rarest terms stand in any match; with more, fewer places are looked at, by more terms.
NEAR_EVIDENCE = 2


def terms(text: Column) -> Column:
    """Lower-cased words of a text in order."""
    words = F.filter(F.split(F.coalesce(text, F.lit("")), SEPARATORS), lambda w: w != "")
    return F.transform(words, ascii_lower)


def _agreeing(a: Column, b: Column) -> Column:
    """Length of the common prefix of two arrays."""
    differs = F.array_position(F.zip_with(a, b, lambda x, y: x.eqNullSafe(y)), False)
    return F.when(differs == 0, F.greatest(F.size(a), F.size(b))).otherwise(differs - 1).cast("int")


def _before(words: Column, pos: Column, n: int) -> Column:
    """Up to ``n`` words before position ``pos``, nearest first."""
    return F.reverse(F.slice(words, F.greatest(pos - n, F.lit(0)) + 1, F.least(pos, F.lit(n))))


def _after(words: Column, pos: Column, n: int) -> Column:
    return F.slice(words, pos + 2, F.lit(n))


def term_counts(tokens: DataFrame, wanted: DataFrame) -> DataFrame:
    """Occurrences in ``tokens`` (words) of the ``wanted`` terms (term): (term, n)."""
    return tokens.select(F.explode("words").alias("term")).join(wanted, "term").groupBy("term").agg(
        F.count("*").alias("n"))


def pivots(items: DataFrame, counts: DataFrame, window: int = WINDOW) -> DataFrame:
    """(term, item_id, need, left, right): the places of the rarest term of every window all of whose terms occur."""
    placed = items.select("item_id", "words", F.size("words").alias("size"), F.posexplode("words").alias("pos", "term"))
    placed = placed.join(counts, "term", "left")
    frame = Window.partitionBy("item_id", "words").orderBy("pos").rowsBetween(0, window - 1)
    need = F.least(F.lit(window), F.col("size"))
    rarest = F.min(F.when(F.col("n").isNotNull(), F.struct("n", "pos"))).over(frame)["pos"]
    starts = placed.select("item_id", "words", need.alias("need"), rarest.alias("pivot"),
                           F.count("n").over(frame).alias("present"), "pos", "size")
    starts = starts.where((F.col("pos") <= F.col("size") - F.col("need")) & (F.col("present") == F.col("need")))
    at = starts.select("item_id", "words", "need", "pivot").distinct()
    return at.select(F.element_at("words", F.col("pivot") + 1).alias("term"), "item_id", "need",
                     _before(F.col("words"), F.col("pivot"), window - 1).alias("left"),
                     _after(F.col("words"), F.col("pivot"), window - 1).alias("right"))


def _bit_field(hashes: DataFrame, bits: int) -> Callable[[Column], Column]:
    """A test whether a hash may be among ``hashes`` (h), from a bit field of ``bits`` bits (a power of two, at least
    64). It never misses one; how many others it lets through depends on how full it is."""
    h = F.col("h").bitwiseAND(F.lit(bits - 1))
    powers = F.array(*[F.lit(1 << k if k < 63 else -(1 << 63)) for k in range(64)])
    one = F.element_at(powers, h.bitwiseAND(F.lit(63)).cast("int") + 1)
    field = ["0"] * (bits >> 6)
    for c in hashes.groupBy(F.shiftright(h, 6).alias("cell")).agg(F.bit_or(one).alias("ones")).collect():
        field[c["cell"]] = str(c["ones"])             # at most bits / 64 rows
    literal = F.split(F.lit(",".join(field)), ",").cast("array<bigint>")

    def test(h: Column) -> Column:
        h = h.bitwiseAND(F.lit(bits - 1))
        return F.getbit(F.get(literal, F.shiftright(h, 6).cast("int")), h.bitwiseAND(F.lit(63)).cast("int")) == 1
    return test


def _pivot_test(words: Column, hashes: Column, rare: DataFrame) -> Callable[[Column], Column]:
    """Whether the word at a position may be a pivot with a neighbour of its own, decided in the word's row.

    Two bit fields of bounded size, of pivots and of pivots with a neighbour; what they let through in
    addition fails the join on the term. A larger benchmark fills them up and loses nothing.
    """
    places = rare.select("term", F.get("left", F.lit(0)).alias("was"), F.get("right", F.lit(0)).alias("comes")).distinct()
    bits = _bits(places)
    term = _bit_field(places.select(F.xxhash64("term").alias("h")), bits)
    # A word without neighbours in its item needs none.
    near = _bit_field(places.select(F.explode(F.array(F.xxhash64("was", "term"), F.xxhash64("term", "comes"))).alias("h"),
                                    (F.col("was").isNotNull() | F.col("comes").isNotNull()).alias("has")).where("has").select("h"),
                      bits)
    alone = [r["term"] for r in places.where("was is null and comes is null").select("term").distinct().limit(1).collect()]

    def test(i: Column) -> Column:
        word = F.get(words, i)
        beside = near(F.xxhash64(F.get(words, i - 1), word)) | near(F.xxhash64(word, F.get(words, i + 1)))
        return term(F.get(hashes, i)) & (F.lit(True) if alone else beside)
    return test


def _bits(rows: DataFrame) -> int:
    return min(FILTER_BITS[1], max(FILTER_BITS[0], 1 << (32 * rows.count()).bit_length()))


def near_windows(items: DataFrame, counts: DataFrame, window: int = WINDOW, near_share: float = NEAR_SHARE,
                 near_slack: int = NEAR_SLACK) -> DataFrame:
    """(item_id, held, required, span, rare): the distinct terms of each window that can have a proximity match, how many of them
    must stand within ``span`` words, and those of its rarest terms that occur in the corpus at all; terms as hashes."""
    need = F.least(F.lit(window), F.size("words"))
    starts = F.sequence(F.lit(1), F.size("words") - need + 1)
    each = items.select("item_id", need.alias("need"), F.explode(F.transform(
        starts, lambda i: F.array_sort(F.array_distinct(F.slice("words", i, need))))).alias("held")).distinct()
    each = each.where(F.size("held") >= NEAR_TERMS).withColumn(
        "required", F.ceil(F.lit(near_share) * F.size("held")).cast("int")).withColumn("span", F.col("need") + near_slack)
    counted = each.select("*", F.explode("held").alias("term")).join(counts, "term", "left")
    ranked = counted.groupBy("item_id", "held", "required", "span").agg(
        F.array_sort(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "term"))).alias("by"))
    rarest = F.slice("by", F.lit(1), F.size("held") - F.col("required") + NEAR_EVIDENCE)
    absent = F.size(F.filter("by", lambda x: x["n"] == 0))
    return ranked.where(absent <= F.size("held") - F.col("required")).select(
        "item_id", F.transform("held", lambda t: F.xxhash64(t)).alias("held"), "required", "span",
        F.transform(F.filter(rarest, lambda x: x["n"] > 0), lambda x: F.xxhash64(x["term"])).alias("rare"))


def _pair(a: Column, b: Column) -> Column:
    return F.xxhash64(F.least(a, b), F.greatest(a, b))


def _near_places(hashes: Column, windows: DataFrame, reach: int) -> tuple[Callable, Callable]:
    """Tests of a position in the document's row, by bit fields: whether its word is a rare term and, among the ``places`` of
    these, whether enough others that share a window with it follow within ``reach`` words."""
    terms = windows.select(F.explode("rare").alias("h")).distinct()
    pairs = windows.select(F.explode(F.flatten(F.transform("rare", lambda a: F.transform(
        F.filter("rare", lambda b: a < b), lambda b: _pair(a, b))))).alias("h")).distinct()
    rare, beside = _bit_field(terms, _bits(terms)), _bit_field(pairs, _bits(pairs))

    def follows(i: Column, k: Column) -> Column:
        others = F.filter(F.slice("places", k + 2, F.lit(reach)),
                          lambda j: (j - i <= reach) & beside(_pair(F.get(hashes, i), F.get(hashes, j))))
        return F.size(others) >= NEAR_EVIDENCE - 1
    return lambda i: rare(F.get(hashes, i)), follows


def benchmark_matches(tokens: DataFrame, benchmark: DataFrame, *, item_col: str = "item_id", text_col: str = "text",
                      window: int = WINDOW, near_share: float = NEAR_SHARE,
                      near_slack: int = NEAR_SLACK, proximity: bool = True) -> DataFrame:
    """``tokens`` (doc, words) -> (doc, item_id, kind, first, last), one row per match.

    ``kind`` is ``phrase`` for a run of at least a window, with its first and last word position, or, in a document
    without a phrase of the item, ``near``: at least ``near_share`` of a window's distinct terms within ``near_slack`` words more than the window, with
    the position of the first rare term. Without ``proximity`` only phrases are looked for.
    """
    items = benchmark.select(F.col(f"`{item_col}`").alias("item_id"), terms(F.col(f"`{text_col}`")).alias("words"))
    items = materialize(items.where(F.size("words") > 0).distinct(), "bench-items")
    vocabulary = materialize(items.select(F.explode("words").alias("term")).distinct(), "bench-terms")
    counts = materialize(term_counts(tokens, vocabulary), "bench-counts")
    rare = materialize(pivots(items, counts, window), "bench-pivots")
    reach = window - 1 + near_slack
    # One cheap test of every word leaves the places that the others look at.
    asked, windows = rare.select(F.xxhash64("term").alias("h")), None
    if proximity:
        windows = materialize(near_windows(items, counts, window, near_share, near_slack), "bench-windows")
        asked = asked.unionByName(windows.select(F.explode("rare").alias("h")))
    asked = asked.distinct()
    may = _bit_field(asked, _bits(asked))
    words, h = F.col("words"), F.col("h")
    posted = settle(tokens, h=F.transform(words, lambda w: F.xxhash64(w)))
    every = F.filter(F.sequence(F.lit(0), F.size(h) - 1), lambda i: may(F.get(h, i)))
    posted = settle(posted, some=F.when(F.size(h) > 0, every).otherwise(F.array().cast("array<int>")))
    posted = settle(posted, at=F.filter("some", _pivot_test(words, h, rare)))
    none = F.lit(None).cast("array<bigint>")
    every_posting = F.transform("at", lambda x: F.struct(
        x.alias("pos"), F.get(words, x).alias("term"), _before(words, x, window - 1).alias("before"),
        _after(words, x, window - 1).alias("behind"), none.alias("around")))
    if proximity:
        # The hashes around a rare term; its own place among them is the last one that ``reach`` allows.
        is_rare, followed = _near_places(h, windows, reach)
        posted = settle(posted, places=F.filter("some", is_rare))
        posted = settle(posted, near_at=F.filter("places", followed))
        text = F.lit(None).cast("string")
        every_posting = F.concat(every_posting, F.transform("near_at", lambda x: F.struct(
            x.alias("pos"), text.alias("term"), F.array(text).alias("before"), F.array(text).alias("behind"),
            F.slice(h, F.greatest(x - reach, F.lit(0)) + 1, F.least(x, F.lit(reach)) + reach + 1).alias("around"))))
    postings = materialize(posted.select("doc", F.inline(every_posting)), "bench-postings")
    found = postings.where("around is null").join(rare, "term")
    found = found.select(
        "doc", "item_id", "pos", "need",
        _agreeing(F.slice("before", F.lit(1), F.size("left")), F.col("left")).alias("l"),
        _agreeing(F.slice("behind", F.lit(1), F.size("right")), F.col("right")).alias("r"))
    phrases = found.where(F.col("l") + F.col("r") + 1 >= F.col("need")).select(
        "doc", "item_id", F.lit("phrase").alias("kind"), (F.col("pos") - F.col("l")).alias("first"),
        (F.col("pos") + F.col("r")).alias("last"))
    if not proximity:
        return phrases
    around = postings.where("around is not null").select("doc", "pos", "around", F.least("pos", F.lit(reach)).alias("k"))
    around = around.withColumn("h", F.get("around", F.col("k")))
    held = around.join(windows.select("item_id", "held", "required", "span", F.explode("rare").alias("h")), "h")
    held = held.where(F.size(F.array_intersect("around", "held")) >= F.col("required"))
    starts = F.sequence(F.greatest(F.col("k") - F.col("span") + 1, F.lit(0)), F.col("k"))
    full = F.exists(starts, lambda s: F.size(F.array_intersect(F.slice("around", s + 1, F.col("span")), F.col("held")))
                    >= F.col("required"))
    near = held.where(full).select("doc", "item_id", F.lit("near").alias("kind"), F.col("pos").alias("first"), F.col("pos").alias("last"))
    phrases = materialize(phrases, "bench-phrases")
    exact = phrases.select("doc", "item_id").distinct()
    return phrases.unionByName(near.distinct().join(exact, ["doc", "item_id"], "left_anti").select(*phrases.columns))


def tokenized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc, words); ``doc`` holds the id and the text's hash, so repeated ids stay apart."""
    doc = F.struct(F.col(f"`{id_col}`").alias("id"), F.xxhash64(F.col(f"`{text_col}`")).alias("text"))
    return settle(docs.select(doc.alias("doc"), F.col(f"`{text_col}`").alias("t")), words=terms(F.col("t"))).select(
        "doc", "words")


def contamination(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", window: int = WINDOW, proximity: bool = False,
                  keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: ``id_col``, ``n_words``, ``n_hit`` (words inside an occurring window), ``n_items``,
    ``items_sha256`` (their ids, sorted as strings, comma-joined), ``contaminated`` and the ``keep`` columns. With
    ``proximity`` also ``n_near`` and ``near_sha256``: the items with a proximity match and no phrase in the document."""
    matches = benchmark_matches(tokenized(docs, id_col, text_col), benchmark, item_col=item_col, window=window,
                                proximity=proximity)
    matches = materialize(matches.distinct(), "bench-matches")
    phrases = matches.where("kind = 'phrase'").select("doc", "item_id", "first", "last")
    words = phrases.select("doc", F.explode(F.sequence("first", "last")).alias("pos")).distinct().groupBy("doc").agg(
        F.count("*").alias("n_hit"))
    ids = phrases.groupBy("doc").agg(F.collect_set(F.col("item_id").cast("string")).alias("items"))
    hits = words.join(ids, "doc").select(F.col("doc.id").alias("hit_id"), F.col("doc.text").alias("hit_text"),
                                         "n_hit", "items")
    if proximity:
        near = matches.where("kind = 'near'").groupBy("doc").agg(F.collect_set(F.col("item_id").cast("string")).alias("nears"))
        hits = words.join(ids, "doc").join(near, "doc", "full").select(
            F.col("doc.id").alias("hit_id"), F.col("doc.text").alias("hit_text"), "n_hit", "items", "nears")
    text = F.col(f"`{text_col}`")
    rows = docs.select(
        F.col(f"`{id_col}`").alias("id"), F.xxhash64(text).alias("th"),
        F.size(F.filter(F.split(F.coalesce(text, F.lit("")), SEPARATORS), lambda w: w != "")).cast("long").alias("n_words"),
        carry(keep))
    out = rows.join(hits, (F.col("th") == F.col("hit_text")) & F.col("id").eqNullSafe(F.col("hit_id")), "left")
    items = F.coalesce("items", F.array().cast("array<string>"))
    nears = F.coalesce("nears", F.array().cast("array<string>")) if proximity else None
    more = [F.size(nears).cast("long").alias("n_near"),
            F.sha2(F.array_join(F.array_sort(nears), ","), 256).alias("near_sha256")] if proximity else []
    return unpack(out.select(
        F.col("id").alias(id_col), "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort(items), ","), 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"), *more, "carried"), keep)
