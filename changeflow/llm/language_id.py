"""Language identification, words first.

The model counts words and character n-grams per language in labelled texts. A text's words are scored
one by one: a known word by its log frequency in each language; an unseen one by the longest of its
character n-grams that are known, from :data:`LONGEST` characters down to one, with ``<`` and ``>``
at its ends. The language with the largest sum is the prediction.

A word's score in a language is ``log((c + SMOOTHING) / (N + SMOOTHING * V))``, where c is its count there,
N the language's words and V the known words; of the n-grams of one length likewise, averaged over those
of the word that are known. ``score`` is the winner's share when the mean log frequencies per word are taken
as the languages' weights: 1 when they are far apart, 1/k when k languages can't be told apart.

Scale: the model is fitted on a bounded sample of the labelled rows, :data:`SAMPLE_CHARS` characters a
language in expectation, whole texts dealt by a hash of id and text, and counted by Spark. What is collected
is that sample's distinct words and n-grams that occur at least :data:`MIN_COUNT` times, so its size
depends on the parameter, not on the table. The broadcast model scores row by row, without a
shuffle; texts are read in slices, so a task holds one text and the counts of its distinct words.

Defined cases: words are runs of letters (and marks and apostrophes after the first), lower-cased; a null
text or one without a letter is ``und`` with score 0, and so is every text if there is nothing to learn from;
a text none of whose words has a known n-gram is given the language with most training text, with score 1/k;
ties go to that order too, then by code point. Rows with a null language teach nothing. A language is
any value of the label column, the empty text included. Other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from functools import cache
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeflow.llm.common import materialize

LONGEST = 5
SMOOTHING = 0.5
MIN_COUNT = 2
SAMPLE_CHARS = 2_000_000
UNKNOWN = "und"
HELD_TYPES = 20_000
SLICE = 1 << 20
_WORD = regex.compile(r"\p{L}[\p{L}\p{M}'’]*")


@cache
def basic_pattern() -> re.Pattern:
    """The same words among the first 65,536 characters, written out as ranges: ``re`` keeps these as a bit map."""
    def ranges(*kinds: str) -> str:
        runs = groupby(enumerate(unicodedata.category(chr(c))[0] in kinds for c in range(0x10000)), key=lambda x: x[1])
        ends = [[c for c, _ in run] for same, run in runs if same]
        return "".join(f"\\u{r[0]:04x}-\\u{r[-1]:04x}" for r in ends)

    return re.compile(f"[{ranges('L')}][{ranges('L', 'M')}'’]*")


def words_of(text: str) -> Counter:
    """Counts of the words of a text, read in slices that end at blanks."""
    found: Counter = Counter()
    at = 0
    while at < len(text):
        end = at + SLICE
        while end < len(text) and not text[end].isspace():
            end += 1
        part = text[at:end].lower()
        basic = len(part.encode("utf-16-le", "surrogatepass")) == 2 * len(part)
        found.update((basic_pattern() if basic else _WORD).findall(part))
        at = end
    return found


def grams(word: str, n: int) -> Iterator[str]:
    """The n-grams of a word between its ends; shorter words have none of that length."""
    bounded = f"<{word}>"
    return (bounded[k:k + n] for k in range(len(bounded) - n + 1) if n > 1 or 0 < k < len(bounded) - 1)


class Model:
    """Log frequencies per language of words and of n-grams by length; n-grams are looked up by 64-bit hash."""

    def __init__(self, languages: list[str], totals: dict[int, np.ndarray], counts: dict[int, tuple[list[str], np.ndarray]]):
        """``counts[n]`` has the known words (0) or n-grams and their counts, a row each; ``totals[n]`` the languages' totals."""
        self.languages = languages
        self.words = {w: k for k, w in enumerate(counts[0][0])}
        self.scores, self.keys = {}, {}
        for n, (known, c) in counts.items():
            scores = np.log(c + SMOOTHING) - np.log(totals[n] + SMOOTHING * max(1, len(known)))
            if n:
                keys = _keys(_codes("".join(known)).reshape(-1, n).T)
                order = np.argsort(keys)
                self.keys[n], scores = keys[order], scores[order]
            self.scores[n] = scores

    def predict(self, texts: pa.Array) -> list[tuple[str, float]]:
        """(language, score) of each text."""
        out, held, types = [], [], 0
        for text in texts:
            held.append(words_of(text.as_py() or ""))
            types += len(held[-1])
            if types >= HELD_TYPES:
                out += self._predict(held)
                held, types = [], 0
        return out + self._predict(held)

    def _predict(self, texts: list[Counter]) -> list[tuple[str, float]]:
        """Predictions for a few texts, given their words: one array for all of them."""
        if not self.languages or not any(texts):
            return [(UNKNOWN, 0.0)] * len(texts)
        get = self.words.get
        words = [w for found in texts for w in found]
        rows = np.array([get(w, -1) for w in words])
        times = np.fromiter((c for found in texts for c in found.values()), np.float64, len(words))
        text = np.repeat(np.arange(len(texts)), [len(found) for found in texts])
        sums, n = np.zeros((len(texts), len(self.languages))), np.zeros(len(texts))
        seen = rows >= 0
        _add(sums, text[seen], times[seen, None] * self.scores[0][rows[seen]])
        n += np.bincount(text[seen], times[seen], len(texts))
        if not seen.all():
            self._back_off([w for w, r in zip(words, rows.tolist()) if r < 0], times[~seen], text[~seen], sums, n)
        best = sums.argmax(axis=1)
        top = sums[np.arange(len(texts)), best]
        share = 1.0 / np.exp((sums - top[:, None]) / np.maximum(n, 1)[:, None]).sum(axis=1)
        return [(self.languages[b], float(x)) if found else (UNKNOWN, 0.0) for found, b, x in zip(texts, best, share)]

    def _back_off(self, words: list[str], times: np.ndarray, text: np.ndarray, sums: np.ndarray, n_words: np.ndarray) -> None:
        """Add what unseen words give: each the mean over its longest known n-grams."""
        codes = _codes("<" + "><".join(words) + ">")
        own = np.cumsum(codes == _codes("<")[0]) - 1               # the word that a character belongs to
        for n in range(LONGEST, 0, -1):
            if not len(codes):
                break
            if len(codes) < n or not len(self.keys[n]):
                continue
            # An n-gram over the border of two words holds "><", so it is not known.
            keys = _keys([codes[k:len(codes) - n + 1 + k] for k in range(n)])
            at = np.minimum(np.searchsorted(self.keys[n], keys), len(self.keys[n]) - 1)
            hit = self.keys[n][at] == keys
            whose = own[:len(keys)][hit]
            hits = np.bincount(whose, minlength=len(words))
            _add(sums, text[whose], (times[whose] / hits[whose])[:, None] * self.scores[n][at[hit]])
            n_words += np.bincount(text[hits > 0], times[hits > 0], len(n_words))
            left = hits[own] == 0
            codes, own = codes[left], own[left]


def _add(sums: np.ndarray, rows: np.ndarray, values: np.ndarray) -> None:
    """Add ``values`` to the rows of ``sums`` that ``rows``, in ascending order, names."""
    if len(rows):
        starts = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
        sums[rows[starts]] += np.add.reduceat(values, starts, axis=0)


_PLACES = np.random.default_rng(13).integers(1 << 62, (1 << 63) - 1, LONGEST, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _codes(text: str) -> np.ndarray:
    """The characters of a text as spread 64-bit numbers."""
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    c = (c + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    return c ^ (c >> np.uint64(29))


def _keys(codes) -> np.ndarray:
    """Hashes of n-grams, given their first characters, second ones and so on."""
    total = np.zeros(len(codes[0]), np.uint64)
    for c, place in zip(codes, _PLACES):
        total += c * place
    return total


def _counts(found: Counter, names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    keys = zip(*found) if found else [[] for _ in types]
    return pa.RecordBatch.from_arrays([*(pa.array(k, t) for k, t in zip(keys, types)), pa.array(found.values(), pa.int64())],
                                      names=names)


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, text) -> (lang, gram, c), added up over a few hundred texts."""
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            found: Counter = Counter()
            for lang, text in zip(*(c.slice(at, 256) for c in batch.columns)):
                lang = lang.as_py()
                for w, c in words_of(text.as_py() or "").items():
                    found[lang, w] += c
            yield _counts(found, ["lang", "gram", "c"], [pa.string(), pa.string()])


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, word, c) -> (lang, n, gram, c), added up over a batch of words."""
    for batch in batches:
        found: Counter = Counter()
        for lang, word, c in zip(*(x.to_pylist() for x in batch.columns)):
            for n in range(1, LONGEST + 1):
                for g in grams(word, n):
                    found[lang, n, g] += c
        yield _counts(found, ["lang", "n", "gram", "c"], [pa.string(), pa.int32(), pa.string()])


def fit(labelled: DataFrame, *, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id",
        sample_chars: int = SAMPLE_CHARS, min_count: int = MIN_COUNT) -> Model:
    """Learn from about ``sample_chars`` characters of each language."""
    own = labelled.select(F.col(f"`{lang_col}`").cast("string").alias("lang"), F.col(f"`{text_col}`").cast("string").alias("text"),
                          F.col(f"`{id_col}`").cast("string").alias("id")).where("lang is not null and text is not null")
    sizes = {r["lang"]: r["n"] for r in own.groupBy("lang").agg(F.sum(F.char_length("text")).alias("n")).collect()}
    languages = sorted((x for x in sizes if sizes[x]), key=lambda x: (-sizes[x], x))
    k = len(languages)
    if not k:
        return Model([], {n: np.zeros(0) for n in range(LONGEST + 1)}, {n: ([], np.zeros((0, 0))) for n in range(LONGEST + 1)})
    rates = F.create_map(*[x for lang in languages for x in (F.lit(lang), F.lit(min(1.0, sample_chars / sizes[lang])))])
    draw = F.pmod(F.xxhash64("id", F.xxhash64("text")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sample = own.where(draw < F.coalesce(F.try_element_at(rates, F.col("lang")), F.lit(0.0)))
    words = materialize(sample.select("lang", "text").mapInArrow(_count_words, "lang string, gram string, c bigint")
                        .groupBy("lang", "gram").agg(F.sum("c").alias("c")), "language-words")
    pieces = words.mapInArrow(_count_grams, "lang string, n int, gram string, c bigint")
    pieces = pieces.groupBy("lang", "n", "gram").agg(F.sum("c").alias("c"))
    counts = materialize(words.select("lang", F.lit(0).alias("n"), "gram", "c").unionByName(pieces), "language-counts")
    index = {lang: k for k, lang in enumerate(languages)}
    totals = {n: np.zeros(k) for n in range(LONGEST + 1)}
    for r in counts.groupBy("lang", "n").agg(F.sum("c").alias("c")).collect():
        totals[r["n"]][index[r["lang"]]] = r["c"]
    often = counts.groupBy("n", "gram").agg(F.sum("c").alias("all"), F.collect_list("lang").alias("langs"),
                                            F.collect_list("c").alias("by")).where(F.col("all") >= min_count)
    learned = often.orderBy("n", "gram").toArrow()                # bounded by the sample
    known = {}
    for n in range(LONGEST + 1):
        part = learned.filter(pc.equal(learned["n"], n))
        table = np.zeros((part.num_rows, k))
        row = np.repeat(np.arange(part.num_rows), pc.list_value_length(part["langs"]).to_numpy())
        lang = [index[x] for x in pc.list_flatten(part["langs"]).to_pylist()]
        table[row, lang] = pc.list_flatten(part["by"]).to_numpy()
        known[n] = (part["gram"].to_pylist(), table)
    return Model(languages, totals, known)


def identify(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``lang_pred`` and ``score`` of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    own = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            found = model.predict(batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([f[0] for f in found], pa.string()),
                                              pa.array([f[1] for f in found], pa.float64())],
                                             names=["id", "lang_pred", "score"])

    out = own.mapInArrow(run, f"id {docs.schema[id_col].dataType.simpleString()}, lang_pred string, score double")
    return out.select(F.col("id").alias(id_col), "lang_pred", "score")


def held_out(id_col: str = "doc_id", folds: int = 3, fold: int = 1) -> Column:
    """Whether a document is kept from training, by a hash of its id."""
    return F.crc32(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).cast("binary")) % folds == fold


def language_ids(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                 held: Column | None = None, **options) -> DataFrame:
    """``id_col``, ``held_out``, ``lang_pred`` and ``score`` per document, learned from those that are not held out."""
    held = held_out(id_col) if held is None else held
    model = fit(docs.where(~held), text_col=text_col, lang_col=lang_col, id_col=id_col, **options)
    packed = F.struct(F.col(f"`{id_col}`").alias("id"), held.alias("held"))
    own = docs.select(packed.alias("id"), F.col(f"`{text_col}`").alias("text"))
    out = identify(own, model, id_col="id", text_col="text")
    return out.select(F.col("id.id").alias(id_col), F.col("id.held").alias("held_out"), "lang_pred", "score")
