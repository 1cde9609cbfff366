"""Language-model scores: a log-bilinear model trained by noise-contrastive estimation.

Tokens are a text's words, A-Z lower-cased, and one end. The model predicts a token's
class from the two classes before it, and the token inside its class by its count:

* frequent words (``vocabulary``) are classes of their own, all others share
  ``shapes`` classes by their last bytes;
* the context's prediction is ``R[c1] C1 + R[c2] C2``, a class scores its product with ``Q[class]`` plus a
  bias, and the softmax over all classes is computed in full, so probabilities are normalised;
* training is noise-contrastive: each token against noise classes drawn by frequency, as
  batched matrix products in numpy. Biases start at the log frequencies, so the untrained model
  is the class unigram. Every training text is used once, in ``rounds`` disjoint shares; within a
  round each task trains on its own rows and the parameters are averaged by token counts.

The base is a smoothed unigram over all training tokens.

Scale: word counts cover all training texts, combined in the tasks before the shuffle. What is
sent to every task is bounded by parameters: the model, and the ``lookup`` most frequent
words with their counts. All other words are looked up by a shuffle join on the word, once per document
and word. Parameters are averaged by Spark, per entry, so the driver only ever holds one model.

Defined cases: a null or blank text is one end token; a null id counts as the empty text for the
split; repeated rows are scored row by row; an empty table gives an empty result, and without
training rows every token is unknown.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeflow.llm.common import materialize

END = b"\n"               # no word holds a line end
VOCABULARY = 448
SHAPES = 64
DIMENSIONS = 16
ROUNDS = 3
LOOKUP = 1 << 17
BATCH = 512
# Tokens that a task works on at a time; bounds its memory.
HELD_TOKENS = 1 << 16
NOISE = 32
RATE = 0.1
# Distinct words that a task holds before it passes counts on.
HELD_WORDS = 300_000
FOLDS, HELD_OUT_FOLD = 7, 2


def fold(id_col: Column) -> Column:
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit(""))) % FOLDS


def words(text: str | None) -> list[bytes]:
    """Words of a text as UTF-8. ``bytes.lower`` and ``bytes.split`` treat exactly A-Z and space, \\t-\\r."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


# ------------------------------------------------------------------ counts
def token_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(word binary, c): how often each token occurs, the end included."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def out() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.binary()), pa.array(held.values(), pa.int64())],
                                               names=["word", "c"])
            held.clear()
            return batch

        for batch in batches:
            for text in batch.column(0):
                held.update(words(text.as_py()))
                held[END] += 1
                if len(held) >= HELD_WORDS:
                    yield out()
        if held:
            yield out()

    counted = docs.select(F.col(f"`{text_col}`").cast("string")).mapInArrow(count, "word binary, c bigint")
    return counted.groupBy("word").agg(F.sum("c").alias("c"))


# ------------------------------------------------------------------ the model
class Model:
    """Parameters of the log-bilinear model over ``n`` classes; class ``n`` stands before a text."""

    FIELDS = ("R", "Q", "b", "C1", "C2")

    def __init__(self, n: int, dimensions: int, frequency: np.ndarray, seed: int = 1):
        draw = np.random.default_rng(seed)
        small = lambda *size: (draw.standard_normal(size) * 0.1).astype(np.float32)
        self.n, self.d = n, dimensions
        self.noise = (frequency / frequency.sum()).astype(np.float64)
        self.R, self.Q = small(n + 1, dimensions), small(n, dimensions)
        self.b = np.log(self.noise).astype(np.float32)
        self.C1 = np.eye(dimensions, dtype=np.float32)
        self.C2 = np.eye(dimensions, dtype=np.float32) * np.float32(0.5)
        self.norms: np.ndarray | None = None

    def flat(self) -> np.ndarray:
        return np.concatenate([getattr(self, f).ravel() for f in self.FIELDS])

    def load(self, values: np.ndarray) -> None:
        at = 0
        for f in self.FIELDS:
            old = getattr(self, f)
            setattr(self, f, values[at:at + old.size].reshape(old.shape).astype(np.float32))
            at += old.size
        self.norms = None

    def predicted(self, c1: np.ndarray, c2: np.ndarray) -> np.ndarray:
        return self.R[c1] @ self.C1 + self.R[c2] @ self.C2

    def log_norm(self, c1: np.ndarray, c2: np.ndarray) -> np.ndarray:
        """Log of the softmax denominator for each context, kept per pair of classes: each is computed once."""
        if self.norms is None:
            self.norms = np.full((self.n + 1) ** 2, np.nan, np.float32)
        pairs = c1.astype(np.int64) * (self.n + 1) + c2
        new = np.unique(pairs[np.isnan(self.norms[pairs])])
        for at in range(0, len(new), 4096):
            part = new[at:at + 4096]
            s = self.predicted(part // (self.n + 1), part % (self.n + 1)) @ self.Q.T + self.b
            top = s.max(axis=1)
            self.norms[part] = top + np.log(np.exp(s - top[:, None]).sum(axis=1))
        return self.norms[pairs]

    def log_prob(self, c2: np.ndarray, c1: np.ndarray, w: np.ndarray) -> np.ndarray:
        """Natural log probability of each class after its context."""
        out = np.empty(len(w), np.float32)
        for at in range(0, len(w), 1 << 16):             # bounds the gathered rows
            i = slice(at, at + (1 << 16))
            out[i] = np.einsum("ij,ij->i", self.predicted(c1[i], c2[i]), self.Q[w[i]]) + self.b[w[i]]
        return out - self.log_norm(c1, c2)


class Trainer:
    """Noise-contrastive estimation by AdaGrad over minibatches."""

    def __init__(self, model: Model, noise: int = NOISE, rate: float = RATE, seed: int = 1):
        self.m, self.k, self.rate = model, noise, rate
        self.draw = np.random.default_rng(seed)
        self.sums = {f: np.full(getattr(model, f).shape, 0.1, np.float32) for f in model.FIELDS}
        self.log_noise = np.log(noise * model.noise).astype(np.float32)
        self.cumulated = np.cumsum(model.noise)

    def _scatter(self, size: int, index: np.ndarray, rows: np.ndarray) -> np.ndarray:
        return np.stack([np.bincount(index, weights=rows[:, j], minlength=size) for j in range(rows.shape[1])],
                        axis=1).astype(np.float32)

    def step(self, c2: np.ndarray, c1: np.ndarray, w: np.ndarray) -> None:
        m, size = self.m, len(w)
        r1, r2 = m.R[c1], m.R[c2]
        hat = r1 @ m.C1 + r2 @ m.C2
        noise = np.minimum(np.searchsorted(self.cumulated, self.draw.random(self.k)), m.n - 1)
        own = np.einsum("ij,ij->i", hat, m.Q[w]) + m.b[w] - self.log_noise[w]
        other = hat @ m.Q[noise].T + (m.b[noise] - self.log_noise[noise])
        up = 1 / (1 + np.exp(np.clip(own, -30, 30)))              # 1 - sigmoid
        down = -1 / (1 + np.exp(-np.clip(other, -30, 30)))
        back = up[:, None] * m.Q[w] + down @ m.Q[noise]
        q = self._scatter(m.n, w, up[:, None] * hat)
        np.add.at(q, noise, down.T @ hat)
        b = np.bincount(w, weights=up, minlength=m.n).astype(np.float32)
        np.add.at(b, noise, down.sum(axis=0))
        r = self._scatter(m.n + 1, np.concatenate((c1, c2)), np.concatenate((back @ m.C1.T, back @ m.C2.T)))
        steps = {"R": r, "Q": q, "b": b, "C1": r1.T @ back, "C2": r2.T @ back}
        for f, g in steps.items():
            g = g / np.float32(math.sqrt(size))
            self.sums[f] += g * g
            setattr(m, f, getattr(m, f) + np.float32(self.rate) * g / np.sqrt(self.sums[f]))


class Classes:
    """Maps tokens to classes: frequent words first, then shapes."""

    def __init__(self, words: list[bytes], shapes: int):
        self.words, self.shapes = words, shapes
        self.ids = {w: k for k, w in enumerate(words)}
        self.frequent = len(words)
        self.n = self.frequent + shapes

    def of(self, tokens: list[bytes]) -> np.ndarray:
        ids, base, shapes, crc = self.ids, self.frequent, self.shapes, zlib.crc32
        return np.fromiter((ids[t] if t in ids else base + crc(t[-3:]) % shapes for t in tokens), np.int64, len(tokens))

    def contexts(self, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The classes two and one before each token; ``n`` stands before the text."""
        padded = np.concatenate(([self.n, self.n], classes))
        return padded[:-2], padded[1:-1]


def train(docs: DataFrame, text_col: str, classes: Classes, frequency: np.ndarray, *, share: Column,
          rounds: int = ROUNDS, dimensions: int = DIMENSIONS) -> Model:
    """Fit the model on all ``docs``; ``share`` deals each row to one of ``rounds`` rounds."""
    spark = docs.sparkSession
    model = Model(classes.n, dimensions, frequency)
    shared = spark.sparkContext.broadcast((classes.words, classes.shapes))
    for k in range(rounds):
        start = spark.sparkContext.broadcast((model.flat(), frequency))

        def run(batches: Iterator[pa.RecordBatch], k: int = k, start=start) -> Iterator[pa.RecordBatch]:
            values, freq = start.value
            own = Classes(*shared.value)
            local = Model(own.n, dimensions, freq)
            local.load(values)
            trainer = Trainer(local, seed=1000 * k + (TaskContext.get().partitionId() if TaskContext.get() else 0))
            seen, waiting, held = 0, 0, []

            def steps(all_of_it: bool) -> None:
                nonlocal held, waiting
                c2, c1, w = (np.concatenate(x) for x in zip(*held))
                at = 0
                while len(w) - at >= (1 if all_of_it else BATCH):
                    i = slice(at, at + BATCH)
                    trainer.step(c2[i], c1[i], w[i])
                    at += BATCH
                held = [(c2[at:], c1[at:], w[at:])] if at < len(w) else []
                waiting = max(0, len(w) - at)

            for batch in batches:
                for text in batch.column(0):
                    ids = own.of([*words(text.as_py()), END])
                    held.append((*own.contexts(ids), ids))
                    seen += len(ids)
                    waiting += len(ids)
                    if waiting >= HELD_TOKENS:
                        steps(False)
            if held:
                steps(True)
            if seen:
                flat = local.flat().astype(np.float64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(len(flat))), pa.array(flat * seen), pa.array(np.full(len(flat), float(seen)))],
                    names=["i", "v", "n"])

        rows = docs.where(share == k).select(F.col(f"`{text_col}`").cast("string"))
        means = rows.mapInArrow(run, "i bigint, v double, n double").groupBy("i").agg(
            (F.sum("v") / F.sum("n")).alias("v")).toArrow()      # one model's worth of rows
        if means.num_rows:
            values = np.empty(means.num_rows, np.float64)
            values[means["i"].to_numpy()] = means["v"].to_numpy()
            model.load(values)
        start.unpersist()
    return model


# ------------------------------------------------------------------ scores
def lm_scores(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", held_out: Column | None = None,
              vocabulary: int = VOCABULARY, shapes: int = SHAPES, dimensions: int = DIMENSIONS, rounds: int = ROUNDS,
              lookup: int = LOOKUP) -> DataFrame:
    """One row per document: ``id_col``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and
    ``score`` (log10 probabilities of the text)."""
    spark = docs.sparkSession
    held_out = fold(F.col(f"`{id_col}`")) == HELD_OUT_FOLD if held_out is None else held_out
    training = docs.where(~held_out)
    counts = materialize(token_counts(training, text_col), "lm-counts")
    total = counts.agg(F.sum("c").alias("n"), F.count("*").alias("v")).first()
    n_train, n_words = total["n"] or 0, total["v"]

    # Bounded by ``lookup``: the words whose counts go to every task, down to a frequency that a histogram
    # gives (some thousand rows at most). The first ``vocabulary`` are classes.
    octave = F.floor(F.log2("c") * 64)
    least, room = None, lookup
    for r in sorted(counts.groupBy(octave.alias("bin")).count().collect(), key=lambda r: -r["bin"]):
        room -= r["count"]
        if room < 0:
            break
        least = r["bin"]
    top = [] if least is None else counts.where(octave >= least).select("word", "c").collect()
    known = {bytes(r["word"]): r["c"] for r in sorted(top, key=lambda r: (-r["c"], bytes(r["word"])))}
    known |= {END: r["c"] for r in counts.where(F.col("word") == F.lit(END)).collect()}      # a class by itself
    frequent = [w for w in known if w != END][:vocabulary - 1] + [END]
    classes = Classes(frequent, shapes)
    bounded = spark.sparkContext.broadcast((frequent, known))

    def class_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, kinds = np.zeros(classes.n, np.int64), np.zeros(classes.n, np.int64)
        for batch in batches:
            ids = classes.of(batch.column(0).to_pylist())
            sums += np.bincount(ids, weights=batch.column(1).to_numpy(), minlength=classes.n).astype(np.int64)
            kinds += np.bincount(ids, minlength=classes.n)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(classes.n)), pa.array(sums), pa.array(kinds)],
                                         names=["k", "c", "v"])

    per_class = counts.mapInArrow(class_sums, "k bigint, c bigint, v bigint").groupBy("k").agg(
        F.sum("c").alias("c"), F.sum("v").alias("v")).collect()          # one row per class
    size, kinds = np.zeros(classes.n), np.zeros(classes.n)
    for r in per_class:
        size[r["k"]], kinds[r["k"]] = r["c"], r["v"]
    share = F.floor(F.crc32(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit(""))) / FOLDS) % rounds
    model = train(training, text_col, classes, size + 1, share=share, rounds=rounds, dimensions=dimensions)

    # Inside a shape, a word's share is its smoothed count; one unknown word is allowed for.
    inside = np.zeros(classes.n)
    inside[classes.frequent:] = np.log10(size + kinds + 1)[classes.frequent:]
    fitted = spark.sparkContext.broadcast((model.flat(), size + 1, inside))
    per_token = math.log10(n_train + n_words + 1)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (frequent_words, counted), (values, frequency, in_shape) = bounded.value, fitted.value
        own = Classes(frequent_words, shapes)
        fit = Model(own.n, dimensions, frequency)
        fit.load(values)
        logs = {w: math.log10(c + 1) for w, c in counted.items()}
        part = TaskContext.get().partitionId() if TaskContext.get() else 0
        row = part << 40
        kinds_out = (pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(),
                     pa.list_(pa.struct([("word", pa.binary()), ("m", pa.int64())])))

        def scored_rows(tokens: list[list[bytes]]) -> Iterator[tuple]:
            classes_of = [own.of(t) for t in tokens]
            before = [own.contexts(k) for k in classes_of]
            flat = np.concatenate(classes_of)
            by_class = fit.log_prob(np.concatenate([b[0] for b in before]), np.concatenate([b[1] for b in before]), flat)
            by_class = by_class.astype(np.float64) / math.log(10) - in_shape[flat]
            ends = np.cumsum([len(t) for t in tokens])
            sums = np.add.reduceat(by_class, np.concatenate(([0], ends[:-1])))
            for k, t in enumerate(tokens):
                base = shaped = 0.0
                n_known, rest = 0, {}
                for w, m in Counter(t).items():
                    if w in logs:
                        n_known += m
                        base += m * logs[w]
                        if w not in own.ids:
                            shaped += m * logs[w]
                    else:
                        rest[w] = m
                yield len(t), n_known, base, float(sums[k]) + shaped, [{"word": w, "m": m} for w, m in rest.items()]

        for batch in batches:
            at = 0
            while at < batch.num_rows:                 # a few texts at a time, by their tokens
                tokens, size = [], 0
                while at + len(tokens) < batch.num_rows and size < HELD_TOKENS:
                    tokens.append([*words(batch.column(2)[at + len(tokens)].as_py()), END])
                    size += len(tokens[-1])
                columns = list(zip(*((row + k, *r) for k, r in enumerate(scored_rows(tokens)))))
                done = batch.slice(at, len(tokens))
                yield pa.RecordBatch.from_arrays(
                    [done.column(0), done.column(1), *(pa.array(c, k) for c, k in zip(columns, kinds_out))],
                    names=["id", "held_out", "row", "n_tokens", "n_known", "base", "score", "rest"])
                at += len(tokens)
                row += len(tokens)

    narrow = docs.select(F.col(f"`{id_col}`").alias("id"), held_out.alias("held_out"),
                         F.col(f"`{text_col}`").cast("string").alias("text"))
    id_type = narrow.schema["id"].dataType.simpleString()
    # Row numbers are made once: later steps read the written table.
    scored = materialize(narrow.mapInArrow(
        score, f"id {id_type}, held_out boolean, row bigint, n_tokens bigint, n_known bigint, base double, score double, "
               "rest array<struct<word:binary,m:bigint>>"), "lm-scored")
    rest = scored.select("row", F.inline("rest")).join(counts, "word").groupBy("row").agg(
        F.sum("m").alias("more_known"), F.sum(F.col("m") * F.log10(F.col("c") + 1)).alias("more"))
    out = scored.drop("rest").join(rest, "row", "left")
    more = F.coalesce("more", F.lit(0.0))
    return out.select(
        F.col("id").alias(id_col), "held_out", "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", F.lit(0))).cast("long").alias("n_known"),
        F.lit(n_train).cast("long").alias("train_tokens"),
        (F.col("base") + more - F.col("n_tokens") * per_token).alias("base_score"),
        (F.col("score") + more).alias("score"))
