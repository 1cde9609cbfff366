"""SimHash near-duplicates: fingerprints, a binary-trie self-join, components.

1. A text's fingerprint takes the majority of each bit over the hashes of its
   word shingles (computed per row with numpy inside the scan's tasks).
2. Equal fingerprints are merged before anything else, so a group of copies is
   one trie entry however large it is.
3. Two fingerprints within ``max_bits`` < 4 bits agree on at least one of four
   16-bit blocks. The entries are dealt four times, by block, each time as a
   binary trie whose root is that block. The join walks pairs of trie nodes
   together from (root, root), adds a bit to a pair's distance where the two
   branches differ, and drops the pair once the distance exceeds ``max_bits``.
4. A block that many entries share is dealt on in pairs of its sub-tries
   ``split_bits`` further down whose prefixes are near enough, so no task gets
   more than a bounded share. Every near pair still meets.
5. Each task passes on a spanning forest of the links it finds (fewer edges than
   entries, the same reachability); the components of all forests are the groups.

Defined cases: null, empty and blank texts have no words and fingerprint zero,
linked like any other; a text shorter than a shingle is one shingle; equal rows
and repeated ids keep their rows; null ids never name a component unless no other
id is reachable.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from changeflow.llm.common import materialize
from changeflow.llm.components import connected_components

SHINGLE_WORDS = 3
MAX_BITS = 3
SEED = 42
BLOCK_BITS = 16
# A block with more entries than this (some 100 MB in a task) is dealt on in pairs of sub-tries.
HOT_BLOCK = 1_000_000
SPLIT_BITS = 10
# Node pairs of up to this many comparisons are compared outright.
LEAF = 64
# Node pairs walked at a time; bounds a task's memory.
FRONTIER = 1 << 18
_CHUNK = 1 << 15
# Rows that a task gathers before it joins the whole units among them.
_HELD = 200_000


def fingerprint(text: str | None, shingle_words: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """The 64-bit SimHash of a text as an unsigned integer. ``bytes.lower`` and
    ``bytes.split`` treat exactly A-Z and space, \\t-\\r."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle_words:
        return xxhash.xxh64_intdigest(joined, seed)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[: len(words) - shingle_words + 1]
    ends = ends[shingle_words - 1:]
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for at in range(0, len(starts), _CHUNK):
        part = zip(starts[at:at + _CHUNK].tolist(), ends[at:at + _CHUNK].tolist())
        hashes = np.array([digest(joined[a:b], seed) for a, b in part], dtype=">u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    bits = (2 * ones > len(starts)).astype(np.uint8)
    return int(np.packbits(bits).view(">u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle_words: int = SHINGLE_WORDS, seed: int = SEED) -> DataFrame:
    """(id, row, fp): fp is the fingerprint's bits as a signed long, row the text's own hash."""
    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.fromiter((fingerprint(t.as_py(), shingle_words, seed) for t in batch.column(2)),
                              np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(fps.view(np.int64))],
                                             names=["id", "row", "fp"])

    text = F.col(f"`{text_col}`").cast("string")
    narrow = docs.select(F.col(f"`{id_col}`").alias("id"), F.xxhash64(text).alias("row"), text.alias("text"))
    id_type = narrow.schema["id"].dataType.simpleString()
    return narrow.mapInArrow(compute, f"id {id_type}, row bigint, fp bigint")


# ------------------------------------------------------------------ the trie join inside a task
def _flatten(labels: np.ndarray) -> np.ndarray:
    while True:
        up = labels[labels]
        if np.array_equal(up, labels):
            return labels
        labels = up


def _unite(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Merge the sets of a[i] and b[i]; labels point at the smallest member."""
    while True:
        labels = _flatten(labels)
        x, y = labels[a], labels[b]
        apart = x != y
        if not apart.any():
            return labels
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(labels, np.maximum(x, y), np.minimum(x, y))


def _compare(keys: np.ndarray, labels: np.ndarray, pairs: tuple, max_bits: int) -> np.ndarray:
    """Compare all members of small node pairs and unite those that link."""
    a_lo, a_hi, b_lo, b_hi = pairs[:4]
    wide = b_hi - b_lo
    counts = (a_hi - a_lo) * wide
    which = np.repeat(np.arange(len(counts)), counts)
    offset = np.arange(len(which)) - np.repeat(np.cumsum(counts) - counts, counts)
    i = a_lo[which] + offset // wide[which]
    j = b_lo[which] + offset % wide[which]
    near = (i < j) & (np.bitwise_count(keys[i] ^ keys[j]) <= max_bits)
    return _unite(labels, i[near], j[near]) if near.any() else labels


def trie_links(unit: np.ndarray, keys: np.ndarray, side: np.ndarray, max_bits: int = MAX_BITS) -> np.ndarray:
    """Labels (index of the smallest linked entry) after a trie self-join inside every unit.

    ``unit`` is dense from 0 and sorted, ``keys`` is sorted inside each unit. In a
    unit that pairs two sub-tries, ``side`` tells them apart and only pairs across
    are walked; elsewhere it is 0 throughout.
    """
    labels = np.arange(len(keys))
    if not len(keys):
        return labels
    low = np.uint64((1 << (64 - BLOCK_BITS)) - 1)
    path = (unit.astype(np.uint64) << np.uint64(64 - BLOCK_BITS)) | (keys & low)
    lo = np.flatnonzero(np.concatenate(([True], unit[1:] != unit[:-1])))
    hi = np.concatenate((lo[1:], [len(unit)]))
    crossing = np.add.reduceat(side, lo)
    cross = crossing > 0
    mid = np.where(cross, hi - crossing, hi)         # side 1 has the larger prefix, so it sorts last
    zero = np.zeros(len(lo), np.int8)
    # A pair across two sub-tries starts at their root: the walk itself adds up the prefix bits.
    stack = [(lo, np.where(cross, mid, hi), np.where(cross, mid, lo), hi, zero, 63 - BLOCK_BITS)]
    while stack:
        a_lo, a_hi, b_lo, b_hi, bits, depth = stack.pop()
        live = (a_hi > a_lo) & (b_hi > b_lo) & (bits <= max_bits)
        small = live & (((a_hi - a_lo) * (b_hi - b_lo) <= LEAF) | (depth < 0))
        for at in range(0, int(small.sum()), FRONTIER // LEAF):
            at = slice(at, at + FRONTIER // LEAF)
            labels = _compare(keys, labels, tuple(x[small][at] for x in (a_lo, a_hi, b_lo, b_hi)), max_bits)
        go = live & ~small
        if not go.any():
            continue
        a_lo, a_hi, b_lo, b_hi, bits = (x[go] for x in (a_lo, a_hi, b_lo, b_hi, bits))
        if len(a_lo) > FRONTIER:                     # walk one part to its end before the next
            half = len(a_lo) // 2
            for part in (slice(None, half), slice(half, None)):
                stack.append((a_lo[part], a_hi[part], b_lo[part], b_hi[part], bits[part], depth))
            continue
        bit = np.uint64(1 << depth)
        above = ~np.uint64((1 << (depth + 1)) - 1)
        a_mid = np.searchsorted(path, (path[a_lo] & above) | bit)
        b_mid = np.searchsorted(path, (path[b_lo] & above) | bit)
        a_mid, b_mid = np.minimum(a_mid, a_hi), np.minimum(b_mid, b_hi)
        same = (a_lo == b_lo) & (a_hi == b_hi)       # a node with itself has one mixed pair
        n = ~same
        parts = [(a_lo, a_mid, b_lo, b_mid, bits), (a_mid, a_hi, b_mid, b_hi, bits),
                 (a_lo, a_mid, b_mid, b_hi, bits + 1), (a_mid[n], a_hi[n], b_lo[n], b_mid[n], bits[n] + 1)]
        stack.append((*(np.concatenate(x) for x in zip(*parts)), depth - 1))
    return _flatten(labels)


def _rotated(fp, block: int):
    """The fingerprint with the given block moved to the top."""
    k = BLOCK_BITS * block
    return fp if k == 0 else F.shiftleft(fp, k).bitwiseOR(F.shiftrightunsigned(fp, 64 - k))


def _join_partition(max_bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []

        def links(rows: tuple[np.ndarray, ...]) -> pa.RecordBatch:
            unit_a, unit_b, key, side, block = rows
            new = np.concatenate(([True], (unit_a[1:] != unit_a[:-1]) | (unit_b[1:] != unit_b[:-1])))
            units = np.cumsum(new) - 1
            u, v = [], []
            edges = np.append(np.flatnonzero(new), len(units))
            for first in range(0, units[-1] + 1, 1 << BLOCK_BITS):     # unit numbers fill the top bits of a path
                last = min(first + (1 << BLOCK_BITS), units[-1] + 1)
                at = slice(edges[first], edges[last])
                labels = trie_links(units[at] - first, key[at].view(np.uint64), side[at].astype(np.int64), max_bits)
                own = np.flatnonzero(labels != np.arange(len(labels)))
                back = block[at].astype(np.uint64) * np.uint64(BLOCK_BITS)
                turn = lambda x, k: (x >> k) | np.where(k > 0, x << ((np.uint64(64) - k) & np.uint64(63)), 0)
                plain = turn(key[at].view(np.uint64), back)
                u.append(plain[own].view(np.int64))
                v.append(plain[labels[own]].view(np.int64))
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(u)), pa.array(np.concatenate(v))],
                                              names=["u", "v"])

        waiting, enough = 0, _HELD
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(tuple(c.to_numpy(zero_copy_only=False) for c in batch.columns))
            waiting += batch.num_rows
            if waiting < enough:
                continue
            rows = tuple(np.concatenate(x) for x in zip(*held))
            a, b = rows[0], rows[1]
            turns = np.flatnonzero((a[1:] != a[:-1]) | (b[1:] != b[:-1]))
            if not len(turns):                         # one large unit so far
                held, enough = [rows], 2 * waiting
                continue
            cut = turns[-1] + 1                        # the last unit may go on in the next batch
            yield links(tuple(x[:cut] for x in rows))
            held = [tuple(x[cut:] for x in rows)]
            waiting, enough = len(held[0][0]), max(_HELD, 2 * len(held[0][0]))
        if held:
            yield links(tuple(np.concatenate(x) for x in zip(*held)))
    return run


def near_links(entries: DataFrame, max_bits: int = MAX_BITS, hot_block: int = HOT_BLOCK,
               split_bits: int = SPLIT_BITS) -> DataFrame:
    """Distinct fingerprints (fp) -> edges (u, v) that connect all within ``max_bits`` bits, ``max_bits`` < 4."""
    if not 0 <= max_bits < 64 // BLOCK_BITS:
        raise ValueError(f"max_bits must be under {64 // BLOCK_BITS}")
    turned = entries.select(F.explode(F.array(*[
        F.struct(F.lit(b).alias("block"), _rotated(F.col("fp"), b).alias("key"))
        for b in range(64 // BLOCK_BITS)])).alias("e")).select("e.block", "e.key")
    # block number and its 16 bits
    turned = turned.withColumn("root", F.shiftrightunsigned("key", 64 - BLOCK_BITS) * 8 + F.col("block"))
    sizes = materialize(turned.groupBy("root").agg(F.count("*").alias("entries")).where(F.col("entries") > hot_block),
                        "simhash-hot")
    sized = turned.join(sizes, "root", "left")
    prefix = F.shiftrightunsigned("key", 64 - BLOCK_BITS - split_bits).bitwiseAND(F.lit((1 << split_bits) - 1))
    near = [x for x in range(1 << split_bits) if x.bit_count() <= max_bits]
    cells = F.when(F.col("entries").isNull(), F.array(F.lit(-1).cast("long"))).otherwise(
        F.transform(F.array(*[F.lit(x).cast("long") for x in near]), lambda x: x.bitwiseXOR(F.col("prefix"))))
    dealt = sized.withColumn("prefix", prefix).withColumn("other", F.explode(cells))
    whole = F.col("other") < 0
    dealt = dealt.select(
        "root", F.when(whole, F.lit(0).cast("long")).otherwise(
            F.least("prefix", "other") * (1 << split_bits) + F.greatest("prefix", "other") + 1).alias("cell"),
        "key", F.when(~whole & (F.col("prefix") > F.col("other")), 1).otherwise(0).cast("byte").alias("side"),
        F.col("block").cast("byte").alias("block"))
    # Keys of one root share their top bits, so signed order is the trie's order.
    dealt = dealt.repartition("root", "cell").sortWithinPartitions("root", "cell", "key")
    return dealt.mapInArrow(_join_partition(max_bits), "u bigint, v bigint")


def row_groups(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
               shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """One row per document: (id, row, fp, n_same, component): the group as its smallest linked fingerprint."""
    marked = materialize(fingerprints(docs, id_col, text_col, shingle_words), "simhash-fp")
    entries = materialize(marked.groupBy("fp").agg(F.count("*").alias("n_same")), "simhash-entries")
    groups = connected_components(near_links(entries.select("fp"), max_bits), "simhash-cc")
    # Written before it is joined, so that the join can be split where a fingerprint is hot.
    labelled = materialize(entries.join(groups, entries["fp"] == groups["node"], "left").select(
        "fp", "n_same", F.coalesce("component", "fp").alias("component")), "simhash-labels")
    return marked.join(labelled, "fp").select("id", "row", "fp", "n_same", "component")


def simhash_groups(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                   shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """One row per document: ``id_col``, ``fingerprint`` (16 hex digits), ``component_id`` (smallest id reachable
    over links of at most ``max_bits`` bits) and ``n_same`` (documents of exactly this fingerprint)."""
    rows = materialize(row_groups(docs, id_col=id_col, text_col=text_col, shingle_words=shingle_words,
                                  max_bits=max_bits), "simhash-rows")
    smallest = materialize(rows.groupBy("component").agg(F.min("id").alias("component_id")), "simhash-smallest")
    return rows.join(smallest, "component").select(
        F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id", "n_same")


def one_per_group(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                  shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs`` that stay: of each group the one with the smallest id (null last, then by text hash)."""
    rows = row_groups(docs, id_col=id_col, text_col=text_col, shingle_words=shingle_words, max_bits=max_bits)
    first = rows.groupBy("component").agg(F.min(F.struct(F.col("id").isNull().alias("unknown"), "id", "row")).alias("r"))
    key = lambda i, row: F.concat_ws(":", F.coalesce(i.cast("string"), F.lit("null")), row.cast("string"))
    stay = materialize(first.select(key(F.col("r.id"), F.col("r.row")).alias("_key")), "simhash-stay")
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("kept")
    keyed = docs.select(key(F.col(f"`{id_col}`"), F.xxhash64(F.col(f"`{text_col}`").cast("string"))).alias("_key"), whole)
    # Rows equal in id and text share a key; one of them stays, the same in every run.
    rest = [f"kept.`{f.name}`" for f in docs.schema.fields if not re.search("map<|variant", f.dataType.simpleString())]
    nth = F.row_number().over(Window.partitionBy("_key").orderBy(F.xxhash64(*rest)))
    return keyed.join(stay, "_key").withColumn("_nth", nth).where("_nth = 1").select("kept.*")
