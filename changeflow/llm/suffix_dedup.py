"""Exact removal of repeated byte strings, by bucket-pointer refinement of suffixes.

A byte goes if a string of ``length`` bytes that covers it also starts anywhere else.

1. Every string has one anchor, the smallest hashed 8-gram among its first ``SPAN`` starts. That is a
   property of the string, so equal strings have their anchors at the same offset, and strings
   can be sorted by their anchors' suffixes. Strings that follow each other mostly share the anchor.
2. Initial buckets: the q bytes after an anchor that all its strings contain. A bucket with
   one suffix holds no repeated string and is done.
3. Refinement: the strings of an anchor are parted by their offset, each part extends the bytes that
   its strings have in common to later and earlier offsets, and (bucket, gram at the later
   offset, gram at the earlier one) names its new bucket, which the next round refines in the same way.
   The last round has single strings, so nothing is decided by less than all their bytes.
4. Shortcut: if also all bytes that any string of a part touches are equal to another part's,
   every string of both is repeated, without further rounds. That settles whole copies at once;
   one of them goes on for all, for the parts that share some of its strings only.

Scale: a text is shuffled once, into a table bucketed by row; later rounds join their lists to
it without moving texts. Buckets are counted with map-side combination and never gathered, so a
string that occurs in a third of all documents is one count; the join that hands counts back can be
split. A round only carries what the round before left open.

Bucket names are 64-bit hashes; a decision to remove needs two independent ones to agree.

Defined cases: null is the empty text; texts shorter than ``length`` lose nothing; each row is a document of
its own, so equal rows remove each other; a very long text is anchored in pieces.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeflow.llm.common import materialize
from changeflow.session import scratch_path

LENGTH = 400
SPAN = 256                 # starts per anchor; a power of two
PARTS = (SPAN, 16, 1)      # strings per part, round by round
_GRAM = 8
_PIECE = 1 << 20
_NODE = "row bigint, at int, lo int, hi int, core bigint, block bigint"
_name = xxhash.xxh3_64_intdigest


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def anchors(text: bytes, length: int = LENGTH) -> tuple[list[int], list[int], list[int]]:
    """(anchor, first start, last start) of each run of string starts with the same anchor."""
    at, lo = [], []
    n = len(text) - length + 1                    # string starts
    data = np.frombuffer(text, np.uint8)
    for piece in range(0, n, _PIECE):
        starts = min(_PIECE, n - piece)
        size = starts + SPAN - 1                  # gram starts that these strings look at
        grams = np.lib.stride_tricks.sliding_window_view(data[piece:piece + size + _GRAM - 1], _GRAM)
        h = np.ascontiguousarray(grams).view("<u8").ravel() * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        # Hash above, place below: equal hashes go to the leftmost.
        key = (h >> np.uint64(32) << np.uint64(32)) | np.arange(size, dtype=np.uint64)
        step = 1
        while step < SPAN:
            key = np.minimum(key[:-step], key[step:])
            step *= 2
        best = (key & np.uint64(0xFFFFFFFF)).astype(np.int64) + piece
        turn = np.flatnonzero(np.concatenate(([True], best[1:] != best[:-1])))
        new_at, new_lo = best[turn].tolist(), (turn + piece).tolist()
        if at and new_at[0] == at[-1]:            # the run goes on over the seam
            new_at, new_lo = new_at[1:], new_lo[1:]
        at += new_at
        lo += new_lo
    return at, lo, [x - 1 for x in lo[1:]] + [n - 1] if lo else []


def _block(text: bytes, at: int, slot: int, part: int, length: int) -> int:
    """Name of all bytes that strings of the part can touch, as far as the text goes."""
    a, b = max(0, at - (slot + 1) * part + 1), min(len(text), at - slot * part + length)
    return _name(text[a:b], seed=((at - a) << 20) | (b - at + length))


def first_parts(text: bytes, length: int = LENGTH) -> Iterator[tuple]:
    """(anchor, lo, hi, core, block) of every anchor: its initial bucket is named by its q bytes."""
    q = length - SPAN + 1
    if len(text) < length:
        return
    for at, lo, hi in zip(*anchors(text, length)):
        yield at, lo, hi, _signed(_name(text[at:at + q])), _signed(_block(text, at, 0, SPAN, length))


def finer_parts(text: bytes, at: int, lo: int, hi: int, core: int, part: int, finer: int,
                length: int = LENGTH) -> Iterator[tuple]:
    """The same for the parts of ``finer`` strings of a part of ``part`` strings, whose bucket is ``core``."""
    slot = (at - lo) // part
    old_a, old_b = at - slot * part, at - (slot + 1) * part + 1 + length     # the bytes in common so far
    bucket = core & ((1 << 64) - 1)
    for s in range((at - hi) // finer, (at - lo) // finer + 1):
        a, b = at - s * finer, at - (s + 1) * finer + 1 + length
        refined = _name(text[a:old_a], seed=_name(text[old_b:b], seed=bucket))
        yield (at, max(lo, at - (s + 1) * finer + 1), min(hi, a), _signed(refined),
               _signed(_block(text, at, s, finer, length)))


def _batches(rows: Iterator[tuple], types: list[pa.DataType], names: list[str], size: int = 50_000):
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names=names)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names=names)


_TYPES = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64()]
_NAMES = ["row", "at", "lo", "hi", "core", "block"]


def text_store(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(row, id, z): compressed texts under a number of their own, bucketed by it."""
    spark = docs.sparkSession
    numbered = docs.select(F.monotonically_increasing_id().alias("row"), F.col(f"`{id_col}`").alias("id"),
                           F.col(f"`{text_col}`").cast("string").alias("t"))
    id_type = numbered.schema["id"].dataType.simpleString()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        z = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            packed = [z.compress((t.as_py() or "").encode("utf-8", "surrogatepass")) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(packed, pa.binary())],
                                             names=["row", "id", "z"])

    packed = numbered.mapInArrow(pack, f"row bigint, id {id_type}, z binary")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = f"suffix_texts_{uuid.uuid4().hex}"
    packed.repartition(buckets, "row").write.bucketBy(buckets, "row").option(
        "path", scratch_path(spark, "suffix-texts")).saveAsTable(table)
    return spark.table(table)


def _settled(parts: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """Parts with repeated strings only, and the parts that the next round refines.

    Those are the open ones and, of each group of whole parts in a bucket with open ones, a single
    one that stands for all, as an open part may share strings with it.
    """
    # Counts are written before they are joined: a join with an aggregate cannot be split where a bucket is hot.
    shared = materialize(parts.groupBy("core").agg(F.count("*").alias("n")).where("n > 1").select("core"), f"{name}-shared")
    live = materialize(parts.join(shared, "core", "left_semi"), f"{name}-live")
    place = F.xxhash64("row", "at")
    equal = materialize(live.groupBy("core", "block").agg(F.count("*").alias("n"), F.min(place).alias("first")).where("n > 1"),
                        f"{name}-equal")
    marked = materialize(live.join(equal, ["core", "block"], "left").select(
        "row", "at", "lo", "hi", "core", F.col("n").isNotNull().alias("whole"), (place == F.col("first")).alias("stands")),
        f"{name}-marked")
    columns = ["row", "at", "lo", "hi", "core"]
    open_ = marked.where("not whole").select(columns)
    undecided = materialize(open_.select("core").distinct(), f"{name}-undecided")
    standing = marked.where("stands").select(columns).join(undecided, "core", "left_semi")
    return marked.where("whole").select("row", "lo", "hi"), open_.unionByName(standing)


def _finer(store: DataFrame, parts: DataFrame, part: int, finer: int, length: int) -> DataFrame:
    lists = parts.groupBy("row").agg(F.collect_list(F.struct("at", "lo", "hi", "core")).alias("parts"))

    def refine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            z = zstandard.ZstdDecompressor()
            for batch in batches:
                for row, packed, mine in zip(*(batch.column(k) for k in range(3))):
                    number, text = row.as_py(), z.decompress(packed.as_py())
                    for p in mine.as_py():
                        for found in finer_parts(text, p["at"], p["lo"], p["hi"], p["core"], part, finer, length):
                            yield (number, *found)
        yield from _batches(rows(), _TYPES, _NAMES)

    return store.select("row", "z").join(lists, "row").select("row", "z", "parts").mapInArrow(refine, _NODE)


def repeated_strings(store: DataFrame, length: int = LENGTH) -> DataFrame:
    """(row, lo, hi): starts lo to hi of the row's text begin strings that also start elsewhere."""
    def initial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            z = zstandard.ZstdDecompressor()
            for batch in batches:
                for row, packed in zip(batch.column(0), batch.column(1)):
                    number = row.as_py()
                    for found in first_parts(z.decompress(packed.as_py()), length):
                        yield (number, *found)
        yield from _batches(rows(), _TYPES, _NAMES)

    parts = store.select("row", "z").mapInArrow(initial, _NODE)
    done, found = [], None
    for k, size in enumerate(PARTS):
        whole, left = _settled(parts, f"suffix-{size}")
        done.append(whole)
        if size > 1:
            parts = _finer(store, left, size, PARTS[k + 1], length)
    for d in done:
        found = d if found is None else found.unionByName(d)
    return found


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Union of half-open spans, in order; touching ones become one."""
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def cut_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                length: int = LENGTH) -> DataFrame:
    """One row per document: (id, n_bytes, spans, kept): the removed runs and the bytes that stay."""
    if length < SPAN + _GRAM:
        raise ValueError(f"length must be at least {SPAN + _GRAM}")
    store = text_store(docs, id_col, text_col)
    found = repeated_strings(store, length).groupBy("row").agg(F.collect_list(F.struct("lo", "hi")).alias("starts"))
    id_type = store.schema["id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        z = zstandard.ZstdDecompressor()
        for batch in batches:
            sizes, spans, kept = [], [], []
            for packed, starts in zip(batch.column(1), batch.column(2)):
                text = z.decompress(packed.as_py())
                runs = merged([(s["lo"], s["hi"] + length) for s in starts.as_py() or []])
                edges = [0, *(x for run in runs for x in run), len(text)]
                sizes.append(len(text))
                spans.append([{"start": a, "stop": b} for a, b in runs])
                kept.append(b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2])))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()),
                 pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))),
                 pa.array(kept, pa.binary())], names=["id", "n_bytes", "spans", "kept"])

    rows = store.join(found, "row", "left").select("id", "z", "starts")
    return rows.mapInArrow(cut, f"id {id_type}, n_bytes bigint, spans array<struct<start:bigint,stop:bigint>>, "
                                "kept binary").withColumnRenamed("id", id_col)
