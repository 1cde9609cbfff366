"""Repair of conversations whose turns do not alternate, by aligning them to the roles they should have.

A conversation in order is aligned to target strings of role initials, ``(s?(ua)+)?``: no turns, or an
optional system turn and then user and assistant in turn. Edits are Keep (0), Rerole to user or assistant
(1), Delete (2) and Insert of an empty user or assistant turn (5). Blank and duplicate turns must
be deleted; a truncated turn that stays costs 5 more. The cheapest alignment wins, and of equally
cheap ones the one whose audit, the initials of its edits in order, is least.

Method: a Wagner-Fischer table per target length, from the nearest length outwards. The cheapest alignment so
far bounds the next ones: a length is left out, and a table's diagonals are (Ukkonen's band), when the
deletions and insertions they force cost more than that. An alignment as cheap as the incumbent is walked
through and the two audits are compared. Walking from the first turn and taking the least edit that is on a
cheapest path gives the least audit.

Long conversations: blocks of :data:`BLOCK` turns are aligned apart, against each feasible length of the
alternation from each role that may have come before, to each role that may come last. Two neighbouring
stretches combine by the role between them, cost and audit together; no audit is a proper prefix
of an equally cheap one between the same roles, so the least audit of the whole is made of
least audits. That makes the outcome independent of where blocks begin.

Scale: equal rows are counted before they are dealt, then rows are range-partitioned by
conversation and turn, so a conversation that holds a third of all rows spreads over many tasks, each of
which returns one summary per conversation of its range. Duplicates are found by hash of role and text with an aggregate
that combines map-side. Texts take no part until the end, where a conversation's turns are streamed in order
behind its audit: its hash is sequential by definition, and a task holds one turn and one audit.

Defined cases: a null role or text is one space; null turns come first, other ties go by role and by the
SHA-256 of the text; rows with a null conversation are one conversation; a role's initial is its first character, none for an
empty role; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeflow.llm.common import NOT_BLANK, arrow_batches, arrow_rows, materialize

# The costs of edits.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
ROLES = {"u": "user", "a": "assistant"}
BLOCK = 24

# What came last: nothing, the system turn, a user turn, an assistant turn.
START, SYSTEM, USER, ASSISTANT = range(4)
Audit = tuple[int, str]
Moves = dict[tuple[int, int], Audit]


class Item(NamedTuple):
    """A turn, or a run of turns that must be deleted (``initial`` None)."""
    initial: str | None
    extra: int = 0
    times: int = 1


def target(family: str, length: int) -> str:
    """The target of a length: alternating from user (``u``) or assistant (``a``), or behind a system turn (``s``)."""
    if family == "s":
        return "s" + target("u", length - 1)
    two = "ua" if family == "u" else "au"
    return (two * (length // 2 + 1))[:length]


def align(items: list[Item], goal: str, limit: int) -> Audit | None:
    """The cheapest edits of ``items`` into ``goal``, least audit first, or None if they cost over ``limit``."""
    n, size = len(items), len(goal)
    forced = sum(DELETE * x.times for x in items if x.initial is None)
    free = sum(1 for x in items if x.initial is not None)
    surplus = free - size
    least = forced + (DELETE * surplus if surplus >= 0 else -INSERT * surplus)
    if least > limit:
        return None
    slack = (limit - least) // (DELETE + INSERT)          # a diagonal further costs a deletion and an insertion
    low, high = min(0, -surplus) - slack, max(0, -surplus) + slack
    width, never = high - low + 1, limit + 1
    # rows[i][t - low]: the cost of editing items[i:] into goal[j:], j = turns that may stay before i, plus t
    rows = [[never] * (width + 1) for _ in range(n + 1)]
    before = free
    for i in range(n, -1, -1):
        item = items[i] if i < n else None
        if item is not None and item.initial is not None:
            before -= 1
        row, below = rows[i], rows[i + 1] if i < n else None
        for k in range(width - 1, -1, -1):
            j = before + low + k
            if not 0 <= j <= size:
                continue
            best = 0 if i == n and j == size else never
            if j < size and goal[j] != "s":
                best = min(best, row[k + 1] + INSERT)
            if item is not None:
                if item.initial is None:
                    best = min(best, below[k] + DELETE * item.times)
                else:
                    if k:
                        best = min(best, below[k - 1] + DELETE)
                    if j < size and (goal[j] == item.initial or goal[j] != "s"):
                        best = min(best, below[k] + item.extra + (REROLE if goal[j] != item.initial else 0))
            row[k] = best
    if not 0 <= -low < width or rows[0][-low] > limit:
        return None
    audit, i, k, before = [], 0, -low, 0
    while i < n or before + low + k < size:
        here, j, item = rows[i][k], before + low + k, items[i] if i < n else None
        kept = item is not None and item.initial is not None
        if item is not None and not kept and rows[i + 1][k] + DELETE * item.times == here:
            audit.append("D" * item.times)
            i += 1
        elif kept and k and rows[i + 1][k - 1] + DELETE == here:
            audit.append("D")
            i, k, before = i + 1, k - 1, before + 1
        elif j < size and goal[j] != "s" and rows[i][k + 1] + INSERT == here:
            audit.append("I")
            k += 1
        else:
            audit.append("K" if goal[j] == item.initial else "R")
            i, before = i + 1, before + 1
    return rows[0][-low], "".join(audit)


def cheapest(items: list[Item], family: str, first: int, step: int = 2) -> Audit | None:
    """The cheapest alignment to the family's targets of length ``first``, ``first + step`` and so on."""
    forced = sum(DELETE * x.times for x in items if x.initial is None)
    free = sum(1 for x in items if x.initial is not None)
    if family == "s" and not any(x.initial == "s" for x in items):
        return None
    given = 1 if family == "s" else 0                   # deleting all but what can't be inserted is the first incumbent
    limit = forced + DELETE * (free - given) + TRUNCATED * given + INSERT * (first - given)
    best = None

    def least(length: int) -> int:
        return forced + (DELETE * (free - length) if length <= free else INSERT * (length - free))

    longest = free + limit // INSERT if step else first
    for length in sorted(range(first, max(first, longest) + 1, step or 1), key=lambda x: (least(x), x)):
        if least(length) > limit:
            break
        found = align(items, target(family, length), limit)
        if found and (best is None or found < best):
            best, limit = found, found[0]
    return best


def moves(items: list[Item], whole: bool = False) -> Moves:
    """(role before, role last) -> the cheapest edits of a block. ``whole`` conversations start with nothing and end well."""
    gone = sum(x.times for x in items)
    zero = (DELETE * gone, "D" * gone)
    found = {(START, START): [zero],
             (START, ASSISTANT): [cheapest(items, "u", 2), cheapest(items, "s", 3)]}
    if not whole:
        from_user, two = cheapest(items, "u", 1), found[START, ASSISTANT][0]
        found |= {(START, SYSTEM): [cheapest(items, "s", 1, 0)], (START, USER): [from_user, cheapest(items, "s", 2)],
                  (SYSTEM, SYSTEM): [zero], (SYSTEM, USER): [from_user], (SYSTEM, ASSISTANT): [two],
                  (ASSISTANT, ASSISTANT): [zero, two], (ASSISTANT, USER): [from_user],
                  (USER, USER): [zero, cheapest(items, "a", 2)], (USER, ASSISTANT): [cheapest(items, "a", 1)]}
    return {k: min(x for x in v if x) for k, v in found.items() if any(v)}


def combine(a: Moves, b: Moves) -> Moves:
    """The moves of two neighbouring stretches together."""
    out: Moves = {}
    for (p, r), (cost, audit) in a.items():
        for (r2, q), (more, rest) in b.items():
            if r == r2:
                found = (cost + more, audit + rest)
                if (p, q) not in out or found < out[p, q]:
                    out[p, q] = found
    return out


class Stretch:
    """Counts and moves of neighbouring turns of one conversation, taken in order and held in a number of
    pieces that grows with the logarithm of their length."""

    def __init__(self):
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first = self.last = self.low = self.high = None
        self.items: list[Item] = []
        self.pieces: list[tuple[int, Moves]] = []
        self.block, self.blocks = 0, 0

    def add(self, turn: int | None, initial: str, copies: int, fault: str | None) -> None:
        self.meet(turn, turn, 0 if turn is None else 1, initial, initial)
        self.illegal += (copies - 1) * (initial + initial not in ("su", "ua", "au"))
        if fault in ("blank", "duplicate"):
            setattr(self, fault, getattr(self, fault) + copies)
            self.push(Item(None, 0, copies))
            return
        self.truncated += fault == "truncated"
        self.push(Item(initial, TRUNCATED if fault == "truncated" else 0))
        if copies > 1:
            self.duplicate += copies - 1
            self.push(Item(None, 0, copies - 1))

    def meet(self, low, high, turns: int, first, last) -> None:
        """Count the turn numbers and the meeting roles of what comes next."""
        if first is not None:
            if self.last is not None:
                self.illegal += self.last + first not in ("su", "ua", "au")
            self.first = first if self.first is None else self.first
            self.last = last
        if low is not None:
            self.turns += turns - (low == self.high)
            self.low = low if self.low is None else self.low
            self.high = high

    def push(self, item: Item) -> None:
        if item.initial is None and self.items and self.items[-1].initial is None:
            self.items[-1] = Item(None, 0, self.items[-1].times + item.times)
            return
        if len(self.items) >= BLOCK:
            self.close()
        self.items.append(item)

    def close(self, whole: bool = False) -> None:
        if self.items:
            found, self.items = moves(self.items, whole and not self.pieces), []
            self.put(found)

    def put(self, found: Moves) -> None:
        level = 0
        while self.pieces and self.pieces[-1][0] <= level:
            level, found = self.pieces[-1][0] + 1, combine(self.pieces.pop()[1], found)
        self.pieces.append((level, found))

    def all_moves(self, whole: bool = False) -> Moves:
        self.close(whole)
        found = self.pieces[-1][1] if self.pieces else {(START, START): (0, "")}
        for _, before in reversed(self.pieces[:-1]):
            found = combine(before, found)
        return found


def outcome(found: Moves) -> Audit:
    return min(found[k] for k in ((START, START), (START, ASSISTANT)) if k in found)


# ------------------------------------------------------------------- Spark
def damage(turns: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text") -> DataFrame:
    """Rows (conv_id, turn, role, text) with faults put in by a hash of conversation and turn: of twenty, 0 drops the row,
    1 empties its text, 2 removes its stops, 3 repeats it and 4 makes it a user's."""
    conv, turn, role, text = (F.col(f"`{c}`") for c in (conv_col, turn_col, role_col, text_col))
    blank = F.lit(" ")
    kind = F.crc32(F.concat(F.coalesce(conv.cast("string"), blank), F.lit(":"),
                            F.coalesce(turn.cast("string"), blank)).cast("binary")) % 20
    text = F.coalesce(text.cast("string"), blank)
    rows = turns.select(
        conv.alias("conv_id"), turn.alias("turn"), kind.alias("kind"),
        F.when(kind == 4, "user").otherwise(F.coalesce(role.cast("string"), blank)).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"))
    copies = F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.where("kind <> 0").select("conv_id", "turn", "role", "text", F.explode(copies).alias("_")).drop("_")


def ordered_turns(turns: DataFrame) -> DataFrame:
    """Distinct rows with ``copies`` and a position ``pos`` that follows their order, written once."""
    rows = turns.select("conv_id", F.col("turn").cast("bigint").alias("turn"),
                        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
                        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"))
    counted = rows.groupBy("conv_id", "turn", "role", "text").agg(F.count(F.lit(1)).alias("copies"))
    last = F.substring(F.rtrim(F.col("text"), F.lit(" \t\n\x0b\x0c\r")), -1, 1)
    who = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit("")), F.lit(":"), F.col("conv_id").isNull().cast("string"),
                   F.lit(":"), F.length("role").cast("string"), F.lit(":"), F.col("role"))
    marked = counted.select("*", F.sha2(F.col("text").cast("binary"), 256).alias("text_hash")).select(
        "*", F.unhex(F.sha2(F.concat_ws("\n", who, "text_hash").cast("binary"), 256)).alias("mark"),
        F.when(~F.rlike("text", F.lit(NOT_BLANK)), "blank").when(~last.isin(".", "!", "?"), "truncated").alias("fault"))
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "text_hash")]
    dealt = marked.repartitionByRange(*order).sortWithinPartitions(*order)
    return materialize(dealt.select(F.monotonically_increasing_id().alias("pos"), "conv_id", "turn", "role", "text", "copies",
                                    "mark", "fault"), "conversation-turns")


def _faults(rows: DataFrame) -> DataFrame:
    """(conv_id, pos, turn, initial, copies, fault) with duplicates told from the first row of their role and text."""
    firsts = rows.groupBy("mark").agg(F.min("pos").alias("earliest"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    later = F.coalesce(F.col("pos") > F.col("earliest"), F.lit(False))
    fault = F.when(F.col("fault") == "blank", "blank").when(later, "duplicate").otherwise(F.col("fault"))
    light = rows.select("pos", "conv_id", "turn", F.substring("role", 1, 1).alias("initial"), "copies", "mark", "fault")
    return light.join(firsts, "mark", "left").select("conv_id", "pos", "turn", "initial", "copies", fault.alias("fault"))


_COUNTS = ("blank", "duplicate", "truncated", "illegal", "turns")
_MOVE = pa.struct([("before", pa.int32()), ("last", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())])
_STRETCH = [("pos", pa.int64()), *((c, pa.int64()) for c in _COUNTS), ("low", pa.int64()), ("high", pa.int64()),
            ("first", pa.string()), ("last", pa.string()), ("moves", pa.list_(_MOVE))]
_STRETCH_SQL = ("pos bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, turns bigint, low bigint, "
                "high bigint, first string, last string, "
                "moves array<struct<before:int,last:int,cost:bigint,audit:string>>")


def _stretches(rows: Iterator[tuple]) -> Iterator[tuple]:
    """Sorted rows of a range to one summary per conversation. Only its first and last one can go on elsewhere."""
    held, conv, begin, first = None, None, None, True
    for c, pos, turn, initial, copies, fault in rows:
        if held is None or c != conv:
            if held is not None:
                yield _summary(conv, begin, held, not first)
                first = False
            held, conv, begin = Stretch(), c, pos
        held.add(turn, initial, copies, fault)
    if held is not None:
        yield _summary(conv, begin, held, False)


def _summary(conv, pos: int, s: Stretch, whole: bool) -> tuple:
    found = [{"before": p, "last": q, "cost": cost, "audit": audit} for (p, q), (cost, audit) in s.all_moves(whole).items()]
    return (conv, pos, *(getattr(s, c) for c in _COUNTS), s.low, s.high, s.first, s.last, found)


def _joined(rows: Iterator[tuple]) -> Iterator[tuple]:
    """Summaries in order to one report row per conversation."""
    held, conv = None, None

    def report() -> tuple:
        gaps = 0 if held.low is None else min(held.high - held.low + 1 - held.turns, 2**63 - 1)
        return (conv, gaps, held.blank, held.duplicate, held.truncated, held.illegal, *outcome(held.all_moves()))

    for c, _, blank, duplicate, truncated, illegal, turns, low, high, first, last, found in rows:
        if held is None or c != conv:
            if held is not None:
                yield report()
            held, conv = Stretch(), c
        held.meet(low, high, turns, first, last)
        held.blank, held.duplicate = held.blank + blank, held.duplicate + duplicate
        held.truncated, held.illegal = held.truncated + truncated, held.illegal + illegal
        held.put({(m["before"], m["last"]): (m["cost"], m["audit"]) for m in found})
    if held is not None:
        yield report()


def audits(rows: DataFrame) -> DataFrame:
    """:func:`ordered_turns` -> conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit."""
    kind = rows.schema["conv_id"].dataType.simpleString()
    dealt = _faults(rows).repartitionByRange("pos").sortWithinPartitions("pos")

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _typed(batches, _stretches, _STRETCH)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _typed(batches, _joined, [*((c, pa.int64()) for c in ("gaps", *_COUNTS[:4], "cost")), ("audit", pa.string())])

    parts = dealt.mapInArrow(summarise, f"conv_id {kind}, {_STRETCH_SQL}")
    parts = parts.repartition("conv_id").sortWithinPartitions(F.col("conv_id").asc_nulls_first(), "pos")
    return parts.mapInArrow(join, f"conv_id {kind}, gaps bigint, blank bigint, duplicate bigint, truncated bigint, "
                                  "illegal bigint, cost bigint, audit string")


def _typed(batches: Iterator[pa.RecordBatch], use, fields: list) -> Iterator[pa.RecordBatch]:
    """``use`` over the rows, its first column of the type that the input's first column has."""
    batches = iter(batches)
    ahead = next(batches, None)
    if ahead is not None:
        schema = pa.schema([("conv_id", ahead.schema.field(0).type), *fields])
        yield from arrow_batches(use(arrow_rows(_chain(ahead, batches))), schema)


def _chain(first: pa.RecordBatch, rest: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    yield first
    yield from rest


def _repaired(rows: Iterator[tuple]) -> Iterator[tuple]:
    """Each conversation's audit and then its turns, in order, to (conv, seq, role, text) and, behind its last
    turn, (conv, None, None, None)."""
    conv, audit, at, made, odd, begun = None, "", 0, 0, False, False

    def due() -> bytes:
        return ROLES["ua"[(made - odd) % 2]].encode()

    def inserted() -> Iterator[tuple]:
        nonlocal at, made
        while at < len(audit) and audit[at] == "I":
            yield conv, made, due(), b""
            at, made = at + 1, made + 1

    for c, pos, role, text, copies, found in rows:
        if pos < 0:
            if begun:
                yield from inserted()
                yield conv, None, None, None
            conv, audit, at, made, begun = c, found, 0, 0, True
            odd = (len(audit) - audit.count("D")) % 2 == 1
            continue
        for _ in range(copies):
            yield from inserted()
            edit = audit[at]
            at += 1
            if edit != "D":
                yield conv, made, (role if edit == "K" else due()), text
                made += 1
    if begun:
        yield from inserted()
        yield conv, None, None, None


def _streamed(rows: DataFrame, report: DataFrame) -> DataFrame:
    """Turns behind their conversation's audit, each conversation in order in one task."""
    turns = rows.select("conv_id", "pos", F.col("role").cast("binary").alias("role"), F.col("text").cast("binary").alias("text"),
                        "copies", F.lit(None).cast("string").alias("audit"))
    heads = report.select("conv_id", F.lit(-1).cast("bigint").alias("pos"), F.lit(None).cast("binary").alias("role"),
                          F.lit(None).cast("binary").alias("text"), F.lit(1).cast("bigint").alias("copies"), "audit")
    return turns.unionByName(heads).repartition("conv_id").sortWithinPartitions(F.col("conv_id").asc_nulls_first(), "pos")


def repaired_turns(rows: DataFrame, report: DataFrame) -> DataFrame:
    """The repaired conversations: conv_id, seq, role, text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fields = [("seq", pa.int64()), ("role", pa.binary()), ("text", pa.binary())]
        yield from _typed(batches, lambda x: (r for r in _repaired(x) if r[1] is not None), fields)

    out = _streamed(rows, report).mapInArrow(
        run, f"conv_id {rows.schema['conv_id'].dataType.simpleString()}, seq bigint, role binary, text binary")
    return out.select("conv_id", "seq", F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))


def repaired_hashes(rows: DataFrame, report: DataFrame) -> DataFrame:
    """conv_id and the SHA-256 of the repaired ``role:text`` lines."""
    def hashes(turns: Iterator[tuple]) -> Iterator[tuple]:
        digest, n = hashlib.sha256(), 0
        for conv, seq, role, text in turns:
            if seq is None:
                yield conv, digest.hexdigest()
                digest, n = hashlib.sha256(), 0
                continue
            digest.update((b"\n" if n else b"") + role + b":")
            digest.update(text)
            n += 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _typed(batches, lambda x: hashes(_repaired(x)), [("repaired_sha256", pa.string())])

    return _streamed(rows, report).mapInArrow(
        run, f"conv_id {rows.schema['conv_id'].dataType.simpleString()}, repaired_sha256 string")


def repair_report(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """One row per ``conv_id`` of ``conversations``: the counts of faults, cost and audit of its ``turns``
    (conv_id, turn, role, text) and the hash of the repaired conversation."""
    rows = ordered_turns(turns)
    report = materialize(audits(rows), "conversation-audits")
    hashes = repaired_hashes(rows, report)

    def keyed(df: DataFrame, name: str) -> DataFrame:
        return df.withColumnRenamed("conv_id", name)

    def same(a: str, b: str) -> Column:
        return F.col(a).eqNullSafe(F.col(b))

    ids = conversations.select("conv_id").distinct()
    wide = ids.join(keyed(report, "_r"), same("conv_id", "_r"), "left").join(keyed(hashes, "_h"), same("conv_id", "_h"), "left")
    counts = [F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("gaps", *_COUNTS[:4], "cost")]
    empty = hashlib.sha256().hexdigest()
    return wide.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"),
                       F.coalesce("repaired_sha256", F.lit(empty)).alias("repaired_sha256"))
