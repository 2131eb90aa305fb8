"""Conversation structure repair by target alignment.

A sound conversation's role initials match ``(s?(ua)+)?``.  For each feasible
length of that alternating string, Wagner-Fischer aligns the turns to it: a turn
is kept where its initial is the target's (0), reroled to user or assistant (1),
or deleted (2); a missing user or assistant turn is inserted (5); a truncated turn
costs 5 more unless it is deleted; blank and repeated turns must be deleted.  All
targets end alike, so one matrix over suffixes holds the distances of all lengths,
and a second one those that begin with ``s``.  Ukkonen's band limits both: a cell
whose turns and symbols left differ so much that deletions or insertions alone cost
more than the incumbent, a greedy repair, is never filled.  The audit of every
cheapest length is traced back, and the least one in ASCII order is the result.

Only marks of the turns reach the alignment; texts are read where the damage is
done and where the repaired turns are put out, one after the other.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
SPACE = " \t\n\x0b\x0c\r"
ENDS = (".", "!", "?")
#: conversations with more turns take the recurrence with all targets of one phase folded into one column, because a
#: matrix costs the square of their turns
LONGEST = 2000
#: repairs of mark strings that a task remembers
REMEMBERED = 50_000
FAR = np.int32(1 << 29)


# --- alignment of one conversation -----------------------------------------------------------
# A turn's mark: u, a, s or x (any other initial); upper case where its text is truncated; d where it must go.

def keep_cost(mark: str, target: str) -> int:
    """Cost of keeping or reroling a turn as ``target`` (u, a or s); ``FAR`` where that is not allowed."""
    if mark == "d" or (target == "s" and mark not in "sS"):
        return int(FAR)
    return (KEEP if mark.lower() == target else REROLE) + (TRUNCATED if mark.isupper() else 0)


def incumbent(marks: str) -> int:
    """Cost of a greedy repair: what doesn't continue the grammar is deleted, an open pair closed by an insertion."""
    cost, want, kept = 0, "su", 0
    for m in marks:
        if m in want:
            kept += m != "s"
            want = "a" if m == "u" else "u"
        else:
            cost += DELETE
    if want == "a":
        cost += INSERT
    return min(cost, DELETE * len(marks)) if kept else DELETE * len(marks)


def matrices(marks: str, bound: int) -> tuple[np.ndarray, np.ndarray]:
    """Distances of suffixes: ``plain[i, m]`` of the turns from ``i`` to the last ``m`` symbols of ``..uaua``, and
    ``led[i, m]`` to ``s`` before them; cells that cost over ``bound`` for certain stay ``FAR``."""
    n = len(marks)
    width = n + bound // INSERT + 1
    plain, led = np.full((n + 1, width), FAR), np.full((n + 1, width), FAR)
    cols = np.arange(width, dtype=np.int32)
    plain[n, :bound // INSERT + 1] = INSERT * cols[:bound // INSERT + 1]
    for i in range(n - 1, -1, -1):
        left, mark = n - i, marks[i]
        lo, hi = max(0, left - bound // DELETE), min(width, left + bound // INSERT + 1)
        best = plain[i + 1, lo:hi] + DELETE
        if mark != "d":
            at = max(lo, 1)
            cost = np.array([keep_cost(mark, "u"), keep_cost(mark, "a")], np.int32)[cols[at:hi] & 1]
            np.minimum(best[at - lo:], plain[i + 1, at - 1:hi - 1] + cost, out=best[at - lo:])
        step = INSERT * cols[lo:hi]
        plain[i, lo:hi] = np.minimum(np.minimum.accumulate(best - step) + step, FAR)
        led[i] = led[i + 1] + DELETE
        if mark in "sS":
            np.minimum(led[i], plain[i + 1] + keep_cost(mark, "s"), out=led[i])
        np.minimum(led[i], FAR, out=led[i])
    return plain, led


def traced(marks: str, plain: np.ndarray, led: np.ndarray, m: int, s: bool) -> str:
    """The least audit in ASCII order among the cheapest alignments to one target (``m`` symbols, ``s`` before them)."""
    i, n, out = 0, len(marks), []
    while i < n or m or s:
        now = led[i, m] if s else plain[i, m]
        if i < n and now == DELETE + (led if s else plain)[i + 1, m]:
            out.append("D")
            i += 1
        elif s:  # the only way to an s is a turn that has it
            out.append("K")
            i, s = i + 1, False
        elif m and now == INSERT + plain[i, m - 1]:
            out.append("I")
            m -= 1
        else:
            out.append("K" if marks[i].lower() == ("a" if m & 1 else "u") else "R")
            i, m = i + 1, m - 1
    return "".join(out)


def aligned(marks: str) -> tuple[int, str]:
    """(cost, audit) by one distance for each feasible length of the target."""
    bound = incumbent(marks)
    plain, led = matrices(marks, bound)
    best = min(int(plain[0, 0]), int(plain[0, 2::2].min(initial=FAR)), int(led[0, 2::2].min(initial=FAR)))
    lengths = [(int(m), False) for m in np.flatnonzero(plain[0] == best) if m % 2 == 0]
    lengths += [(int(m), True) for m in np.flatnonzero(led[0] == best) if m % 2 == 0 and m]
    return best, min(traced(marks, plain, led, m, s) for m, s in lengths)


def folded(marks: str) -> tuple[int, str]:
    """The same cost and audit for very long conversations: columns of one phase are one, so time is linear.

    The phases are: nothing put out, ``s`` put out, ``u`` put out, ``a`` put out.
    """
    n = len(marks)
    none, after_s, after_u, after_a = (array("i", bytes(4 * (n + 1))) for _ in range(4))
    none[n], after_s[n], after_u[n], after_a[n] = 0, 2 * INSERT, INSERT, 0
    for i in range(n - 1, -1, -1):
        u, a, s = (keep_cost(marks[i], t) for t in "uas")
        open_, closed = min(DELETE + after_u[i + 1], a + after_a[i + 1]), min(DELETE + after_a[i + 1], u + after_u[i + 1])
        after_u[i], after_a[i] = min(open_, INSERT + closed), min(closed, INSERT + open_)
        after_s[i] = min(DELETE + after_s[i + 1], u + after_u[i + 1], INSERT + after_u[i])
        none[i] = min(DELETE + none[i + 1], u + after_u[i + 1], s + after_s[i + 1], INSERT + after_u[i])
    out, i, now = [], 0, none
    while i < n or now is after_u or now is after_s:
        after = after_a if now is after_u else after_u
        target = "a" if now is after_u else "u"
        if i < n and now[i] == DELETE + now[i + 1]:
            out.append("D")
            i += 1
        elif now[i] == INSERT + after[i]:
            out.append("I")
            now = after
        elif now is none and marks[i] in "sS" and now[i] == keep_cost(marks[i], "s") + after_s[i + 1]:
            out.append("K")
            i, now = i + 1, after_s
        else:
            out.append("K" if marks[i].lower() == target else "R")
            i, now = i + 1, after
    return none[0], "".join(out)


def repaired(marks: str) -> tuple[int, str]:
    """(cost, audit) of one conversation's marks."""
    return aligned(marks) if len(marks) <= LONGEST else folded(marks)


# --- tables -----------------------------------------------------------------------------------

def damaged(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
            text_col: str = "text") -> DataFrame:
    """``conv``, ``turn``, ``role``, ``text`` and ``there`` of every row after damage by crc32(``conv:turn``) % 20.

    0 drops the row, 1 empties its text, 2 takes ``.``, ``!`` and ``?`` out of it, 3 repeats it, 4 makes its role
    user.  Nulls count as one space, but for the order and the gaps of turns, which see them as null.  A dropped
    row stays with ``there`` false and no text, so that its conversation does not vanish.
    """
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fate = F.crc32(F.concat(blank(conv_col), F.lit(":"), blank(turn_col)).cast("binary")) % 20
    one = df.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), blank(role_col).alias("role"),
                    blank(text_col).alias("text"), fate.alias("_fate"))
    text = (F.when(F.col("_fate").isin(0, 1), "").when(F.col("_fate") == 2, F.regexp_replace("text", "[.!?]", ""))
            .otherwise(F.col("text")))
    copies = F.when(F.col("_fate") == 3, F.array(F.lit(True), F.lit(True))).otherwise(F.array(F.col("_fate") != 0))
    return one.select("conv", "turn", F.when(F.col("_fate") == 4, "user").otherwise(F.col("role")).alias("role"),
                      text.alias("text"), F.explode(copies).alias("there"))


def undamaged(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
              text_col: str = "text") -> DataFrame:
    """The same columns for a table that is to be repaired as it is (nulls count as one space)."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    return df.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), blank(role_col).alias("role"),
                     blank(text_col).alias("text"), F.lit(True).alias("there"))


def _digest() -> Column:
    """16 bytes that tell the turns of a conversation apart by role and text; ties of a turn number follow them."""
    return F.unhex(F.md5(F.concat(F.col("role"), F.lit("\0"), F.col("text")).cast("binary")))


def _groups(batches) -> Iterator[tuple[object, int, pa.RecordBatch]]:
    """(conversation, does it begin here, rows) for each stretch of equal first column in sorted batches."""
    last, begun = None, False
    for batch in batches:
        ids, at = batch.column(0).to_pylist(), 0
        while at < len(ids):
            end = at
            while end < len(ids) and ids[end] == ids[at]:
                end += 1
            yield ids[at], not begun or ids[at] != last, batch.slice(at, end - at)
            last, begun, at = ids[at], True, end


def _batch(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)


class _Conversation:
    """What a task holds of one conversation: about 20 bytes a turn, no text."""

    def __init__(self, key):
        self.key, self.initials, self.faults, self.digests = key, [], bytearray(), []
        self.first = self.last = None
        self.distinct = 0

    def add(self, batch: pa.RecordBatch) -> None:
        turn, initial, state, digest, there = (batch.column(i).to_pylist() for i in range(1, 6))
        for t, c, f, d, here in zip(turn, initial, state, digest, there):
            if not here:
                continue
            if t is not None:
                self.first = t if self.first is None else self.first
                self.distinct += t != self.last
                self.last = t
            self.initials.append(c)
            self.faults.append(f)
            self.digests.append(d)

    def repeats(self) -> np.ndarray:
        """True for each turn whose role and text stand earlier in the conversation."""
        out = np.ones(len(self.digests), bool)
        if len(out):
            names = np.frombuffer(b"".join(self.digests), dtype=[("a", "<u8"), ("b", "<u8")])
            order = np.lexsort((np.arange(len(out)), names["b"], names["a"]))
            same = names[order[1:]] == names[order[:-1]]
            out[order] = np.concatenate(([False], same))
        return out

    def row(self, memory: dict[str, tuple[int, str]]) -> tuple:
        faults = np.frombuffer(bytes(self.faults), np.uint8)  # 1: blank, 2: truncated
        twice = self.repeats() & (faults != 1)
        truncated = (faults == 2) & ~twice
        known = [c if c in ("u", "a", "s") else "x" for c in self.initials]
        marks = "".join("d" if f == 1 or w else c.upper() if f == 2 else c for c, f, w in zip(known, self.faults, twice.tolist()))
        found = memory.get(marks)
        if found is None:
            if len(memory) >= REMEMBERED:
                memory.clear()
            found = repaired(marks)
            if len(marks) <= 64:
                memory[marks] = found
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(self.initials, self.initials[1:]))
        gaps = self.last - self.first + 1 - self.distinct if self.first is not None else 0
        return self.key, gaps, int((faults == 1).sum()), int(twice.sum()), int(truncated.sum()), illegal, *found


AUDIT = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]


def audits(rows: DataFrame) -> DataFrame:
    """One row per ``conv`` of :func:`damaged` or :func:`undamaged`: ``gaps``, ``blank``, ``duplicate``,
    ``truncated``, ``illegal``, ``cost`` and ``audit`` (D, I, K and R).

    Marks and 16-byte digests of the turns are sorted by conversation and turn; texts are not shuffled.  A task reads
    one conversation after the other and holds about 20 bytes for each turn of the one it is at.  A conversation
    with no turn left has zeros and an empty audit; a null id is a conversation of its own; turns with the same
    number are ordered by role, then by digest; repeated rows are turns of their own; an empty table gives an empty
    one.
    """
    end = F.rtrim(F.col("text"), F.lit(SPACE))
    state = F.when(end == "", 1).when(F.right(end, F.lit(1)).isin(*ENDS), 0).otherwise(2)
    light = rows.select("conv", "turn", F.left("role", F.lit(1)).alias("initial"), state.alias("state"),
                        _digest().alias("digest"), "there", "role")
    order = [F.asc_nulls_first("conv"), F.asc_nulls_first("turn"), F.asc("role"), F.asc("digest")]
    light = light.repartition("conv").sortWithinPartitions(*order).drop("role")

    def run(batches):
        memory: dict[str, tuple[int, str]] = {}
        held, out, id_type = None, [], None
        for key, begins, part in _groups(batches):
            id_type = part.schema.field(0).type
            if begins:
                if held is not None:
                    out.append(held.row(memory))
                held = _Conversation(key)
            held.add(part)
            if len(out) >= 4096:
                yield _batch(out, ["conv", *AUDIT], [id_type, *types])
                out = []
        if held is not None:
            out.append(held.row(memory))
        if out:
            yield _batch(out, ["conv", *AUDIT], [id_type, *types])

    kind = rows.schema["conv"].dataType.simpleString()
    types = [pa.int64()] * 6 + [pa.string()]
    return light.mapInArrow(run, f"conv {kind}, " + ", ".join(f"{c} bigint" for c in AUDIT[:-1]) + ", audit string")


class Writer:
    """Follows an audit through the turns of one conversation and tells the role that each repaired turn gets."""

    def __init__(self, audit: str):
        self.audit, self.at, self.last = audit, 0, ""

    def _next(self) -> str:
        return "assistant" if self.last == "u" else "user"

    def inserted(self) -> Iterator[str]:
        """Roles of the turns to be inserted before the next one (or after the last)."""
        while self.audit[self.at:self.at + 1] == "I":
            self.at += 1
            role = self._next()
            self.last = role[0]
            yield role

    def role(self, role: str) -> str | None:
        """The role that the next turn gets; None where it is deleted."""
        op, self.at = self.audit[self.at], self.at + 1
        if op == "D":
            return None
        role = role if op == "K" else self._next()
        self.last = role[0]
        return role


def _stream(rows: DataFrame, found: DataFrame) -> DataFrame:
    """The turns of each conversation in order, after a first row that carries its audit."""
    kind = rows.schema["conv"].dataType.simpleString()
    heads = found.select("conv", F.lit(None).cast(rows.schema["turn"].dataType).alias("turn"), F.lit("").alias("role"),
                         F.col("audit").alias("text"), F.lit(0).alias("step"), F.lit(b"").alias("digest"))
    turns = rows.where("there").select("conv", "turn", "role", "text", F.lit(1).alias("step"), _digest().alias("digest"))
    order = [F.asc_nulls_first("conv"), F.asc("step"), F.asc_nulls_first("turn"), F.asc("role"), F.asc("digest")]
    both = heads.unionByName(turns).repartition("conv").sortWithinPartitions(*order)
    return both.select(F.col("conv").cast(kind).alias("conv"), "step", "role", "text", "turn")


def turns(rows: DataFrame, found: DataFrame) -> DataFrame:
    """The repaired conversations, a row per turn: ``conv``, ``no`` (from 0), ``turn`` (null: inserted), ``role``, ``text``.

    Turns pass through a task one after the other; it holds one batch of them and one audit.
    """
    stream = _stream(rows, found)

    def run(batches):
        writer, no, out, last = None, 0, [], None
        for batch in batches:
            kinds = [batch.schema.field(i).type for i in (0, 4)]
            types = [kinds[0], pa.int64(), kinds[1], pa.string(), pa.string()]
            for key, step, role, text, turn in zip(*(c.to_pylist() for c in batch.columns)):
                for r in writer.inserted() if writer else ():
                    out.append((last, no, None, r, ""))
                    no += 1
                if step == 0:
                    writer, no, last = Writer(text), 0, key
                elif (r := writer.role(role)) is not None:
                    out.append((key, no, turn, r, text))
                    no += 1
            if out:
                yield _batch(out, names, types)
                out = []
        for r in writer.inserted() if writer else ():
            out.append((last, no, None, r, ""))
            no += 1
        if out:
            yield _batch(out, names, types)

    kinds = [rows.schema[c].dataType.simpleString() for c in ("conv", "turn")]
    names = ["conv", "no", "turn", "role", "text"]
    return stream.mapInArrow(run, f"conv {kinds[0]}, no bigint, turn {kinds[1]}, role string, text string")


def digests(rows: DataFrame, found: DataFrame) -> DataFrame:
    """``conv`` and ``sha256`` of its repaired turns as ``role:text``, joined by line feeds (none: of nothing).

    A digest of a whole conversation needs its turns in order, so they pass through one task, turn by turn.
    """
    stream = _stream(rows, found)

    def run(batches):
        writer = digest = last = id_type = None
        begun, out = False, []

        def put(role: str, text: str) -> None:
            nonlocal begun
            digest.update(f"{chr(10) if begun else ''}{role}:{text}".encode())
            begun = True

        def close() -> None:
            for r in writer.inserted():
                put(r, "")
            out.append((last, digest.hexdigest()))

        for batch in batches:
            id_type = batch.schema.field(0).type
            for key, step, role, text in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if step == 0:
                    if writer:
                        close()
                    writer, digest, last, begun = Writer(text), hashlib.sha256(), key, False
                    continue
                for r in writer.inserted():
                    put(r, "")
                if (r := writer.role(role)) is not None:
                    put(r, text)
            if out:
                yield _batch(out, ["conv", "sha256"], [id_type, pa.string()])
                out.clear()
        if writer:
            close()
            yield _batch(out, ["conv", "sha256"], [id_type, pa.string()])

    kind = rows.schema["conv"].dataType.simpleString()
    return stream.drop("turn").mapInArrow(run, f"conv {kind}, sha256 string")
