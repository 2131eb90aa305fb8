"""Fill-in-middle transformation over a Roaring-style set of line boundaries.

The lines of a text (``[^\\n]*\\n|[^\\n]+``) end at code-point offsets.  A document's
offsets form a compressed set: those that share their upper 16 bits lie in one
container, kept as a sorted array, as a bitmap or as runs, whichever is smallest.
Containers are built while the text is read in pieces of 65,536 code points.  A
cumulative count of boundaries per container answers "where does line m end": a
binary search over the counts finds the container, a select inside it finds the
offset.  Two such selects cut the text into prefix, middle and suffix.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

CHUNK = 1 << 16
#: bytes of a bitmap container
BITMAP = CHUNK // 8
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
MARKS = (PREFIX, SUFFIX, MIDDLE)
#: characters of texts that a task holds beside their outputs at once
BATCH_CHARS = 1 << 22


class Array:
    """Sorted 16-bit values, 2 bytes each."""

    def __init__(self, values: np.ndarray):
        self.values = values.astype(np.uint16)

    def select(self, k: int) -> int:
        return int(self.values[k])


class Bitmap:
    """One bit per value, 8,192 bytes, with the count of bits before every 64-byte block."""

    def __init__(self, values: np.ndarray):
        bits = np.zeros(CHUNK, np.uint8)
        bits[values] = 1
        self.bits = np.packbits(bits, bitorder="little")
        per = np.bitwise_count(self.bits).reshape(-1, 64).sum(axis=1)
        self.before = np.concatenate(([0], np.cumsum(per)))

    def select(self, k: int) -> int:
        block = int(np.searchsorted(self.before, k, "right")) - 1
        inside = np.flatnonzero(np.unpackbits(self.bits[block * 64:block * 64 + 64], bitorder="little"))
        return block * 512 + int(inside[k - int(self.before[block])])


class Runs:
    """First value of each run of consecutive values, and the count of values before it."""

    def __init__(self, values: np.ndarray):
        at = np.flatnonzero(np.diff(values, prepend=-2) != 1)
        self.first, self.before = values[at].astype(np.uint16), at.astype(np.int32)

    def select(self, k: int) -> int:
        run = int(np.searchsorted(self.before, k, "right")) - 1
        return int(self.first[run]) + k - int(self.before[run])


def container(values: np.ndarray) -> Array | Bitmap | Runs:
    """The smallest form of one container's sorted values (all below 65,536, at least one)."""
    runs = int(np.count_nonzero(np.diff(values) != 1)) + 1
    if 4 * runs < min(2 * len(values), BITMAP):
        return Runs(values)
    return Array(values) if 2 * len(values) <= BITMAP else Bitmap(values)


class Boundaries:
    """The set of line ends of one text: the containers by their upper bits, and boundaries before each."""

    def __init__(self, text: str):
        self.high: list[int] = []
        self.parts: list[Array | Bitmap | Runs] = []
        before = [0]
        for high, values in self._ends(text):
            self.high.append(high)
            self.parts.append(container(values))
            before.append(before[-1] + len(values))
        self.before = np.array(before, np.int64)

    @staticmethod
    def _ends(text: str) -> Iterator[tuple[int, np.ndarray]]:
        """(upper bits, sorted lower bits) of the line ends: one past each line feed, and the end of an open last line.

        Offsets ``high * CHUNK .. high * CHUNK + CHUNK - 1`` ask for the characters before them.
        """
        for high in range(len(text) // CHUNK + 1 if text else 0):
            start = max(0, high * CHUNK - 1)
            part = text[start:(high + 1) * CHUNK - 1]
            codes = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), "<u4")
            ends = np.flatnonzero(codes == 10) + (start + 1 - high * CHUNK)
            if text[-1] != "\n" and len(text) // CHUNK == high:
                ends = np.append(ends, len(text) - high * CHUNK)
            if len(ends):
                yield high, ends

    def __len__(self) -> int:
        return int(self.before[-1])

    def select(self, k: int) -> int:
        """The boundary of rank ``k`` (0: the first)."""
        at = int(np.searchsorted(self.before, k, "right")) - 1
        return self.high[at] * CHUNK + self.parts[at].select(k - int(self.before[at]))

    def cut(self, units: int) -> int:
        """Code-point offset after the first ``units`` lines."""
        return self.select(units - 1) if units else 0


def draws(seed: int, key) -> list[int]:
    """The first four 8-digit groups of the hex SHA-256 of ``seed:key``, as unsigned integers (a null key: empty)."""
    digest = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
    return [int(digest[i:i + 8], 16) for i in range(0, 32, 8)]


def cuts(text: str, seed: int, key, rate: int = 100, spm: int = 50) -> tuple[int, str, int, int]:
    """(lines, form, first cut, second cut) of one text."""
    lines = Boundaries(text)
    n, (h1, h2, h3, h4) = len(lines), draws(seed, key)
    if not text or any(m in text for m in MARKS) or h3 % 100 >= rate:
        return n, "plain", 0, 0
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    return n, "spm" if h4 % 100 < spm else "psm", lines.cut(a), lines.cut(b)


def joined(text: str, form: str, a: int, b: int) -> str:
    """The text in its form, cut at the code-point offsets ``a`` and ``b``."""
    if form == "plain":
        return text
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if form == "psm":
        return f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"
    return f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"


def rebuilt(output: str, form: str) -> str:
    """The text that :func:`joined` was given, from its output and form alone.

    A transformed text holds no mark, and no mark begins as it ends, so the first occurrence of each is its own.
    """
    if form == "plain":
        return output
    first, second = (PREFIX, SUFFIX) if form == "psm" else (SUFFIX, PREFIX)
    head, _, rest = output.removeprefix(first).partition(second)
    tail, _, middle = rest.partition(MIDDLE)
    return head + middle + tail if form == "psm" else tail + middle + head


def transform(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 7, rate: int = 100,
              spm: int = 50) -> DataFrame:
    """``id_col``, ``n``, ``form``, ``first_cut``, ``second_cut``, ``output`` and ``restored`` of every whole text.

    ``n`` counts lines; the cuts are code-point offsets after the smaller and the larger of two numbers of lines
    drawn from ``seed`` and the id, null where the form is plain.  ``rate`` percent of the texts are transformed,
    ``spm`` percent of those suffix first.  A null or empty text, or one that holds a mark, is plain (empty texts
    have 0 lines).  ``restored`` is rebuilt from output and form.  Null ids draw like an empty id; repeated rows are
    returned as often as they occur; an empty table gives an empty one; other columns are left out.  Rows are
    worked on one by one inside the scan's own tasks, so nothing is shuffled and no key can be hot.
    """
    source = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def run(batches):
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            rows, held, first = [], 0, 0
            for i in range(batch.num_rows):
                text = texts[i].as_py()
                n, form, a, b = cuts(text, seed, ids[i].as_py(), rate, spm)
                out = joined(text, form, a, b)
                rows.append((n, form, *((None, None) if form == "plain" else (a, b)), out, rebuilt(out, form)))
                held += len(text)
                if held >= BATCH_CHARS or i == batch.num_rows - 1:
                    cols = [pa.array(c, t) for c, t in zip(zip(*rows), types)]
                    yield pa.RecordBatch.from_arrays([ids.slice(first, len(rows)), *cols], names)
                    rows, held, first = [], 0, i + 1

    names = ["id", "n", "form", "first_cut", "second_cut", "output", "restored"]
    types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
    kind = source.schema["id"].dataType.simpleString()
    made = source.mapInArrow(run, f"id {kind}, n bigint, form string, first_cut bigint, "
                                  "second_cut bigint, output string, restored string")
    return made.withColumnRenamed("id", id_col)
