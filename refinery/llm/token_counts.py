"""Token counts of whole texts by a map-side lookup in two tiers.

A text is cut into the pieces that the tokenizer encodes separately.  The length
in tokens of the frequent pieces of a bounded sample is put into a compact hash
table (open addressing over numpy arrays, the pieces' bytes in one blob) that is
broadcast; a task looks up the distinct pieces of a batch of texts in it at once.
Pieces that the table lacks are encoded by the tokenizer library and remembered
by the worker.  No piece is ever shuffled: the only job besides the scan of the
texts is the map over the sample.
"""

from __future__ import annotations

import json
import os
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame, functions as F

#: rows of the sample from which the frequent pieces are taken, on average, and characters read of each; the table
#: only saves encoding, so no count depends on it
SAMPLE_ROWS, SAMPLE_CHARS = 2000, 4000
#: pieces in the broadcast table
FREQUENT = 1 << 16
#: lengths that a worker remembers before it starts anew, and the longest piece (in characters) it remembers
REMEMBERED, LONG_PIECE = 200_000, 200
#: characters of texts whose pieces a task holds at once; longer texts are cut where no piece can span
BATCH_CHARS = 1 << 20

# Code points whose classes (letter, number, space) agree between the pattern's engine here and the
# tokenizer library.  Texts with others are cut by the library itself.
AGREED = re.compile("[^\x00-\u0557\u2000-\u208e\u20a0-\ua7cd]")
# A piece is white space, or other characters after at most one space: none goes on from a printable character to a space.
BREAK = re.compile("(?<=[!-~])(?=[ \n])")


class LengthTable:
    """Pieces and their lengths in tokens: slots of hashes, places in a blob of bytes, and lengths."""

    def __init__(self, lengths: dict[str, int]):
        names = [p.encode() for p in lengths]
        self.bits = max(4, (2 * len(names)).bit_length())
        size = 1 << self.bits
        self.blob = b"".join(names)
        self.start, self.width = np.zeros(size, np.uint32), np.zeros(size, np.uint32)
        self.hash, self.length = np.zeros(size, np.uint64), np.zeros(size, np.uint32)
        at = 0
        for name, n in zip(names, lengths.values()):
            h = xxhash.xxh3_64_intdigest(name) or 1
            slot = h & (size - 1)
            while self.hash[slot]:
                slot = (slot + 1) & (size - 1)
            self.hash[slot], self.start[slot], self.width[slot], self.length[slot] = h, at, len(name), n
            at += len(name)

    def lookup(self, pieces: list[str]) -> list[int]:
        """The length of each piece, 0 where the table lacks it."""
        names = [p.encode() for p in pieces]
        want = np.fromiter((xxhash.xxh3_64_intdigest(x) or 1 for x in names), np.uint64, len(names))
        out, mask = np.zeros(len(names), np.int64), np.uint64((1 << self.bits) - 1)
        todo, slot = np.arange(len(names)), (want & mask).astype(np.int64)
        while len(todo):
            there = self.hash[slot]
            for i, s in zip(todo[there == want[todo]].tolist(), slot[there == want[todo]].tolist()):
                first = int(self.start[s])
                if self.blob[first:first + int(self.width[s])] == names[i]:  # equal hashes don't make equal pieces
                    out[i] = self.length[s]
            go = (there != 0) & (out[todo] == 0)
            todo, slot = todo[go], (slot[go] + 1) & int(mask)
        return out.tolist()


class Pieces:
    """How one tokenizer file cuts a text into pieces that it encodes separately."""

    def __init__(self, blob: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task is one thread
        from tokenizers import Tokenizer
        spec = json.loads(blob)
        cutter = spec["pre_tokenizer"] or {}
        if spec["normalizer"] or cutter.get("type") != "ByteLevel" or cutter["add_prefix_space"] or not cutter["use_regex"]:
            raise ValueError("only byte-level tokenizers without normalizer and prefix space count by pieces")
        added = spec["added_tokens"]
        if any(a["single_word"] or a["lstrip"] or a["rstrip"] for a in added):
            raise ValueError("added tokens that take in their surroundings are not supported")
        self.library = Tokenizer.from_str(blob)
        self.library.no_truncation()
        self.library.no_padding()
        self.pattern = regex.compile(public_tokenizers.PATTERN)
        names = sorted((a["content"] for a in added), key=len, reverse=True)
        self.added = re.compile("|".join(map(re.escape, names))) if names else None

    def cut(self, text: str) -> list[str]:
        if text.isascii() or not AGREED.search(text):
            return self.pattern.findall(text)
        return [text[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(text)]

    def of(self, text: str) -> Iterator[tuple[int, list[str]]]:
        """(added tokens met, pieces) of the text, part by part."""
        parts = self.added.split(text) if self.added else [text]
        yield len(parts) - 1, []
        for part in parts:
            at = 0
            while len(part) - at > BATCH_CHARS:
                m = BREAK.search(part, at + BATCH_CHARS // 2)
                if not m:
                    break
                yield 0, self.cut(part[at:m.start()])
                at = m.start()
            yield 0, self.cut(part[at:])

    def lengths(self, pieces: list[str]) -> list[int]:
        """Tokens of each piece, by the library."""
        out = []
        for at in range(0, len(pieces), 4096):
            out += [len(e.ids) for e in self.library.encode_batch(pieces[at:at + 4096], add_special_tokens=False)]
        return out


@lru_cache(maxsize=2)
def _pieces(blob: str) -> Pieces:
    return Pieces(blob)


class Counting:
    """One task's memory of lengths, over the broadcast table."""

    def __init__(self, pieces: Pieces, table: LengthTable):
        self.pieces, self.table, self.memory = pieces, table, {}

    def _learn(self, new: list[str]) -> dict[str, int]:
        found = dict(zip(new, self.table.lookup(new)))
        missed = [p for p, n in found.items() if not n]
        found.update(zip(missed, self.pieces.lengths(missed)))
        if len(self.memory) + len(found) > REMEMBERED:
            self.memory.clear()
        self.memory.update((p, n) for p, n in found.items() if len(p) <= LONG_PIECE)
        return found

    def counts(self, texts: Iterable[str]) -> list[int]:
        out: list[int] = []
        held: list[tuple[int, list[str]]] = []
        size = 0

        def settle() -> None:
            distinct = {p for _, part in held for p in part}
            known = {p: n for p in distinct if (n := self.memory.get(p)) is not None}
            if len(known) < len(distinct):
                known |= self._learn([p for p in distinct if p not in known])
            for i, part in held:
                out[i] += sum(map(known.__getitem__, part))
            held.clear()

        for i, text in enumerate(texts):
            out.append(0)
            for added, part in self.pieces.of(text):
                out[i] += added
                held.append((i, part))
                size += sum(map(len, part))
                if size >= BATCH_CHARS:
                    settle()
                    size = 0
        settle()
        return out


def frequent(df: DataFrame, text_col: str, tokenizer: str, sample_rows: int = SAMPLE_ROWS,
             sample_chars: int = SAMPLE_CHARS, keep: int = FREQUENT) -> LengthTable:
    """The table of the most frequent pieces of a sample of about ``sample_rows`` rows.

    Tasks count the pieces of their sampled rows; the driver adds up at most ``sample_rows * sample_chars``
    characters of distinct pieces.  An empty table gives an empty one.
    """
    with open(tokenizer, encoding="utf-8") as f:
        blob = f.read()
    rows = df.count()
    if not rows:
        return LengthTable({})
    shared = df.sparkSession.sparkContext.broadcast(blob)
    sample = (df.select(F.substring(F.col(text_col), 1, sample_chars).alias("text")).where("text IS NOT NULL")
              .sample(min(1.0, sample_rows / rows), 7))

    def run(batches):
        cut, counts = _pieces(shared.value), Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                for _, part in cut.of(text):
                    counts.update(p for p in part if len(p) <= LONG_PIECE)
        yield pa.RecordBatch.from_pydict({"piece": pa.array(list(counts), pa.string()),
                                          "n": pa.array(list(counts.values()), pa.int64())})

    total: Counter[str] = Counter()
    found = sample.mapInArrow(run, "piece string, n bigint").toArrow()
    for piece, n in zip(found.column(0).to_pylist(), found.column(1).to_pylist()):
        total[piece] += n
    best = sorted(total, key=lambda p: (-total[p], p))[:keep]
    return LengthTable(dict(zip(best, _pieces(blob).lengths(best))))


def count(df: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
          table: LengthTable | None = None) -> DataFrame:
    """``id_col``, ``n_bytes`` (UTF-8) and ``n_tokens`` of every whole text, as the tokenizer library counts them.

    ``tokenizer`` is a byte-level file of that library, read by the driver and broadcast; nothing is added,
    truncated or padded, and added tokens inside a text count as one token each.  ``table`` (default:
    :func:`frequent` of ``df``) has a fixed number of entries; its content changes the time only.  A null or empty
    text has no bytes and no tokens; null ids and repeated rows are kept row by row; an empty table gives an empty
    one; other columns are left out.
    """
    with open(tokenizer, encoding="utf-8") as f:
        blob = f.read()
    sc = df.sparkSession.sparkContext
    shared = sc.broadcast((blob, table if table is not None else frequent(df, text_col, tokenizer)))
    source = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def run(batches):
        blob, known = shared.value
        counting = Counting(_pieces(blob), known)
        for batch in batches:
            texts = batch.column(1)
            sizes = pa.array([len(t.as_buffer()) for t in texts], pa.int64())
            tokens = counting.counts(t.as_py() for t in texts)
            yield pa.RecordBatch.from_arrays([batch.column(0), sizes, pa.array(tokens, pa.int64())],
                                             ["id", "n_bytes", "n_tokens"])

    kind = source.schema["id"].dataType.simpleString()
    return source.mapInArrow(run, f"id {kind}, n_bytes bigint, n_tokens bigint").withColumnRenamed("id", id_col)
