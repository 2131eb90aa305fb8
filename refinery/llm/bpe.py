"""Byte-level BPE encoding and decoding over length-bucketed numpy matrices.

A text is cut by the tokenizer's pattern; each distinct piece is encoded once
per task.  Pieces of similar length form one padded matrix of token ids.  In
every round each row merges its leftmost pair of minimum rank; ranks come from
an open-addressed hash table of (left id, right id), the row closes the gap, and
only the two pairs beside the merge are looked up again.  Rows without a pair
left leave the matrix.  Pieces beyond the widest bucket would cost the square of
their length there, so they take the same merges from a heap over a linked list.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

NO_RANK = np.int32(2**31 - 1)
WIDEST = 256
#: distinct pieces that a task remembers before it starts anew (bounds its memory)
REMEMBERED = 200_000
#: texts above this length are cut piece by piece instead of into one list
LONG_TEXT = 1 << 20


class Vocabulary:
    """Token bytes, single-byte ids and the hashed pair table of one ranks file."""

    def __init__(self, blob: bytes):
        self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, blob.splitlines()) if a}
        self.tokens: list[bytes] = [b""] * (max(self.ranks.values()) + 1)
        for tok, r in self.ranks.items():
            self.tokens[r] = tok
        self.bytes = np.array([self.ranks[bytes([i])] for i in range(256)], np.int32)
        pairs = np.fromiter((x for t, r in self.ranks.items() for i in range(1, len(t))
                             if t[:i] in self.ranks and t[i:] in self.ranks
                             for x in (self.ranks[t[:i]], self.ranks[t[i:]], r)), np.int64)
        left, right, rank = pairs.reshape(-1, 3).T
        self.bits = max(4, int(2 * len(rank)).bit_length())
        self.mask = np.int64((1 << self.bits) - 1)
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.vals = np.full(1 << self.bits, NO_RANK, np.int32)
        keys, vals = left << 32 | right, rank.astype(np.int32)
        slot = self._slot(keys)
        while len(keys):  # each free slot goes to the first key that asks for it; the others step on
            free = self.keys[slot] == -1
            first = np.zeros(len(keys), bool)
            _, at = np.unique(slot[free], return_index=True)
            first[np.flatnonzero(free)[at]] = True
            self.keys[slot[first]], self.vals[slot[first]] = keys[first], vals[first]
            keys, vals, slot = keys[~first], vals[~first], (slot[~first] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each adjacent pair (NO_RANK: no such token, or a padding id on either side)."""
        out = np.full(left.shape, NO_RANK, np.int32)
        todo = np.flatnonzero((left >= 0) & (right >= 0))
        keys = left.ravel()[todo].astype(np.int64) << 32 | right.ravel()[todo].astype(np.int64)
        slot, flat = self._slot(keys), out.ravel()
        while len(todo):
            there = self.keys[slot]
            hit = there == keys
            flat[todo[hit]] = self.vals[slot[hit]]
            go = ~hit & (there != -1)
            todo, keys, slot = todo[go], keys[go], (slot[go] + 1) & self.mask
        return flat.reshape(left.shape)

    def _matrix(self, pieces: list[bytes], width: int) -> list[bytes]:
        ids = np.full((len(pieces), width), -1, np.int32)
        for row, p in zip(ids, pieces):
            row[:len(p)] = self.bytes[np.frombuffer(p, np.uint8)]
        done: list[bytes] = [b""] * len(pieces)
        ranks = np.full((len(pieces), width), NO_RANK, np.int32)
        ranks[:, :-1] = self.pair_ranks(ids[:, :-1], ids[:, 1:])
        which, cols = np.arange(len(pieces)), np.arange(width)
        while len(which):
            at = ranks.argmin(axis=1)  # leftmost of the minimum
            rows = np.arange(len(which))
            best = ranks[rows, at]
            for i in np.flatnonzero(best == NO_RANK):
                done[which[i]] = ids[i][ids[i] >= 0].astype("<u4").tobytes()
            go = best != NO_RANK
            which, ids, ranks, at, best = which[go], ids[go], ranks[go], at[go], best[go]
            if not len(which):
                break
            rows = np.arange(len(which))
            shift = np.minimum(cols[None, :] + (cols[None, :] > at[:, None]), width - 1)
            ids = np.take_along_axis(ids, shift, 1)
            ids[:, -1] = -1
            ranks = np.take_along_axis(ranks, shift, 1)
            ranks[:, -1] = NO_RANK
            ids[rows, at] = best
            last = at + 1 < width
            ranks[rows[last], at[last]] = self.pair_ranks(ids[rows[last], at[last]], ids[rows[last], at[last] + 1])
            before = at > 0
            ranks[rows[before], at[before] - 1] = self.pair_ranks(ids[rows[before], at[before] - 1],
                                                                  ids[rows[before], at[before]])
        return done

    def _heap(self, piece: bytes) -> bytes:
        """The same merges for a very long piece, in n log n steps."""
        rank, tokens, n = self.ranks.get, self.tokens, len(piece)
        ids = self.bytes[np.frombuffer(piece, np.uint8)].tolist()
        nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, ids[i], ids[i + 1]) for i in range(n - 1) if (r := rank(piece[i:i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = nxt[i] if ids[i] == a else n
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], ids[j], nxt[i] = r, -1, nxt[j]
            if nxt[i] < n:
                prv[nxt[i]] = i
            for x in (prv[i], i):
                if x >= 0 and nxt[x] < n and (q := rank(tokens[ids[x]] + tokens[ids[nxt[x]]])) is not None:
                    heapq.heappush(heap, (q, x, ids[x], ids[nxt[x]]))
        return np.array([x for x in ids if x >= 0], "<u4").tobytes()

    def encode_pieces(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of each piece as little-endian unsigned 32-bit integers."""
        out: list[bytes] = [b""] * len(pieces)
        buckets: dict[int, list[int]] = {}
        for i, p in enumerate(pieces):
            r = self.ranks.get(p)
            if r is not None:
                out[i] = r.to_bytes(4, "little")
            elif len(p) > WIDEST:
                out[i] = self._heap(p)
            elif p:
                buckets.setdefault(max(4, 1 << (len(p) - 1).bit_length()), []).append(i)
        for width, members in buckets.items():
            step = max(1, (1 << 20) // width)
            for at in range(0, len(members), step):
                part = members[at:at + step]
                for i, ids in zip(part, self._matrix([pieces[i] for i in part], width)):
                    out[i] = ids
        return out


@lru_cache(maxsize=2)
def _vocabulary(blob: bytes) -> Vocabulary:
    return Vocabulary(blob)


def _pieces(cut, texts: list[str]) -> Iterator[tuple[int, list[str]]]:
    for i, t in enumerate(texts):
        if len(t) < LONG_TEXT:
            yield i, cut.findall(t)
        else:
            found = (m.group() for m in cut.finditer(t))
            while part := list(islice(found, LONG_TEXT)):
                yield i, part


def _encode_texts(vocab: Vocabulary, cut, memory: dict[str, bytes], texts: list[str]) -> list[bytes]:
    out: list[list[bytes]] = [[] for _ in texts]
    held: list[tuple[int, list[str]]] = []
    size = 0

    def settle() -> None:
        new = {p for _, part in held for p in part if p not in memory}
        if new:
            if len(memory) + len(new) > REMEMBERED:
                memory.clear()
                new = {p for _, part in held for p in part}
            names = list(new)
            memory.update(zip(names, vocab.encode_pieces([p.encode() for p in names])))
        for i, part in held:
            out[i].append(b"".join(map(memory.__getitem__, part)))
        held.clear()

    for i, part in _pieces(cut, texts):
        held.append((i, part))
        size += len(part)
        if size >= 200_000:
            settle()
            size = 0
    settle()
    return [b"".join(x) for x in out]


def _decoded(vocab: Vocabulary, ids: bytes) -> bytes:
    return b"".join(map(vocab.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def encode(df: DataFrame, id_col: str, text_col: str, vocabulary: str, pattern: str) -> DataFrame:
    """``id_col`` and ``ids``: the token ids of every whole text, as little-endian unsigned 32-bit integers.

    ``vocabulary`` is the path of a ranks file, read by the driver and broadcast (its size is that of the
    vocabulary, whatever the data).  A null or empty text has no ids; null ids and repeated rows are kept
    row by row; an empty table gives an empty one; other columns are left out.
    """
    with open(vocabulary, "rb") as f:
        blob = df.sparkSession.sparkContext.broadcast(f.read())
    source = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def run(batches):
        vocab, cut, memory = _vocabulary(blob.value), regex.compile(pattern), {}
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                ids = _encode_texts(vocab, cut, memory, part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.binary())], ["id", "ids"])

    kind = source.schema["id"].dataType.simpleString()
    return source.mapInArrow(run, f"id {kind}, ids binary").select(F.col("id").alias(id_col), "ids")


def decode(df: DataFrame, id_col: str, vocabulary: str) -> DataFrame:
    """``id_col``, ``ids`` and ``decoded``: the bytes that the ids stand for (null ids: empty)."""
    with open(vocabulary, "rb") as f:
        blob = df.sparkSession.sparkContext.broadcast(f.read())
    source = df.select(F.col(id_col).alias("id"), F.coalesce(F.col("ids"), F.lit(b"")).alias("ids"))

    def run(batches):
        vocab = _vocabulary(blob.value)
        for batch in batches:
            texts = [_decoded(vocab, x.as_buffer()) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.binary())],
                                             ["id", "ids", "decoded"])

    kind = source.schema["id"].dataType.simpleString()
    return source.mapInArrow(run, f"id {kind}, ids binary, decoded binary").select(
        F.col("id").alias(id_col), "ids", "decoded")


def round_trip(df: DataFrame, id_col: str, text_col: str, vocabulary: str, pattern: str) -> DataFrame:
    """:func:`encode`, then :func:`decode`, in one task: ``id_col``, ``ids`` and ``decoded``.

    A task holds the vocabulary once and the ids of a few hundred texts at a time.
    """
    with open(vocabulary, "rb") as f:
        blob = df.sparkSession.sparkContext.broadcast(f.read())
    source = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def run(batches):
        vocab, cut, memory = _vocabulary(blob.value), regex.compile(pattern), {}
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                ids = _encode_texts(vocab, cut, memory, part.column(1).to_pylist())
                texts = [_decoded(vocab, x) for x in ids]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.binary()), pa.array(texts, pa.binary())],
                                                 ["id", "ids", "decoded"])

    kind = source.schema["id"].dataType.simpleString()
    return source.mapInArrow(run, f"id {kind}, ids binary, decoded binary").select(
        F.col("id").alias(id_col), "ids", "decoded")
