"""Removal of repeated substrings by column-wise construction of a collection's suffix order.

A byte goes if it lies in a ``length``-byte string that also starts in a document
of smaller id.  All suffixes of a corpus can't be sorted together, so equal
strings are first brought to the same place:

1. Every string of ``length`` bytes is named by its anchor, the leftmost of its
   ``GRAM``-byte grams with the smallest hash; equal strings have equal anchors.
   Anchor hashes are packed by shard and counted; those that a second document
   holds go into a Bloom filter of bounded size.
2. The stretches of text around anchors that pass it (all strings with that
   anchor occurrence) are dealt out by anchor.  Equal stretches of a batch of
   documents travel once, and what a batch sends to one place is packed by
   columns and compressed.  Anchors that too many batches hold are dealt by single
   strings instead of by anchor, so one anchor never fills a deal.  Stretches
   overlap, so all of them together can be several times the text: the deals are
   taken in as many passes over the text as keep a pass below it (``_passes``),
   each with a filter of its own anchors, and a pass's files go when it ends.
3. In a deal the distinct stretches, aligned at their anchors, are a collection
   of short documents.  Its Burrows-Wheeler order and common prefixes are built
   column by column: each round inserts one symbol in front of every document,
   a stable sort of the last order by that symbol, and the common prefix of two
   neighbours is one more than the least common prefix between them before.
   Neighbours with ``length`` common symbols are equal strings; the smallest
   document id of each run decides.  Columns never mix, because equal strings
   lie in the same column; a round costs one pass over its column.
4. The removed stretches come together by document, packed as well, and are
   merged at the end of each pass; only texts that lose something are shuffled.
"""

from __future__ import annotations

import ctypes
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from refinery.llm import bits
from refinery.llm.common import written
from refinery.session import remove_dir, scratch_dir, session_conf

#: two words of 8 bytes
GRAM = 16
#: bytes of text that a shard stands for, and the fewest shards
SHARD_BYTES, LEAST_SHARDS = 32 << 20, 256
#: stretches of a deal, and bytes of text of a bucket of documents
DEAL, BUCKET_BYTES = 1 << 17, 16 << 20
#: words of 64 bits in the filter (at most 32 MB)
MOST_WORDS = 1 << 22
#: strings that are handled at a time (few enough for their arrays to stay in a core's cache)
BLOCK = 1 << 16
#: documents whose keys are put together before they are sent
BATCH = 256
#: bytes of text whose stretches are put together before they are sent, and stretches that a task holds until then
SENT_BYTES, MOST_HELD = 8 << 20, 1 << 17
#: bytes that a packed stretch takes with its holder, and bytes of a pass's stretches for each byte of text
STRETCH_BYTES, MOST_SENT = 45, 0.75
#: as far as this Spark knows them: shuffle files go when the statement that made them ends, not when the driver collects
#: its garbage, and a task gets no more text at a time than it puts together
TIDY = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
        "spark.sql.execution.arrow.maxBytesPerBatch": str(SENT_BYTES)}


def anchors(text, length: int, ends: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(first string, last string, anchor position, anchor hash) of each run of strings with one anchor.

    ``text`` may hold several texts, one after another; ``ends`` says where, and no string runs over an end.
    """
    wide, low = length - GRAM + 1, np.uint64((1 << 21) - 1)
    ends = np.array([len(text)]) if ends is None else ends
    own = np.zeros(len(text), bool)
    for a, b in zip(np.concatenate([[0], ends[:-1]]).tolist(), ends.tolist()):
        if b - a >= length:
            own[a:b - length + 1] = True
    for base in range(0, len(text) - length + 1, BLOCK):
        many = min(BLOCK, len(text) - length + 1 - base)
        words = np.ndarray((many + length - 8,), "<u8", text, base, (1,)).copy()
        h = words[:-8] * np.uint64(0x9E3779B97F4A7C15) + words[8:] * np.uint64(0xC2B2AE3D27D4EB4F)
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(29)
        least, step = (h & ~low) | np.arange(len(h), dtype=np.uint64), 1  # equal hashes: the leftmost is least
        while step * 2 <= wide:
            least = np.minimum(least[:-step], least[step:])
            step *= 2
        if wide > step:
            least = np.minimum(least[:-(wide - step)], least[wide - step:])
        at, ours = (least & low).astype(np.int64), own[base:base + many]
        first = np.concatenate([[0], np.flatnonzero((at[1:] != at[:-1]) | (ours[1:] != ours[:-1])) + 1])
        last = np.append(first[1:] - 1, many - 1)
        first, last = first[ours[first]], last[ours[first]]
        yield first + base, last + base, at[first] + base, h[at[first]].view(np.int64)


def _shard(keys: np.ndarray, shards: int) -> np.ndarray:
    return ((keys.view(np.uint64) >> np.uint64(20)) % np.uint64(shards)).astype(np.int32)


def _hand_back() -> None:
    """Give freed memory back to the system, where the allocators can: idle workers stand beside those at work."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def _slices(column: pa.Array, documents: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes of their texts, end of each) of slices of so many documents and ``SENT_BYTES``."""
    if not len(column):
        return
    kind = np.dtype(np.int64 if pa.types.is_large_string(column.type) else np.int32)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, kind, len(column) + 1, column.offset * kind.itemsize).astype(np.int64)
    data, first = np.frombuffer(data, np.uint8), 0
    while first < len(column):
        full = int(np.searchsorted(offsets, offsets[first] + SENT_BYTES, side="right")) - 1
        stop = min(first + documents, max(first + 1, full), len(column))
        yield first, stop, data[offsets[first]:offsets[stop]], offsets[first + 1:stop + 1] - offsets[first]
        first = stop


def _packed_keys(source: DataFrame, length: int, shards: int) -> DataFrame:
    """``shard`` and ``keys``: the anchor hashes of a batch of documents, twice where two of them hold one."""
    def run(batches):
        for batch in batches:
            for _, _, data, ends in _slices(batch.column(1), BATCH):
                found = [(np.searchsorted(ends, first, side="right"), key) for first, _, _, key in anchors(data, length, ends)]
                doc, key = (np.concatenate(c) for c in zip(*found))
                order = np.argsort(key, kind="stable")
                doc, key = doc[order], key[order]
                key = key[np.concatenate([[True], (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])])]  # each document once
                keys, n = np.unique(key, return_counts=True)
                keys = np.repeat(keys, np.minimum(n, 2))
                shard = _shard(keys, shards)
                order = np.argsort(shard, kind="stable")
                keys, cut = keys[order], np.flatnonzero(np.diff(shard[order])) + 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shard[order][np.concatenate([[0], cut])]),
                     pa.array([x.tobytes() for x in np.split(keys, cut)], pa.binary())], ["shard", "keys"])

    return source.select("doc", "text").mapInArrow(run, "shard int, keys binary")


def _shared_keys(packed: DataFrame) -> DataFrame:
    """``key`` and ``n``: anchor hashes that more than one document holds; n counts batches, up to two documents each."""
    def run(table: pa.Table) -> pa.Table:
        keys = np.concatenate([np.frombuffer(x.as_buffer(), np.int64) for x in table.column("keys")])
        keys, n = np.unique(keys, return_counts=True)
        return pa.table({"key": keys[n > 1], "n": n[n > 1].astype(np.int64)})

    return packed.groupBy("shard").applyInArrow(run, "key bigint, n bigint")


def _passes(keys: int, held: int, total: int, length: int) -> tuple[int, int]:
    """(passes, deals): ``keys`` shared anchors, ``held`` by so many batches, in texts of ``total`` bytes.

    The fewest passes whose stretches, and those that the filter lets through by chance, stay below their
    share of the text.  Half as many again are allowed than the sizes of the stretches ask for.
    """
    others = max(0, 2 * total // (length - GRAM + 2) - held)
    least = max(1, math.ceil(held * STRETCH_BYTES / max(1, total * MOST_SENT)))
    for passes in range(least, least + least // 2 + 2):
        chance = (1 - (63 / 64) ** (4 * keys / passes / MOST_WORDS)) ** 4
        sent = held + others * chance
        if sent * STRETCH_BYTES / passes <= total * MOST_SENT:
            break
    return passes, max(LEAST_SHARDS, passes, int(sent) // DEAL)


def _planes(numbers: np.ndarray) -> bytes:
    """The lowest byte of every number, then the next byte of every number, and so on: zeros come together."""
    return np.ascontiguousarray(numbers).view(np.uint8).reshape(len(numbers), -1).T.tobytes()


def _pack(columns: list[np.ndarray], rest: bytes | np.ndarray = b"") -> bytes:
    """Columns of numbers and some bytes, compressed."""
    raw = b"".join([*map(_planes, columns), bytes(rest)])
    sizes = np.array([len(raw), *map(len, columns)], "<i4")
    return sizes.tobytes() + pa.Codec("zstd", 1).compress(raw, asbytes=True)


def _unpack(blob: bytes, kinds: list[str]) -> tuple[list[np.ndarray], bytes]:
    """What :func:`_pack` was given."""
    sizes, at, out = np.frombuffer(blob, "<i4", len(kinds) + 1), 0, []
    raw = pa.Codec("zstd").decompress(blob[4 * len(sizes):], int(sizes[0]), asbytes=True)
    for n, kind in zip(sizes[1:].tolist(), map(np.dtype, kinds)):
        planes = np.frombuffer(raw, np.uint8, n * kind.itemsize, at).reshape(kind.itemsize, n)
        out.append(planes.T.copy().view(kind).ravel())
        at += n * kind.itemsize
    return out, raw[at:]


#: of packed stretches: bytes, anchor and number of places of each; difference of ids, tag and place of each place
STRETCHES = ["<u2", "<u2", "<u4", "<i8", "<i4", "<i4"]
#: of packed removals: differences of ids and of tags, first string, number of strings
REMOVALS = ["<i8", "<i4", "<i4", "<u2"]


def _strings(data: np.ndarray, size: np.ndarray) -> pa.Array:
    """Strings of these sizes that lie one after another."""
    ends = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(ends), pa.py_buffer(data)])


def _cut_out(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """These pieces of the data, one after another."""
    ends = np.concatenate([[0], np.cumsum(size)])
    out = np.empty(ends[-1], np.uint8)
    for i in range(0, len(start), 1 << 15):
        n, e = size[i:i + (1 << 15)], ends[i:i + (1 << 15) + 1]
        out[e[0]:e[-1]] = data[np.repeat(start[i:i + (1 << 15)] - e[:-1], n) + np.arange(e[0], e[-1])]
    return out


def _distinct(strings: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(number of its string of each, an example of each string, bytes of the distinct strings in that order)."""
    found = strings.dictionary_encode()
    which = found.indices.to_numpy().astype(np.int64)
    example = np.empty(len(found.dictionary), np.int64)
    example[which[::-1]] = np.arange(len(which))[::-1]
    ends, data = found.dictionary.buffers()[1:]
    ends = np.frombuffer(ends, np.int32, len(example) + 1)
    return which, example, np.frombuffer(data, np.uint8)[ends[0]:ends[-1]]


def _stretches(source: DataFrame, filtered, hot: np.ndarray, length: int, shards: int) -> DataFrame:
    """``shard`` and ``blob``: stretches of a batch of documents, who holds them, and where.

    ``filtered`` is a broadcast (filter, first shard, shard after the last) of the pass.
    """
    sent = source.sparkSession.sparkContext.broadcast(hot)

    def chosen(data: np.ndarray, first, last, at, key) -> tuple[np.ndarray, ...]:
        """(start, size, anchor in it, shard) of the block's stretches that the pass takes."""
        (table, low, high), often = filtered.value, sent.value
        shard, many = _shard(key, shards), np.isin(key, often)
        ok = np.flatnonzero((shard >= low) & (shard < high) & ~many)
        ok = ok[bits.passes(table, key[ok])]
        out = first[ok], last[ok] - first[ok] + length, at[ok] - first[ok], shard[ok]
        if not many.any():
            return out
        n = (last - first + 1)[many]
        start = np.repeat(first[many] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        shard = np.array([xxhash.xxh3_64_intdigest(data[p:p + length]) % shards for p in start.tolist()], np.int32)
        ours = (shard >= low) & (shard < high)
        single = start, np.full(len(start), length), np.repeat(at[many], n) - start, shard
        return tuple(np.concatenate([a, b[ours]]) for a, b in zip(out, single))

    def packed(data, ends, doc, tag, held) -> pa.RecordBatch:
        start, size, off, shard = (np.concatenate(c) for c in zip(*held))
        order = np.argsort(shard, kind="stable")
        start, size, off, shard = (x[order] for x in (start, size, off, shard))
        which, example, bodies = _distinct(_strings(_cut_out(data, start, size), size))  # a string tells its anchor and shard
        holder = np.argsort(which, kind="stable")
        row = np.searchsorted(ends, start[holder], side="right")
        place = start[holder] - np.concatenate([[0], ends])[row]
        count, size, off, shard = np.bincount(which, minlength=len(example)), size[example], off[example], shard[example]
        cut = np.concatenate([[0], np.flatnonzero(np.diff(shard)) + 1, [len(shard)]])
        body_at, holder_at = (np.concatenate([[0], np.cumsum(x)])[cut] for x in (size, count))
        step = np.diff(doc[row], prepend=0)
        step[holder_at[:-1]] = doc[row[holder_at[:-1]]]
        each = [x.astype(k) for x, k in zip((size, off, count, step, tag[row], place), STRETCHES)]
        blobs = []
        for a, b, c, d, e, f in np.stack([x[i:len(x) - 1 + i] for x in (cut, holder_at, body_at) for i in (0, 1)], 1).tolist():
            blobs.append(_pack([*(x[a:b] for x in each[:3]), *(x[c:d] for x in each[3:])], bodies[e:f]))
        return pa.RecordBatch.from_arrays(
            [pa.array(shard[cut[:-1]], pa.int32()), pa.array(blobs, pa.binary())], ["shard", "blob"])

    def run(batches):
        for batch in batches:
            for first, stop, data, ends in _slices(batch.column(2), batch.num_rows):
                doc, tag = (batch.column(i).slice(first, stop - first).to_numpy() for i in (0, 1))
                held, n = [], 0
                for block in anchors(data, length, ends):
                    found = chosen(data, *block)
                    if len(found[0]):
                        held.append(found)
                        n += len(found[0])
                    if n >= MOST_HELD:  # what a task keeps at a time is bounded, whatever the texts
                        yield packed(data, ends, doc, tag, held)
                        held, n = [], 0
                if held:
                    yield packed(data, ends, doc, tag, held)
            held = None
            _hand_back()

    return source.select("doc", "tag", "text").mapInArrow(run, "shard int, blob binary")


def least_holders(bodies, offs: np.ndarray, docs: np.ndarray, length: int) -> np.ndarray:
    """Smallest document of each string: (stretch, string of it), by column-wise insertion.

    ``bodies`` are strings, or (their bytes one after another, the size of each).  ``docs`` has the smallest
    document that holds each stretch; entries beyond a stretch's strings are the largest integer.
    """
    if not isinstance(bodies, tuple):
        bodies = np.frombuffer(b"".join(bodies), np.uint8), np.fromiter(map(len, bodies), np.int64, len(bodies))
    data, size = bodies
    lead, none = length - GRAM, np.iinfo(np.int64).max
    width, m = lead + length, len(size)
    start = lead - offs.astype(np.int64)
    cols = np.arange(width)
    inside = (cols >= start[:, None]) & (cols < (start + size)[:, None])
    symbols = np.zeros((m, width), np.uint8)
    symbols[inside] = data
    found = np.full((m, lead + 1), none)
    order, common = np.arange(m), np.zeros(m, np.uint8)
    for col in range(width - 1, -1, -1):
        inserted = symbols[order, col]
        to = np.argsort(inserted, kind="stable")
        common = _next_common(common, inserted[to], to)
        order = order[to]
        if col > lead:
            continue
        whole = (start[order] <= col) & ((start + size)[order] >= col + length)
        if not whole.any():
            continue
        runs = np.flatnonzero(common < length)
        least = np.minimum.reduceat(np.where(whole, docs[order], none), runs)
        least = np.repeat(least, np.diff(np.append(runs, m)))
        found[order[whole], col - start[order[whole]]] = least[whole]
    return found


def _next_common(common: np.ndarray, symbol: np.ndarray, to: np.ndarray) -> np.ndarray:
    """Common prefixes after a round: ``to`` are the old places in the new order, ``common`` the old prefixes."""
    out = np.zeros(len(to), np.uint8)
    same = np.flatnonzero(symbol[1:] == symbol[:-1]) + 1
    if len(same):
        a, b = to[same - 1] + 1, to[same]  # the least of common[a..b], from a table of powers of two
        span = b - a + 1
        level = np.frexp(span.astype(np.float64))[1] - 1
        table = [common]
        for k in range(int(level.max())):
            table.append(np.minimum(table[-1][:-(1 << k)], table[-1][1 << k:]))
        least = np.empty(len(same), np.uint8)
        for k in np.unique(level).tolist():
            pick = level == k
            least[pick] = np.minimum(table[k][a[pick]], table[k][b[pick] - (1 << k) + 1])
        out[same] = np.minimum(least, 250) + 1
    return out


def _removed(stretches: DataFrame, length: int, buckets: int) -> DataFrame:
    """``bucket`` and ``blob``: strings that documents of a bucket lose in a shard."""
    def run(table: pa.Table) -> pa.Table:
        parts = [_unpack(x.as_buffer().to_pybytes(), STRETCHES) for x in table.column("blob")]
        size, offs, count, _, tag, place = (np.concatenate(c) for c in zip(*(columns for columns, _ in parts)))
        doc, place = np.concatenate([np.cumsum(columns[3]) for columns, _ in parts]), place.astype(np.int64)
        which, example, data = _distinct(_strings(np.frombuffer(b"".join(x for _, x in parts), np.uint8), size))
        del parts
        which, size, offs = np.repeat(which, count), size[example].astype(np.int64), offs[example]
        least = np.full(len(example), np.iinfo(np.int64).max)
        np.minimum.at(least, which, doc)
        found = least_holders((data, size), offs, least, length)
        strings = size - length + 1
        told = np.arange(found.shape[1]) < strings[:, None]
        low, high = found.min(axis=1)[which], np.where(told, found, np.iinfo(np.int64).min).max(axis=1)[which]
        whole = np.flatnonzero(doc > high)  # each of its strings starts in a document of smaller id
        some = np.flatnonzero((doc > low) & (doc <= high))
        runs = [(whole, place[whole], strings[which[whole]])]
        for i in range(0, len(some), 1 << 15):
            part = some[i:i + (1 << 15)]
            gone = np.zeros((len(part), found.shape[1] + 2), np.int8)
            gone[:, 1:-1] = (found[which[part]] < doc[part, None]) & told[which[part]]
            edge = np.diff(gone, axis=1)
            at, first = np.nonzero(edge == 1)
            runs.append((part[at], place[part[at]] + first, np.nonzero(edge == -1)[1] - first))
        holder, start, number = (np.concatenate(c) for c in zip(*runs))
        del found, told, runs
        _hand_back()
        doc, tag = doc[holder], tag[holder]
        mixed = (doc.view(np.uint64) ^ tag.astype(np.uint64) << np.uint64(32)) * np.uint64(0x9E3779B97F4A7C15)
        bucket = ((mixed >> np.uint64(33)) % np.uint64(buckets)).astype(np.int32)
        order = np.lexsort((start, tag, doc, bucket))
        doc, tag, start, number, bucket = (x[order] for x in (doc, tag, start, number, bucket))
        cut = np.flatnonzero(np.diff(bucket)) + 1
        edges = [0, *cut.tolist(), len(bucket)] if len(bucket) else [0]
        blobs = []
        for a, b in zip(edges, edges[1:]):
            columns = [np.diff(doc[a:b], prepend=0), np.diff(tag[a:b], prepend=np.int32(0)), start[a:b], number[a:b]]
            blobs.append(_pack([x.astype(k) for x, k in zip(columns, REMOVALS)]))
        return pa.table({"bucket": pa.array(bucket[edges[:-1]], pa.int32()), "blob": pa.array(blobs, pa.binary())})

    return stretches.groupBy("shard").applyInArrow(run, "bucket int, blob binary")


def _merged(removed: DataFrame, length: int) -> DataFrame:
    """``doc``, ``tag`` and ``runs``: what a document loses in a pass, as maximal (start, end) bytes."""
    def run(table: pa.Table) -> pa.Table:
        parts = [_unpack(x.as_buffer().to_pybytes(), REMOVALS)[0] for x in table.column("blob")]
        doc, tag = (np.concatenate([np.cumsum(x[i], dtype=x[i].dtype) for x in parts]) for i in (0, 1))
        start, number = (np.concatenate([x[i] for x in parts]).astype(np.int64) for i in (2, 3))
        order = np.lexsort((start, tag, doc))
        doc, tag, start = doc[order], tag[order], start[order]
        other = np.concatenate([[True], (doc[1:] != doc[:-1]) | (tag[1:] != tag[:-1])])
        text = np.cumsum(other) - 1
        ends = np.maximum.accumulate((text << 32) + start + number[order] - 1 + length)
        first = np.flatnonzero(np.concatenate([[True], (text[1:] << 32) + start[1:] > ends[:-1]]))
        ends = ends[np.append(first[1:] - 1, len(ends) - 1)] & 0xFFFFFFFF
        spans = np.stack([start[first], ends], 1).astype("<i4")
        new = np.flatnonzero(other)
        size = np.bincount(text[first], minlength=len(new)) * 8
        del parts, order, start, number, ends, first, other, text
        _hand_back()
        return pa.table({"doc": pa.array(doc[new], pa.int64()), "tag": pa.array(tag[new], pa.int32()),
                         "runs": _strings(spans.view(np.uint8).ravel(), size)})

    return removed.groupBy("bucket").applyInArrow(run, "doc bigint, tag int, runs binary")


def _covered(blobs: list[bytes]) -> list[tuple[int, int]]:
    """Maximal removed stretches, as (start, end) bytes, of those of all passes."""
    runs = np.concatenate([np.frombuffer(b, "<i4").reshape(-1, 2) for b in blobs])
    runs = runs[np.argsort(runs[:, 0], kind="stable")]
    ends = np.maximum.accumulate(runs[:, 1])
    first = np.flatnonzero(np.concatenate([[True], runs[1:, 0] > ends[:-1]]))
    return list(zip(runs[first, 0].tolist(), ends[np.append(first[1:] - 1, len(runs) - 1)].tolist()))


def _of_deals(shared: DataFrame, low: int, high: int, deals: int) -> DataFrame:
    """The keys of these deals."""
    def run(batches):
        for batch in batches:
            deal = _shard(batch.column(0).to_numpy(), deals)
            yield batch.filter(pa.array((deal >= low) & (deal < high)))

    return shared.select("key").mapInArrow(run, "key bigint")


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 50,
                   name: str = "substrings") -> DataFrame:
    """``id_col``, ``n_bytes``, ``spans`` (removed byte ranges), ``n_removed`` and ``kept`` (remaining bytes) of every row.

    A null or empty text has no bytes.  A row with a null id neither loses bytes nor takes them from others.
    Repeated rows (equal ids) don't take bytes from one another; each is judged by its own text.  An empty
    table gives an empty one; other columns are ignored.
    """
    spark = df.sparkSession
    rows = df.select(F.col(id_col).cast("long").alias("doc"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.withColumn("tag", F.hash("text"))
    source = rows.where((F.col("doc").isNotNull()) & (F.octet_length("text") >= length))
    total = int(rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0)
    shards, buckets = max(LEAST_SHARDS, total // SHARD_BYTES), max(64, total // BUCKET_BYTES)
    with session_conf(spark, TIDY):
        path = scratch_dir(spark, f"{name}-shared")
        _shared_keys(_packed_keys(source, length, shards)).write.mode("overwrite").parquet(path)
        shared = spark.read.schema("key bigint, n bigint").parquet(path)
        keys, held = shared.agg(F.count("n"), F.sum("n")).first()
        passes, deals = _passes(keys, int(held or 0), total, length)
        often = max(1000, total // (GRAM * shards * 4))  # a quarter of a shard's share of anchors
        hot = np.sort(np.array([r["key"] for r in shared.where(F.col("n") > often).select("key").collect()], np.int64))
        gone = None
        for i in range(passes):
            low, high = deals * i // passes, deals * (i + 1) // passes
            table = bits.build(_of_deals(shared, low, high, deals) if passes > 1 else shared, MOST_WORDS)
            filtered = spark.sparkContext.broadcast((table, low, high))
            removed = _removed(_stretches(source, filtered, hot, length, deals), length, buckets)
            part = written(_merged(removed, length), f"{name}-gone")
            gone = part if gone is None else gone.unionByName(part)
            filtered.destroy()
        remove_dir(spark, path)
        return _apply(rows, gone).withColumnRenamed("doc", id_col)


def _apply(rows: DataFrame, gone: DataFrame) -> DataFrame:
    """Cut the removed stretches; texts that lose nothing pass without a shuffle."""
    table = bits.build(gone.select(F.xxhash64("doc", "tag").alias("key")), MOST_WORDS)
    sent = rows.sparkSession.sparkContext.broadcast(table)
    kind = "doc bigint, tag int, text string"

    def losing(batches):
        for batch in batches:
            keys = batch.column(3).to_numpy()
            yield batch.filter(pa.array(bits.passes(sent.value, keys))).select(["doc", "tag", "text"])

    def keeping(batches):
        for batch in batches:
            keys = batch.column(3).to_numpy()
            yield batch.filter(pa.array(~bits.passes(sent.value, keys))).select(["doc", "tag", "text"])

    keyed = rows.select("doc", "tag", "text", F.xxhash64("doc", "tag").alias("key"))
    none = F.array().cast("array<struct<start:bigint,end:bigint>>")
    whole = keyed.mapInArrow(keeping, kind).select(
        "doc", F.octet_length("text").cast("long").alias("n_bytes"), none.alias("spans"),
        F.lit(0).cast("long").alias("n_removed"), F.col("text").cast("binary").alias("kept"))
    spans = gone.groupBy("doc", "tag").agg(F.collect_list("runs").alias("runs"))
    some = keyed.mapInArrow(losing, kind).join(spans, ["doc", "tag"], "left").select("doc", "text", "runs")

    def cut(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH):
                out = []
                for row in batch.slice(at, BATCH).to_pylist():
                    text = row["text"].encode()
                    spans = _covered(row["runs"]) if row["runs"] else []
                    edges = [0, *(x for span in spans for x in span), len(text)]
                    out.append({"doc": row["doc"], "n_bytes": len(text), "spans": [{"start": a, "end": b} for a, b in spans],
                                "n_removed": sum(b - a for a, b in spans),
                                "kept": b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))})
                yield pa.RecordBatch.from_pylist(out, CUT)

    return whole.unionByName(some.mapInArrow(
        cut, "doc bigint, n_bytes bigint, spans array<struct<start:bigint,end:bigint>>, n_removed bigint, kept binary"))


CUT = pa.schema([("doc", pa.int64()), ("n_bytes", pa.int64()),
                 ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                 ("n_removed", pa.int64()), ("kept", pa.binary())])
