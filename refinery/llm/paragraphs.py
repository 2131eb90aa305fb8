"""Substring dedup by paragraph MinHash banding.

A paragraph is a sentence of a line, with the short sentences before it, so a
passage that repeats in the middle of other text is cut the same way everywhere
after its first sentence.  Each paragraph gets MinHash values over five-word
shingles; bands are tuned to the wanted recall.  Paragraphs that share a band
key are compared by the exact Jaccard similarity of their shingle sets, links
are clustered by connected components, and all but the first member of a
cluster are removals.  Words too few for a paragraph are carried into the next
lines; those left before a paragraph or at the end are compared exactly.

A passage that repeats inside longer sentences, or in text without any, holds
no equal paragraph.  So windows of 25 words are compared too, exactly: of those
in any 50 consecutive words, whatever breaks stand among them, the one of
smallest hash, which is the same one wherever the 50 words stand.

Most paragraphs share no key with any other.  One aggregation counts the keys;
those held twice go into a blocked Bloom filter of bounded size, and only
paragraphs that pass it are written, counted exactly and verified.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import Counter
from functools import lru_cache
from itertools import accumulate
from math import ceil

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from refinery.llm import bits
from refinery.llm.common import connected_components, written

SHINGLE = 5
LEAST_WORDS = 8
#: members of a bucket that one row may hold; larger buckets are split by rare shingles, then into blocks
BUCKET = 256
#: deals of a bucket that can't be split further
TURNS = 2
#: words of 64 bits in the filter: at most 2^20 (8 MB), whatever the input
MOST_WORDS = 1 << 20
#: any passage of so many words holds a whole window of so many
PASSAGE, WINDOW = 50, 25
#: between the words of what is compared exactly; a blank to ``str.split``, so no word holds it
GLUE = "\x1f"
REMEMBERED = 500_000


def tune(threshold: float, recall: float, most_rows: int = 4, most_bands: int = 32) -> tuple[int, int]:
    """(bands, rows per band) with the fewest bands that reach ``recall`` at ``threshold``, then the most rows."""
    fits = [(b, r) for r in range(1, most_rows + 1) for b in range(1, most_bands + 1)
            if 1 - (1 - threshold ** r) ** b >= recall]
    return min(fits, key=lambda x: (x[0], -x[1]))


class _Memory(dict):
    """Hashes of words met before; the lowest bit tells whether a sentence may end with the word."""

    def __missing__(self, w: str) -> int:
        h = self[w] = xxhash.xxh3_64_intdigest(w) & ~1 | (w[-1] in ".!?")
        return h


def _hashes(words: list[str], memory: _Memory) -> np.ndarray:
    """Hash of each word."""
    if len(memory) > REMEMBERED:
        memory.clear()
    return np.fromiter(map(memory.__getitem__, words), np.uint64, len(words))


def _sentences(lines: list[int], stops: list[int], least: int) -> list[tuple[int, int]]:
    """(start, end) of the paragraphs of a text, from the word numbers at which lines end and sentences stop.

    The last words of a line are carried into the next lines until they are ``least`` or a line has a paragraph
    of its own; then, and at the end of the text, what is carried is a shorter paragraph.  No word is left out.
    """
    out, carried, start, n = [], 0, 0, 0
    for end in lines:
        for stop in stops[n:bisect_left(stops, end, n)] + [end]:
            if stop - start >= least:
                if carried < start:
                    out.append((carried, start))
                out.append((start, stop))
                carried = start = stop
        if end - carried >= least:
            out.append((carried, end))
            carried = end
        n = bisect_right(stops, end, n)
        start = end
    return out + [(carried, start)] * (carried < start)


def _windows(flat: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first word, hash) of the chosen windows of texts that end at ``ends``.

    Of the windows that lie in ``PASSAGE`` consecutive words, the one of smallest hash is chosen, so any two
    texts that share so many words have an equal window there.  One that overlaps an equal one is left out.
    """
    if len(flat) < PASSAGE:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    whole, done, power = None, 0, flat
    for bit in range(WINDOW.bit_length()):
        if WINDOW >> bit & 1:
            n = len(flat) - (done + (1 << bit)) + 1
            whole = power[:n] if whole is None else _mix(whole[:n], power[done:done + n])
            done += 1 << bit
        power = _mix(power[:-(1 << bit)], power[1 << bit:])
    first = np.arange(len(flat) - PASSAGE + 1)
    inside = first + PASSAGE <= ends[np.searchsorted(ends, first, "right")]
    near = np.lib.stride_tricks.sliding_window_view(whole, PASSAGE - WINDOW + 1)
    low = _lowest(whole, PASSAGE - WINDOW + 1)
    # the choice moves only where the lowest hash changes, the chosen window has been left, or another text begins
    moves = np.ones(len(first), bool)
    moves[1:] = (low[1:] != low[:-1]) | (whole[:len(low) - 1] == low[:-1]) | ~inside[:-1]
    first = np.flatnonzero(moves & inside)
    at = np.unique(first + near[first].argmin(axis=1))
    last: dict[int, int] = {}
    keep = []
    for i, (p, h) in enumerate(zip(at.tolist(), whole[at].tolist())):
        if last.get(h, -WINDOW) + WINDOW <= p:
            last[h] = p
            keep.append(i)
    return at[keep], whole[at[keep]]


def _lowest(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values, by spans of doubled length."""
    low, done, power = None, 0, values
    for bit in range(width.bit_length()):
        if width >> bit & 1:
            n = len(values) - (done + (1 << bit)) + 1
            low = power[:n] if low is None else np.minimum(low[:n], power[done:done + n])
            done += 1 << bit
        power = np.minimum(power[:-(1 << bit)], power[1 << bit:])
    return low


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    h = (a ^ (a >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) + b
    return (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)


def units(texts: list[str], least: int, memory: _Memory) -> tuple:
    """(words, their hashes, paragraphs of ``least`` words or more, shorter ones and windows, hash of each of these,
    word at which each text begins).

    Paragraphs and windows are given by the number of their text, first word and end.
    """
    lines = [[line.split() for line in t.lower().split("\n")] for t in texts]
    words = [w for ls in lines for ws in ls for w in ws]
    flat = _hashes(words, memory)
    stops = np.flatnonzero(flat & np.uint64(1)) + 1
    ends = np.cumsum([sum(map(len, ls)) for ls in lines])
    spans, exact, at = [], [], 0
    for i, ls in enumerate(lines):
        own = stops[np.searchsorted(stops, at, "right"):np.searchsorted(stops, ends[i], "right")] - at
        for a, b in _sentences(list(accumulate(map(len, ls))), own.tolist(), least):
            (spans if b - a >= least else exact).append((i, at + a, at + b))
        at = int(ends[i])
    short = np.array([xxhash.xxh3_64_intdigest(GLUE.join(words[a:b])) for _, a, b in exact], np.uint64)
    first, hashes = _windows(flat, ends)
    of = np.searchsorted(ends, first, "right")
    exact += [(i, a, a + WINDOW) for i, a in zip(of.tolist(), first.tolist())]
    return words, flat, spans, exact, np.concatenate([short, hashes]), [0, *ends[:-1].tolist()]


def split(text: str, least: int = LEAST_WORDS) -> list[list[str]]:
    """Words (lower case) of each paragraph of ``least`` words or more, then, as one entry joined by ``GLUE``, of each
    shorter paragraph and of each window."""
    words, _, spans, exact, *_ = units([text], least, _Memory())
    return [words[a:b] for _, a, b in spans] + [[GLUE.join(words[a:b])] for _, a, b in exact]


@lru_cache(maxsize=4)
def _mixers(n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20)
    return (rng.integers(1, 1 << 63, n, dtype=np.uint64) | np.uint64(1), rng.integers(0, 1 << 63, n, dtype=np.uint64))


def band_keys(words: np.ndarray, spans: list[tuple[int, int, int]], bands: int, rows: int) -> np.ndarray:
    """(paragraph, band) keys as signed 64-bit integers: the band's MinHash values, mixed with its number."""
    if not spans:
        return np.empty((0, bands), np.int64)
    _, start, end = np.array(spans, np.int64).T
    size = end - start
    ends = np.cumsum(size)
    flat = words[np.arange(ends[-1]) + np.repeat(start - ends + size, size)]
    mixed = flat[:len(flat) - SHINGLE + 1].copy()
    for i in range(1, SHINGLE):
        mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + flat[i:len(flat) - SHINGLE + 1 + i]
    inside = np.ones(len(flat), bool)
    for i in range(1, SHINGLE):
        inside[ends - i] = False
    mixed = mixed[inside[:len(mixed)]]
    off = np.concatenate([[0], np.cumsum(size - SHINGLE + 1)[:-1]])
    mul, add = _mixers(bands * rows)
    keys = np.empty((len(spans), bands), np.uint64)
    for b in range(bands):
        key = np.full(len(spans), np.uint64(b + 1))
        for r in range(b * rows, (b + 1) * rows):
            h = mixed * mul[r] + add[r]
            h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            key = (key * np.uint64(0x9E3779B97F4A7C15)) ^ np.minimum.reduceat(h, off)
        keys[:, b] = key ^ (key >> np.uint64(32))
    return keys.view(np.int64)


def _keys(source: DataFrame, bands: int, rows: int, least: int) -> DataFrame:
    def run(batches):
        memory = _Memory()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                _, flat, spans, _, hashes, _ = units(batch.column(1).slice(at, 256).to_pylist(), least, memory)
                keys = np.concatenate([band_keys(flat, spans, bands, rows).ravel(), hashes.view(np.int64)])
                yield pa.RecordBatch.from_arrays([pa.array(keys)], ["key"])

    return source.mapInArrow(run, "key bigint")


MEMBER = pa.schema([("doc", pa.int64()), ("no", pa.int32()), ("words", pa.int32()), ("uid", pa.int64()), ("first", pa.int32()),
                    ("body", pa.string()), ("keys", pa.list_(pa.int64()))])


def _passing(source: DataFrame, table: np.ndarray, bands: int, rows: int, least: int) -> DataFrame:
    """Paragraphs and windows with a key that the filter passes; those compared by ``uid`` only have no body."""
    sent = source.sparkSession.sparkContext.broadcast(table)

    def run(batches):
        memory = _Memory()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                docs = part.column(0).to_pylist()
                words, flat, spans, exact, hashes, begin = units(part.column(1).to_pylist(), least, memory)
                keys = band_keys(flat, spans, bands, rows)
                ok = [*bits.passes(sent.value, keys).any(axis=1).tolist(), *bits.passes(sent.value, hashes.view(np.int64)).tolist()]
                numbers, out = Counter(), [[] for _ in MEMBER]
                for n, (i, a, b) in enumerate(spans + exact):
                    no, numbers[i] = numbers[i], numbers[i] + 1
                    if not ok[n]:
                        continue
                    similar = n < len(spans)
                    body = (" " if similar else GLUE).join(words[a:b])
                    one = (docs[i], no, b - a, xxhash.xxh3_64_intdigest(body), a - begin[i],
                           body if similar else None, keys[n].tolist() if similar else None)
                    for column, x in zip(out, one):
                        column.append(x)
                out[3] = np.array(out[3], np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(out, MEMBER)], schema=MEMBER)

    return source.mapInArrow(run, "doc bigint, no int, words int, uid bigint, first int, body string, keys array<bigint>")


def shingles(body: str) -> frozenset[str]:
    ws = body.split(" ")
    return frozenset(" ".join(ws[i:i + SHINGLE]) for i in range(max(1, len(ws) - SHINGLE + 1)))


def _own_shingles(key: int, body: str, memory: _Memory) -> np.ndarray:
    """Distinct hashes of a paragraph's shingles, each mixed with the key of the bucket it is looked at in."""
    flat = _hashes(body.split(" "), memory)
    mixed = flat[:max(1, len(flat) - SHINGLE + 1)].copy()
    for i in range(1, min(SHINGLE, len(flat))):
        mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + flat[i:len(mixed) + i]
    return _mix(np.unique(mixed), np.uint64(key % (1 << 64)))


def rare_prefixes(hot: DataFrame, threshold: float, name: str) -> DataFrame:
    """``key``, ``uid``: hot buckets (``key``, ``uid``, ``body``) split by the rarest shingles of their members.

    Two sets of Jaccard similarity t or more that are read in one common order share one of their first
    n - ceil(t n) + 1 members, n being either's size; so each paragraph is dealt to that many of its shingles, and no
    link is lost.  The order puts shingles that over ``BUCKET`` members of a bucket hold last, so paragraphs around
    one template part.  Which those are is an estimate (each batch tells the shingles that it holds twice or more; a
    filter of bounded size keeps the frequent ones), but the same one for all members, so the order is common.
    """
    def shingled(batches):
        memory = _Memory()
        for batch in batches:
            found = [_own_shingles(k, b, memory) for k, b in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist())]
            if found:
                keys, n = np.unique(np.concatenate(found), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(keys[n > 1].view(np.int64)), pa.array(n[n > 1])], ["key", "n"])

    hot = hot.select("key", "uid", "body")
    common = written(hot.mapInArrow(shingled, "key bigint, n bigint").groupBy("key").agg(F.sum("n").alias("n"))
                     .where(F.col("n") > BUCKET).select("key"), f"{name}-common")
    sent = hot.sparkSession.sparkContext.broadcast(bits.build(common, MOST_WORDS))

    def dealt(batches):
        memory = _Memory()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                keys, uids = [], []
                for k, uid, body in zip(*(c.to_pylist() for c in batch.slice(at, 256).columns)):
                    own = _own_shingles(k, body, memory)
                    last = bits.passes(sent.value, own.view(np.int64))
                    first = own[np.lexsort((own, last))][:len(own) - ceil(threshold * len(own) - 1e-9) + 1]
                    keys.append(first)
                    uids += [uid] * len(first)
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys).view(np.int64)), pa.array(uids, pa.int64())],
                                                 ["key", "uid"])

    return hot.mapInArrow(dealt, "key bigint, uid bigint")


def _forest(members: list[tuple[int, str]], threshold: float, side: list[int], known: list[int]) -> list[tuple[int, int]]:
    """Links that connect the members of one bucket; members of one side of a block pair were compared elsewhere, and
    those of one known component need no further link."""
    sets = [shingles(b) for _, b in members]
    heads: dict[int, int] = {}
    root = [heads.setdefault(k, i) for i, k in enumerate(known)]

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = i = root[root[i]]
        return i

    edges = []
    order = sorted(range(len(members)), key=lambda i: (len(sets[i]), members[i][0]))
    for n, i in enumerate(order):
        for j in reversed(order[:n]):
            if len(sets[j]) < threshold * len(sets[i]):
                break  # sorted by size: none of the smaller ones can reach the threshold
            if (side[i] == side[j] and side[i] >= 0) or find(i) == find(j):
                continue
            both = len(sets[i] & sets[j])
            if both >= threshold * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
                edges.append((members[i][0], members[j][0]))
    return edges


def _compared(rows: DataFrame, by: list[str], threshold: float) -> DataFrame:
    """``src``, ``dst`` of the links in each group of ``rows`` (``uid``, ``body``, ``side``, ``root`` and the group's columns)."""
    groups = rows.groupBy(*by).agg(F.collect_list(F.struct("uid", "body", "side", "root")).alias("all")).select("all")

    def run(batches):
        for batch in batches:
            found = []
            for members in batch.column(0).to_pylist():
                found += _forest([(m["uid"], m["body"]) for m in members], threshold, [m["side"] for m in members],
                                 [m["root"] for m in members])
            yield pa.RecordBatch.from_arrays([pa.array([e[0] for e in found], pa.int64()),
                                              pa.array([e[1] for e in found], pa.int64())], ["src", "dst"])

    return groups.mapInArrow(run, "src bigint, dst bigint").distinct()


def _shared_keys(rows: DataFrame, name: str) -> DataFrame:
    """``rows`` whose ``key`` others have too, with the number ``n`` of its rows."""
    return rows.join(written(rows.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), name), "key")


def links(variants: DataFrame, threshold: float, name: str) -> DataFrame:
    """``src``, ``dst``: links that connect the distinct paragraphs (``uid``, ``body``, ``keys``) that share a key and are similar.

    Buckets of at most ``BUCKET`` members are compared as they are.  Larger ones are split by their members' rarest
    shingles (:func:`rare_prefixes`), which loses no link.  What is still larger is a crowd of much the same text: it is
    dealt into blocks ``TURNS`` times, each block is compared, and buckets whose members these links connect are
    done.  In any that are left every pair of blocks meets in a row of its own, but for members known
    to be connected; so the result is whole, and no row holds more than two blocks.
    """
    one = [F.lit(-1).alias("side"), F.col("uid").alias("root")]
    rows = _shared_keys(variants.select(F.explode("keys").alias("key"), "uid", "body"), f"{name}-sizes")
    found = written(_compared(rows.where(F.col("n") <= BUCKET).select("key", "uid", "body", *one), ["key"], threshold), f"{name}-links")
    hot = written(rows.where(F.col("n") > BUCKET).select("key", "uid", "body"), f"{name}-hot")
    if hot.isEmpty():
        return found
    fine = written(rare_prefixes(hot, threshold, name), f"{name}-fine")
    fine = written(_shared_keys(fine, f"{name}-fine-sizes").join(variants.select("uid", "body"), "uid"), f"{name}-split")
    more = _compared(fine.where(F.col("n") <= BUCKET).select("key", "uid", "body", *one), ["key"], threshold)
    found = written(found.union(more), f"{name}-links")
    crowd = fine.where(F.col("n") > BUCKET).withColumn("blocks", F.ceil(F.col("n") / BUCKET).cast("int")).withColumn("root", F.col("uid"))
    if TURNS and not crowd.isEmpty():
        deal = F.explode(F.sequence(F.lit(1), F.lit(TURNS))).alias("turn")
        deals = crowd.select("*", deal, F.lit(-1).alias("side")).withColumn(
            "block", F.pmod(F.xxhash64("uid", "turn"), F.col("blocks")))
        found = written(found.union(_compared(deals, ["key", "turn", "block"], threshold)), f"{name}-links")
        roots = connected_components(found, f"{name}-turn").withColumnRenamed("node", "uid")
        crowd = written(crowd.drop("root").join(roots, "uid", "left").withColumn("root", F.coalesce("root", "uid")), f"{name}-crowd")
        apart = crowd.groupBy("key").agg(F.min("root").alias("least"), F.max("root").alias("most")).where("least < most")
        crowd = written(crowd.join(apart.select("key"), "key", "left_semi"), f"{name}-apart")
    if crowd.isEmpty():
        return found
    own = F.pmod(F.xxhash64("uid"), F.col("blocks")).cast("int")
    meets = crowd.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    meets = meets.select("key", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"), "uid", "body", "root",
                         F.when(F.col("own") == F.col("other"), -1).otherwise(F.col("own")).alias("side"))
    return written(found.union(_compared(meets, ["key", "a", "b"], threshold)), f"{name}-links")


def duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.8,
               recall: float = 0.99, least: int = LEAST_WORDS, name: str = "paragraphs") -> DataFrame:
    """One row per paragraph or window that has an equal or similar one anywhere, itself included.

    Returns ``id_col``, ``paragraph`` (its number among the text's paragraphs of ``least`` words or more, which
    its shorter ones and its windows follow), ``words``, ``class_id``, ``class_size``, ``kept_id`` and ``kept_paragraph`` (the first
    member, by id and number), ``removed`` (every other member), ``first_word`` (the number, in the text, of its first
    word) and ``unit`` (the hash of its words).  :func:`remove` takes what is removed out of the texts.  A class is a component of links of Jaccard
    similarity ``threshold`` or more over five-word shingles, or of equal windows or shorter paragraphs; any
    ``PASSAGE`` consecutive words that two texts share hold such a window.  Null and empty texts have no paragraphs; rows with a
    null id are left out, as nothing could name them; a repeated row's paragraphs are members again, and those
    that equal the kept one in id and number stay; an empty table gives an empty one; other columns are ignored.
    """
    bands, rows = tune(threshold, recall)
    source = df.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text")).where(
        "doc is not null and text is not null")
    shared = written(_keys(source, bands, rows, least).groupBy("key").agg(F.count("*").alias("n"))
                     .where("n > 1").select("key"), f"{name}-shared")
    passed = written(_passing(source, bits.build(shared, MOST_WORDS), bands, rows, least), f"{name}-passed")
    variants = written(passed.where("body is not null").groupBy("uid").agg(F.min("body").alias("body"), F.min("keys").alias("keys")),
                       f"{name}-variants")
    roots = connected_components(links(variants, threshold, name), name)
    members = passed.select("doc", "no", "words", "uid", "first")
    classed = written(members.join(roots, members["uid"] == roots["node"], "left")
                      .select("doc", "no", "words", F.coalesce("root", "uid").alias("class_id"), "first", "uid"), f"{name}-classed")
    tops = written(classed.groupBy("class_id").agg(F.count("*").alias("class_size"), F.min(F.struct("doc", "no")).alias("top"))
                   .where("class_size > 1"), f"{name}-tops")
    same = F.col("doc").eqNullSafe(F.col("top.doc")) & (F.col("no") == F.col("top.no"))
    return classed.join(tops, "class_id").select(
        F.col("doc").alias(id_col), F.col("no").alias("paragraph"), "words", "class_id", "class_size",
        F.col("top.doc").alias("kept_id"), F.col("top.no").alias("kept_paragraph"), (~same).alias("removed"),
        F.col("first").alias("first_word"), F.col("uid").alias("unit"))


def cut_spans(text: str, found: list[dict]) -> list[tuple[int, int]]:
    """(start, end) in code points of the runs of words that ``found`` (``first_word``, ``words``, ``unit``) covers.

    A unit counts only where its words stand, so what was found in another text of the same id cuts nothing here.
    """
    words, spans = text.lower().split(), []
    for u in sorted(found, key=lambda u: u["first_word"]):
        a, b = u["first_word"], u["first_word"] + u["words"]
        if u["unit"] % (1 << 64) not in [xxhash.xxh3_64_intdigest(glue.join(words[a:b])) for glue in (" ", GLUE)]:
            continue
        if spans and a <= spans[-1][1]:
            spans[-1][1] = max(b, spans[-1][1])
        else:
            spans.append([a, b])
    at = [m.span() for m in re.finditer(r"\S+", text)] if spans else []
    return [(at[a][0], at[b - 1][1]) for a, b in spans]


CUTS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def remove(df: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``df`` without the words that ``found``, the rows of :func:`duplicates` on it, says are removed.

    Returns all columns of ``df`` with the text that is left, then ``removed_spans`` (start and end in code points of the old
    text; a column of that name is replaced).  Null and empty texts, texts of a null id and those without removals stay as they
    are, with no spans; repeated rows are cut alike; an empty table gives an empty one.  What is gathered per id are the
    removals of its own texts.
    """
    cuts = found.where("removed").groupBy(F.col(id_col).alias("__id")).agg(
        F.collect_set(F.struct("first_word", "words", "unit")).alias("__cuts"))
    named = [c for c in df.columns if c != "removed_spans"]
    rows = df.select(*[F.col(f"`{c}`") for c in named])
    rows = rows.join(cuts, F.col(f"`{id_col}`").cast("long") == cuts["__id"], "left").drop("__id")
    at = named.index(text_col)

    def run(batches):
        for batch in batches:
            texts, spans = batch.column(at).to_pylist(), []
            for i, c in enumerate(batch.column(len(named)).to_pylist()):
                spans.append(cut_spans(texts[i], c) if texts[i] and c else [])
                if spans[-1]:
                    bounds = [0, *(x for s in spans[-1] for x in s), len(texts[i])]
                    texts[i] = "".join(texts[i][a:b] for a, b in zip(bounds[::2], bounds[1::2]))
            told = pa.array([[{"start": a, "end": b} for a, b in s] for s in spans], CUTS)
            columns = batch.columns[:at] + [pa.array(texts, pa.string())] + batch.columns[at + 1:-1]
            yield pa.RecordBatch.from_arrays([*columns, told], [*named, "removed_spans"])

    schema = T.StructType([*df.select(*[F.col(f"`{c}`") for c in named]).schema.fields,
                           T.StructField("removed_spans", T.ArrayType(
                               T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])))])
    return rows.mapInArrow(run, schema)
