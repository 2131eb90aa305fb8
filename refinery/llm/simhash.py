"""SimHash near-duplicates through covering locality-sensitive hashing.

Fingerprints within ``radius`` bits are found without a false negative: every
bit position gets a non-zero vector of ``radius + 1`` bits, and table ``v`` keeps
the positions whose vector has an odd product with ``v``.  Any ``radius``
positions leave some ``v`` that keeps none of them, so a pair that differs only
there has the same key in that table.

A bucket with many distinct fingerprints is covered again over the bits that its
mask leaves free, up to three levels deep; after that fewer than 2^7 fingerprints
can share a key, so no bucket is ever unbounded and nothing is left out.  A
bucket yields a spanning forest of its links, never all its pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from refinery.llm.common import connected_components, written

BITS = 64
#: distinct fingerprints in a bucket that one row may hold; larger buckets are covered again
BUCKET = 64
LEVELS = 3
STEP = 1 << 16


def fingerprint(text: str | None, words: int = 3, seed: int = 42) -> int:
    """SimHash of the word shingles of one text, as a signed 64-bit integer (no words: 0)."""
    found = (text or "").encode().lower().split()  # on bytes both touch ASCII only
    if not found:
        return 0
    joined = b" ".join(found)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(found) - words + 1)
    starts, ends = starts[:n].tolist(), ends[-n:].tolist()
    digest, counts = xxhash.xxh64_intdigest, np.zeros(BITS, np.int64)
    for at in range(0, n, STEP):
        h = np.array([digest(joined[a:b], seed) for a, b in zip(starts[at:at + STEP], ends[at:at + STEP])], "<u8")
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<i8")[0])


def fingerprints(df: DataFrame, id_col: str, text_col: str, words: int = 3) -> DataFrame:
    """``id_col``, ``fp`` (signed long) and ``text_hash`` (64 bits) of every whole text; a null text counts as empty,
    with fingerprint 0."""
    source = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("text_hash"))

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                fps = [fingerprint(t.as_py(), words) for t in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(fps, pa.int64()), part.column(2)], ["id", "fp", "text_hash"])

    kind = source.schema["id"].dataType.simpleString()
    return source.mapInArrow(run, f"id {kind}, fp bigint, text_hash bigint").select(F.col("id").alias(id_col), "fp", "text_hash")


def covering_masks(radius: int, kept: int = 0) -> list[int]:
    """Masks that cover every pair within ``radius`` among fingerprints that agree on the bits of ``kept``."""
    tables = (1 << (radius + 1)) - 1
    free = [i for i in range(BITS) if not kept >> i & 1]
    vector = {bit: at % tables + 1 for at, bit in enumerate(free)}
    return [kept | sum(1 << b for b, m in vector.items() if (m & v).bit_count() & 1) for v in range(1, tables + 1)]


def _signed(x: int) -> int:
    return x - (1 << BITS) if x >> (BITS - 1) else x


def _forest(fps: list[int], radius: int) -> list[tuple[int, int]]:
    """Edges that span the groups of one bucket, each edge a link of at most ``radius`` bits."""
    x = np.array(fps, np.int64)
    near = np.bitwise_count((x[:, None] ^ x[None, :]).view(np.uint64)) <= radius
    left, edges = set(range(len(x))), []
    while left:
        queue = [min(left)]
        left.discard(queue[0])
        for i in queue:
            for j in np.flatnonzero(near[i]).tolist():
                if j in left:
                    left.discard(j)
                    queue.append(j)
                    edges.append((fps[i], fps[j]))
    return edges


def links(fps: DataFrame, radius: int = 2, name: str = "simhash") -> DataFrame:
    """``src``, ``dst``: links that connect all fingerprints within ``radius`` bits (column ``fp``, distinct)."""
    rows = fps.select(F.lit(0).alias("mask"), "fp")
    masks, edges = [0], None
    for level in range(LEVELS):
        deeper = [covering_masks(radius, m) for m in masks]
        tables = F.array(*[F.array(*[F.lit(_signed(m)) for m in ms]) for ms in deeper])
        per = len(deeper[0])
        rows = (rows.select("mask", "fp", F.posexplode(F.get(tables, F.col("mask"))).alias("t", "bits"))
                .select((F.col("mask") * per + F.col("t")).alias("mask"), F.col("fp").bitwiseAND(F.col("bits")).alias("key"), "fp"))
        shared = written(rows.groupBy("mask", "key").agg(F.count("fp").alias("n")).where("n > 1"), f"{name}-buckets")
        rows = written(rows.join(shared, ["mask", "key"]), f"{name}-rows")
        last = level == LEVELS - 1
        found = _bucket_links(rows if last else rows.where(F.col("n") <= BUCKET), radius)
        edges = found if edges is None else edges.union(found)
        masks = [m for ms in deeper for m in ms]
        rows = rows.where(F.col("n") > BUCKET).select("mask", "fp")
        if last or rows.isEmpty():
            return edges


def _bucket_links(rows: DataFrame, radius: int) -> DataFrame:
    buckets = rows.groupBy("mask", "key").agg(F.collect_set("fp").alias("fps")).select("fps")

    def run(batches):
        for batch in batches:
            pairs = [e for fps in batch.column(0).to_pylist() for e in _forest(sorted(fps), radius)]
            yield pa.RecordBatch.from_arrays([pa.array([e[0] for e in pairs], pa.int64()),
                                              pa.array([e[1] for e in pairs], pa.int64())], ["src", "dst"])

    return buckets.mapInArrow(run, "src bigint, dst bigint").distinct()


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3,
                    radius: int = 2, name: str = "simhash") -> DataFrame:
    """``id_col``, ``fp`` and ``component_id`` of every row.

    ``component_id`` is the smallest id among the rows that chains of fingerprints within ``radius`` bits
    reach.  Null or empty texts have fingerprint 0 and link like any other; a null id gets its component's id
    (null only where no member has one); repeated rows are returned as often as they occur; an empty table
    gives an empty one; other columns are ignored.
    """
    return _labelled(df, id_col, text_col, words, radius, name).select(F.col("_id").alias(id_col), "fp", "component_id")


def _labelled(df: DataFrame, id_col: str, text_col: str, words: int, radius: int, name: str) -> DataFrame:
    """``_id``, ``fp``, ``text_hash``, ``root`` (a fingerprint that names the component) and ``component_id`` of every row."""
    fps = written(fingerprints(df.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")),
                               "_id", "_text", words), f"{name}-fps")
    classes = written(fps.groupBy("fp").agg(F.min("_id").alias("first")), f"{name}-classes")
    roots = connected_components(links(classes, radius, name), name)
    member = written(classes.join(roots, classes["fp"] == roots["node"], "left")
                     .select("fp", "first", F.coalesce("root", "fp").alias("root")), f"{name}-members")
    lowest = written(member.groupBy("root").agg(F.min("first").alias("component_id")), f"{name}-lowest")
    named = written(member.join(lowest, "root").select("fp", "root", "component_id"), f"{name}-named")
    return fps.join(named, "fp").select("_id", "fp", "text_hash", "root", "component_id")


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, radius: int = 2,
             name: str = "simhash") -> DataFrame:
    """The rows of ``df`` without those that another row of their component (the one of smallest id) stands for.

    Rows are told apart by id and 64 bits of their text's hash: of rows with the same id, one with an unrelated text
    stays.  Several rows of a component that share its smallest id leave one, that of the smallest hash; rows with a
    null id stay, as nothing could name them.  The rows to go are joined to the rows; Spark broadcasts them while they
    are few.
    """
    found = _labelled(df, id_col, text_col, words, radius, name).where(F.col("_id").isNotNull())
    found = written(found.select("_id", F.col("text_hash").alias("_hash"), "root", "component_id"), f"{name}-found")
    kept = (found.where("_id = component_id").groupBy("_id", "root").agg(F.count("*").alias("n"), F.min("_hash").alias("first"))
            .where("n > 1"))
    twice = written(found.join(kept, ["_id", "root"]).select("_id", "_hash", (F.col("_hash") == F.col("first")).alias("stays"))
                    .distinct(), f"{name}-twice")
    gone = found.where("_id <> component_id").select("_id", "_hash").unionByName(twice.where("NOT stays").select("_id", "_hash"))
    gone = written(gone.distinct(), f"{name}-gone")
    match = lambda other: (df[id_col] == other["_id"]) & (F.xxhash64(df[text_col]) == other["_hash"])
    left = df.join(gone, match(gone), "left_anti")
    if twice.isEmpty():
        return left
    stays = twice.where("stays").select("_id", "_hash")
    once = left.join(stays, match(stays), "left_anti")
    again = left.join(stays, match(stays), "left_semi").withColumn("_text_hash", F.xxhash64(text_col))
    return once.unionByName(again.dropDuplicates([id_col, "_text_hash"]).drop("_text_hash"))
