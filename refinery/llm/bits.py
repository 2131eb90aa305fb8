"""A Bloom filter over 64-bit keys in numpy, of bounded size, for use inside tasks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F


def cells(keys: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """(word of the filter, its four bits) of each key."""
    h = keys.view(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    bits = np.zeros(h.shape, np.uint64)
    for i in range(4):
        bits |= np.uint64(1) << ((h >> np.uint64(6 * i)) & np.uint64(63))
    return ((h >> np.uint64(32)) % np.uint64(words)).astype(np.int64), bits


def build(keys: DataFrame, most_words: int) -> np.ndarray:
    """Filter of the long column ``key``, 16 bits a key up to ``most_words`` words; the driver gets those words only."""
    n = keys.count()
    words = int(min(most_words, max(64, 1 << (max(1, n) // 4).bit_length())))

    def run(batches):
        for batch in batches:
            at, bits = cells(batch.column(0).to_numpy(), words)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(bits.view(np.int64))], ["at", "bits"])

    table = np.zeros(words, np.int64)
    found = keys.select("key").mapInArrow(run, "at bigint, bits bigint").groupBy("at").agg(F.bit_or("bits").alias("bits"))
    for batch in found.toArrow().to_batches():
        table[batch.column(0).to_numpy()] = batch.column(1).to_numpy()
    return table


def passes(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether the filter passes each key (never false for one that is in it)."""
    at, bits = cells(keys, len(table))
    return (table[at].view(np.uint64) & bits) == bits
