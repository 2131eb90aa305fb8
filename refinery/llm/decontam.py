"""Benchmark decontamination by pigeonhole edit matching.

An item of ``L`` characters may differ from a passage by ``k = floor(rate * L)``
edits.  Cut into ``k + 1`` pieces, at least one piece must occur unchanged in
any such passage.  One automaton holds the pieces of a block of items and is run
over every whole text; each hit fixes where the item would lie, and Myers'
bit-parallel algorithm gives the exact edit distance there.  Texts are never
shuffled: the only rows that leave a task are matches.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from refinery.llm.common import written

#: characters of items that one pass over the documents looks for (bounds the broadcast and the automaton)
BLOCK_CHARS = 4_000_000


def normal(text: str) -> str:
    """Lower case, white space runs as one space."""
    return " ".join(text.lower().split())


def pieces(length: int, rate: float) -> list[tuple[int, int]]:
    """Bounds of the error-budget-plus-one pieces of an item of ``length`` characters."""
    n = int(rate * length) + 1
    return [(i * length // n, (i + 1) * length // n) for i in range(n)]


def distance(masks: dict[str, int], m: int, text: str, limit: int) -> int:
    """Fewest edits between the pattern of ``m`` characters and any passage of ``text`` (Myers' bit vectors)."""
    full, top = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score, best = full, 0, m, m
    for c in text:
        eq = masks.get(c, 0)
        vertical = eq | minus
        horizontal = (((eq & plus) + plus) ^ plus) | eq
        up, down = minus | (full & ~(horizontal | plus)), plus & horizontal
        if up & top:
            score += 1
        elif down & top:
            score -= 1
            if score < best:
                best = score
                if not best:
                    break
        up, down = up << 1 & full, down << 1 & full
        plus, minus = down | (full & ~(vertical | up)), up & vertical
    return best if best <= limit else -1


class Matcher:
    """Automaton, budgets and bit masks of one block of items (normalised text -> ids)."""

    def __init__(self, items: list[str], rate: float):
        self.items, self.budget, self.masks = items, [int(rate * len(t)) for t in items], {}
        where: dict[str, list[tuple[int, int]]] = {}
        for i, t in enumerate(items):
            for a, b in pieces(len(t), rate):
                where.setdefault(t[a:b], []).append((i, a))
        self.auto = ahocorasick.Automaton()
        for p, at in where.items():
            self.auto.add_word(p, (len(p), at))
        self.auto.make_automaton()

    def _masks(self, i: int) -> dict[str, int]:
        if i not in self.masks:
            found = self.masks[i] = {}
            for at, c in enumerate(self.items[i]):
                found[c] = found.get(c, 0) | 1 << at
        return self.masks[i]

    def find(self, text: str) -> list[tuple[int, int]]:
        """(item, distance) of every item that some passage of ``text`` is within budget of."""
        text, spans = normal(text), {}
        for end, (n, at) in self.auto.iter(text):
            for i, off in at:
                start, k, windows = end - n + 1 - off, self.budget[i], spans.setdefault(i, [])
                a, b = max(0, start - k), start + len(self.items[i]) + k
                if windows and a <= windows[-1][1] and a >= windows[-1][0]:
                    windows[-1][1] = max(b, windows[-1][1])
                else:
                    windows.append([a, b])
        out = []
        for i, windows in spans.items():
            best = -1
            merged: list[list[int]] = []
            for a, b in sorted(windows):
                if merged and a <= merged[-1][1]:
                    merged[-1][1] = max(b, merged[-1][1])
                else:
                    merged.append([a, b])
            for a, b in merged:
                d = distance(self._masks(i), len(self.items[i]), text[a:b], self.budget[i])
                best = d if best < 0 or 0 <= d < best else best
                if not best:
                    break
            if best >= 0:
                out.append((i, best))
        return out


@lru_cache(maxsize=1)
def _matcher(items: tuple[str, ...], rate: float) -> Matcher:
    return Matcher(list(items), rate)


def named_items(items: DataFrame, item_id: str, item_text: str) -> DataFrame:
    """``id``, ``text`` (normalised, not empty) and ``key`` (digest of the text) of every item, written."""
    rows = items.select(F.col(item_id).alias("id"), F.col(item_text).alias("text")).where("text is not null")

    def run(batches):
        for batch in batches:
            texts = pa.array([normal(t) for t in batch.column(1).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), texts], ["id", "text"])

    kind = rows.schema["id"].dataType.simpleString()
    clean = rows.mapInArrow(run, f"id {kind}, text string").where("text <> ''")
    return written(clean.withColumn("key", F.sha2("text", 256)), "decontam-items")


def text_blocks(named: DataFrame, block_chars: int) -> Iterator[tuple[bool, dict[str, str]]]:
    """The distinct texts of :func:`named_items`, text to key, in blocks of about ``block_chars`` characters, and
    whether a block is the last.  The driver holds one block, which copies of a text do not enlarge; without any item there
    is one empty block."""
    texts = written(named.select("key", "text").dropDuplicates(["key"]), "decontam-texts")
    total = texts.agg(F.sum(F.length("text"))).first()[0] or 0
    n = max(1, -(-int(total) // block_chars))
    block = F.pmod(F.xxhash64("key"), F.lit(n))
    for at in range(n):
        yield at == n - 1, {r["text"]: r["key"] for r in texts.where(block == at).orderBy("key").collect()}


def matches(df: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            item_id: str = "item_id", item_text: str = "text", rate: float = 0.05,
            block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``id_col``, ``item_id`` and ``distance``: every item within its edit budget of some passage of a whole text.

    Both sides are compared in lower case with white space runs as one space.  Null or empty texts and items
    match nothing; items with equal texts all match; a null id is returned as null, repeated rows as often as
    they occur; an empty table on either side gives an empty one; other columns are ignored.
    """
    spark = df.sparkSession
    source = df.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    named, out = named_items(items, item_id, item_text), None
    for _, block in text_blocks(named, block_chars):
        sent = spark.sparkContext.broadcast((tuple(block), list(block.values())))

        def run(batches, sent=sent):
            texts, keys = sent.value
            matcher = _matcher(texts, rate) if texts else None
            for batch in batches:
                at, key, dist = [], [], []
                for n, t in enumerate(batch.column(1)):
                    for i, d in matcher.find(t.as_py()) if matcher else ():
                        at.append(n), key.append(keys[i]), dist.append(d)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), pa.array(key, pa.string()),
                                                  pa.array(dist, pa.int32())], ["id", "key", "distance"])

        found = source.mapInArrow(run, f"id {kind}, key string, distance int")
        out = found if out is None else out.union(found)
    ids = named.select(F.col("id").alias("item_id"), "key")
    return out.join(ids, "key").select(F.col("id").alias(id_col), "item_id", "distance")


def keep_clean(df: DataFrame, items: DataFrame, text_col: str = "text", item_id: str = "item_id",
               item_text: str = "text", rate: float = 0.05, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The rows of ``df`` that match no item (see :func:`matches`), all columns as they are, without a shuffle.

    What a block of items leaves is written before the next one, so a task never holds two automata.
    """
    at_text = df.columns.index(text_col)
    for last, block in text_blocks(named_items(items, item_id, item_text), block_chars):
        sent = df.sparkSession.sparkContext.broadcast(tuple(block))

        def run(batches, sent=sent):
            matcher = _matcher(sent.value, rate) if sent.value else None
            for batch in batches:
                ok = [not (matcher and t.as_py() and matcher.find(t.as_py())) for t in batch.column(at_text)]
                yield batch.filter(pa.array(ok, pa.bool_()))

        df = df.mapInArrow(run, df.schema)
        if not last:
            df = written(df, "decontam-left")
    return df
