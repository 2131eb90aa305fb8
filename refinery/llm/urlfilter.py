"""URL filter: host and path rules, and a list of canonical URLs behind a blocked Bloom filter.

The filter is a table of blocks of eight 32-bit words; a listed URL sets one bit
in each word of one block.  The number of blocks follows the list up to
``MOST_BLOCKS``, which bounds what is broadcast whatever the list's size: a
longer list makes the filter pass more URLs, never fewer.  Only URLs that it
passes are joined, by their full canonical text, with the list.
"""

from __future__ import annotations

from collections.abc import Sequence
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, functions as F

from refinery.llm.common import written

WORDS = 8
PER_BLOCK = 16
MOST_BLOCKS = 1 << 16
#: scheme, host and path; the first group ends at the first "://"
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased (null or no ``://``: empty)."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), PARTS, 1), ascii_uppercase, ascii_lowercase)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end (null or no ``://``: empty)."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), PARTS, 2)


def canonical(host: Column, path: Column) -> Column:
    """Host without a leading ``www.`` or ``m.``, and path without trailing slashes; scheme, query, fragment go."""
    return F.concat(F.regexp_replace(host, r"^(www|m)\.", ""), F.regexp_replace(path, r"/+$", ""))


def _bits(c: Column) -> list[Column]:
    h = F.xxhash64(c, F.lit(1))
    return [F.shiftrightunsigned(h, 5 * i).bitwiseAND(F.lit(31)).cast("int") for i in range(WORDS)]


def _block(c: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(c), F.lit(blocks))


def bloom(listed: DataFrame, blocks: int) -> DataFrame:
    """The filter of the column ``url``: ``block`` and the words ``w0`` to ``w7``, at most ``blocks`` rows."""
    one = F.lit(1)
    rows = listed.select(_block(F.col("url"), blocks).alias("block"),
                         *[F.call_function("shiftleft", one, b).alias(f"w{i}") for i, b in enumerate(_bits(F.col("url")))])
    return rows.groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(WORDS)])


def possible(rows: DataFrame, listed: DataFrame, blocks: int) -> DataFrame:
    """``rows`` (with ``key``) and the boolean ``maybe``: whether the filter passes the key."""
    there = bloom(listed, blocks)
    hit = F.lit(True)
    for i, b in enumerate(_bits(F.col("key"))):
        hit = hit & (F.call_function("shiftrightunsigned", F.col(f"w{i}"), b).bitwiseAND(F.lit(1)) == 1)
    return (rows.withColumn("block", _block(F.col("key"), blocks)).join(F.broadcast(there), "block", "left")
            .withColumn("maybe", F.coalesce(hit, F.lit(False))).drop("block", *[f"w{i}" for i in range(WORDS)]))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule, action) of the longest fitting rule of (action, host, path), else nulls."""
    name, action = None, None
    for act, h, p in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r)):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name = F.when(fits, h + p) if name is None else name.when(fits, h + p)
        action = F.when(fits, act) if action is None else action.when(fits, act)
    return (F.lit(None).cast("string"),) * 2 if name is None else (name, action)


def judge(pages: DataFrame, listed: DataFrame, rules: Sequence[tuple[str, str, str]], id_col: str = "page_id",
          url_col: str = "url") -> DataFrame:
    """``id_col``, ``host``, ``path``, ``rule``, ``listed`` and ``verdict`` of every row.

    ``listed`` has canonical URLs in the column ``url`` (nulls and repeats are ignored).  The verdict is the
    rule's, else ``block`` for listed URLs and ``allow`` for the rest.  A null URL, or one without ``://``, has
    an empty host and path and is listed only if the list holds the empty URL.  Null ids and repeated rows are
    kept row by row; empty tables on either side are fine; other columns are ignored.
    """
    known = written(listed.select("url").where("url is not null").distinct(), "url-list")
    n = known.count()
    blocks = min(MOST_BLOCKS, max(1, -(-n // PER_BLOCK)))
    host, path = host_of(F.col("u")), path_of(F.col("u"))
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("u")).select(
        "id", host.alias("host"), path.alias("path"))
    rows = rows.withColumn("key", canonical(F.col("host"), F.col("path")))
    seen = possible(rows, known, blocks)
    hits = known.select(F.col("url").alias("key"), F.lit(True).alias("listed"))
    passed = seen.where("maybe").join(hits, "key", "left")
    both = (passed.select("id", "host", "path", F.coalesce("listed", F.lit(False)).alias("listed"))
            .unionByName(seen.where("not maybe").select("id", "host", "path", F.lit(False).alias("listed"))))
    rule, action = rule_of(F.col("host"), F.col("path"), rules)
    return both.select(F.col("id").alias(id_col), "host", "path", rule.alias("rule"), "listed",
                       F.coalesce(action, F.when(F.col("listed"), "block").otherwise("allow")).alias("verdict"))
