"""Heavy hitters of a key by a mergeable summary.

One pass keeps a frequent-items sketch (Misra-Gries with counters, Spark's
``approx_top_k_accumulate``) and the number of rows, as one row per group.  Such
rows can be stored with a batch and merged later (days into a month) without
reading the batch again.  A sketch never loses a key: its estimate is at least
the key's count, and at most ``2.7 / tracked`` of all rows too high.  So the
keys whose estimate passes the threshold are a superset of the hot ones, at
most about ``1 / share`` of them.  That is all a join needs to steer its rows; where
the counts themselves are asked for, a second pass that reads the key column
alone counts just the candidates exactly.

No pass shuffles the keys: a task sends its sketch (first pass) or a count for
each candidate (second pass).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SKETCH, ROWS, ESTIMATE = "sketch", "rows", "estimate"
#: keys that a sketch tracks by default (some 100 KB at most)
TRACKED = 8192


def summarise(df: DataFrame, key: str, by: Sequence[str] = (), tracked: int = TRACKED) -> DataFrame:
    """One row per group (one row in all without ``by``): the sketch of its non-null keys and their number."""
    known = df.where(F.col(key).isNotNull())
    return known.groupBy(*by).agg(F.expr(f"approx_top_k_accumulate(`{key}`, {int(tracked)})").alias(SKETCH),
                                  F.count(key).alias(ROWS))


def merged(summaries: DataFrame, by: Sequence[str] = (), tracked: int = TRACKED) -> DataFrame:
    """Summaries of parts of a table as those of coarser groups (of the whole without ``by``)."""
    return summaries.groupBy(*by).agg(F.expr(f"approx_top_k_combine({SKETCH}, {int(tracked)})").alias(SKETCH),
                                      F.sum(ROWS).alias(ROWS))


def _least_share(share: float, tracked: int) -> float:
    """The least true share that a key can have whose estimate passes ``share``."""
    error = 2.7 / tracked
    if not 0 < share < 1 or share < 2 * error:
        raise ValueError(f"a sketch of {tracked} keys can't tell shares of {share}; track {math.ceil(6 / share)} keys or more")
    return share - error


def superset(summaries: DataFrame, share: float, by: Sequence[str] = (), tracked: int = TRACKED) -> DataFrame:
    """``by``, the candidate key (column ``item``), its ``estimate`` and the group's ``rows``: every key with more
    than ``share`` of its group's rows, and possibly a few just below it."""
    most = math.ceil(1 / _least_share(share, tracked)) + 1
    found = summaries.select(*by, ROWS, F.explode(F.expr(f"approx_top_k_estimate({SKETCH}, {most})")).alias("_top"))
    return (found.select(*by, F.col("_top.item").alias("item"), F.col("_top.count").alias(ESTIMATE), ROWS)
            .where(F.col(ESTIMATE) > F.col(ROWS) * F.lit(float(share))))


def hot_keys(df: DataFrame, key: str, share: float, by: Sequence[str] = (), tracked: int | None = None,
             summaries: DataFrame | None = None) -> DataFrame:
    """``by``, ``key``, its exact count ``rows`` and the group's ``total``, for keys with over ``share`` of their group.

    At most ``1 / share`` rows a group.  ``summaries`` (of all of ``df``, by the same groups and tracking as many
    keys) saves the first pass.  Null keys don't count; an empty table gives no row.
    """
    tracked = tracked or max(TRACKED, math.ceil(8 / share))
    made = summaries if summaries is not None else summarise(df, key, by, tracked)
    few = superset(made, share, by, tracked).select(*[F.col(c).alias(f"_by_{c}") for c in by], F.col("item").alias("_item"),
                                                    F.col(ROWS).alias("total"))
    same = F.col(key) == F.col("_item")
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_by_{c}"))
    # bounded by 1 / share candidates a group; without groups that is a few dozen rows
    met = df.select(*by, key).join(few if by else F.broadcast(few), same)
    counted = met.groupBy(*by, key, "total").agg(F.count(F.lit(1)).alias("rows"))
    return counted.where(F.col("rows") > F.col("total") * F.lit(float(share))).select(*by, key, "rows", "total")


def hot_key_list(df: DataFrame, key: str, share: float) -> list:
    """Every key with more than ``share`` of the non-null rows, on the driver: one pass over one column.

    The superset without the exact count: a key within the sketch's error below the share may be listed too, which
    does no harm where the list only steers rows.  At most about ``1 / share`` values.
    """
    tracked = max(TRACKED, math.ceil(8 / share))
    return sorted(r["item"] for r in superset(summarise(df, key, (), tracked), share, (), tracked).collect())
