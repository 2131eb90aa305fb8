"""Dedup with late materialisation, for tables in Parquet files.

``cleaning.dedup`` carries whole rows through its aggregation; their strings
don't fit a fixed-width buffer, so Spark sorts all rows on both sides of the
shuffle.  Here a first pass reads the key and the order alone and keeps, in a
hash aggregation, one fixed-width number per key: the order in its upper part,
a 64-bit hash of the row's address (file and position) in its lower one.  A
second pass reads the columns that are asked for and joins the winners back by
that number in a shuffled hash join.  Nothing is sorted, columns that the
result doesn't need are never read, and the rows of a hot key spread by their
addresses.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PLACE = "_place"
#: orders lie strictly between -LIMIT and LIMIT, so that order and hash fit a decimal of 38 digits
LIMIT = 1 << 61


def file_address() -> list[Column]:
    """What tells apart all rows of a Parquet table."""
    return [F.col("_metadata.file_path"), F.col("_metadata.row_index")]


def _place(order: Column | None, address: Sequence[Column]) -> Column:
    low = F.xxhash64(*address).cast("decimal(20,0)") + F.lit(Decimal(1 << 63))
    if order is None:
        return low.cast("decimal(38,0)")
    rank = F.coalesce(order.cast("bigint"), F.lit(-LIMIT)).cast("decimal(19,0)")
    return (rank * F.lit(Decimal(1 << 64)) + low).cast("decimal(38,0)")


def latest(df: DataFrame, keys: str | Sequence[str], order: Column | str | None = None, columns: Sequence[str] | None = None,
           address: Sequence[Column] | None = None) -> DataFrame:
    """One row per key (null keys form one group): the greatest by ``order``; ``keys`` and ``columns`` of it.

    ``order`` is a whole number, date or timestamp between -2**61 and 2**61 (others raise or are truncated by
    their cast to whole numbers; dates must be given as days), nulls lowest; rows of a key that agree in it are told
    apart by ``address`` (default: file and position in the file, so ``df`` must be a scan of Parquet files without
    joins), which makes the winner the same in every run over the same files.  A hash of 64 bits stands for the
    address among rows of one key and order.  ``columns`` default to all.  An empty table gives an empty one.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    if not keys:
        raise ValueError("latest needs at least one key column")
    rest = [c for c in (columns if columns is not None else df.columns) if c not in keys]
    order = F.col(order) if isinstance(order, str) else order
    placed = df.select(*[F.col(f"`{c}`") for c in [*keys, *rest]],
                       _place(order, address if address is not None else file_address()).alias(PLACE))
    best = (placed.groupBy(*[F.col(f"`{k}`").alias(f"_key_{i}") for i, k in enumerate(keys)])
            .agg(F.max(PLACE).alias("_best")))
    same = F.col(PLACE) == F.col("_best")
    for i, k in enumerate(keys):
        same = same & F.col(f"`{k}`").eqNullSafe(F.col(f"_key_{i}"))
    out = columns if columns is not None else df.columns
    names = [*[k for k in keys if k not in out], *out]
    return placed.join(best.hint("shuffle_hash"), same).select(*[F.col(f"`{c}`") for c in names])
