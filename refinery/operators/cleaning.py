"""Cleaning operators: dedup on business keys, key/amount/range filters,
type coercion, null defaults, constants and processing metadata.

Dedup is an aggregation, not a window: ``groupBy(keys).agg(max(struct))``
combines map-side, so a key holding a third of all rows is collapsed inside
each map task before the shuffle instead of landing whole in one task.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refinery.functions import columns as fx
from refinery.functions import fixed

WINNER = "_winner"
GROUP_ROWS = "_group_rows"


def _as_list(x) -> list[str]:
    if x is None:
        return []
    return [x] if isinstance(x, str) else list(x)


def _winner_struct(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> tuple[Column, list[str]]:
    rest = [c for c in df.columns if c not in keys and c not in order_by]
    fields = list(order_by) + rest
    return F.struct(*[F.col(f"`{c}`") for c in fields]), fields


def dedup(df: DataFrame, keys, order_by=(), with_counts: bool = False) -> DataFrame:
    """One row per key (null keys form one group).

    The winner is the greatest row by ``order_by`` (e.g. ingestion time or a
    sequence), ties broken by the remaining columns in column order, nulls
    lowest.  Deterministic, so recomputation after an executor loss yields
    the same rows.  ``with_counts`` adds ``_group_rows`` (rows per key).
    """
    keys, order_by = _as_list(keys), _as_list(order_by)
    if not keys:
        raise ValueError("dedup needs at least one key column")
    missing = [c for c in keys + order_by if c not in df.columns]
    if missing:
        raise ValueError(f"dedup: unknown columns {missing}")
    winner, fields = _winner_struct(df, keys, order_by)
    aggs = [F.max(winner).alias(WINNER)]
    if with_counts:
        aggs.append(F.count(F.lit(1)).alias(GROUP_ROWS))
    out = df.groupBy(*keys).agg(*aggs)
    cols = [F.col(f"`{k}`") for k in keys] + [F.col(f"{WINNER}.`{f}`").alias(f) for f in fields]
    if with_counts:
        cols.append(F.col(GROUP_ROWS))
    return out.select(*cols).select(*[f"`{c}`" for c in df.columns] + ([GROUP_ROWS] if with_counts else []))


def key_present(key) -> Column:
    c = F.col(key)
    return c.isNotNull() & (c != "")


def require_key(df: DataFrame, key) -> DataFrame:
    """Keep rows whose key is neither null nor the empty string."""
    cond = None
    for k in _as_list(key):
        cond = key_present(k) if cond is None else cond & key_present(k)
    return df.filter(cond)


def coerce(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Typed parse of string columns: ``double``/``int`` (guarded), ``date``,
    ``boolean`` (flag words); failures become null rather than errors."""
    out = {}
    for name, typ in types.items():
        if name not in df.columns:
            continue
        if typ == "double":
            out[name] = fx.to_double(name)
        elif typ in ("int", "integer"):
            out[name] = fx.to_int(name)
        elif typ == "date":
            out[name] = fx.parse_date(name)
        elif typ == "boolean":
            out[name] = fx.parse_flag(name)
        else:
            out[name] = F.col(name).try_cast(typ)
    return df.withColumns(out)


def require_positive(df: DataFrame, col: str) -> DataFrame:
    """Keep rows whose (numeric) value is non-null, not NaN and > 0."""
    c = F.col(col)
    return df.filter(c.isNotNull() & ~F.isnan(c) & (c > 0))


def require_range(df: DataFrame, col: str, low, high, null_ok_col: str | None = None) -> DataFrame:
    """Keep rows with ``low <= col <= high``; rows where ``null_ok_col`` is null pass."""
    cond = F.col(col).between(low, high)
    if null_ok_col:
        cond = F.col(null_ok_col).isNull() | cond
    return df.filter(F.coalesce(cond, F.lit(False)))


def defaults(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Fill nulls (only nulls; an empty string stays) per column."""
    present = {k: v for k, v in values.items() if k in df.columns}
    return df.fillna(present) if present else df


def constants(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    return df.withColumns({k: F.lit(v) for k, v in values.items()})


def normalise(df: DataFrame, upper: Iterable[str] = (), lower: Iterable[str] = (),
              initcap: Iterable[str] = (), trim: Iterable[str] = ()) -> DataFrame:
    """trim(upper/lower/initcap(x)) per column list (space trimming only)."""
    out = {}
    for c in upper:
        out[c] = fx.upper_trim(c)
    for c in lower:
        out[c] = fx.lower_trim(c)
    for c in initcap:
        out[c] = fx.initcap_trim(c)
    for c in trim:
        out[c] = F.trim(F.col(c))
    out = {k: v for k, v in out.items() if k in df.columns}
    return df.withColumns(out) if out else df


def stamp(df: DataFrame, clock, source_date: str, version: str = fixed.ETL_VERSION) -> DataFrame:
    """Processing metadata: transform time (passed in), ETL version, source date."""
    return df.withColumns({
        "_last_transformed": F.lit(fx.timestamp_str(clock)),
        "_etl_version": F.lit(version),
        "_source_date": F.lit(source_date),
    })


def dedup_stats(df: DataFrame, key: str) -> DataFrame:
    """rows, distinct keys (null counted as one value) and duplicates removed."""
    k = F.col(key)
    distinct = F.count_distinct(k) + F.max(F.when(k.isNull(), 1).otherwise(0))
    return (df.agg(F.count(F.lit(1)).alias("rows_before"), distinct.alias("rows_after"))
              .withColumn("duplicates_removed", F.col("rows_before") - F.col("rows_after")))
