"""Summary queries over curated tables (counts, revenue, null keys, stage totals).

All are single aggregations with map-side partial combine; ordered outputs
sort the (small) aggregate, and top-k uses ``orderBy().limit()`` which Spark
plans as ``TakeOrderedAndProject`` (per-partition top-k, no global sort).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refinery.functions import columns as fx
from refinery.operators.cleaning import GROUP_ROWS, dedup


def register_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df


def sql_over(df: DataFrame, view: str, sql: str) -> DataFrame:
    """Run ``sql`` against ``df`` registered as temp view ``view`` (same Catalyst plan as the API)."""
    register_view(df, view)
    return df.sparkSession.sql(sql)


def total(df: DataFrame, alias: str = "total_rows") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(alias))


def null_keys(df: DataFrame, key: str, alias: str = "null_keys") -> DataFrame:
    return df.agg(F.count_if(F.col(key).isNull()).alias(alias))


def by_month(df: DataFrame, year: str = "year", month: str = "month") -> DataFrame:
    return (df.groupBy(year, month).agg(F.count(F.lit(1)).alias("cnt"))
              .orderBy(F.col(year).asc_nulls_first(), F.col(month).asc_nulls_first()))


def count_by(df: DataFrame, col: str, sort: str | None = None, alias: str = "cnt") -> DataFrame:
    """Row count per value of ``col``; ``sort`` in {None, 'key', 'count'}."""
    out = df.groupBy(col).agg(F.count(F.lit(1)).alias(alias))
    if sort == "key":
        out = out.orderBy(F.col(col).asc_nulls_first())
    elif sort == "count":
        out = out.orderBy(F.col(alias).desc(), F.col(col).asc_nulls_first())
    return out


def revenue_by(df: DataFrame, keys: Sequence[str] | str, amount: str = "total_ttc",
               alias: str = "revenue") -> DataFrame:
    """round(sum(amount), 2) per key, largest first.

    Amounts are 2-decimal values; they are summed as decimals so the result
    does not depend on the order in which partitions are combined.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    out = df.groupBy(*keys).agg(F.round(fx.money_sum(amount), 2).alias(alias))
    return out.orderBy(F.col(alias).desc(), *[F.col(k).asc_nulls_first() for k in keys])


@dataclass(frozen=True)
class Summary:
    """One summary of a table: rows (or the sum of the ``amount`` column as money) by at most two columns."""
    name: str
    keys: tuple[str, ...] = ()
    amount: str | None = None


def in_one_pass(df: DataFrame, summaries: Sequence[Summary]) -> DataFrame:
    """All ``summaries`` of ``df`` as rows of (summary, key, key2, value), by one aggregation over grouping sets.

    One scan and one shuffle of partial results, however many summaries there are.  Keys are text, null where the
    table has null; a summary without keys is a single row, also over an empty table.
    """
    cols = sorted({k for s in summaries for k in s.keys})
    sets = sorted({tuple(sorted(s.keys)) for s in summaries})
    amounts = sorted({s.amount for s in summaries if s.amount})
    measures = [F.count(F.lit(1)).cast("double").alias("_rows"),
                *[F.round(fx.money_sum(a), 2).cast("double").alias(f"_sum_{i}") for i, a in enumerate(amounts)]]
    if cols:
        grouped = df.groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(c) for c in cols])
        found = grouped.agg(F.grouping_id().alias("_set"), *measures)
    else:
        found = df.agg(F.lit(0).alias("_set"), *measures)
    out_of = lambda keys: sum(1 << (len(cols) - 1 - i) for i, c in enumerate(cols) if c not in keys)

    def line(s: Summary):
        keys = [F.col(k).cast("string") for k in s.keys] + [F.lit(None).cast("string")] * (2 - len(s.keys))
        value = F.col(f"_sum_{amounts.index(s.amount)}") if s.amount else F.col("_rows")
        return F.struct(F.lit(s.name).alias("summary"), keys[0].alias("key"), keys[1].alias("key2"), value.alias("value"),
                        (F.col("_set") == out_of(s.keys)).alias("_meant"))

    told = found.select(F.inline(F.array(*[line(s) for s in summaries]))).where("_meant").drop("_meant")
    return told


def top_k(df: DataFrame, order: Sequence[Column], k: int = 20) -> DataFrame:
    """The first ``k`` rows by a total order (the console ``show()`` default is 20)."""
    return df.orderBy(*order).limit(k)


def stage_totals(raw: DataFrame, key: str, order_by=(), keep: Column | None = None) -> DataFrame:
    """Rows read, null keys, rows after dedup and rows after cleaning, in one pass.

    One aggregation by key (dedup with group sizes), then one global
    aggregate over the groups; ``keep`` is the cleaning predicate evaluated
    on each dedup winner.
    """
    g = dedup(raw, key, order_by, with_counts=True)
    kept = F.count_if(keep) if keep is not None else F.count(F.lit(1))
    return g.agg(
        F.sum(GROUP_ROWS).alias("rows_read"),
        F.coalesce(F.sum(F.when(F.col(key).isNull(), F.col(GROUP_ROWS))), F.lit(0)).cast("bigint").alias("null_keys"),
        F.count(F.lit(1)).alias("rows_after_dedup"),
        kept.alias("rows_after_cleaning"),
    )
