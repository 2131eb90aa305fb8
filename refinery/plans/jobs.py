"""Jobs: user-level composition of the operators (customers, sales, quality,
compaction, daily run).

Paths are ``<root>/sources/<entity>/*.csv`` (landing input),
``<root>/raw/<entity>/ingest_date=<d>/`` (raw zone),
``<root>/curated/<entity>/<partitions>/`` (curated zone),
``<root>/summaries/<entity>``, ``<root>/reports/`` and ``<root>/alerts/``.

Stage metrics come from ``DataFrame.observe`` (collected while the write
runs) instead of separate ``count()`` actions that would re-read the input.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from refinery.operators import alerts, maintenance, quality, summaries
from refinery.operators.joins import read_dimension
from refinery.operators.privacy import mask
from refinery.plans import curation as cur
from refinery.sources import landing, readers, sinks
from refinery.sources.landing import PARTITION

SALES_PARTITIONS = maintenance.SALES_LAYOUT.partition_cols
CUSTOMERS_PARTITIONS = maintenance.CUSTOMERS_LAYOUT.partition_cols


def _observed(df: DataFrame, name: str, key: str) -> tuple[DataFrame, Observation]:
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows"),
                      F.count_if(F.col(key).isNull()).alias("null_keys")), obs


def _of_batch(df: DataFrame, date: str) -> DataFrame:
    """The curated rows that this source date wrote (the summaries of a day don't read older rows' values)."""
    return df.where(F.col("_source_date") == date)


CUSTOMER_SUMMARIES = [summaries.Summary("total"), *[summaries.Summary(f"by_{c}", (c,))
                                                    for c in ("segment", "loyalty", "age_band", "active")]]
SALES_SUMMARIES = [summaries.Summary("total"), summaries.Summary("by_month", ("year", "month")),
                   summaries.Summary("revenue_by_region", ("region",), "total_ttc")]


def _write_summary(entity: str, back: DataFrame, wanted: list[summaries.Summary], raw_null_keys: int, path: str) -> None:
    """The summaries of the curated rows, by one pass over them, and the null keys seen while the raw rows were read."""
    found = summaries.in_one_pass(back, wanted)
    nulls = back.sparkSession.createDataFrame([("raw_null_keys", None, None, float(raw_null_keys))], found.schema)
    rows = found.unionByName(nulls).select(F.lit(entity).alias("entity"), "*")
    rows.coalesce(1).write.mode("overwrite").parquet(path)  # a few dozen rows


def build_customers(spark: SparkSession, root: str, date: str, as_of, clock) -> dict:
    """Raw customers of ``date`` -> cleaned, enriched, masked, partitioned by region/segment."""
    raw = readers.read_raw(spark, f"{root}/raw", "customers", date).drop(PARTITION)
    raw, seen = _observed(raw, "raw_customers", cur.CUSTOMERS_KEY)
    df = cur.curate_customers(raw, as_of, clock, date)
    df, obs = _observed(df, "customers", cur.CUSTOMERS_KEY)
    sinks.write_curated(mask(df), f"{root}/curated/customers", CUSTOMERS_PARTITIONS)
    back = _of_batch(readers.read_curated(spark, f"{root}/curated/customers", CUSTOMERS_PARTITIONS), date)
    _write_summary("customers", back, CUSTOMER_SUMMARIES, seen.get["null_keys"], f"{root}/summaries/customers")
    return dict(obs.get)


def build_sales(spark: SparkSession, root: str, date: str, clock, strategy: str = "auto") -> dict:
    """Raw sales of ``date`` -> cleaned, joined with curated customers, partitioned by year/month/day.

    A missing customers table leaves segment/region null (the job goes on).
    """
    raw = readers.read_raw(spark, f"{root}/raw", "sales", date).drop(PARTITION)
    dim = read_dimension(spark, f"{root}/curated/customers", CUSTOMERS_PARTITIONS)
    watched, seen = _observed(raw, "raw_sales", cur.SALES_KEY)
    df = cur.curate_sales(raw, dim, clock, date, strategy, watched)
    df, obs = _observed(df, "sales", cur.SALES_KEY)
    sinks.write_curated(df, f"{root}/curated/sales", SALES_PARTITIONS)
    back = _of_batch(readers.read_curated(spark, f"{root}/curated/sales", SALES_PARTITIONS), date)
    _write_summary("sales", back, SALES_SUMMARIES, seen.get["null_keys"], f"{root}/summaries/sales")
    return dict(obs.get)


QUALITY_OPTIONS = {"sales": {"key": "id", "amount": "amount"}, "customers": {"key": "id"}}
PARTITIONS = {"sales": SALES_PARTITIONS, "customers": CUSTOMERS_PARTITIONS}


def check_quality(spark: SparkSession, root: str, zone: str, entity: str, date: str, as_of, clock) -> DataFrame:
    """Score one input and write its report; returns the dimension rows with global columns."""
    zone_root = f"{root}/{zone}"
    if not maintenance.exists(spark, f"{zone_root}/{entity}"):
        sinks.write_report(quality.empty_report(spark, zone, entity, date, clock), f"{root}/reports")
        return quality.with_global(quality.missing_input(spark, zone, entity, date))
    df = readers.load_zone(spark, zone, zone_root, entity, date if zone == "raw" else None, PARTITIONS[entity])
    if PARTITION in df.columns:
        df = df.drop(PARTITION)
    if zone == "curated" and "_source_date" in df.columns:
        df = _of_batch(df, date)
    dims = quality.run(df, zone, entity, date, as_of, **QUALITY_OPTIONS.get(entity, {}))
    rows = dims.collect()  # one row per dimension
    dims = spark.createDataFrame(rows, dims.schema)
    sinks.write_report(quality.report(dims, clock), f"{root}/reports")
    return quality.with_global(dims)


def compact_all(spark: SparkSession, root: str, forced_files: int | None = None,
                cleanup_backups: bool = False, incremental: bool = False) -> DataFrame:
    layouts = {"sales": maintenance.SALES_LAYOUT, "customers": maintenance.CUSTOMERS_LAYOUT}
    return maintenance.compact_all(spark, f"{root}/curated", layouts, forced_files, cleanup_backups, incremental)


def run_day(spark: SparkSession, root: str, date: str, clock, as_of, now: dt.datetime | None = None,
            purge: bool = False) -> DataFrame:
    """The daily order: land both -> raw DQ both -> customers -> sales -> curated DQ both
    -> compaction of untidy folders -> retention (``purge``: raw files past their time are deleted, else
    counted) -> success alert.  Raises on the first failure.

    Returns one status row per stage.
    """
    rows: list[tuple] = []
    for entity in ("sales", "customers"):
        landed = landing.land(spark, f"{root}/sources/{entity}", f"{root}/raw", entity, date, clock, glob="*.csv")
        rows.append(("land", entity, "OK" if landed is not None else "EMPTY", None))
    for entity in ("sales", "customers"):
        g = check_quality(spark, root, "raw", entity, date, as_of, clock).select("global_status").first()
        rows.append(("quality_raw", entity, g["global_status"] if g else "CRITICAL", None))
    m = build_customers(spark, root, date, as_of, clock)
    rows.append(("build", "customers", "OK", int(m["rows"])))
    m = build_sales(spark, root, date, clock)
    rows.append(("build", "sales", "OK", int(m["rows"])))
    for entity in ("sales", "customers"):
        g = check_quality(spark, root, "curated", entity, date, as_of, clock).select("global_status").first()
        rows.append(("quality_curated", entity, g["global_status"] if g else "CRITICAL", None))
    status = compact_all(spark, root, incremental=True)
    for r in status.collect():
        if r["status"] == "FAILED":
            raise RuntimeError(f"compaction failed for {r['entity']}: {r['error']}")
        rows.append(("compaction", r["entity"], r["status"], r["rows"]))
    expired = maintenance.purge(spark, f"{root}/raw", now or dt.datetime.now(), dry_run=not purge)
    rows.append(("retention", "raw", "OK" if purge else "DRY_RUN", expired))
    stamp = clock if isinstance(clock, str) else clock.isoformat()
    done = spark.createDataFrame([(stamp,)], "ts string")
    sinks.append_json(alerts.make(done, F.lit("DATA_LAKE_SUCCESS"), F.lit("data_lake"), F.lit("all_zones"),
                                  F.lit("Pipeline completed successfully"), F.lit("INFO"), F.col("ts")),
                      f"{root}/alerts")
    rows.append(("alert", "data_lake", "OK", 1))
    return spark.createDataFrame(rows, "stage string, entity string, status string, rows long")
