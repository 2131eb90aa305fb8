"""Sinks: partitioned curated Parquet, DQ reports and alert logs (JSON)."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refinery.session import session_conf


MIN_TASK_BYTES_KEY = "spark.sql.adaptive.coalescePartitions.minPartitionSize"


def write_curated(df: DataFrame, path: str, partition_cols: Sequence[str], rebalance: bool = True,
                  mode: str = "overwrite", min_task_bytes: str | None = "64k") -> None:
    """Partitioned Parquet (Snappy) with dynamic partition overwrite.

    Only partitions present in ``df`` are replaced; the rest survive, so a
    rerun of one batch is idempotent.  ``rebalance`` shuffles by the
    partition columns through AQE's REBALANCE, which splits a hot partition
    value over several tasks and merges small ones, so each directory gets a
    few right-sized files instead of one file per task.

    Every output file has a fixed cost, so a small batch spread over many
    directories should still use many writer tasks: for this write AQE may
    not merge shuffle partitions below ``min_task_bytes``.  Large batches
    never reach that floor, so at scale it changes nothing; each partition
    value still hashes to one task, so the file count does not grow.
    """
    out = df.hint("rebalance", *partition_cols) if rebalance and partition_cols else df
    with session_conf(df.sparkSession, {MIN_TASK_BYTES_KEY: min_task_bytes}):
        (out.write.mode(mode).option("partitionOverwriteMode", "dynamic").option("compression", "snappy")
            .partitionBy(*partition_cols).parquet(path))


def write_report(report: DataFrame, path: str) -> None:
    """DQ report documents, one JSON object per (zone, entity, date) partition; reruns replace."""
    (report.withColumnRenamed("data_date", "run_date").write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").partitionBy("zone", "entity", "run_date").json(path))


def append_json(df: DataFrame, path: str, partition_cols: Sequence[str] = ()) -> None:
    """Append rows as JSON lines (alert records, pipeline alert log)."""
    w = df.write.mode("append")
    if partition_cols:
        w = w.partitionBy(*partition_cols)
    w.json(path)


def append_daily_log(df: DataFrame, path: str, timestamp_col: str = "timestamp") -> None:
    """Daily alert log: append partitioned by ``alert_date`` (no read-modify-write)."""
    out = df.withColumn("alert_date", F.substring(F.col(timestamp_col), 1, 10))
    append_json(out, path, ["alert_date"])


def write_run(df: DataFrame, path: str, run: str, timestamp_col: str = "timestamp") -> None:
    """Alert rows of one run of a job, in ``<path>/run=<run>/alert_date=<day>/``.

    A run that is repeated replaces all that its earlier attempt wrote, also days that it no longer writes; other
    runs stay.  ``run`` must be a plain name.
    """
    if not re.fullmatch(r"[A-Za-z0-9_.-]+", run):
        raise ValueError(f"not a plain name: {run!r}")
    out = df.withColumn("alert_date", F.substring(F.col(timestamp_col), 1, 10))
    (out.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("alert_date")
        .json(f"{path.rstrip('/')}/run={run}"))
