"""Alert tables: alert rows, pipeline status rows, decoration, alerts from DQ, counts.

Alerts are rows of a table (JSON sink), never a side effect on the driver:
delivery channels (chat, e-mail) are outside this library.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refinery.functions import columns as fx
from refinery.functions import fixed

ALERT_SCHEMA = ("timestamp string, type string, entity string, zone string, severity string, message string")
STATUS_SCHEMA = ("timestamp string, dag_id string, task_id string, status string, error_message string, "
                 "context struct<execution_date: string, try_number: int>")


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def make(df: DataFrame, alert_type, entity, zone, message, severity=None, timestamp=None) -> DataFrame:
    """Alert rows (timestamp, type, entity, zone, severity, message); severity defaults to WARNING."""
    sev = _c(severity) if severity is not None else F.lit(fixed.DEFAULT_SEVERITY)
    ts = _c(timestamp) if timestamp is not None else F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss")
    return df.select(ts.cast("string").alias("timestamp"), _c(alert_type).alias("type"),
                     _c(entity).alias("entity"), _c(zone).alias("zone"),
                     F.coalesce(sev, F.lit(fixed.DEFAULT_SEVERITY)).alias("severity"),
                     _c(message).cast("string").alias("message"))


def make_status(df: DataFrame, dag_id, task_id, status, error_message=None, execution_date=None,
                try_number=None, timestamp=None) -> DataFrame:
    """Pipeline status rows; ``context`` is null when neither execution date nor try number is known."""
    ed = _c(execution_date).cast("string") if execution_date is not None else F.lit(None).cast("string")
    tn = _c(try_number).cast("int") if try_number is not None else F.lit(None).cast("int")
    ctx = F.when(ed.isNotNull() | tn.isNotNull(), F.struct(ed.alias("execution_date"), tn.alias("try_number")))
    ts = _c(timestamp) if timestamp is not None else F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss")
    err = _c(error_message).cast("string") if error_message is not None else F.lit(None).cast("string")
    return df.select(ts.cast("string").alias("timestamp"), _c(dag_id).alias("dag_id"), _c(task_id).alias("task_id"),
                     _c(status).alias("status"), err.alias("error_message"), ctx.alias("context"))


def decorate(df: DataFrame) -> DataFrame:
    """Colour per severity (grey when unknown) and ``display``, the text cut at 500 characters for a chat.

    Status rows (with ``status``) get red for FAIL and orange otherwise.  The
    stored text (``message``, ``error_message``) stays whole.
    """
    if "status" in df.columns:
        colour = F.when(F.col("status") == "FAIL", F.lit(fixed.STATUS_COLOUR_FAIL)).otherwise(
            F.lit(fixed.STATUS_COLOUR_OTHER))
        return df.withColumns({"colour": colour, "display": fx.truncate("error_message")})
    colour = fx.lookup("severity", fixed.SEVERITY_COLOURS, fixed.SEVERITY_COLOUR_OTHER)
    return df.withColumns({"colour": colour, "display": fx.truncate("message")})


def from_quality(dims: DataFrame, timestamp: str) -> DataFrame:
    """Alert rows from DQ dimension rows carrying their report's global columns.

    One alert per failing or warning dimension (FAIL -> CRITICAL, WARNING ->
    WARNING) and one per report whose global status is not OK.
    """
    dim_alerts = dims.where(F.col("status").isin("FAIL", "WARNING")).select(
        F.lit(timestamp).alias("timestamp"), F.lit("DATA_QUALITY").alias("type"), "entity", "zone",
        F.when(F.col("status") == "FAIL", "CRITICAL").otherwise("WARNING").alias("severity"),
        F.concat_ws(" ", F.col("dimension"), F.col("status"), F.concat(F.lit("score="),
                    F.col("score").cast("string"))).alias("message"))
    glob = (dims.where(F.col("global_status") != "OK")
                .select("entity", "zone", "global_status", "global_score", "recommendation").distinct())
    glob_alerts = glob.select(
        F.lit(timestamp).alias("timestamp"), F.lit("DATA_QUALITY_GLOBAL").alias("type"), "entity", "zone",
        F.col("global_status").alias("severity"),
        F.concat(F.lit("global score "), F.col("global_score").cast("string"), F.lit(" - "),
                 F.col("recommendation")).alias("message"))
    return dim_alerts.unionByName(glob_alerts)


def counts(alerts: DataFrame) -> DataFrame:
    """Number of alerts per severity and entity."""
    return alerts.groupBy("severity", "entity").agg(F.count(F.lit(1)).alias("alerts"))


def payload(alerts_df: DataFrame, alias: str = "payload") -> DataFrame:
    """One JSON text per alert (all columns), as a delivery channel would send it."""
    return alerts_df.select(F.to_json(F.struct(*[F.col(c) for c in alerts_df.columns])).alias(alias))
