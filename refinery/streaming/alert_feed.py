"""Alert feed: a Structured Streaming copy of alert JSON files into a table.

The source folder is watched by the file source (new files only, tracked
in the checkpoint); the Parquet file sink is exactly-once with that
checkpoint, so rerunning after a crash or an executor loss neither loses
nor duplicates alerts.  ``trigger(availableNow=True)`` processes what is
there and stops, which suits a scheduled job; ``processingTime`` keeps it
running.  The copy needs no watermark: the sink is append-only and the query
keeps no state.

Running counts are a stateful query over the same feed: the state store holds
one number per severity and entity, and each batch writes the totals it changed
into a folder of its own, which a batch that is repeated replaces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from refinery.operators import alerts
from refinery.operators.alerts import ALERT_SCHEMA


def alert_stream(spark: SparkSession, folder: str, multiline: bool = False,
                 max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming DataFrame of alert records (pretty-printed single objects need ``multiline``)."""
    r = spark.readStream.schema(ALERT_SCHEMA).option("multiLine", str(multiline).lower())
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.json(folder).withColumn("source_file", F.col("_metadata.file_name"))


def ingest_stream(spark: SparkSession, folder: str, table_path: str, checkpoint: str,
                  multiline: bool = False, once: bool = True, interval: str = "5 seconds"):
    """Start the copy; returns the ``StreamingQuery`` (already finished when ``once``)."""
    w = (alert_stream(spark, folder, multiline).writeStream.format("parquet").option("path", table_path)
         .option("checkpointLocation", checkpoint).outputMode("append"))
    return _started(w, once, interval)


def _started(writer, once: bool, interval: str):
    q = (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=interval)).start()
    if once:
        q.awaitTermination()
    return q


def count_stream(spark: SparkSession, folder: str, totals_path: str, checkpoint: str, multiline: bool = False,
                 once: bool = True, interval: str = "5 seconds", max_files_per_trigger: int | None = None):
    """Start the running counts of alerts per severity and entity; returns the ``StreamingQuery``.

    Counts are kept in the state store of ``checkpoint`` (one long per pair, null severity or entity included; a
    hot entity is summed up in each task before the shuffle), so a run reads new files only.  Batch n writes the
    totals that changed in it to ``<totals_path>/batch=<n>``; a batch that is repeated after a failure counts from
    the same state and replaces that folder, so nothing is counted twice.  :func:`running_counts` reads them.
    A session may set ``spark.sql.streaming.stateStore.providerClass`` where the pairs outgrow the heap.
    """
    def put(changed: DataFrame, batch: int) -> None:
        changed.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{totals_path}/batch={batch}")

    counted = alerts.counts(alert_stream(spark, folder, multiline, max_files_per_trigger))
    w = counted.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(put)
    return _started(w, once, interval)


def running_counts(spark: SparkSession, totals_path: str) -> DataFrame:
    """The newest total per severity and entity of :func:`count_stream`; one aggregation over what the batches changed."""
    found = spark.read.schema("severity string, entity string, alerts bigint, batch bigint").parquet(totals_path)
    return found.groupBy("severity", "entity").agg(F.max_by("alerts", "batch").alias("alerts"))
