"""Landing ingest: source CSV files -> raw zone with lineage columns.

The raw zone is Hive-style ``<raw_root>/<entity>/ingest_date=<date>/`` so a
processing date is a partition filter (pruned at listing time) and a rerun
of one date replaces only that date (dynamic partition overwrite).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from refinery.session import hadoop_fs
from refinery.sources import quoted_csv

LINEAGE = ["source_system", "ingestion_timestamp", "file_name"]
PARTITION = "ingest_date"


def ingestion_text(clock) -> str:
    """Ingestion clock as ``yyyy-MM-dd HH:mm:ss`` text."""
    if isinstance(clock, str):
        return clock.replace("T", " ")[:19]
    return clock.strftime("%Y-%m-%d %H:%M:%S")


def with_lineage(df: DataFrame, source_system: str, clock, file_name: Column | str | None = None) -> DataFrame:
    """Append source system, ingestion time and source file name."""
    if file_name is None:
        fname = F.col("_metadata.file_name")
    elif isinstance(file_name, str):
        fname = F.lit(file_name)
    else:
        fname = file_name
    return df.withColumns({
        "source_system": F.lit(source_system),
        "ingestion_timestamp": F.lit(ingestion_text(clock)),
        "file_name": fname,
    })


#: a quoted field may hold line breaks, and a quote inside one is doubled; the same on both sides of the raw zone
CSV_OPTIONS = {"header": "true", "quote": '"', "escape": '"', "multiLine": "true"}
CSV_WRITE = {"header": "true", "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "false",
             "ignoreTrailingWhiteSpace": "false"}


def _frames(spark: SparkSession, folder: str, glob: str, exclude: str | None) -> list[DataFrame]:
    """The rows of the matching files, one DataFrame per distinct header, with the file's path in a column."""
    fs, root = hadoop_fs(spark, folder)
    return [df for _, df in quoted_csv.read_by_header(spark, folder, glob, exclude)] if fs.exists(root) else []


def _together(frames: list[DataFrame]) -> DataFrame | None:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames) if frames else None


def read_sources(spark: SparkSession, folder: str, glob: str = "*.csv",
                 exclude: str | None = "_enrichi") -> DataFrame | None:
    """All matching CSV files of ``folder`` as one DataFrame, or ``None`` when no file matches.

    Each file is read by its own header, whatever the order of its columns;
    a column that a file lacks is null for its rows.  Quoted line breaks,
    doubled quotes and backslashes are kept.  A large file is read by many
    tasks, and many files without a loop over them (see :mod:`quoted_csv`).
    """
    found = _together(_frames(spark, folder, glob, exclude))
    return None if found is None else found.drop(quoted_csv.FILE_PATH)


def land(spark: SparkSession, source_folder: str, raw_root: str, entity: str, date: str, clock,
         glob: str | None = None, exclude: str | None = "_enrichi", fmt: str = "csv") -> DataFrame | None:
    """Land every source file of ``entity`` for ``date``; returns the landed rows
    (read back from the raw zone) or ``None`` when there was nothing to land.

    Header-only files contribute no rows.  Rerunning a date overwrites that
    date's partition only.
    """
    out = _together([with_lineage(f, entity, clock, quoted_csv.file_name()).drop(quoted_csv.FILE_PATH)
                     for f in _frames(spark, source_folder, glob or f"{entity}*.csv", exclude)])
    if out is None:
        return None
    lineage = [F.col(f"`{c}`") for c in out.columns if c not in LINEAGE] + [F.col(c) for c in LINEAGE]
    out = out.select(*lineage).withColumn(PARTITION, F.lit(date))
    target = f"{raw_root.rstrip('/')}/{entity}"
    w = out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PARTITION)
    if fmt == "csv":
        w = w.options(**CSV_WRITE)
    w.format(fmt).save(target)
    return read_raw_landed(spark, target, date, fmt, columns=[c for c in out.columns if c != PARTITION])


def read_raw_landed(spark: SparkSession, entity_root: str, date: str | None, fmt: str = "csv",
                    columns=None) -> DataFrame:
    """Raw rows of one entity, all strings (the date too), pruned to ``date`` when given."""
    r = spark.read.options(**CSV_OPTIONS)
    if columns is not None:
        fields = [T.StructField(c, T.StringType()) for c in [*columns, PARTITION]]
        r = r.schema(T.StructType(fields)).option("enforceSchema", "false")
    df = r.format(fmt).load(entity_root)
    if date is not None:
        df = df.where(F.col(PARTITION) == date)
    return df
