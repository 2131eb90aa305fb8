"""Readers for the raw and curated zones."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from refinery.sources import quoted_csv
from refinery.sources.landing import CSV_OPTIONS, LINEAGE, PARTITION

# landed (raw-zone) column lists per entity, all strings
RAW_COLUMNS = {
    "sales": ["id", "sale_date", "amount", "product", "client_id", "seq"] + LINEAGE,
    "customers": ["id", "last_name", "first_name", "email", "phone", "birth_date", "signup_date", "segment",
                  "region", "active", "postcode"] + LINEAGE,
}


def raw_schema(columns: Sequence[str]) -> T.StructType:
    """All-string data columns plus the ``ingest_date`` partition column (kept as text)."""
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns if c != PARTITION]
                        + [T.StructField(PARTITION, T.StringType(), True)])


def read_raw(spark: SparkSession, raw_root: str, entity: str, date: str | None = None,
             columns: Sequence[str] | None = None, multiline: bool = True, split: bool = False) -> DataFrame:
    """Raw CSV rows of ``entity`` (explicit all-string schema, header checked by name).

    A file whose header does not match the schema fails the read instead of
    being misread by position.  Quoting is that of the landing writer.
    ``multiline`` (a quoted field may hold line breaks) makes every file a
    single task; turn it off only for text known to hold none, or read with
    ``split``: then every file is cut into as many tasks as its bytes ask for and
    line breaks are kept all the same (see :mod:`quoted_csv`).  ``date`` is a
    partition filter (directory pruning).
    """
    cols = list(columns or RAW_COLUMNS[entity])
    if split:
        return _split_raw(spark, f"{raw_root.rstrip('/')}/{entity}", date, cols)
    r = (spark.read.schema(raw_schema(cols)).options(**CSV_OPTIONS).option("enforceSchema", "false")
         .option("multiLine", str(multiline).lower()))
    df = r.csv(f"{raw_root.rstrip('/')}/{entity}")
    if date is not None:
        df = df.where(F.col(PARTITION) == date)
    return df


def _split_raw(spark: SparkSession, path: str, date: str | None, cols: list[str]) -> DataFrame:
    found = quoted_csv.read_by_header(spark, path, partition=PARTITION, value=date)
    for names, _ in found:
        if names != cols:
            raise ValueError(f"{path} has a file with the header {names}; {cols} expected")
    rows = found[0][1] if found else spark.createDataFrame([], raw_schema([*cols, quoted_csv.FILE_PATH]))
    day = F.regexp_extract(quoted_csv.FILE_PATH, f"/{PARTITION}=([^/]*)/", 1)
    return rows.select(*[F.col(f"`{c}`") for c in cols], day.alias(PARTITION))


def read_curated(spark: SparkSession, path: str, partition_cols: Sequence[str] = ()) -> DataFrame:
    """Curated Parquet with partition values kept as strings (``'04'`` stays ``'04'``).

    The data schema comes from the Parquet footers; partition columns are
    declared as strings so type inference cannot turn ``month=04`` into 4.
    """
    probe = spark.read.parquet(path)
    fields = [f for f in probe.schema.fields if f.name not in partition_cols]
    fields += [T.StructField(p, T.StringType(), True) for p in partition_cols]
    return spark.read.schema(T.StructType(fields)).parquet(path)


def load_zone(spark: SparkSession, zone: str, root: str, entity: str, date: str | None = None,
              partition_cols: Sequence[str] = ()) -> DataFrame:
    """The input of a quality run: raw CSV for ``raw``, Parquet for ``curated``."""
    if zone == "raw":
        return read_raw(spark, root, entity, date)
    if zone == "curated":
        return read_curated(spark, f"{root.rstrip('/')}/{entity}", partition_cols)
    raise ValueError(f"unknown zone {zone!r}")
