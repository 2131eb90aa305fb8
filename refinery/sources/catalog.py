"""Catalog registration: database, external partitioned table, partition discovery.

A new table finds its partitions by one listing (:func:`register`).  After that nothing needs to be listed: a batch
written through the table registers the partitions it wrote (:func:`insert`), and those that another job wrote beside
the table are added by name (:func:`add_partitions`).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from refinery.session import session_conf
from refinery.sources.sinks import MIN_TASK_BYTES_KEY

#: partitions that one statement adds
ADD_AT_ONCE = 500


def _q(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def ensure_database(spark: SparkSession, name: str, comment: str | None = None,
                    location: str | None = None) -> None:
    sql = f"CREATE DATABASE IF NOT EXISTS `{name}`"
    if comment:
        sql += f" COMMENT {_q(comment)}"
    if location:
        sql += f" LOCATION {_q(location)}"
    spark.sql(sql)


def table_ddl(db: str, table: str, schema_df: DataFrame, partition_cols: Sequence[str], location: str,
              comments: Mapping[str, str] | None = None) -> str:
    """``CREATE TABLE ... USING parquet PARTITIONED BY ... LOCATION`` derived from a DataFrame schema.

    Partition columns appear once (as the last columns); their type is the
    DataFrame's (strings for year/month/day).
    """
    comments = comments or {}
    fields = [f for f in schema_df.schema.fields if f.name not in partition_cols]
    fields += [schema_df.schema[p] for p in partition_cols]
    cols = []
    for f in fields:
        c = f"`{f.name}` {f.dataType.simpleString()}"
        if f.name in comments:
            c += f" COMMENT {_q(comments[f.name])}"
        cols.append(c)
    parts = ", ".join(f"`{p}`" for p in partition_cols)
    ddl = f"CREATE TABLE IF NOT EXISTS `{db}`.`{table}` ({', '.join(cols)}) USING parquet"
    if partition_cols:
        ddl += f" PARTITIONED BY ({parts})"
    ddl += f" LOCATION {_q(location)} TBLPROPERTIES ('parquet.compression'='SNAPPY')"
    return ddl


def _external(spark: SparkSession, db: str, table: str) -> bool:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED `{db}`.`{table}`").where("col_name = 'Type'").select("data_type").collect()
    return bool(rows) and rows[0]["data_type"].upper() == "EXTERNAL"


def register(spark: SparkSession, db: str, table: str, schema_df: DataFrame, partition_cols: Sequence[str],
             location: str, comments: Mapping[str, str] | None = None) -> DataFrame:
    """Register an external table over ``location`` and discover its partitions.

    An external table of the same name is replaced, so the name always stands
    for this location and schema (its old files stay where they are).  A managed
    table of that name raises, because dropping it would delete its data.
    """
    if spark.catalog.tableExists(f"{db}.{table}"):
        if not _external(spark, db, table):
            raise ValueError(f"{db}.{table} is a managed table; it is not replaced by an external one")
        spark.sql(f"DROP TABLE `{db}`.`{table}`")
    spark.sql(table_ddl(db, table, schema_df, partition_cols, location, comments))
    if partition_cols:
        spark.sql(f"MSCK REPAIR TABLE `{db}`.`{table}`")
    return spark.table(f"`{db}`.`{table}`")


def insert(df: DataFrame, db: str, table: str, rebalance: bool = True, min_task_bytes: str | None = "64k") -> None:
    """Write a batch through a registered table: the partitions it holds are replaced and, where new, registered.

    Columns bind by name; a missing or further one raises.  Spark's write keeps the list of the partitions it touched
    and adds the new ones to the catalog, so no folder is listed and other partitions stay as they are.  A run that is
    repeated leaves the same rows.  A null partition value is the partition of nulls.  An empty batch changes
    nothing.  For ``rebalance`` and ``min_task_bytes`` see :func:`refinery.sources.sinks.write_curated`.
    """
    spark, name = df.sparkSession, f"`{db}`.`{table}`"
    columns = spark.table(name).columns
    if sorted(columns) != sorted(df.columns):
        raise ValueError(f"columns differ from those of {db}.{table}: {sorted(set(columns) ^ set(df.columns))}")
    keys = [c.name for c in spark.catalog.listColumns(f"{db}.{table}") if c.isPartition]
    out = df.select(*[F.col(f"`{c}`") for c in columns])
    out = out.hint("rebalance", *keys) if rebalance and keys else out
    with session_conf(spark, {MIN_TASK_BYTES_KEY: min_task_bytes, "spark.sql.sources.partitionOverwriteMode": "dynamic"}):
        out.write.insertInto(name, overwrite=True)


def add_partitions(spark: SparkSession, db: str, table: str, values: DataFrame) -> int:
    """Register the partitions named by the rows of ``values``, whose files another job has written already.

    ``values`` holds the table's partition columns (others are ignored) and may repeat them; Spark reduces it to one row
    per partition, and only these names pass through the driver, ``ADD_AT_ONCE`` to a statement.  Partitions that are
    registered already stay as they are.  Returns the number of names.
    """
    keys = [c.name for c in spark.catalog.listColumns(f"{db}.{table}") if c.isPartition]
    if not keys:
        raise ValueError(f"{db}.{table} has no partitions")
    names = values.select(*[F.col(k).cast("string").alias(k) for k in keys]).distinct()
    held, done = [], 0
    for row in names.toLocalIterator():
        held.append("PARTITION (" + ", ".join(f"`{k}` = {'NULL' if row[k] is None else _q(row[k])}" for k in keys) + ")")
        if len(held) == ADD_AT_ONCE:
            spark.sql(f"ALTER TABLE `{db}`.`{table}` ADD IF NOT EXISTS {' '.join(held)}")
            done, held = done + len(held), []
    if held:
        spark.sql(f"ALTER TABLE `{db}`.`{table}` ADD IF NOT EXISTS {' '.join(held)}")
    return done + len(held)
