"""Registered queries that go through storage: landing, curated round trip,
dynamic partition overwrite, catalog, compaction, retention, alerts, stream,
and the daily run.

Every run writes under a fresh folder of the shared checkpoint directory
(``refinery.session.scratch_dir``), never a machine-local temp folder.
"""

from __future__ import annotations

import csv
import datetime as dt
import io

from pyspark.sql import functions as F

from refinery.functions import columns as fx
from refinery.operators import alerts, maintenance, quality, versions
from refinery.operators.privacy import mask
from refinery.plans import curation as cur
from refinery.plans import jobs, samples
from refinery.plans.queries import AS_OF, CLOCK, SOURCE_DATE, _d, _dims, customer_dim, register
from refinery.session import hadoop_fs, scratch_dir, session_conf
from refinery.sources import catalog, files, landing, readers, sinks
from refinery.streaming import alert_feed

SALES_DATA_COLS = ["id", "sale_date", "amount", "product", "client_id", "segment", "region", "amount_ttc",
                   "total", "total_ttc", "year", "month", "day"]
CUSTOMER_DATA_COLS = ["id", "last_name", "first_name", "email", "phone", "birth_date", "signup_date", "active",
                      "postcode", "age", "age_band", "tenure_days", "loyalty", "region", "segment"]


def write_sources(df, folder: str, prefix: str = "rows", by: str | None = None) -> None:
    """Write a sample as header CSV files with plain names (``<prefix>_<value of by>_<number>.csv``).

    Spaces, quotes and line breaks are kept.  Only file names pass through the driver.
    """
    spark = df.sparkSession
    made = f"{folder}/_made"
    w = df.write.mode("overwrite").options(**landing.CSV_WRITE)
    (w.partitionBy(by) if by else w).csv(made)
    fs, root = hadoop_fs(spark, made)
    path = spark._jvm.org.apache.hadoop.fs.Path
    for n, one in enumerate(fs.globStatus(path(root, "*/part-*.csv" if by else "part-*.csv"))):
        value = one.getPath().getParent().getName().split("=")[-1] if by else "all"
        fs.rename(one.getPath(), path(folder, f"{prefix}_{value}_{n}.csv"))


def write_one_source(df, folder: str, prefix: str = "rows") -> None:
    """Write a sample as one header CSV file, by as many tasks as the sample has.

    Every task writes a part without header, and the parts are joined (:func:`refinery.sources.files.join_local`).  A
    store that lets nobody write into the middle of a file gets it from one task.
    """
    spark = df.sparkSession
    fs, _ = hadoop_fs(spark, folder)
    if fs.getUri().getScheme() != "file":
        return write_sources(df.coalesce(1), folder, prefix)
    made = f"{folder}/_made"
    df.write.mode("overwrite").options(**landing.CSV_WRITE | {"header": "false"}).csv(made)
    path = spark._jvm.org.apache.hadoop.fs.Path
    parts = sorted((one.getPath().toString(), one.getLen()) for one in fs.globStatus(path(made, "part-*.csv")))
    head = io.StringIO()
    csv.writer(head, lineterminator="\n").writerow(df.columns)
    files.join_local(spark, head.getvalue().encode(), parts, f"{folder}/{prefix}_all_0.csv")
    fs.delete(path(made), True)


def write_small_files(df, path: str, partition_cols, per_folder: int, mode: str = "overwrite") -> None:
    """Partitioned Parquet of up to ``per_folder`` files a folder, for a compaction to merge.

    A folder's rows are dealt by a hash, and its deals go to different ones of the session's shuffle tasks.  So few
    files a folder don't mean few tasks: each sorts and writes its share of the folders.
    """
    tasks = max(per_folder, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    row = F.xxhash64(*[x for c in df.columns for x in (F.col(c), F.col(c).isNull())])
    first = F.pmod(F.xxhash64(*partition_cols), F.lit(tasks))
    out = df.repartitionById(tasks, F.pmod(first + F.pmod(row, F.lit(per_folder)), F.lit(tasks)).cast("int"))
    sinks.write_curated(out, path, partition_cols, rebalance=False, mode=mode)


def curated_sales(spark, sf):
    return cur.curate_sales(samples.raw_sales(spark, sf), customer_dim(spark, sf), CLOCK, SOURCE_DATE)


def curated_customers_masked(spark, sf):
    return mask(cur.curate_customers(samples.raw_customers(spark, sf), AS_OF, CLOCK, SOURCE_DATE))


def _sales_out(df):
    return df.select(*[_d(c) if c == "sale_date" else c for c in SALES_DATA_COLS])


def _customers_out(df):
    return df.select(*[_d(c) if c == "signup_date" else c for c in CUSTOMER_DATA_COLS])


def _source_name():
    """The file name without its running number."""
    return F.regexp_replace("file_name", r"_\d+\.csv$", ".csv").alias("file_name")


@register("land_roundtrip")
def land_roundtrip(spark, sf):
    root = scratch_dir(spark, "land")
    raw = samples.raw_sales(spark, sf).withColumn("kind", F.coalesce(F.length("amount"), F.lit(0)))
    write_sources(raw, f"{root}/sources/sales", "sales", "kind")
    landing.land(spark, f"{root}/sources/sales", f"{root}/raw", "sales", SOURCE_DATE, CLOCK)
    back = readers.read_raw(spark, f"{root}/raw", "sales", SOURCE_DATE)
    return back.select("id", "sale_date", "amount", "product", "client_id", "seq", "source_system",
                       "ingestion_timestamp", _source_name(), landing.PARTITION)


@register("land_mixed_headers")
def land_mixed_headers(spark, sf):
    """Files of one folder with reordered and further columns, one excluded file, and another entity's."""
    root = scratch_dir(spark, "mixed")
    o = samples.table(spark, sf, "orders")
    k, folder = F.col("o_orderkey"), f"{root}/sources"
    ident, amount = k.cast("string").alias("id"), F.format_string("%.2f", "o_totalprice").alias("amount")
    write_sources(o.where(k % 3 == 0).select(ident, amount), folder, "sales_a")
    write_sources(o.where(k % 3 == 1).select(amount, ident), folder, "sales_b")
    write_sources(o.where(k % 3 == 2).select(F.col("o_orderpriority").alias("note"), ident, amount), folder, "sales_c")
    write_sources(o.select(F.lit("foo").alias("foo"), F.lit("bar").alias("bar")), folder, "sales_enrichi")
    write_sources(samples.raw_customers(spark, sf), folder, "customers")
    found = landing.land(spark, folder, f"{root}/raw", "sales", SOURCE_DATE, CLOCK)
    return found.select("id", "amount", "note", F.substring("file_name", 1, 7).alias("file_name"))


@register("land_quoted_text")
def land_quoted_text(spark, sf):
    """Whole document texts (line breaks, quotes, backslashes) through source files and the raw zone."""
    root = scratch_dir(spark, "quoted")
    docs = samples.table(spark, sf, "documents")
    text = F.concat(F.lit('say "hi", \\n\\ '), F.col("text"), F.lit(' "'))
    write_sources(docs.select(F.col("doc_id").cast("string").alias("id"), text.alias("text")), f"{root}/sources", "docs")
    landing.land(spark, f"{root}/sources", f"{root}/raw", "docs", SOURCE_DATE, CLOCK)
    return readers.read_raw(spark, f"{root}/raw", "docs", SOURCE_DATE, ["id", "text", *landing.LINEAGE]).select("id", "text")


@register("land_one_file")
def land_one_file(spark, sf):
    """Whole document texts in a single source file, read in ranges of 1 MB, and the raw zone read likewise."""
    root = scratch_dir(spark, "one_file")
    docs = samples.table(spark, sf, "documents")
    text = F.concat(F.lit('"quoted",\n'), F.col("text"), F.lit('\n"" end'))
    write_one_source(docs.select(F.col("doc_id").cast("string").alias("id"), text.alias("text")), f"{root}/sources", "docs")
    with session_conf(spark, {"spark.sql.files.maxPartitionBytes": "1m"}):
        landing.land(spark, f"{root}/sources", f"{root}/raw", "docs", SOURCE_DATE, CLOCK)
        back = readers.read_raw(spark, f"{root}/raw", "docs", SOURCE_DATE, ["id", "text", *landing.LINEAGE], split=True)
    return back.select("id", "text", landing.PARTITION)


@register("land_customers")
def land_customers(spark, sf):
    root = scratch_dir(spark, "land_customers")
    write_sources(samples.raw_customers(spark, sf), f"{root}/sources", "customers")
    landing.land(spark, f"{root}/sources", f"{root}/raw", "customers", SOURCE_DATE, CLOCK)
    return readers.load_zone(spark, "raw", f"{root}/raw", "customers", SOURCE_DATE).withColumn("file_name", _source_name())


@register("curated_roundtrip")
def curated_roundtrip(spark, sf):
    path = scratch_dir(spark, "curated") + "/sales"
    sinks.write_curated(curated_sales(spark, sf), path, jobs.SALES_PARTITIONS)
    return _sales_out(readers.read_curated(spark, path, jobs.SALES_PARTITIONS))


@register("overwrite_partitions")
def overwrite_partitions(spark, sf):
    path = scratch_dir(spark, "overwrite") + "/sales"
    first = curated_sales(spark, sf)
    sinks.write_curated(first, path, jobs.SALES_PARTITIONS)
    # a re-issued batch for 1995: only its large sales, with a later source date
    again = cur.curate_sales(samples.raw_sales(spark, sf), customer_dim(spark, sf), CLOCK, "2002-01-01")
    again = again.where((F.col("year") == "1995") & (F.col("amount") >= 50000))
    sinks.write_curated(again, path, jobs.SALES_PARTITIONS)
    back = readers.read_curated(spark, path, jobs.SALES_PARTITIONS)
    return back.select("id", "amount", "total_ttc", "_source_date", "year", "month", "day")


def _registered(spark, name, df, partition_cols):
    """The table ``name`` registered over a first folder (no rows), then over one with ``df``."""
    root = scratch_dir(spark, "catalog")
    sinks.write_curated(df.limit(0), f"{root}/old", partition_cols)
    sinks.write_curated(df, f"{root}/new", partition_cols)
    catalog.ensure_database(spark, "refinery_lake", "curated zone", f"{root}/refinery_lake.db")
    catalog.register(spark, "refinery_lake", name, df, partition_cols, f"{root}/old")
    return catalog.register(spark, "refinery_lake", name, df, partition_cols, f"{root}/new")


@register("catalog_scan")
def catalog_scan(spark, sf):
    return _sales_out(_registered(spark, "sales", curated_sales(spark, sf), jobs.SALES_PARTITIONS))


@register("catalog_customers")
def catalog_customers(spark, sf):
    return _customers_out(_registered(spark, "customers", curated_customers_masked(spark, sf), jobs.CUSTOMERS_PARTITIONS))


@register("catalog_late")
def catalog_late(spark, sf):
    """A registered table after late batches: one written through it (twice), one beside it and added by name, and one
    beside it that nobody added and that stays unseen, because nothing is listed again."""
    root = scratch_dir(spark, "late")
    path, keys = f"{root}/customers", jobs.CUSTOMERS_PARTITIONS
    df = curated_customers_masked(spark, sf).withColumn("batch", F.pmod(F.col("id").cast("bigint"), F.lit(4)))
    batch = lambda b: df.where(F.col("batch") == b).withColumn(
        "segment", F.concat_ws("-", "segment", F.col("batch").cast("string"))).drop("batch")
    sinks.write_curated(batch(0), path, keys)
    catalog.ensure_database(spark, "refinery_lake", "curated zone", f"{root}/refinery_lake.db")
    catalog.register(spark, "refinery_lake", "customers_late", batch(0), keys, path)
    for _ in range(2):
        catalog.insert(batch(1), "refinery_lake", "customers_late")
    for b in (2, 3):
        sinks.write_curated(batch(b), path, keys)
    catalog.add_partitions(spark, "refinery_lake", "customers_late", batch(2))
    return _customers_out(spark.table("refinery_lake.customers_late"))


@register("compaction")
def compaction(spark, sf):
    root = scratch_dir(spark, "compaction")
    df = curated_customers_masked(spark, sf)
    # many small files: sixteen per region/segment directory
    write_small_files(df, f"{root}/customers", jobs.CUSTOMERS_PARTITIONS, 16)
    maintenance.compact(spark, f"{root}/customers", f"{root}/customers_compact",
                        maintenance.CUSTOMERS_LAYOUT)
    back = readers.read_curated(spark, f"{root}/customers_compact", jobs.CUSTOMERS_PARTITIONS)
    return _customers_out(back)


@register("compaction_swap")
def compaction_swap(spark, sf):
    root = scratch_dir(spark, "swap")
    # small files to compact: about two per day directory for sales, up to eight per customer directory
    write_small_files(curated_sales(spark, sf), f"{root}/curated/sales", jobs.SALES_PARTITIONS, 2)
    write_small_files(curated_customers_masked(spark, sf), f"{root}/curated/customers", jobs.CUSTOMERS_PARTITIONS, 8)
    status = jobs.compact_all(spark, root, cleanup_backups=True).select("entity", "status", F.col("rows").alias("rows_checked"))
    sales = readers.read_curated(spark, f"{root}/curated/sales", jobs.SALES_PARTITIONS)
    customers = readers.read_curated(spark, f"{root}/curated/customers", jobs.CUSTOMERS_PARTITIONS)
    rows = (sales.select(F.lit("sales").alias("entity"), "id", F.col("total_ttc").cast("string").alias("value"))
            .unionByName(customers.select(F.lit("customers").alias("entity"), "id", F.col("email").alias("value"))))
    backups = sum(maintenance.exists(spark, f"{root}/curated/{e}_backup") for e in ("sales", "customers"))
    return rows.join(F.broadcast(status), "entity").withColumn("backups", F.lit(backups))  # two status rows


def _age(spark, folder: str, days: int, pattern: str = "*") -> None:
    """Set the modification time of the files of ``folder`` back by ``days``."""
    fs, root = hadoop_fs(spark, folder)
    then = int((dt.datetime.now() - dt.timedelta(days=days)).timestamp() * 1000)
    for one in fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(root, pattern)):
        if one.isFile():
            fs.setTimes(one.getPath(), then, -1)


@register("retention")
def retention(spark, sf):
    """What is left of a raw zone with old files beside, above and below fresh ones, after a real purge."""
    root = scratch_dir(spark, "retention")
    raw, entity = samples.raw_sales(spark, sf), f"{root}/raw/sales"
    write_sources(raw, f"{root}/sources", "sales")
    for date in ("2001-01-01", SOURCE_DATE):
        landing.land(spark, f"{root}/sources", f"{root}/raw", "sales", date, CLOCK)
    write_sources(raw.limit(5), f"{root}/raw", "stray")
    write_sources(raw.limit(5), entity, "stray")
    write_sources(raw.limit(5), f"{entity}/{landing.PARTITION}={SOURCE_DATE}", "stray")
    limit = maintenance.fixed.RETENTION_DAYS
    for folder, pattern in ((f"{entity}/{landing.PARTITION}=2001-01-01", "*"), (f"{root}/raw", "stray*"), (entity, "stray*"),
                            (f"{entity}/{landing.PARTITION}={SOURCE_DATE}", "stray*")):
        _age(spark, folder, limit + 1, pattern)
    _age(spark, f"{entity}/{landing.PARTITION}={SOURCE_DATE}", limit - 1, "part-*")
    now = dt.datetime.now()
    expired = maintenance.purge(spark, f"{root}/raw", now)
    maintenance.purge(spark, f"{root}/raw", now, dry_run=False)
    left = readers.read_raw(spark, f"{root}/raw", "sales")
    return left.select("id", "amount", "seq", landing.PARTITION).withColumn(
        "purged", F.lit(expired > 0 and maintenance.purge(spark, f"{root}/raw", now) == 0))


@register("alerts_from_quality")
def alerts_from_quality(spark, sf):
    docs = samples.table(spark, sf, "documents").select("doc_id", "text")
    dims = _dims(spark, sf).unionByName(quality.run(docs, "raw", "documents", SOURCE_DATE, AS_OF, key="text",
                                                        wide_key=True))
    out = alerts.decorate(alerts.from_quality(quality.with_global(dims), CLOCK))
    return out.select("timestamp", "type", "entity", "zone", "severity", "message", "colour", "display")


def _status_rows(spark, sf):
    return alerts.make_status(
        samples.status_events(spark, sf), F.lit("events"), F.concat(F.lit("user_"), F.col("user_id").cast("string")),
        F.col("status"), error_message=F.col("error_message"), execution_date=fx.ntz_date_text("ts"),
        try_number=(F.col("event_id") % 3 + 1), timestamp=fx.ntz_iso_text("ts"))


@register("alert_log")
def alert_log(spark, sf):
    """Status rows of all events, stored whole, read back and decorated."""
    path = scratch_dir(spark, "alert_log")
    sinks.append_daily_log(_status_rows(spark, sf), path)
    back = spark.read.schema(alerts.STATUS_SCHEMA + ", alert_date string").json(path)
    return alerts.decorate(back).select(
        "timestamp", "dag_id", "task_id", "status", "error_message", F.col("context.execution_date").alias("execution_date"),
        F.col("context.try_number").alias("try_number"), "alert_date", "colour", "display")


def event_alerts(spark, sf):
    ev = samples.table(spark, sf, "events")
    sev = (F.when(F.col("event_type") == "error", "CRITICAL").when(F.col("event_type") == "signup", "INFO")
            .otherwise("WARNING"))
    return alerts.make(ev, F.upper("event_type"), F.concat(F.lit("user_"), F.col("user_id").cast("string")),
                       F.lit("events"), F.col("props"), sev, fx.ntz_iso_text("ts"))


@register("alert_stream")
def alert_stream(spark, sf):
    root = scratch_dir(spark, "alert_stream")
    sinks.append_json(event_alerts(spark, sf), f"{root}/incoming")
    alert_feed.ingest_stream(spark, f"{root}/incoming", f"{root}/table", f"{root}/checkpoint")
    return alerts.counts(spark.read.parquet(f"{root}/table"))


@register("alert_counts_stream")
def alert_counts_stream(spark, sf):
    """Running alert counts after two deliveries of files and a third run that finds none."""
    root = scratch_dir(spark, "alert_counts")
    rows = event_alerts(spark, sf)
    late = F.col("timestamp") >= "2024-01-15"
    for part in (rows.where(~F.coalesce(late, F.lit(False))), rows.where(late), None):
        if part is not None:
            sinks.append_json(part, f"{root}/incoming")
        alert_feed.count_stream(spark, f"{root}/incoming", f"{root}/totals", f"{root}/checkpoint", max_files_per_trigger=4)
    return alert_feed.running_counts(spark, f"{root}/totals")


def _landed(spark, sf) -> str:
    """A root with both entities landed."""
    root = scratch_dir(spark, "daily")
    write_sources(samples.raw_sales(spark, sf), f"{root}/sources/sales", "sales")
    write_sources(samples.raw_customers(spark, sf), f"{root}/sources/customers", "customers")
    for entity in ("sales", "customers"):
        landing.land(spark, f"{root}/sources/{entity}", f"{root}/raw", entity, SOURCE_DATE, CLOCK)
    return root


@register("daily_customers")
def daily_customers(spark, sf):
    """The curated customers that the customers job writes."""
    root = _landed(spark, sf)
    jobs.build_customers(spark, root, SOURCE_DATE, AS_OF, CLOCK)
    return _customers_out(readers.read_curated(spark, f"{root}/curated/customers", jobs.CUSTOMERS_PARTITIONS))


@register("daily_sales")
def daily_sales(spark, sf):
    """The curated sales and the summaries that both jobs write: one row per sale and per summary line."""
    root = _landed(spark, sf)
    jobs.build_customers(spark, root, SOURCE_DATE, AS_OF, CLOCK)
    jobs.build_sales(spark, root, SOURCE_DATE, CLOCK)
    sales = readers.read_curated(spark, f"{root}/curated/sales", jobs.SALES_PARTITIONS).select(
        F.lit("sales").alias("entity"), F.lit("row").alias("summary"), F.col("id").alias("key"),
        F.concat_ws("|", "segment", "region").alias("key2"), F.col("total_ttc").alias("value"))
    return sales.unionByName(spark.read.parquet(f"{root}/summaries/customers", f"{root}/summaries/sales"))


@register("daily_reports")
def daily_reports(spark, sf):
    """The raw-zone quality reports that the quality job writes, one row per dimension."""
    root = _landed(spark, sf)
    for entity in ("sales", "customers"):
        jobs.check_quality(spark, root, "raw", entity, SOURCE_DATE, AS_OF, CLOCK)
    found = spark.read.json(f"{root}/reports")
    return found.select("zone", "entity", F.col("run_date").cast("string").alias("run_date"),
                        F.col("global_assessment.global_score").alias("global_score"), F.explode("dimensions").alias("d")).select(
        "zone", "entity", "run_date", "global_score", F.col("d.dimension").alias("dimension"), F.col("d.status").alias("status"))


@register("daily_missing_input")
def daily_missing_input(spark, sf):
    """Reports of a day on which only the sales have landed: the customers' has no dimension, score 0 and is critical."""
    root = scratch_dir(spark, "missing")
    write_sources(samples.raw_sales(spark, sf), f"{root}/sources", "sales")
    landing.land(spark, f"{root}/sources", f"{root}/raw", "sales", SOURCE_DATE, CLOCK)
    for entity in ("sales", "customers"):
        jobs.check_quality(spark, root, "raw", entity, SOURCE_DATE, AS_OF, CLOCK)
    found = spark.read.json(f"{root}/reports")
    given = F.col("global_assessment")
    return found.select("zone", "entity", F.size("dimensions").alias("dimensions"), given["global_score"].alias("global_score"),
                        given["global_status"].alias("global_status"), given["recommendation"].alias("recommendation"))


@register("land_nothing_new")
def land_nothing_new(spark, sf):
    """The raw zone after a second landing found no file of the entity: the rows of the first are all there."""
    root = scratch_dir(spark, "nothing")
    raw = samples.raw_sales(spark, sf)
    write_sources(raw, f"{root}/first", "sales")
    write_sources(raw, f"{root}/second", "sales_enrichi")
    landing.land(spark, f"{root}/first", f"{root}/raw", "sales", SOURCE_DATE, CLOCK)
    again = landing.land(spark, f"{root}/second", f"{root}/raw", "sales", SOURCE_DATE, CLOCK)
    back = readers.read_raw(spark, f"{root}/raw", "sales", SOURCE_DATE)
    return back.select("id", "amount", "seq", F.lit(again is None).alias("no_op"))


@register("daily_run")
def daily_run(spark, sf):
    """What a whole day leaves behind, retention included: curated rows, the quality reports of both zones, the
    alert, and the raw rows of each date (those of an old date, past their time, are gone)."""
    root, old = scratch_dir(spark, "daily"), "2001-01-01"
    write_sources(samples.raw_sales(spark, sf), f"{root}/sources/sales", "sales")
    write_sources(samples.raw_customers(spark, sf), f"{root}/sources/customers", "customers")
    landing.land(spark, f"{root}/sources/customers", f"{root}/raw", "customers", old, CLOCK)
    _age(spark, f"{root}/raw/customers/{landing.PARTITION}={old}", maintenance.fixed.RETENTION_DAYS + 1)
    jobs.run_day(spark, root, SOURCE_DATE, CLOCK, AS_OF, purge=True)

    def rows(df, what, entity, key, value):
        return df.select(F.lit(what).alias("what"), entity.alias("entity"), key.cast("string").alias("key"),
                         value.cast("string").alias("value"))

    sales = readers.read_curated(spark, f"{root}/curated/sales", jobs.SALES_PARTITIONS)
    customers = readers.read_curated(spark, f"{root}/curated/customers", jobs.CUSTOMERS_PARTITIONS)
    reports = spark.read.json(f"{root}/reports").select("zone", "entity", F.explode("dimensions").alias("d"))
    told = spark.read.schema(alerts.ALERT_SCHEMA).json(f"{root}/alerts")
    out = rows(sales, "curated", F.lit("sales"), F.col("id"), F.col("total_ttc"))
    out = out.unionByName(rows(customers, "curated", F.lit("customers"), F.col("id"), F.col("email")))
    out = out.unionByName(rows(reports, "report", F.concat_ws(":", "zone", "entity"), F.col("d.dimension"), F.col("d.status")))
    out = out.unionByName(rows(told, "alert", F.col("entity"), F.col("type"), F.col("message")))
    for entity in ("sales", "customers"):
        left = readers.read_raw(spark, f"{root}/raw", entity).groupBy(landing.PARTITION).agg(F.count(F.lit(1)).alias("n"))
        out = out.unionByName(rows(left, "raw", F.lit(entity), F.col(landing.PARTITION), F.col("n")))
    return out


@register("compaction_incremental")
def compaction_incremental(spark, sf):
    """Reports of three incremental compactions (many small files; nothing new; late rows in some folders), and the rows left."""
    root = scratch_dir(spark, "incremental")
    path, df = f"{root}/curated/customers", curated_customers_masked(spark, sf)
    batch = F.pmod(F.col("id").cast("bigint"), F.lit(3))
    for b in range(3):  # one file a folder and batch
        write_small_files(df.where(batch == b), path, jobs.CUSTOMERS_PARTITIONS, 1, "append")

    def run(name):
        told = maintenance.compact_all(spark, f"{root}/curated", {"customers": maintenance.CUSTOMERS_LAYOUT}, incremental=True)
        return told.select(F.lit(name).alias("run"), "status", "folders", "files_before", "files_after", "rows")

    told = [run("first"), run("second")]
    late = df.where(F.col("loyalty") == "GOLD").withColumn("id", F.concat(F.lit("late-"), "id"))
    write_small_files(late.where("region = 'ASIA'"), path, jobs.CUSTOMERS_PARTITIONS, 1, "append")
    told.append(run("third"))
    left = readers.read_curated(spark, path, jobs.CUSTOMERS_PARTITIONS).groupBy("region", "segment").agg(F.count(F.lit(1)).alias("rows"))
    none = F.lit(None).cast("int")
    table = left.select(F.concat_ws("/", F.lit("left"), "region", "segment").alias("run"), F.lit("TABLE").alias("status"),
                        none.alias("folders"), none.alias("files_before"), none.alias("files_after"), "rows")
    return told[0].unionByName(told[1]).unionByName(told[2]).unionByName(table)


@register("compaction_versions")
def compaction_versions(spark, sf):
    """A versioned table of many small files, compacted while a reader holds its first version: the rows of both."""
    root = scratch_dir(spark, "versions") + "/customers"
    df = curated_customers_masked(spark, sf)
    first = versions.publish(spark, root, lambda out: write_small_files(df, out, jobs.CUSTOMERS_PARTITIONS, 8))
    held = versions.read(spark, root, jobs.CUSTOMERS_PARTITIONS)
    second = versions.compact(spark, root, maintenance.CUSTOMERS_LAYOUT)
    now = versions.read(spark, root, jobs.CUSTOMERS_PARTITIONS)
    return (_customers_out(held).withColumn("version", F.lit(first))
            .unionByName(_customers_out(now).withColumn("version", F.lit(second))))


@register("alert_rerun")
def alert_rerun(spark, sf):
    """The status log after a day's job ran twice, the second time with its FAIL rows alone."""
    path = scratch_dir(spark, "alert_rerun")
    rows = _status_rows(spark, sf)
    late = F.col("timestamp") >= "2024-01-15"
    sinks.write_run(rows.where(~F.coalesce(late, F.lit(False))), path, "day-1")
    sinks.write_run(rows.where(late), path, "day-2")
    sinks.write_run(rows.where(late & (F.col("status") == "FAIL")), path, "day-2")
    back = spark.read.schema(alerts.STATUS_SCHEMA + ", run string, alert_date string").json(path)
    return back.select("run", "alert_date", "status", "task_id", "timestamp")


@register("compaction_report")
def compaction_report(spark, sf):
    """The report of a whole compaction into a forced number of files, sizes judged against the folders' own listing."""
    root = scratch_dir(spark, "report")
    path = f"{root}/customers"
    df = curated_customers_masked(spark, sf)
    batch = F.pmod(F.col("id").cast("bigint"), F.lit(4))
    for b in range(4):
        write_small_files(df.where(batch == b), path, jobs.CUSTOMERS_PARTITIONS, 1, "append")
    before = maintenance.folder_sizes(spark, path).agg(F.round(F.sum("bytes") / 1024 ** 2, 2)).first()[0]
    rep = maintenance.compact(spark, path, f"{root}/out", maintenance.CUSTOMERS_LAYOUT)
    after = maintenance.folder_sizes(spark, f"{root}/out")
    size, files = after.agg(F.round(F.sum("bytes") / 1024 ** 2, 2), F.sum("files")).first()
    told = spark.createDataFrame([(rep["rows"], rep["files_before"], rep["target_files"], rep["files_after"] == files,
                                   abs(rep["size_mb_before"] - before) < 0.1 and abs(rep["size_mb_after"] - size) < 0.1,
                                   rep["reduction_pct"] == round(100 * (1 - rep["size_mb_after"] / rep["size_mb_before"]), 2))],
                                 "rows long, files_before int, target_files int, files_counted boolean, sizes_agree boolean, reduction_agrees boolean")
    return told
