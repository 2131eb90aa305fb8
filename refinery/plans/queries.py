"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame``.

Each reads whole driver tables (through the dirty-sample builders) and runs
one or more operators.  Dates are rendered as ``yyyy-MM-dd`` text in the
final projection so results compare across engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from refinery.functions import columns as fx
from refinery.functions import fixed
from refinery.operators import cleaning as cl
from refinery.operators import hot_keys, late, privacy, quality, summaries
from refinery.plans import curation as cur
from refinery.plans import samples

AS_OF = "2001-12-31"
CLOCK = "2001-12-31T00:00:00"
SOURCE_DATE = "2001-12-31"
TIMELINESS_AS_OF = "1995-06-17"

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        REGISTRY[name] = fn
        return fn
    return deco


def _d(col: str):
    return F.col(col).cast("string").alias(col)


# --- shared inputs ----------------------------------------------------------------

def clean_sales(spark, sf):
    return cur.clean_sales(samples.raw_sales(spark, sf))


def customer_dim(spark, sf):
    return cur.customer_dimension(samples.raw_customers(spark, sf), AS_OF)


def enriched_sales(spark, sf):
    raw = samples.raw_sales(spark, sf)
    return cur.enrich_sales(cur.clean_sales(raw), customer_dim(spark, sf), raw=raw)


def curated_customers(spark, sf):
    return cur.enrich_customers(cur.clean_customers(samples.raw_customers(spark, sf), AS_OF), AS_OF)


# --- sales cleaning -----------------------------------------------------------------

@register("sales_dedup")
def sales_dedup(spark, sf):
    raw = samples.raw_sales(spark, sf)
    return cl.require_key(cl.dedup(raw, "id", "seq"), "id")


@register("sales_dedup_stats")
def sales_dedup_stats(spark, sf):
    return cl.dedup_stats(samples.raw_sales(spark, sf), "id")


@register("lineitem_dedup")
def lineitem_dedup(spark, sf):
    return cl.dedup(samples.line_sales(spark, sf), ["l_orderkey", "l_linenumber"])


@register("sales_latest")
def sales_latest(spark, sf):
    """Id and amount of the latest row of each sale; the other columns are not read."""
    raw = samples.raw_sales(spark, sf)
    address = [*late.file_address(), F.col("seq")]  # a source row may stand for two sales
    return cl.require_key(late.latest(raw, "id", F.col("seq"), ["amount"], address), "id")


@register("user_last_event")
def user_last_event(spark, sf):
    """The last event of every user."""
    return late.latest(samples.table(spark, sf, "events"), "user_id", "event_id", ["event_id", "event_type", "props"])


@register("sales_positive")
def sales_positive(spark, sf):
    df = cl.require_key(cl.dedup(samples.raw_sales(spark, sf), "id", "seq"), "id")
    df = cl.require_positive(cl.coerce(df, {"amount": "double"}), "amount")
    return df.select("id", "amount")


@register("sales_defaults")
def sales_defaults(spark, sf):
    return clean_sales(spark, sf).select("id", "product", "client_id", "quantity")


@register("sales_amounts")
def sales_amounts(spark, sf):
    li = samples.line_sales(spark, sf)
    df = li.select("l_orderkey", "l_linenumber", F.col("l_extendedprice").alias("amount"),
                   F.col("l_quantity").cast("int").alias("quantity"))
    return cur.add_amounts(df)


@register("sales_date_parts")
def sales_date_parts(spark, sf):
    df = cur.add_date_parts(clean_sales(spark, sf), "sale_date")
    return df.select("id", _d("sale_date"), "year", "month", "day")


@register("sales_enriched")
def sales_enriched(spark, sf):
    return enriched_sales(spark, sf).select("id", "client_id", "segment", "region", "amount",
                                            "amount_ttc", "total", "total_ttc")


@register("sales_merge_join")
def sales_merge_join(spark, sf):
    """The enrichment with the join forced to sort and merge."""
    clean = cur.clean_sales(samples.raw_sales(spark, sf))
    return cur.enrich_sales(clean, customer_dim(spark, sf), strategy="merge").select("id", "client_id", "segment", "region", "total_ttc")


@register("hot_clients")
def hot_clients(spark, sf):
    """Clients with over 0.2 % of the sales: sketches of each order priority's sales, merged, then exact counts."""
    raw, share = samples.raw_sales(spark, sf), 0.002
    clients = cur.client_keys(raw).select("client_id")
    parts = hot_keys.summarise(raw.withColumn("client_id", F.trim("client_id")).na.fill({"client_id": fixed.CLIENT_DEFAULT}),
                               "client_id", ["product"])
    return hot_keys.hot_keys(clients, "client_id", share, tracked=hot_keys.TRACKED, summaries=hot_keys.merged(parts))


@register("hot_event_users")
def hot_event_users(spark, sf):
    """Users with over 1 % of the events of their type, one sketch a type."""
    return hot_keys.hot_keys(samples.table(spark, sf, "events"), "user_id", 0.01, ["event_type"])


@register("sales_missing_dim")
def sales_missing_dim(spark, sf):
    from refinery.operators.joins import read_dimension
    from refinery.session import scratch_dir
    dim = read_dimension(spark, scratch_dir(spark, "absent") + "/customers")
    return cur.enrich_sales(clean_sales(spark, sf), dim).select("id", "client_id", "segment", "region", "total_ttc")


@register("revenue_by_region")
def revenue_by_region(spark, sf):
    return summaries.revenue_by(enriched_sales(spark, sf), "region", "total_ttc")


@register("sales_by_month")
def sales_by_month(spark, sf):
    return summaries.by_month(enriched_sales(spark, sf))


@register("top_regions")
def top_regions(spark, sf):
    rev = summaries.revenue_by(enriched_sales(spark, sf), ["region", "segment"], "total_ttc")
    return summaries.top_k(rev, [F.col("revenue").desc(), F.col("region").asc_nulls_first(),
                                 F.col("segment").asc_nulls_first()], 20)


@register("sales_stamped")
def sales_stamped(spark, sf):
    raw = samples.raw_sales(spark, sf)
    df = cur.curate_sales(raw, customer_dim(spark, sf), CLOCK, SOURCE_DATE)
    return df.select("id", "_last_transformed", "_etl_version", "_source_date")


@register("sales_totals_sql")
def sales_totals_sql(spark, sf):
    """The sanity summary as SQL over a temp view: total rows and null keys in one scan."""
    return summaries.sql_over(enriched_sales(spark, sf), "sales_curated_tmp",
                              "SELECT COUNT(*) AS total_rows, COUNT_IF(id IS NULL) AS null_keys, "
                              "COUNT_IF(region IS NULL) AS rows_without_region FROM sales_curated_tmp")


@register("stage_totals")
def stage_totals(spark, sf):
    keep = cl.key_present("id") & (fx.to_double("amount") > 0) & ~F.isnan(fx.to_double("amount"))
    return summaries.stage_totals(samples.raw_sales(spark, sf), "id", "seq", F.coalesce(keep, F.lit(False)))


# --- customers ------------------------------------------------------------------------

@register("customers_text")
def customers_text(spark, sf):
    return cur.clean_customers(samples.raw_customers(spark, sf), AS_OF).select(
        "id", "last_name", "first_name", "region", "segment", "postcode")


@register("customers_email")
def customers_email(spark, sf):
    return cur.clean_customers(samples.raw_customers(spark, sf), AS_OF).select("id", "email")


@register("customers_phone")
def customers_phone(spark, sf):
    return cur.clean_customers(samples.raw_customers(spark, sf), AS_OF).select("id", "phone")


@register("customers_flag")
def customers_flag(spark, sf):
    return cur.clean_customers(samples.raw_customers(spark, sf), AS_OF).select("id", "active")


@register("customers_age")
def customers_age(spark, sf):
    return curated_customers(spark, sf).select("id", _d("birth_date"), "age", "age_band")


@register("customers_loyalty")
def customers_loyalty(spark, sf):
    return curated_customers(spark, sf).select("id", _d("signup_date"), "tenure_days", "loyalty",
                                               "signup_year", "signup_month")


@register("customers_masked")
def customers_masked(spark, sf):
    df = privacy.mask(curated_customers(spark, sf))
    return df.select("id", "email", "phone", "last_name", "first_name", "birth_date", "age")


@register("customers_by_segment")
def customers_by_segment(spark, sf):
    return summaries.count_by(curated_customers(spark, sf), "segment", sort="count")


@register("customers_by_loyalty")
def customers_by_loyalty(spark, sf):
    return summaries.count_by(curated_customers(spark, sf), "loyalty")


@register("customers_by_age_band")
def customers_by_age_band(spark, sf):
    return summaries.count_by(curated_customers(spark, sf), "age_band", sort="key")


@register("customers_by_active")
def customers_by_active(spark, sf):
    return summaries.count_by(curated_customers(spark, sf), "active")


# --- data quality -------------------------------------------------------------------------

@register("dq_completeness")
def dq_completeness(spark, sf):
    out = None
    for entity, df in (("sales", samples.raw_sales(spark, sf)), ("customers", samples.raw_customers(spark, sf))):
        c = quality.completeness_columns(df).select(F.lit(entity).alias("entity"), "column_name", "rows",
                                                    "non_blank", "completeness")
        out = c if out is None else out.unionByName(c)
    return out


def _dims(spark, sf, zone="raw", keys=True):
    """Dimension rows of both raw samples; ``keys=False`` skips the distinct-key count
    (and its shuffle) when the uniqueness rows are not needed."""
    key = {"key": "id"} if keys else {}
    return quality.run_many({
        "sales": (samples.raw_sales(spark, sf), {**key, "amount": "amount"}),
        "customers": (samples.raw_customers(spark, sf), key),
    }, zone, SOURCE_DATE, AS_OF)


@register("dq_uniqueness")
def dq_uniqueness(spark, sf):
    docs = samples.table(spark, sf, "documents").select("doc_id", "text")
    d = _dims(spark, sf).unionByName(quality.run(docs, "raw", "documents", SOURCE_DATE, AS_OF, key="text",
                                                        wide_key=True))
    return d.where(F.col("dimension") == quality.fixed.DIM_UNIQUENESS).select(
        "entity", "status", "score", "total", "unique", "duplicates")


@register("dq_validity")
def dq_validity(spark, sf):
    return _dims(spark, sf, keys=False).where(F.col("dimension") == quality.fixed.DIM_VALIDITY).select(
        "entity", "status", "score", "check")


@register("dq_timeliness")
def dq_timeliness(spark, sf):
    dates = samples.raw_sales(spark, sf).select("sale_date").distinct()
    t = quality.timeliness(F.col("sale_date"), TIMELINESS_AS_OF)
    return dates.select("sale_date", t.status.alias("status"), t.score.alias("score"),
                        t.age_days.alias("age_days"))


@register("dq_report")
def dq_report(spark, sf):
    return quality.with_global(_dims(spark, sf)).select(
        "zone", "entity", "rows", "dimension", "status", "score", "global_score", "global_status",
        "recommendation")
