"""Raw -> curated transformations for the two entities (sales, customers).

Composed from the generic operators; column names are the landed names of
``refinery.plans.samples``.  Order follows the source pipeline: dedup on the
business key first (null keys form one group), then key filter, then the
amount / age filters that must run *after* dedup (moving them below it would
change the dedup winner).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refinery.functions import columns as fx
from refinery.functions import fixed
from refinery.operators import cleaning as cl
from refinery.operators.joins import enrich_left

SALES_KEY = "id"
CUSTOMERS_KEY = "id"
#: a client with more than this share of the sales is joined map-side (at most 1 / HOT_SHARE clients)
HOT_SHARE = 0.05
DIM_ORDER = ("_source_date", "_last_transformed")


# --- sales ---------------------------------------------------------------------

LATEST_FIRST = ("ingestion_timestamp", "seq")


def clean_sales(raw: DataFrame, order_by=LATEST_FIRST) -> DataFrame:
    """dedup (latest ingestion wins) -> key -> amount > 0 -> date -> text -> defaults -> quantity."""
    order = [c for c in order_by if c in raw.columns]
    df = cl.dedup(raw, SALES_KEY, order)
    df = cl.require_key(df, SALES_KEY)
    df = cl.coerce(df, {"amount": "double"})
    df = cl.require_positive(df, "amount")
    df = df.withColumn("sale_date", fx.parse_date("sale_date"))
    df = cl.normalise(df, upper=["product"], trim=["client_id"])
    df = cl.defaults(df, {"product": fixed.PRODUCT_DEFAULT, "client_id": fixed.CLIENT_DEFAULT})
    quantity = F.coalesce(fx.to_int("quantity"), F.lit(1)) if "quantity" in df.columns else F.lit(1)
    return df.withColumn("quantity", quantity.cast("int"))


def add_amounts(df: DataFrame, amount: str = "amount", quantity: str = "quantity") -> DataFrame:
    """Tax-inclusive amount, total and tax-inclusive total (rounded twice, as specified)."""
    df = df.withColumn("amount_ttc", fx.with_tax(amount))
    df = df.withColumn("total", fx.line_total(amount, quantity))
    return df.withColumn("total_ttc", fx.line_total("amount_ttc", quantity))


def add_date_parts(df: DataFrame, date: str, prefix: str = "") -> DataFrame:
    return df.withColumns({f"{prefix}year": fx.year_str(date), f"{prefix}month": fx.month_str(date),
                           f"{prefix}day": fx.day_str(date)})


def client_keys(raw: DataFrame) -> DataFrame:
    """The client of every raw sale as :func:`clean_sales` writes it, without the dedup: one column of one scan."""
    return cl.defaults(cl.normalise(raw.select("client_id"), trim=["client_id"]), {"client_id": fixed.CLIENT_DEFAULT})


def enrich_sales(clean: DataFrame, customers: DataFrame | None, strategy: str = "auto",
                 raw: DataFrame | None = None) -> DataFrame:
    """Join segment/region of the client; sales of unknown clients (the default key) and of
    any client with more than ``HOT_SHARE`` of the sales go through a bounded broadcast
    instead of one reducer.  Of several rows of a client the latest counts.  With ``raw``
    (the rows that ``clean`` was made from), hot clients are looked for there, before the dedup."""
    df = enrich_left(clean, customers, "client_id", CUSTOMERS_KEY, ["segment", "region"], strategy,
                     hot_keys=[fixed.CLIENT_DEFAULT], detect_hot_share=HOT_SHARE, dim_order=DIM_ORDER,
                     hot_from=None if raw is None else client_keys(raw))
    df = add_amounts(df)
    return add_date_parts(df, "sale_date")


def curate_sales(raw: DataFrame, customers: DataFrame | None, clock, source_date: str,
                 strategy: str = "auto", watched: DataFrame | None = None) -> DataFrame:
    """``watched`` is ``raw`` with an observation, which only the main pass over the rows should feed."""
    clean = clean_sales(raw if watched is None else watched)
    return cl.stamp(enrich_sales(clean, customers, strategy, raw), clock, source_date)


# --- customers -------------------------------------------------------------------

def clean_customers(raw: DataFrame, as_of, order_by=LATEST_FIRST) -> DataFrame:
    df = cl.dedup(raw, CUSTOMERS_KEY, [c for c in order_by if c in raw.columns])
    df = cl.require_key(df, CUSTOMERS_KEY)
    df = df.withColumns({"birth_date": fx.parse_date("birth_date"), "signup_date": fx.parse_date("signup_date")})
    df = df.withColumn("age", fx.age_years("birth_date", as_of))
    df = cl.require_range(df, "age", fixed.MIN_AGE, fixed.MAX_AGE, null_ok_col="birth_date")
    df = cl.normalise(df, upper=["last_name", "region", "segment"], initcap=["first_name"],
                      lower=["email"], trim=["postcode"])
    df = df.withColumns({
        "email": fx.valid_email("email"),
        "phone": fx.clean_phone("phone"),
        "active": fx.parse_flag("active"),
    })
    return cl.defaults(df, {"segment": fixed.SEGMENT_DEFAULT, "region": fixed.REGION_DEFAULT})


def enrich_customers(df: DataFrame, as_of) -> DataFrame:
    df = df.withColumn("age_band", fx.age_band("age"))
    df = df.withColumn("tenure_days", fx.tenure_days("signup_date", as_of))
    df = df.withColumn("loyalty", fx.loyalty("tenure_days"))
    return df.withColumns({"signup_year": fx.year_str("signup_date"), "signup_month": fx.month_str("signup_date")})


def curate_customers(raw: DataFrame, as_of, clock, source_date: str) -> DataFrame:
    return cl.stamp(enrich_customers(clean_customers(raw, as_of), as_of), clock, source_date)


def customer_dimension(raw_customers: DataFrame, as_of) -> DataFrame:
    """The columns of curated customers that sales enrichment reads."""
    return clean_customers(raw_customers, as_of).select(CUSTOMERS_KEY, "segment", "region")
