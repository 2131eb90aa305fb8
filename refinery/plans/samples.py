"""Dirty raw-zone samples derived from the driver's tables.

The driver's tables hold no nulls; these builders add dirt with
deterministic rules on the integer key ``k`` so that the same rows can be
written in DuckDB SQL (see ``refinery.plans.oracle``).  Every builder reads
whole tables; the modulo rules only choose *which dirt* a row gets, never
which rows are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from refinery.functions import columns as fx


def _null():
    return F.lit(None).cast("string")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _sale_cols(k: Column, amount: Column) -> list[Column]:
    return [
        F.when(k % 97 == 0, _null()).when(k % 89 == 0, F.lit("")).otherwise(k.cast("string")).alias("id"),
        F.when(k % 67 == 0, F.lit("n/a")).otherwise(fx.ntz_date_text("o_orderdate")).alias("sale_date"),
        amount.alias("amount"),
        F.when(k % 71 == 0, _null())
         .otherwise(F.concat(F.lit("  "), F.lower("o_orderpriority"), F.lit(" "))).alias("product"),
        F.when(k % 29 == 0, _null()).when(k % 3 == 0, F.lit(" 7 "))
         .otherwise(F.concat(F.lit(" "), F.col("o_custkey").cast("string"), F.lit(" "))).alias("client_id"),
        F.col("seq"),
    ]


def raw_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales as landed strings: id, sale_date, amount, product, client_id (+ seq).

    Rows with ``k % 41 = 0`` appear twice; the second copy (seq = 1) carries
    another amount, so dedup has a real winner to pick.  Client 7 holds a third
    of all sales, and some sales have no client.
    """
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    o = o.withColumn("seq", F.explode(F.when(k % 41 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    amount = (F.when(F.col("seq") == 1, F.format_string("%.2f", F.col("o_totalprice") + 1))
               .when(k % 53 == 0, F.lit("abc")).when(k % 59 == 0, F.lit("-5"))
               .when(k % 61 == 0, _null()).otherwise(F.format_string("%.2f", "o_totalprice")))
    return o.select(*_sale_cols(k, amount))


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as landed strings (customer joined to nation and region).

    Customers with ``k % 23 = 0`` appear twice; the second row has another name
    and segment, and wins the dedup by its name.
    """
    c = table(spark, sf_dir, "customer").withColumn("copy", F.explode(
        F.when(F.col("c_custkey") % 23 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    again = F.col("copy") == 1
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    geo = n.join(r, n.n_regionkey == r.r_regionkey).select("n_nationkey", "r_name")
    k = F.col("c_custkey")
    seg = F.col("c_mktsegment")
    birth = F.date_add(F.lit("1870-01-01").cast("date"), ((k * 7919) % 52000).cast("int"))
    signup = F.date_add(F.lit("1995-01-01").cast("date"), ((k * 31) % 2500).cast("int"))
    return (c.join(geo, c.c_nationkey == geo.n_nationkey, "left").select(
        k.cast("string").alias("id"),
        F.concat(F.when(again, F.lit(" z")).otherwise(F.lit(" ")), F.lower("c_name"), F.lit(" ")).alias("last_name"),
        F.concat(F.lit(" "), F.when(k % 2 == 0, F.lower(seg)).otherwise(seg), F.lit(" ")).alias("first_name"),
        F.when(k % 11 == 0, F.lit("bad@x.co.uk"))
         .otherwise(F.concat(F.lit(" User"), k.cast("string"), F.lit("@Mail.com "))).alias("email"),
        F.concat(F.lit("+33 (6) "), k.cast("string")).alias("phone"),
        F.when(k % 17 == 0, _null()).otherwise(birth.cast("string")).alias("birth_date"),
        signup.cast("string").alias("signup_date"),
        F.when(again, F.lit(" vip")).when(k % 13 == 0, _null()).otherwise(F.concat(F.lit(" "), F.lower(seg))).alias("segment"),
        F.concat(F.lower("r_name"), F.lit(" ")).alias("region"),
        F.when(k % 6 == 0, F.lit("true")).when(k % 6 == 1, F.lit("1")).when(k % 6 == 2, F.lit("oui"))
         .when(k % 6 == 3, F.lit("no")).when(k % 6 == 4, F.lit("0")).otherwise(_null()).alias("active"),
        F.concat(F.lit(" "), F.lpad((F.col("c_nationkey") * 1000 + k % 1000).cast("string"), 5, "0"),
                 F.lit(" ")).alias("postcode"),
    ))


def line_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")


def status_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events with a pipeline status and, unless it is SUCCESS, a text (over 500 characters for FAIL)."""
    e = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts", "props")
    status = (F.when(F.col("event_type") == "error", "FAIL").when(F.col("event_type") == "signup", "SUCCESS")
               .otherwise("WARNING"))
    text = F.when(F.col("event_type") == "error", F.repeat("props", 70)).when(F.col("event_type") != "signup", F.col("props"))
    return e.withColumns({"status": status, "error_message": text})
