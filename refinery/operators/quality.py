"""Data-quality scoring: completeness, uniqueness, validity, timeliness, global score.

One aggregation pass profiles the input (row count, non-blank count per
column, valid amounts, distinct keys); the dimension rows are then derived
from that single row with column expressions (``explode`` of an array of
structs), so the whole check is one Spark job reading the data once.
Statuses and thresholds are the fixed values of ``refinery.functions.fixed``.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from refinery.functions import columns as fx
from refinery.functions import fixed

DIMENSION_FIELDS = T.StructType([
    T.StructField("dimension", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("score", T.DoubleType()),
    T.StructField("columns", T.MapType(T.StringType(), T.DoubleType())),
    T.StructField("total", T.LongType()),
    T.StructField("unique", T.LongType()),
    T.StructField("duplicates", T.LongType()),
    T.StructField("check", T.StringType()),
    T.StructField("age_days", T.IntegerType()),
])


def _nb(i: int) -> str:
    return f"_nb{i}"


def profile(df: DataFrame, key: str | None = None, amount: str | None = None,
            wide_key: bool = False) -> DataFrame:
    """Single-row profile: rows, non-blank count per column, valid amounts, distinct keys.

    One scan and one aggregation.  With ``wide_key`` (long texts as key) the
    distinct keys are counted by their SHA-256 digest, so 32 bytes a row cross
    the network instead of the text, and copies are combined before they do.
    """
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for i, c in enumerate(df.columns):
        aggs.append(F.count_if(~fx.is_blank(F.col(f"`{c}`").cast("string"))).alias(_nb(i)))
    if amount is not None:
        valid = fx.is_valid_amount(amount) if amount in df.columns else F.lit(True)
        aggs.append(F.count_if(valid).alias("_valid"))
    if key is not None and key in df.columns:
        k = F.col(key)
        counted = F.unhex(F.sha2(k.cast("binary"), 256)) if wide_key else k
        aggs.append((F.count_distinct(counted) + F.max(F.when(k.isNull(), 1).otherwise(0))).alias("_unique"))
    return df.agg(*aggs)


def _pct(part: Column, whole: Column) -> Column:
    return part / whole * F.lit(100.0)


def completeness_columns(df: DataFrame, prof: DataFrame | None = None) -> DataFrame:
    """Per column: non-blank share in percent (unrounded), from one profile row."""
    prof = prof if prof is not None else profile(df)
    items = [F.struct(F.lit(c).alias("column_name"), F.col(_nb(i)).alias("non_blank"))
             for i, c in enumerate(df.columns)]
    long = prof.select("_rows", F.inline(F.array(*items)))
    return long.select(
        "column_name", F.col("_rows").alias("rows"), "non_blank",
        F.when(F.col("_rows") > 0, _pct(F.col("non_blank"), F.col("_rows"))).alias("completeness"))


def _dimension(name, status, score, columns=None, total=None, unique=None, duplicates=None,
               check=None, age_days=None) -> Column:
    n = F.lit(None)
    return F.struct(
        F.lit(name).alias("dimension"), status.alias("status"), score.cast("double").alias("score"),
        (columns if columns is not None else n.cast("map<string,double>")).alias("columns"),
        (total if total is not None else n).cast("bigint").alias("total"),
        (unique if unique is not None else n).cast("bigint").alias("unique"),
        (duplicates if duplicates is not None else n).cast("bigint").alias("duplicates"),
        (check if check is not None else n).cast("string").alias("check"),
        (age_days if age_days is not None else n).cast("int").alias("age_days"),
    )


def _completeness_dim(cols: list[str]) -> Column:
    rows = F.col("_rows")
    per_col = [_pct(F.col(_nb(i)), rows) for i in range(len(cols))]
    mean = F.aggregate(F.array(*per_col), F.lit(0.0), lambda acc, x: acc + x) / F.lit(float(len(cols)))
    colmap = F.map_from_arrays(F.array(*[F.lit(c) for c in cols]), F.array(*per_col))
    ok = rows > 0
    return F.when(ok, _dimension(fixed.DIM_COMPLETENESS,
                                 F.when(mean >= fixed.COMPLETENESS_PASS, "PASS").otherwise("WARNING"),
                                 F.round(mean, 2), columns=colmap)) \
            .otherwise(_dimension(fixed.DIM_COMPLETENESS, F.lit("SKIP"), F.lit(0)))


def _uniqueness_dim(has_key: bool) -> Column:
    skip = _dimension(fixed.DIM_UNIQUENESS, F.lit("SKIP"), F.lit(0))
    if not has_key:
        return skip
    rows, uniq = F.col("_rows"), F.col("_unique")
    dups = rows - uniq
    return F.when(rows > 0, _dimension(
        fixed.DIM_UNIQUENESS, F.when(dups == 0, "PASS").otherwise("FAIL"),
        F.round(_pct(uniq, rows), 2), total=rows, unique=uniq, duplicates=dups)).otherwise(skip)


def _validity_dim(checks_amount: bool) -> Column:
    rows = F.col("_rows")
    skip = _dimension(fixed.DIM_VALIDITY, F.lit("SKIP"), F.lit(0))
    if not checks_amount:
        return F.when(rows > 0, _dimension(fixed.DIM_VALIDITY, F.lit("PASS"), F.lit(100))).otherwise(skip)
    rate = _pct(F.col("_valid"), rows)
    return F.when(rows > 0, _dimension(
        fixed.DIM_VALIDITY, F.when(rate >= fixed.VALIDITY_PASS, "PASS").otherwise("WARNING"),
        F.round(rate, 2), check=F.lit(fixed.VALIDITY_CHECK_LABEL))).otherwise(skip)


def timeliness(data_date, as_of) -> Column:
    """Age in days of the data date at ``as_of``: <= 1 day PASS/100, else WARNING/50,
    unparsable FAIL/0 (future dates pass)."""
    d = fx.parse_date(data_date if isinstance(data_date, Column) else F.lit(data_date))
    age = F.datediff(fx.date_lit(as_of), d)
    return (F.when(d.isNull(), _dimension(fixed.DIM_TIMELINESS, F.lit("FAIL"), F.lit(0)))
             .when(age <= fixed.TIMELINESS_MAX_AGE_DAYS,
                   _dimension(fixed.DIM_TIMELINESS, F.lit("PASS"), F.lit(100), age_days=age))
             .otherwise(_dimension(fixed.DIM_TIMELINESS, F.lit("WARNING"),
                                   F.lit(fixed.TIMELINESS_LATE_SCORE), age_days=age)))


def run(df: DataFrame, zone: str, entity: str, data_date: str, as_of,
        key: str | None = None, amount: str | None = None, wide_key: bool = False) -> DataFrame:
    """The four dimension rows of one input (one scan).

    ``key``: business key for uniqueness (absent column -> SKIP);
    ``amount``: amount column for validity (only entities with amounts; a
    missing amount *column* counts every row as valid); otherwise validity
    is a constant PASS/100.  Empty input -> SKIP/0 for data dimensions.
    """
    cols = list(df.columns)
    has_key = key is not None and key in cols
    prof = profile(df, key if has_key else None, amount, wide_key)
    dims = F.array(_completeness_dim(cols), _uniqueness_dim(has_key),
                   _validity_dim(amount is not None), timeliness(data_date, as_of))
    return prof.select(F.lit(zone).alias("zone"), F.lit(entity).alias("entity"),
                       F.lit(data_date).alias("data_date"), F.col("_rows").alias("rows"),
                       F.inline(dims))


def missing_input(spark: SparkSession, zone: str, entity: str, data_date: str) -> DataFrame:
    """Dimension rows of an absent input: none (the global score is then 0, CRITICAL)."""
    schema = T.StructType([T.StructField("zone", T.StringType()), T.StructField("entity", T.StringType()),
                           T.StructField("data_date", T.StringType()), T.StructField("rows", T.LongType())]
                          + list(DIMENSION_FIELDS.fields))
    return spark.createDataFrame([], schema)


REPORT_KEYS = ["zone", "entity", "data_date"]


def _global_cols(mean: Column) -> list[Column]:
    score = F.coalesce(F.round(mean, 2), F.lit(0.0))
    status = (F.when(mean.isNull(), "CRITICAL").when(mean < fixed.GLOBAL_CRITICAL_BELOW, "CRITICAL")
               .when(mean < fixed.GLOBAL_WARNING_BELOW, "WARNING").otherwise("OK"))
    rec = (F.when(mean.isNull(), fixed.RECOMMENDATION_NO_DATA)
            .when(mean < fixed.GLOBAL_CRITICAL_BELOW, fixed.RECOMMENDATION_CRITICAL)
            .when(mean < fixed.GLOBAL_WARNING_BELOW, fixed.RECOMMENDATION_WARNING)
            .otherwise(fixed.RECOMMENDATION_OK))
    return [score.alias("global_score"), status.alias("global_status"), rec.alias("recommendation")]


def _positive_mean() -> Column:
    s = F.col("score")
    return F.avg(F.when(s.isNotNull() & (s > 0), s))


def global_score(dims: DataFrame) -> DataFrame:
    """Mean of dimension scores > 0 per report; < 70 CRITICAL, < 85 WARNING, else OK."""
    g = dims.groupBy(*REPORT_KEYS).agg(_positive_mean().alias("_mean"))
    return g.select(*REPORT_KEYS, *_global_cols(F.col("_mean")))


def with_global(dims: DataFrame) -> DataFrame:
    """Dimension rows with their report's global columns (a window over <= 4 rows)."""
    w = Window.partitionBy(*REPORT_KEYS)
    return dims.withColumn("_mean", _positive_mean().over(w)).select(
        *dims.columns, *_global_cols(F.col("_mean")))


def report(dims: DataFrame, clock) -> DataFrame:
    """One nested document per (zone, entity, date): metadata, dimensions, global assessment.

    Reports with no dimension rows are not produced here; use ``empty_report``.
    """
    dim_struct = F.struct(*[F.col(f.name) for f in DIMENSION_FIELDS.fields])
    g = dims.groupBy(*REPORT_KEYS).agg(F.collect_list(dim_struct).alias("dimensions"),
                                       _positive_mean().alias("_mean"))
    gcols = _global_cols(F.col("_mean"))
    return g.select(
        *REPORT_KEYS,
        F.struct(F.lit(fx.timestamp_str(clock)).alias("date"), F.col("zone"), F.col("entity")).alias("metadata"),
        F.col("dimensions"),
        F.struct(*[c for c in gcols]).alias("global_assessment"))


def empty_report(spark: SparkSession, zone: str, entity: str, data_date: str, clock) -> DataFrame:
    """Report for an input that does not exist: no dimensions, score 0, CRITICAL."""
    rows = spark.createDataFrame([(zone, entity, data_date)], "zone string, entity string, data_date string")
    arr = F.array().cast(T.ArrayType(DIMENSION_FIELDS))
    gcols = _global_cols(F.lit(None).cast("double"))
    return rows.select(
        *REPORT_KEYS,
        F.struct(F.lit(fx.timestamp_str(clock)).alias("date"), F.col("zone"), F.col("entity")).alias("metadata"),
        arr.alias("dimensions"), F.struct(*gcols).alias("global_assessment"))


def run_many(inputs: Mapping[str, tuple[DataFrame, dict]], zone: str, data_date: str, as_of) -> DataFrame:
    """Union of dimension rows for several entities: ``{entity: (df, {key=, amount=})}``."""
    out = None
    for entity, (df, opts) in inputs.items():
        d = run(df, zone, entity, data_date, as_of, **opts)
        out = d if out is None else out.unionByName(d)
    return out
