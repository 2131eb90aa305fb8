"""Dimension enrichment: left outer equi-join with a deduplicated dimension.

Strategy (``strategy="auto"``): no hint.  The dimension is first reduced to
one row per key (an aggregation whose output is already hash-partitioned on
the key, so the join reuses it and only the fact side shuffles).  AQE then
measures the real size of the shuffled dimension and switches to a
broadcast hash join only when it is under
``spark.sql.adaptive.autoBroadcastJoinThreshold``: a size bound checked at
run time, never assumed.

Skew.  A key holding a third of the fact rows would land in one reducer of
a sort-merge join (null keys too: they all hash alike).  The join stays a
single pass, with no union of branches and no re-computation of the upstream:

* rows with a null key, and rows whose key is *hot* (``hot_keys`` given by
  the caller, e.g. the ``UNKNOWN`` default, or found with ``detect_hot_share``
  by a heavy-hitter sketch, see :mod:`refinery.operators.hot_keys`), join on a per-row spread key (a row hash) instead
  of their own key, so they scatter evenly over the reducers;
* hot rows take their dimension columns from a broadcast of the dimension
  rows of the hot keys only, at most one row per hot key (a proven size
  bound), joined map-side; any match of the spread key is overridden;
* every other row joins on its own key.

``strategy="merge"`` forces a sort-merge join (what the source pipeline did
by switching broadcast off); ``strategy="broadcast"`` is accepted only
together with ``max_dim_rows`` and verifies the bound with a count before
hinting.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from refinery.operators.cleaning import dedup
from refinery.operators.hot_keys import hot_key_list
from refinery.sources.readers import read_curated

DIM_KEY = "_dim_key"


def _missing(dim_cols: Sequence[str], fact: DataFrame) -> DataFrame:
    return fact.withColumns({c: F.lit(None).cast("string") for c in dim_cols})


def enrich_left(fact: DataFrame, dim: DataFrame | None, left_on: str, right_on: str,
                dim_cols: Sequence[str], strategy: str = "auto", max_dim_rows: int | None = None,
                hot_keys: Sequence | None = None, detect_hot_share: float | None = None,
                dim_order: Sequence[str] = (), hot_from: DataFrame | None = None) -> DataFrame:
    """``fact`` LEFT JOIN ``dim`` on ``fact[left_on] = dim[right_on]`` adding ``dim_cols``.

    ``dim=None`` (dimension not available) adds the columns as typed nulls.
    The dimension is deduplicated on its key first, so the join cannot fan out;
    the greatest row by ``dim_order`` (e.g. its ingestion time) wins.

    ``detect_hot_share`` looks for keys with more than that share of the rows of
    ``hot_from`` (default: of ``fact``) when the join is declared; at most
    ``1 / share`` keys reach the driver.  ``hot_from`` should be rows that are cheap to read and hold the same
    keys in the column ``left_on`` (the raw rows before a dedup): the pass then
    reads one column of a scan instead of running the fact's plan again.  Which keys count as
    hot changes the way of a row through the join, never its result.
    """
    dim_cols = list(dim_cols)
    clash = [c for c in dim_cols if c in fact.columns]
    base = fact.drop(*clash) if clash else fact
    if dim is None:
        return _missing(dim_cols, base)
    order = [c for c in dim_order if c in dim.columns]
    side = dim.select(F.col(right_on).alias(DIM_KEY), *dim_cols, *[F.col(c).alias(f"_order_{c}") for c in order])
    side = dedup(side, DIM_KEY, [f"_order_{c}" for c in order]).select(DIM_KEY, *dim_cols)
    if strategy == "merge":
        side = side.hint("merge")
    elif strategy == "broadcast":
        if max_dim_rows is None:
            raise ValueError("broadcast needs max_dim_rows: a broadcast side must have a checked size")
        if side.count() <= max_dim_rows:
            side = F.broadcast(side)
    elif strategy != "auto":
        raise ValueError(f"unknown join strategy {strategy!r}")

    key = F.col(left_on)
    out_cols = base.columns + dim_cols
    key_type = dict(base.dtypes)[left_on]
    row_hash = F.xxhash64(*[F.col(f"`{c}`") for c in base.columns])

    if detect_hot_share:
        found = hot_key_list(base if hot_from is None else hot_from, left_on, detect_hot_share)
        hot_keys = list(dict.fromkeys([*(hot_keys or []), *found]))
    if hot_keys:
        flagged = base.withColumn("_is_hot", key.isin(*list(hot_keys)))
        is_hot = F.col("_is_hot")
        hot_dim = side.where(F.col(DIM_KEY).isin(*list(hot_keys)))
    else:
        flagged, is_hot, hot_dim = base.withColumn("_is_hot", F.lit(False)), F.col("_is_hot"), None

    hot_names = {c: f"_hot_{c}" for c in dim_cols}
    if hot_dim is not None:
        # at most one row per hot key: the dimension is deduplicated
        small = hot_dim.select(F.col(DIM_KEY).alias("_hot_key"), *[F.col(c).alias(h) for c, h in hot_names.items()])
        flagged = flagged.join(F.broadcast(small), key == small["_hot_key"], "left").drop("_hot_key")
    else:
        flagged = flagged.withColumns({h: F.lit(None).cast("string") for h in hot_names.values()})

    spread = is_hot | key.isNull()
    spread_key, dim_key = _spread_key(row_hash, key, key_type), side[DIM_KEY]
    if spread_key is None:  # other key types: join on the text form of the key
        spread_key, key_text = row_hash.cast("string"), key.cast("string")
        keyed = flagged.withColumn("_join_key", F.when(spread, spread_key).otherwise(key_text))
        dim_key = side[DIM_KEY].cast("string")
    else:
        keyed = flagged.withColumn("_join_key", F.when(spread, spread_key).otherwise(key))
    joined = keyed.join(side, keyed["_join_key"] == dim_key, "left")
    dims = {}
    for c in dim_cols:
        own = F.when(key.isNull(), F.lit(None)).otherwise(F.col(c))
        dims[c] = F.when(is_hot, F.col(hot_names[c])).otherwise(own) if hot_dim is not None else own
    return joined.withColumns(dims).select(*out_cols)


# largest value per narrow integer key type, to fold the 64-bit row hash into range
_INTEGRAL_MAX = {"tinyint": 127, "smallint": 32767, "int": 2147483647}


def _spread_key(row_hash, key, key_type: str):
    """A per-row join key of the key's own type (it may equal a real key; the
    caller overrides such matches), or ``None`` when the type has no such form."""
    if key_type == "string":
        return row_hash.cast("string")
    if key_type == "bigint":
        return row_hash
    if key_type in _INTEGRAL_MAX:
        return F.pmod(row_hash, F.lit(_INTEGRAL_MAX[key_type])).cast(key_type)
    return None


def read_dimension(spark: SparkSession, path: str, partition_cols: Sequence[str] = ()) -> DataFrame | None:
    """The Parquet dimension at ``path``, or ``None`` when the path does not exist.

    Partition values keep their text (``04`` stays ``04``).  Only a missing
    path is tolerated; any other failure propagates.
    """
    try:
        return read_curated(spark, path, partition_cols)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            return None
        raise
