import random

import pytest
from pyspark.sql import functions as F

from refinery.operators import cleaning as cl
from refinery.operators import late


def _table(spark, tmp, rows):
    df = spark.createDataFrame(rows, "k string, seq long, v string, `odd name` int").repartition(5)
    df.write.parquet(f"{tmp}/t")
    return spark.read.parquet(f"{tmp}/t")


def _rows(n=4000, seed=3):
    """A hot key, null keys, null orders and ties."""
    rng = random.Random(seed)
    return [("HOT" if i % 3 == 0 else None if i % 17 == 0 else f"k{rng.randrange(500)}",
             None if rng.random() < 0.1 else rng.randrange(-40, 40), f"v{rng.randrange(50)}", i) for i in range(n)]


def test_winner_has_the_greatest_order_and_is_one_row(spark, tmp):
    rows = _rows()
    df = _table(spark, tmp, rows)
    got = [tuple(r) for r in late.latest(df, "k", "seq").collect()]
    best = {}
    for k, seq, _, _ in rows:
        best[k] = max(best.get(k, -10**6), -10**6 if seq is None else seq)
    assert len(got) == len(best) and {r[0] for r in got} == set(best)
    assert set(got) <= set(rows) and all((-10**6 if r[1] is None else r[1]) == best[r[0]] for r in got)
    assert sorted(got, key=repr) == sorted((tuple(r) for r in late.latest(df, ["k"], F.col("seq")).collect()), key=repr)
    assert late.latest(df.where("k = 'HOT'"), "k").count() == 1


def test_same_winner_as_dedup_where_the_order_is_total(spark, tmp):
    df = _table(spark, tmp, [(k, i, v, i) for i, (k, _, v, _) in enumerate(_rows())])
    want = sorted(map(tuple, cl.dedup(df, "k", "seq").collect()), key=repr)
    assert sorted(map(tuple, late.latest(df, "k", "seq").collect()), key=repr) == want
    two = late.latest(df, ["k", "v"], "seq", ["odd name"])
    assert two.columns == ["k", "v", "odd name"]
    assert sorted(map(tuple, two.collect()), key=repr) == sorted(
        map(tuple, cl.dedup(df, ["k", "v"], "seq").select("k", "v", "`odd name`").collect()), key=repr)


def test_nothing_is_sorted_and_unused_columns_are_not_read(spark, tmp):
    df = late.latest(_table(spark, tmp, _rows(200)), "k", "seq", ["seq"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan and "ShuffledHashJoin" in plan and "HashAggregate" in plan
    assert "odd name" not in plan and "v:string" not in plan


def test_equal_rows_leave_one_and_empty_tables_none(spark, tmp):
    df = _table(spark, tmp, [("a", 1, "x", 1)] * 300 + [(None, None, None, None)] * 300)
    assert sorted(map(tuple, late.latest(df, "k", "seq").collect()), key=repr) == [("a", 1, "x", 1), (None, None, None, None)]
    assert late.latest(df.where("false"), "k", "seq").count() == 0
    with pytest.raises(ValueError):
        late.latest(df, [])


def test_orders_at_the_limit(spark, tmp):
    df = _table(spark, tmp, [("a", (1 << 61) - 1, "x", 1), ("a", (1 << 61) - 2, "y", 1), ("b", -(1 << 61) + 1, "z", 1), ("b", None, "n", 1)])
    assert {(r["k"], r["v"]) for r in late.latest(df, "k", "seq").collect()} == {("a", "x"), ("b", "z")}
