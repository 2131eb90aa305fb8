import pytest

from refinery.operators import privacy
from refinery.operators.joins import enrich_left, read_dimension


def test_enrich_left_cannot_fan_out(spark):
    fact = spark.createDataFrame([("s1", "c1"), ("s2", "c2"), ("s3", "UNKNOWN")], "id string, client_id string")
    dim = spark.createDataFrame([("c1", "A", "R1"), ("c1", "B", "R2"), ("c2", "C", "R3")],
                                "id string, segment string, region string")
    out = enrich_left(fact.withColumnRenamed("id", "sale"), dim, "client_id", "id", ["segment", "region"])
    rows = {r["sale"]: (r["segment"], r["region"]) for r in out.collect()}
    assert len(rows) == 3 and out.count() == 3
    assert rows["s1"] == ("B", "R2")  # deterministic winner of the duplicated key
    assert rows["s3"] == (None, None)


def test_missing_dimension_gives_typed_nulls(spark, tmp):
    fact = spark.createDataFrame([("s1", "c1")], "sale string, client_id string")
    dim = read_dimension(spark, f"{tmp}/does-not-exist")
    assert dim is None
    out = enrich_left(fact, dim, "client_id", "id", ["segment", "region"])
    assert dict(out.dtypes)["segment"] == "string" and out.first()["region"] is None


def test_merge_strategy_and_checked_broadcast(spark):
    fact = spark.createDataFrame([("s1", "c1")], "sale string, client_id string")
    dim = spark.createDataFrame([("c1", "A", "R")], "id string, segment string, region string")
    plan = enrich_left(fact, dim, "client_id", "id", ["segment", "region"], strategy="merge") \
        ._jdf.queryExecution().sparkPlan().toString()
    assert "SortMergeJoin" in plan
    with pytest.raises(ValueError):
        enrich_left(fact, dim, "client_id", "id", ["segment"], strategy="broadcast")
    b = enrich_left(fact, dim, "client_id", "id", ["segment"], strategy="broadcast", max_dim_rows=10)
    assert "BroadcastHashJoin" in b._jdf.queryExecution().sparkPlan().toString()


def test_mask_hashes_present_columns_and_keeps_null(spark):
    df = spark.createDataFrame([("a@b.com", None, 30)], "email string, phone string, age int")
    out = privacy.mask(df).first()
    assert len(out["email"]) == 64 and out["phone"] is None and out["age"] == 30
    again = privacy.mask(df, salt="s").first()
    assert again["email"] != out["email"]


def test_hot_and_null_keys_bypass_the_shuffle_join(spark):
    fact = spark.createDataFrame([("s1", "c1"), ("s2", "UNKNOWN"), ("s3", "UNKNOWN"), ("s4", None), ("s5", "c9")],
                                 "sale string, client_id string")
    dim = spark.createDataFrame([("c1", "A", "R1"), ("UNKNOWN", "U", "RU"), ("c9", "Z", "R9")],
                                "id string, segment string, region string")
    plain = enrich_left(fact, dim, "client_id", "id", ["segment", "region"])
    listed = enrich_left(fact, dim, "client_id", "id", ["segment", "region"], hot_keys=["UNKNOWN"])
    found = enrich_left(fact, dim, "client_id", "id", ["segment", "region"], detect_hot_share=0.3)
    expect = {("s1", "c1", "A", "R1"), ("s2", "UNKNOWN", "U", "RU"), ("s3", "UNKNOWN", "U", "RU"),
              ("s4", None, None, None), ("s5", "c9", "Z", "R9")}
    for out in (plain, listed, found):
        assert out.columns == ["sale", "client_id", "segment", "region"]
        assert set(map(tuple, out.collect())) == expect and out.count() == 5


def test_enrich_left_with_int_and_date_keys_keeps_dim_types(spark):
    import datetime as dt
    fact = spark.createDataFrame([("s1", 7), ("s2", None), ("s3", 9), ("s4", 9)], "sale string, k int")
    dim = spark.createDataFrame([(7, 1.5), (9, 2.5)], "k int, rate double")
    for kw in ({}, {"hot_keys": [9]}, {"detect_hot_share": 0.3}):
        out = enrich_left(fact, dim, "k", "k", ["rate"], **kw)
        assert dict(out.dtypes)["rate"] == "double"
        assert sorted(map(tuple, out.collect()), key=repr) == sorted(
            [("s1", 7, 1.5), ("s2", None, None), ("s3", 9, 2.5), ("s4", 9, 2.5)], key=repr)
    d1, d2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    fact_d = spark.createDataFrame([("s1", d1), ("s2", None), ("s3", d2)], "sale string, d date")
    dim_d = spark.createDataFrame([(d1, "A"), (d2, "B")], "d date, tag string")
    out = enrich_left(fact_d, dim_d, "d", "d", ["tag"], hot_keys=[d2])
    assert sorted(map(tuple, out.collect()), key=repr) == sorted(
        [("s1", d1, "A"), ("s2", None, None), ("s3", d2, "B")], key=repr)
