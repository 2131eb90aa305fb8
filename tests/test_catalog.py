"""Partitions registered from what a write touched."""

import pytest

from refinery.sources import catalog, sinks

ROWS = "id string, k string, d string"


@pytest.fixture()
def lake(spark, tmp):
    db = f"lake_{abs(hash(tmp))}"
    catalog.ensure_database(spark, db, location=f"{tmp}/{db}.db")
    yield db
    spark.sql(f"DROP DATABASE `{db}` CASCADE")


def _made(spark, lake, tmp, rows):
    df = spark.createDataFrame(rows, ROWS)
    sinks.write_curated(df, f"{tmp}/t", ["k", "d"])
    return catalog.register(spark, lake, "t", df, ["k", "d"], f"{tmp}/t")


def _rows(spark, lake):
    return sorted(((r["id"], r["k"], r["d"]) for r in spark.table(f"{lake}.t").collect()), key=str)


def test_insert_registers_what_it_wrote_and_lists_nothing(spark, lake, tmp):
    _made(spark, lake, tmp, [("1", "a", "x"), ("2", "b", "x")])
    sinks.write_curated(spark.createDataFrame([("9", "stray", "x")], ROWS), f"{tmp}/t", ["k", "d"])
    late = spark.createDataFrame([("x", "3", "a"), ("x", "4", "c"), (None, "5", "c")], "d string, id string, k string")
    for _ in range(2):  # a repeated run replaces its own partitions
        catalog.insert(late, lake, "t")
    # the partition (a, x) was replaced, (b, x) stays, the stray folder is not seen
    assert _rows(spark, lake) == sorted([("2", "b", "x"), ("3", "a", "x"), ("4", "c", "x"), ("5", "c", None)], key=str)
    assert spark.sql(f"SHOW PARTITIONS {lake}.t").count() == 4
    catalog.insert(late.limit(0), lake, "t")
    assert len(_rows(spark, lake)) == 4
    with pytest.raises(ValueError):
        catalog.insert(late.withColumnRenamed("id", "ident"), lake, "t")
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").upper() == "STATIC"


def test_add_partitions_by_name(spark, lake, tmp, monkeypatch):
    monkeypatch.setattr(catalog, "ADD_AT_ONCE", 2)
    _made(spark, lake, tmp, [("1", "a", "x")])
    odd = [("2", "it's", "x"), ("3", "b\\c", "x"), ("4", "d/e=f", "x"), ("5", None, "x"), ("6", None, "x"), ("7", "a", "x")]
    more = spark.createDataFrame(odd, ROWS)
    sinks.write_curated(more, f"{tmp}/t", ["k", "d"], mode="append")
    assert catalog.add_partitions(spark, lake, "t", more) == 5
    assert [r[0] for r in _rows(spark, lake)] == ["1", "2", "3", "4", "5", "6", "7"]
    assert catalog.add_partitions(spark, lake, "t", more) == 5  # again: nothing changes
    assert len(_rows(spark, lake)) == 7
    assert catalog.add_partitions(spark, lake, "t", more.limit(0)) == 0


def test_tables_without_partitions(spark, lake, tmp):
    df = spark.createDataFrame([("1", "a", "x")], ROWS)
    df.write.parquet(f"{tmp}/t")
    catalog.register(spark, lake, "t", df, [], f"{tmp}/t")
    with pytest.raises(ValueError):
        catalog.add_partitions(spark, lake, "t", df)
