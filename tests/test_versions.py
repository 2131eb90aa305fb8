import os

import pytest
from pyspark.sql import functions as F

from refinery.operators import maintenance, versions

LAYOUT = maintenance.Layout(["month"], 2, 128)


def _write(df, path):
    df.repartition(6).write.partitionBy("month").parquet(path)


def _rows(spark, n):
    return spark.range(n).select(F.col("id").cast("string").alias("id"), F.lpad((F.col("id") % 3).cast("string"), 2, "0").alias("month"))


def test_readers_see_one_whole_version(spark, tmp):
    root = f"{tmp}/t"
    assert versions.current(spark, root) is None
    with pytest.raises(FileNotFoundError):
        versions.read(spark, root)
    assert versions.publish(spark, root, lambda out: _write(_rows(spark, 90), out)) == 1
    before = versions.read(spark, root, ["month"])
    assert versions.compact(spark, root, LAYOUT) == 2
    assert before.count() == 90 and versions.read(spark, root, ["month"]).count() == 90  # old files are still there
    assert {f for d, _, fs in os.walk(f"{root}/v00000002") for f in fs if f.endswith(".parquet")} and sorted(
        r["month"] for r in versions.read(spark, root, ["month"]).select("month").distinct().collect()) == ["00", "01", "02"]
    assert sum(f.endswith(".parquet") for _, _, fs in os.walk(f"{root}/v00000002") for f in fs) == 3


def test_a_failed_write_or_check_changes_nothing(spark, tmp, monkeypatch):
    root = f"{tmp}/t"
    versions.publish(spark, root, lambda out: _write(_rows(spark, 30), out))

    def broken(out):
        _write(_rows(spark, 5), out)
        raise OSError("disk full")

    with pytest.raises(OSError):
        versions.publish(spark, root, broken)
    plain = maintenance.rewrite
    monkeypatch.setattr(maintenance, "rewrite", lambda df, *a: plain(df.where("id <> '7'"), *a))
    with pytest.raises(RuntimeError):
        versions.compact(spark, root, LAYOUT)
    assert versions.current(spark, root) == 1 and versions.read(spark, root, ["month"]).count() == 30
    monkeypatch.undo()
    assert versions.compact(spark, root, LAYOUT) == 4  # numbers of folders that never counted are not used again


def test_of_two_writers_of_a_number_one_fails(spark, tmp):
    root = f"{tmp}/t"

    def slow(out):
        _write(_rows(spark, 3), out)
        os.makedirs(f"{root}/_current")
        open(f"{root}/_current/00000001", "w").close()  # another writer was faster

    with pytest.raises(RuntimeError):
        versions.publish(spark, root, slow)
    assert os.listdir(f"{root}/_current") == ["00000001"] or versions.current(spark, root) == 1


def test_pruning_keeps_the_last_versions(spark, tmp):
    root = f"{tmp}/t"
    assert versions.prune(spark, root) == []
    for n in range(4):
        versions.publish(spark, root, lambda out: _write(_rows(spark, 3 + n), out))
    assert versions.prune(spark, root, 2) == [1, 2]
    assert versions.current(spark, root) == 4 and versions.read(spark, root, ["month"]).count() == 6
    assert versions.prune(spark, root, 0) == [3] and versions.read(spark, root, ["month"]).count() == 6
