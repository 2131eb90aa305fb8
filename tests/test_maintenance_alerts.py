import datetime as dt
import os
import time

from pyspark.sql import functions as F

from refinery.operators import alerts, maintenance
from refinery.plans import jobs, queries_io
from refinery.session import session_conf
from refinery.sources import readers
from refinery.streaming import alert_feed
from tests.conftest import SF001


def parquet_files(path):
    return [os.path.join(d, f) for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")]


def small_table(spark, path, n=2000):
    df = spark.range(n).select(F.col("id").cast("string").alias("id"), (F.col("id") * 1.5).alias("amount"),
                               F.lit("2024").alias("year"), F.lpad((F.col("id") % 3 + 1).cast("string"), 2, "0")
                               .alias("month"))
    df.repartition(12).write.partitionBy("year", "month").parquet(path)
    return df


def test_target_files_rules():
    assert maintenance.target_files(0, 256, 20) == 20
    assert maintenance.target_files(100, 256, 20) == 1
    assert maintenance.target_files(1000, 256, 20) == 3
    assert maintenance.target_files(1000, 256, 20, forced=7) == 7


def test_compaction_reduces_files_and_keeps_rows(spark, tmp):
    small_table(spark, f"{tmp}/cur")
    before = len(parquet_files(f"{tmp}/cur"))
    layout = maintenance.Layout(["year", "month"], 2, 128)
    rep = maintenance.compact(spark, f"{tmp}/cur", f"{tmp}/tmp", layout, forced_files=3)
    after = len(parquet_files(f"{tmp}/tmp"))
    assert before >= 30 and after <= 6 and rep["rows"] == 2000
    a = readers.read_curated(spark, f"{tmp}/cur", ["year", "month"])
    b = readers.read_curated(spark, f"{tmp}/tmp", ["year", "month"])
    assert maintenance.verify_same(a, b)["same"]
    assert sorted(r["month"] for r in b.select("month").distinct().collect()) == ["01", "02", "03"]
    # compaction is idempotent on the multiset
    maintenance.compact(spark, f"{tmp}/tmp", f"{tmp}/tmp2", layout)
    assert maintenance.verify_same(b, readers.read_curated(spark, f"{tmp}/tmp2", ["year", "month"]))["same"]


def test_verify_detects_changed_rows(spark):
    a = spark.createDataFrame([("1", 1.0), ("2", 2.0)], "id string, v double")
    b = spark.createDataFrame([("1", 1.0), ("2", 2.5)], "id string, v double")
    assert not maintenance.verify_same(a, b)["same"]


def test_swap_and_backups(spark, tmp):
    os.makedirs(f"{tmp}/cur"), os.makedirs(f"{tmp}/new")
    open(f"{tmp}/cur/old.txt", "w").close()
    open(f"{tmp}/new/new.txt", "w").close()
    maintenance.swap(spark, f"{tmp}/cur", f"{tmp}/new", f"{tmp}/bak")
    assert os.listdir(f"{tmp}/cur") == ["new.txt"] and os.path.exists(f"{tmp}/bak/old.txt")
    assert maintenance.drop_backups(spark, [f"{tmp}/bak", f"{tmp}/nope"]) == [f"{tmp}/bak"]
    assert os.path.exists(f"{tmp}/bak")  # dry run
    maintenance.drop_backups(spark, [f"{tmp}/bak"], dry_run=False)
    assert not os.path.exists(f"{tmp}/bak")


def test_compact_all_reports_missing_entity(spark, tmp):
    small_table(spark, f"{tmp}/curated/sales")
    layouts = {"sales": maintenance.Layout(["year", "month"], 2, 128), "customers": maintenance.CUSTOMERS_LAYOUT}
    status = {r["entity"]: r for r in maintenance.compact_all(spark, f"{tmp}/curated", layouts).collect()}
    assert status["sales"]["status"] == "OK" and status["customers"]["status"] == "SKIPPED"
    assert os.path.exists(f"{tmp}/curated/sales_backup")


def test_retention_selects_by_mtime(spark, tmp):
    for name, age_days in (("a/old.csv", 40), ("b/new.csv", 2), ("a/old.txt", 40)):
        p = f"{tmp}/raw/{name}"
        os.makedirs(os.path.dirname(p), exist_ok=True)
        open(p, "w").write("x\n")
        t = time.time() - age_days * 86400
        os.utime(p, (t, t))
    now = dt.datetime.now()
    expired = [r["path"] for r in maintenance.expired_files(spark, f"{tmp}/raw", now).collect()]
    assert len(expired) == 1 and expired[0].endswith("old.csv")
    assert maintenance.purge(spark, f"{tmp}/raw", now) == 1 and os.path.exists(f"{tmp}/raw/a/old.csv")
    assert maintenance.purge(spark, f"{tmp}/raw", now, dry_run=False) == 1
    assert not os.path.exists(f"{tmp}/raw/a/old.csv")
    assert maintenance.purge(spark, f"{tmp}/missing", now) == 0


def test_alert_rows_and_decoration(spark):
    df = spark.createDataFrame([("x" * 700, None)], "msg string, sev string")
    a = alerts.decorate(alerts.make(df, F.lit("T"), F.lit("e"), F.lit("raw"), F.col("msg"), F.col("sev"),
                                    F.lit("2024-01-01T00:00:00"))).first()
    assert a["severity"] == "WARNING" and a["colour"] == "#FFA500" and len(a["message"]) == 700 and len(a["display"]) == 500
    s = alerts.decorate(alerts.make_status(df, F.lit("dag"), F.lit("task"), F.lit("FAIL"), F.col("msg"),
                                           timestamp=F.lit("t"))).first()
    assert s["context"] is None and s["colour"] == "#FF0000" and len(s["error_message"]) == 700 and len(s["display"]) == 500


def test_alert_stream_is_exactly_once(spark, tmp):
    inc = f"{tmp}/incoming"
    os.makedirs(inc)
    for i, sev in enumerate(["INFO", "CRITICAL", "--severity"]):
        with open(f"{inc}/alert_{i}.json", "w") as f:  # pretty-printed single objects
            f.write('{\n  "timestamp": "2024-01-01T00:00:0%d",\n  "type": "T",\n  "entity": "e",\n'
                    '  "zone": "z",\n  "severity": "%s",\n  "message": "m"\n}' % (i, sev))
    for _ in range(2):  # a rerun adds nothing
        alert_feed.ingest_stream(spark, inc, f"{tmp}/table", f"{tmp}/ckpt", multiline=True)
    table = spark.read.parquet(f"{tmp}/table")
    assert table.count() == 3
    counts = {r["severity"]: r["alerts"] for r in alerts.counts(table).collect()}
    assert counts == {"INFO": 1, "CRITICAL": 1, "--severity": 1}
    with open(f"{inc}/alert_9.json", "w") as f:
        f.write('{"timestamp": "t", "type": "T", "entity": "e", "zone": "z", "severity": "INFO", "message": "m"}')
    alert_feed.ingest_stream(spark, inc, f"{tmp}/table", f"{tmp}/ckpt", multiline=True)
    assert spark.read.parquet(f"{tmp}/table").count() == 4


def aged(tmp, name, age_days):
    p = f"{tmp}/raw/{name}"
    os.makedirs(os.path.dirname(p), exist_ok=True)
    open(p, "w").write("x\n")
    t = time.time() - age_days * 86400
    os.utime(p, (t, t))


def test_purge_deletes_expired_files_only(spark, tmp):
    old = ["sales/ingest_date=2020-01-01/a.csv", "sales/ingest_date=2020-01-01/b c.csv", "sales/ingest_date=2024-01-01/c.csv",
           "sales/stray.csv", "root.csv"]
    for name in old:
        aged(tmp, name, 60)
    keep = ["sales/ingest_date=2024-01-01/d.csv", "sales/ingest_date=2024-01-01/new/f.csv"]
    for name in keep:
        aged(tmp, name, 1)
    aged(tmp, "sales/ingest_date=2024-01-01/e.txt", 60)
    now = dt.datetime.now()
    assert maintenance.purge(spark, f"{tmp}/raw", now) == len(old)
    assert maintenance.purge(spark, f"{tmp}/raw", now, dry_run=False) == len(old)
    left = sorted(os.path.relpath(os.path.join(d, f), f"{tmp}/raw") for d, _, fs in os.walk(f"{tmp}/raw") for f in fs)
    assert left == sorted([*keep, "sales/ingest_date=2024-01-01/e.txt"])
    assert maintenance.purge(spark, f"{tmp}/raw", now, dry_run=False) == 0


def test_deleting_a_file_twice_is_no_error(spark, tmp):
    aged(tmp, "a.csv", 60)
    files = spark.createDataFrame([(f"file:{tmp}/raw/a.csv",), (f"file:{tmp}/raw/none.csv",)], "path string")
    assert sorted(r["deleted"] for r in maintenance.delete_files(files).collect()) == [False, True]
    assert not any(r["deleted"] for r in maintenance.delete_files(files).collect())


def test_verify_sees_a_value_that_moves_across_a_null(spark):
    a = spark.createDataFrame([("x", None), (None, "y")], "a string, b string")
    b = spark.createDataFrame([(None, "x"), ("y", None)], "a string, b string")
    assert not maintenance.verify_same(a, b)["same"]


def test_forced_file_count_is_kept_for_partitioned_tables(spark, tmp):
    small_table(spark, f"{tmp}/cur")
    rep = maintenance.compact(spark, f"{tmp}/cur", f"{tmp}/tmp", maintenance.Layout(["year", "month"], 2, 128), forced_files=12)
    assert rep["files_after"] == len(parquet_files(f"{tmp}/tmp")) == 12 and rep["files_before"] == len(parquet_files(f"{tmp}/cur"))


def test_a_crash_between_the_renames_is_mended(spark, tmp):
    layouts = {"sales": maintenance.Layout(["year", "month"], 2, 128)}
    small_table(spark, f"{tmp}/curated/sales_backup")  # the table was moved away and nothing took its place
    (row,) = maintenance.compact_all(spark, f"{tmp}/curated", layouts, cleanup_backups=True).collect()
    assert row["status"] == "OK" and row["rows"] == 2000
    assert readers.read_curated(spark, f"{tmp}/curated/sales", ["year", "month"]).count() == 2000


def test_backups_stay_when_an_entity_is_missing(spark, tmp):
    small_table(spark, f"{tmp}/curated/sales")
    layouts = {"sales": maintenance.Layout(["year", "month"], 2, 128), "customers": maintenance.CUSTOMERS_LAYOUT}
    maintenance.compact_all(spark, f"{tmp}/curated", layouts, cleanup_backups=True)
    assert os.path.exists(f"{tmp}/curated/sales_backup")


def test_alert_payload_is_json(spark):
    import json
    df = spark.createDataFrame([("t", "T", "e", "z", "INFO", 'say "hi"')], alerts.ALERT_SCHEMA)
    doc = json.loads(alerts.payload(df).first()["payload"])
    assert doc == {"timestamp": "t", "type": "T", "entity": "e", "zone": "z", "severity": "INFO",
                   "message": 'say "hi"'}


def test_the_source_is_read_once_and_a_changed_row_is_found(spark, tmp, monkeypatch):
    small_table(spark, f"{tmp}/cur", 300)
    layout = maintenance.Layout(["year", "month"], 2, 128)
    reads = []
    whole = maintenance.fingerprint
    monkeypatch.setattr(maintenance, "fingerprint", lambda df, cols=None: reads.append(df) or whole(df, cols))
    assert maintenance.compact(spark, f"{tmp}/cur", f"{tmp}/a", layout)["rows"] == 300
    assert len(reads) == 1  # of the copy alone: the source's was observed by the rewrite
    plain = maintenance.rewrite
    def spoiled(df, *args):
        plain(df.withColumn("amount", F.when(F.col("id") == "7", -1.0).otherwise(F.col("amount"))), *args)
    monkeypatch.setattr(maintenance, "rewrite", spoiled)
    for forced in (None, 2):
        try:
            maintenance.compact(spark, f"{tmp}/cur", f"{tmp}/b", layout, forced)
        except RuntimeError as e:
            assert "integrity" in str(e)
        else:
            raise AssertionError("a changed row went unnoticed")


def test_an_observation_made_twice_is_settled_by_reading(spark):
    a = spark.createDataFrame([("1", 1.0), ("2", 2.0)], "id string, v double")
    assert maintenance.verify_same(a, a, {"rows": 4, "checksum": "1"})["same"]
    assert not maintenance.verify_same(a, a.limit(1), {"rows": 4, "checksum": "1"})["same"]


def test_incremental_compaction_touches_untidy_folders_only(spark, tmp):
    layout = maintenance.Layout(["year", "month"], 2, 128)
    cur, args = f"{tmp}/cur", (f"{tmp}/tmp", f"{tmp}/bak", layout)
    small_table(spark, cur)
    first = maintenance.compact_untidy(spark, cur, *args)
    assert first["folders"] == 3 and first["rows"] == 2000 and first["files_after"] == 3 == len(parquet_files(cur))
    kept = sorted((f, os.path.getmtime(f)) for f in parquet_files(cur))
    again = maintenance.compact_untidy(spark, cur, *args)
    assert again["folders"] == again["rows"] == 0 and sorted((f, os.path.getmtime(f)) for f in parquet_files(cur)) == kept
    late = spark.createDataFrame([("late", -1.0, "2024", "02")], "id string, amount double, year string, month string")
    late.write.mode("append").partitionBy("year", "month").parquet(cur)
    third = maintenance.compact_untidy(spark, cur, *args)
    assert (third["folders"], third["files_before"], third["files_after"]) == (1, 2, 1)
    left = {f for f, _ in kept if "month=02" not in f}
    assert left < set(parquet_files(cur)) and len(parquet_files(cur)) == 3
    rows = readers.read_curated(spark, cur, ["year", "month"])
    assert rows.count() == 2001 and rows.where("id = 'late' AND month = '02'").count() == 1


def test_a_broken_off_folder_swap_is_put_back(spark, tmp):
    layout = maintenance.Layout(["year", "month"], 2, 128)
    small_table(spark, f"{tmp}/cur", 90)
    os.makedirs(f"{tmp}/bak/year=2024")
    os.rename(f"{tmp}/cur/year=2024/month=03", f"{tmp}/bak/year=2024/month=03")
    os.makedirs(f"{tmp}/tmp/stray")
    maintenance.compact_untidy(spark, f"{tmp}/cur", f"{tmp}/tmp", f"{tmp}/bak", layout)
    assert readers.read_curated(spark, f"{tmp}/cur", ["year", "month"]).count() == 90
    assert not os.path.exists(f"{tmp}/tmp")


def _files(root):
    """{folder: files} of Parquet files under ``root``."""
    found = {}
    for d, _, names in os.walk(root):
        if some := [n for n in names if n.endswith(".parquet")]:
            found[os.path.relpath(d, root)] = some
    return found


def test_small_files_are_written_by_many_tasks(spark, tmp):
    df = spark.range(0, 60000, 1, 3).select("id", F.concat(F.lit("f"), F.col("id") % 40).alias("a"),
                                           F.when(F.col("id") % 7 > 0, (F.col("id") % 2).cast("string")).alias("b"))
    with session_conf(spark, {"spark.sql.shuffle.partitions": "16"}):
        for n in (1, 20):
            queries_io.write_small_files(df, f"{tmp}/{n}", ["a", "b"], n)
            found = _files(f"{tmp}/{n}")
            assert len(found) == 80 and all(len(names) == n for names in found.values())
            assert len({name[:10] for names in found.values() for name in names}) > 10  # part-00000 and so on
            assert sorted(map(tuple, readers.read_curated(spark, f"{tmp}/{n}", ["a", "b"]).collect()), key=repr) == \
                sorted(map(tuple, df.collect()), key=repr)


def test_the_swapped_tables_are_not_made_by_two_tasks(spark, monkeypatch):
    sales, seen = queries_io.curated_sales, {}
    monkeypatch.setattr(queries_io, "curated_sales", lambda *a: sales(*a).where("year = '1995' AND month IN ('01', '02')"))
    whole = jobs.compact_all

    def compact_all(spark, root, **options):
        for entity in ("sales", "customers"):
            seen[entity] = _files(f"{root.removeprefix('file:')}/curated/{entity}")
        return whole(spark, root, **options)

    monkeypatch.setattr(jobs, "compact_all", compact_all)
    with session_conf(spark, {"spark.sql.shuffle.partitions": "12"}):
        rows = queries_io.compaction_swap(spark, SF001).collect()
    assert rows and {r["status"] for r in rows} == {"OK"} and {r["backups"] for r in rows} == {0}
    for entity, most in (("sales", 2), ("customers", 8)):
        assert 1 < max(map(len, seen[entity].values())) <= most
        assert len({name[:10] for names in seen[entity].values() for name in names}) > 8
