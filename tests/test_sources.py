import os

import pytest

from refinery.plans import queries_io, samples
from refinery.sources import catalog, files, landing, readers, sinks
from tests.conftest import SF001


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def test_land_adds_lineage_skips_other_files(spark, tmp):
    write(f"{tmp}/src/sales_a.csv", "id,amount\n1,10.00\n2,\"9,5\"\n")
    write(f"{tmp}/src/sales_b.csv", "id,amount\n")  # header only: no rows
    write(f"{tmp}/src/sales_enrichi.csv", "id,amount\n9,9\n")  # excluded by name
    write(f"{tmp}/src/customers.csv", "id_client,nom\nC1,X\n")  # other entity, other glob
    df = landing.land(spark, f"{tmp}/src", f"{tmp}/raw", "sales", "2024-01-01", "2024-01-01 10:00:00")
    rows = sorted(df.collect(), key=lambda r: r["id"])
    assert [r["id"] for r in rows] == ["1", "2"] and rows[1]["amount"] == "9,5"
    assert rows[0]["source_system"] == "sales" and rows[0]["file_name"] == "sales_a.csv"
    assert rows[0]["ingestion_timestamp"] == "2024-01-01 10:00:00"
    # rerun of the same date replaces it; another date is kept
    landing.land(spark, f"{tmp}/src", f"{tmp}/raw", "sales", "2024-01-01", "2024-01-01 11:00:00")
    landing.land(spark, f"{tmp}/src", f"{tmp}/raw", "sales", "2024-01-02", "2024-01-02 11:00:00")
    all_rows = landing.read_raw_landed(spark, f"{tmp}/raw/sales", None,
                                       columns=["id", "amount"] + landing.LINEAGE).collect()
    assert len(all_rows) == 4


def test_each_file_lands_by_its_own_header(spark, tmp):
    write(f"{tmp}/src/sales_a.csv", "id,amount\n1,10\n")
    write(f"{tmp}/src/sales_b.csv", "amount,id\n2,20\n")
    write(f"{tmp}/src/sales_c.csv", '\ufeffid,"no\nte",amount\n3,"two\nlines ""q"", \\ok",30\n')
    write(f"{tmp}/src/sales_enrichi.csv", "foo,bar,baz,qux\n1,2,3,4\n" * 50)
    write(f"{tmp}/src/sales_empty.csv", "")
    df = landing.land(spark, f"{tmp}/src", f"{tmp}/raw", "sales", "2024-01-01", "2024-01-01 10:00:00")
    rows = sorted((r["id"], r["amount"], r["no\nte"], r["file_name"], r["ingest_date"]) for r in df.na.fill("").collect())
    assert rows == [("1", "10", "", "sales_a.csv", "2024-01-01"), ("20", "2", "", "sales_b.csv", "2024-01-01"),
                    ("3", "30", 'two\nlines "q", \\ok', "sales_c.csv", "2024-01-01")]


def test_land_empty_source_is_noop(spark, tmp):
    os.makedirs(f"{tmp}/empty")
    assert landing.land(spark, f"{tmp}/empty", f"{tmp}/raw", "sales", "2024-01-01", "2024-01-01 00:00:00") is None


def test_read_raw_rejects_foreign_header(spark, tmp):
    cols = ["id", "amount"]
    write(f"{tmp}/raw/sales/ingest_date=2024-01-01/a.csv", "id,amount\n1,2\n")
    assert readers.read_raw(spark, f"{tmp}/raw", "sales", "2024-01-01", cols).count() == 1
    write(f"{tmp}/raw/sales/ingest_date=2024-01-01/b.csv", "id_client,nom\nC1,X\n")
    with pytest.raises(Exception):
        readers.read_raw(spark, f"{tmp}/raw", "sales", "2024-01-01", cols).collect()


def test_read_raw_multiline_quoted_newline(spark, tmp):
    write(f"{tmp}/raw/sales/ingest_date=2024-01-01/a.csv", 'id,amount\n1,"multi\nline"\n2,3\n')
    df = readers.read_raw(spark, f"{tmp}/raw", "sales", "2024-01-01", ["id", "amount"], multiline=True)
    assert sorted(r["amount"] for r in df.collect()) == ["3", "multi\nline"]


def test_date_filter_prunes_partitions(spark, tmp):
    write(f"{tmp}/raw/sales/ingest_date=2024-01-01/a.csv", "id,amount\n1,2\n")
    write(f"{tmp}/raw/sales/ingest_date=2024-01-02/a.csv", "id,amount\n3,4\n")
    df = readers.read_raw(spark, f"{tmp}/raw", "sales", "2024-01-02", ["id", "amount"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and [r["id"] for r in df.collect()] == ["3"]


def test_curated_dynamic_overwrite_and_padded_partitions(spark, tmp):
    path = f"{tmp}/curated/sales"
    first = spark.createDataFrame([("1", "2024", "04"), ("2", "2024", "05"), ("3", None, None)],
                                  "id string, year string, month string")
    sinks.write_curated(first, path, ["year", "month"])
    second = spark.createDataFrame([("9", "2024", "04")], "id string, year string, month string")
    sinks.write_curated(second, path, ["year", "month"])
    back = readers.read_curated(spark, path, ["year", "month"])
    got = sorted((r["id"], r["year"], r["month"]) for r in back.collect())
    assert got == [("2", "2024", "05"), ("3", None, None), ("9", "2024", "04")]


def test_catalog_register_discovers_partitions(spark, tmp):
    df = spark.createDataFrame([("1", 2.0, "2024", "01"), ("2", 3.0, "2024", "02")],
                               "id string, amount double, year string, month string")
    sinks.write_curated(df, f"{tmp}/cur", ["year", "month"])
    catalog.ensure_database(spark, "t_lake", "test", f"{tmp}/t_lake.db")
    ddl = catalog.table_ddl("t_lake", "s", df, ["year", "month"], f"{tmp}/cur", {"id": "sale id"})
    assert ddl.count("`year`") == 2  # column list and PARTITIONED BY, once each
    t = catalog.register(spark, "t_lake", "s", df, ["year", "month"], f"{tmp}/cur")
    assert sorted(r["month"] for r in t.collect()) == ["01", "02"]


def test_registering_again_moves_the_table(spark, tmp):
    a = spark.createDataFrame([("1", "04")], "id string, month string")
    b = spark.createDataFrame([("2", 5.0, "05")], "id string, amount double, month string")
    sinks.write_curated(a, f"{tmp}/a", ["month"])
    sinks.write_curated(b, f"{tmp}/b", ["month"])
    catalog.ensure_database(spark, "t_lake2", None, f"{tmp}/t_lake2.db")
    assert catalog.register(spark, "t_lake2", "s", a, ["month"], f"{tmp}/a").collect()[0]["id"] == "1"
    assert [tuple(r) for r in catalog.register(spark, "t_lake2", "s", b, ["month"], f"{tmp}/b").collect()] == [("2", 5.0, "05")]
    assert os.listdir(f"{tmp}/a")
    b.write.saveAsTable("t_lake2.managed")
    with pytest.raises(ValueError):
        catalog.register(spark, "t_lake2", "managed", b, ["month"], f"{tmp}/b")


def test_dimension_values_keep_their_text(spark, tmp):
    from refinery.operators.joins import read_dimension
    sinks.write_curated(spark.createDataFrame([("c", "04")], "id string, region string"), f"{tmp}/dim", ["region"])
    assert read_dimension(spark, f"{tmp}/dim", ["region"]).first()["region"] == "04"


def test_alert_json_sinks_append(spark, tmp):
    df = spark.createDataFrame([("2024-01-01T10:00:00", "x")], "timestamp string, message string")
    sinks.append_daily_log(df, f"{tmp}/log")
    sinks.append_daily_log(df, f"{tmp}/log")
    back = spark.read.schema("timestamp string, message string, alert_date string").json(f"{tmp}/log")
    assert back.count() == 2 and back.first()["alert_date"] == "2024-01-01"


def test_rewriting_the_same_batch_is_idempotent(spark, tmp):
    df = spark.createDataFrame([("1", "2024", "01"), ("2", "2024", "02")], "id string, year string, month string")
    for _ in range(3):
        sinks.write_curated(df, f"{tmp}/cur", ["year", "month"])
    back = readers.read_curated(spark, f"{tmp}/cur", ["year", "month"])
    assert sorted(map(tuple, back.collect())) == [("1", "2024", "01"), ("2", "2024", "02")]


def _rows_of_tasks(batches):
    """Each text with the task that it passed through."""
    import pyarrow as pa
    from pyspark import TaskContext
    me = TaskContext.get().taskAttemptId()
    for b in batches:
        told = [f"{me}\n{t}" for t in b.column("text").to_pylist()]
        yield pa.RecordBatch.from_pydict({"doc_id": b.column("doc_id"), "text": told})


def test_one_source_file_is_written_by_many_tasks(spark, monkeypatch):
    whole = samples.table(spark, SF001, "documents").select("doc_id", "text")
    dealt = whole.repartition(5).mapInArrow(_rows_of_tasks, "doc_id long, text string")
    monkeypatch.setattr(samples, "table", lambda *_: dealt)
    sources = []
    land = landing.land
    monkeypatch.setattr(landing, "land", lambda s, folder, *a, **k: sources.append(folder) or land(s, folder, *a, **k))
    rows = queries_io.land_one_file(spark, SF001).collect()
    told = {int(r["id"]): r["text"].removeprefix('"quoted",\n').split("\n", 1) for r in rows}
    assert len({task for task, _ in told.values()}) == 5
    assert {i: text.removesuffix('\n"" end') for i, (_, text) in told.items()} == {r["doc_id"]: r["text"] for r in whole.collect()}
    assert [f for f in os.listdir(sources[0].removeprefix("file:")) if not f.startswith(".")] == ["docs_all_0.csv"]


def test_joined_files_hold_every_byte_in_order(spark, tmp):
    texts = [b"first", b"", bytes(range(256)) * 5, "é\n".encode() * 7]
    parts = []
    for i, text in enumerate(texts):
        with open(f"{tmp}/part {i}", "wb") as f:
            f.write(text)
        parts.append((f"file:{tmp}/part {i}", len(text)))
    for piece in (100, 10_000):
        size = files.join_local(spark, b"head\n", parts, f"file:{tmp}/whole", piece)
        with open(f"{tmp}/whole", "rb") as f:
            assert f.read() == b"head\n" + b"".join(texts)
        assert size == 5 + sum(map(len, texts))
    assert files.join_local(spark, b"only\n", [], f"{tmp}/whole") == 5
    with pytest.raises(Exception):
        files.join_local(spark, b"", [(parts[0][0], 6)], f"{tmp}/whole")
