import csv
import io
import os
import random

import pytest
from pyspark.sql import functions as F

from refinery.session import session_conf
from refinery.sources import landing, quoted_csv, readers


def _value(rng):
    return "".join(rng.choice(['a', 'bc', ' ', '"', '""', '\n', '\r\n', ',', '\\', 'é', "x" * 30]) for _ in range(rng.randrange(1, 9)))


def _file(path, rows, header=("id", "text", "more"), end="\n", last_end=True, quoting=csv.QUOTE_MINIMAL):
    out = io.StringIO()
    w = csv.writer(out, lineterminator=end, quoting=quoting)
    w.writerow(header)
    w.writerows(rows)
    text = out.getvalue() if last_end else out.getvalue()[:-len(end)]
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8", newline="") as f:
        f.write(text)
    return len(text.encode())


def _norm(v):
    return v or None


@pytest.mark.parametrize("size", [400, 1 << 20])
def test_ranges_of_any_size_give_the_rows_of_a_plain_reader(spark, tmp, size):
    """Records of many lines, cut in the middle of fields, quotes and line ends, also over several ranges."""
    rng = random.Random(size)
    want, total = [], 0
    for n, (end, last) in enumerate([("\n", True), ("\n", False), ("\r\n", True), ("\n", True)]):
        rows = [(f"{n}-{i}", _value(rng) + "z", rng.choice(["", "plain", _value(rng) + "z"])) for i in range(40)]
        rows.append((f"{n}-long", "line\n" * 300 + '"', "z"))
        total += _file(f"{tmp}/src/part_{n}.csv", rows, end=end, last_end=last, quoting=csv.QUOTE_ALL if n == 3 else csv.QUOTE_MINIMAL)
        want += rows
    with session_conf(spark, {"spark.sql.files.maxPartitionBytes": str(size), "spark.sql.files.openCostInBytes": "0"}):
        found = quoted_csv.read_by_header(spark, f"{tmp}/src", "*.csv")
        assert [names for names, _ in found] == [["id", "text", "more"]]
        got = [tuple(map(_norm, r)) for r in found[0][1].drop(quoted_csv.FILE_PATH).collect()]
        blocks = quoted_csv.line_table(spark, [f"{tmp}/src"]).select("path", "block").distinct().count()
    assert sorted(got, key=repr) == sorted((tuple(map(_norm, r)) for r in want), key=repr)
    assert size > total or blocks > total // size // 4  # a range that holds no line begin has no row


def test_same_rows_as_the_multi_line_reader(spark, tmp):
    rng = random.Random(4)
    _file(f"{tmp}/src/a.csv", [(str(i), _value(rng) + "z", rng.choice(["", " ", "  x "])) for i in range(300)])
    plain = spark.read.options(**landing.CSV_OPTIONS).schema("id string, text string, more string").csv(f"{tmp}/src")
    with session_conf(spark, {"spark.sql.files.maxPartitionBytes": "500", "spark.sql.files.openCostInBytes": "0"}):
        ours = quoted_csv.read_by_header(spark, f"{tmp}/src")[0][1].drop(quoted_csv.FILE_PATH).collect()
    assert sorted(map(tuple, ours), key=repr) == sorted(map(tuple, plain.collect()), key=repr)


def test_files_without_breaks_take_the_split_reader(spark, tmp):
    _file(f"{tmp}/src/a.csv", [(str(i), f'said "{i}", then', " ") for i in range(500)])
    _file(f"{tmp}/src/b.csv", [("b1", "two\nlines", "x")])
    _file(f"{tmp}/src/c.csv", [("c1", "", "x")], end="\r\n")
    with session_conf(spark, {"spark.sql.files.maxPartitionBytes": "2000", "spark.sql.files.openCostInBytes": "0"}):
        told = {os.path.basename(r["path"]): r["tricky"] for r in quoted_csv.survey(spark, f"{tmp}/src").collect()}
        assert told == {"a.csv": False, "b.csv": True, "c.csv": False}
        (names, rows), = quoted_csv.read_by_header(spark, f"{tmp}/src")
        got = {tuple(r) for r in rows.withColumn(quoted_csv.FILE_PATH, quoted_csv.file_name()).collect()}
    assert got == {*((str(i), f'said "{i}", then', " ", "a.csv") for i in range(500)), ("b1", "two\nlines", "x", "b.csv"), ("c1", None, "x", "c.csv")}


def test_one_large_file_lands_in_many_tasks(spark, tmp):
    rows = [(str(i), f'said "{i}",\nthen left', "x" * 40) for i in range(8000)]
    size = _file(f"{tmp}/src/sales.csv", rows)
    with session_conf(spark, {"spark.sql.files.maxPartitionBytes": "64k"}):
        lines = quoted_csv.line_table(spark, [f"{tmp}/src"])
        assert lines.select("block").distinct().count() >= size // (1 << 16)
        landing.land(spark, f"{tmp}/src", f"{tmp}/raw", "sales", "2024-01-01", "2024-01-01 00:00:00")
        back = readers.read_raw(spark, f"{tmp}/raw", "sales", "2024-01-01", ["id", "text", "more", *landing.LINEAGE], split=True)
        assert back.columns == ["id", "text", "more", *landing.LINEAGE, landing.PARTITION]
        assert back.where(F.col("text") == F.format_string('said "%s",\nthen left', "id")).count() == len(rows)
        assert back.select("ingest_date", "file_name").distinct().collect() == [("2024-01-01", "sales.csv")]


def test_many_files_and_headers(spark, tmp):
    """Each of many small files is read by its own header; the driver sees the distinct ones only."""
    for i in range(120):
        a, b = ("id", "amount") if i % 3 else ("amount", "id")
        os.makedirs(f"{tmp}/src", exist_ok=True)
        with open(f"{tmp}/src/sales_{i:03}.csv", "w") as f:
            f.write(f"{a},{b}\n" + (f"{i},{-i}\n" if i % 3 else f"{-i},{i}\n") * (i % 5))
    with open(f"{tmp}/src/sales_none.csv", "w"):
        pass
    found = quoted_csv.read_by_header(spark, f"{tmp}/src", "sales*.csv")
    assert sorted(n for n, _ in found) == [["amount", "id"], ["id", "amount"]]
    rows = landing.read_sources(spark, f"{tmp}/src", "sales*.csv", None)
    assert sorted((int(r["id"]), int(r["amount"])) for r in rows.collect()) == sorted((i, -i) for i in range(120) for _ in range(i % 5))
    assert landing.read_sources(spark, f"{tmp}/src", "other*.csv") is None
    assert landing.read_sources(spark, f"{tmp}/nowhere") is None


def test_names_excluded_and_a_foreign_header(spark, tmp):
    for name, text in (("a.csv", "id,n\n1,2\n"), ("b_enrichi.csv", "x\n1\n"), ("empty.csv", ""), (".hidden.csv", "x\n1\n"), ("blank.csv", "id,n\n\n\n")):
        os.makedirs(f"{tmp}/src", exist_ok=True)
        with open(f"{tmp}/src/{name}", "w") as f:
            f.write(text)
    found = quoted_csv.read_by_header(spark, f"{tmp}/src", "*.csv", "_enrichi")
    assert [n for n, _ in found] == [["id", "n"]] and found[0][1].count() == 1
    os.makedirs(f"{tmp}/raw/sales/ingest_date=2024-01-01")
    with open(f"{tmp}/raw/sales/ingest_date=2024-01-01/a.csv", "w") as f:
        f.write("id_client,nom\n1,2\n")
    with pytest.raises(ValueError):
        readers.read_raw(spark, f"{tmp}/raw", "sales", "2024-01-01", ["id", "amount"], split=True)
    assert readers.read_raw(spark, f"{tmp}/raw", "sales", "2024-01-02", ["id", "amount"], split=True).count() == 0


def test_repeated_names_take_the_last_column(spark, tmp):
    os.makedirs(f"{tmp}/src")
    with open(f"{tmp}/src/a.csv", "w") as f:
        f.write('id,n,"n"\n1,2,3\n')
    assert [tuple(r) for r in landing.read_sources(spark, f"{tmp}/src").select("id", "n").collect()] == [("1", "3")]
