from pyspark.sql import functions as F

from refinery.operators import summaries


def test_total_null_keys_and_orderings(spark):
    df = spark.createDataFrame([("1", "2024", "02", "A", 5.0), (None, "2024", "01", "B", 2.5),
                                ("3", "2023", "12", "A", 1.25), ("4", None, None, None, 1.0)],
                               "id string, year string, month string, seg string, total_ttc double")
    assert summaries.total(df).first()["total_rows"] == 4
    assert summaries.null_keys(df, "id").first()["null_keys"] == 1
    assert [tuple(r) for r in summaries.by_month(df).collect()] == [
        (None, None, 1), ("2023", "12", 1), ("2024", "01", 1), ("2024", "02", 1)]
    assert [tuple(r) for r in summaries.count_by(df, "seg", sort="count").collect()] == [
        ("A", 2), (None, 1), ("B", 1)]
    assert [r["seg"] for r in summaries.count_by(df, "seg", sort="key").collect()] == [None, "A", "B"]
    rev = summaries.revenue_by(df, "seg")
    assert [tuple(r) for r in rev.collect()] == [("A", 6.25), ("B", 2.5), (None, 1.0)]
    top = summaries.top_k(rev, [F.col("revenue").desc()], 2)
    assert [r["seg"] for r in top.collect()] == ["A", "B"]
    out = summaries.sql_over(df, "t_view", "SELECT count(*) AS n FROM t_view WHERE seg = 'A'")
    assert out.first()["n"] == 2


def test_summaries_in_one_pass(spark):
    rows = [("A", "x", 1.25, None), ("A", "y", 2.5, "1"), (None, "x", 3.0, "1"), ("B", None, 0.5, "2")]
    df = spark.createDataFrame(rows, "seg string, reg string, amt double, n string")
    wanted = [summaries.Summary("total"), summaries.Summary("by_seg", ("seg",)), summaries.Summary("both", ("reg", "seg")),
              summaries.Summary("money", ("seg",), "amt"), summaries.Summary("all_money", (), "amt")]
    out = summaries.in_one_pass(df, wanted)
    got = {tuple(r) for r in out.collect()}
    assert got == {("total", None, None, 4.0), ("all_money", None, None, 7.25),
                   ("by_seg", "A", None, 2.0), ("by_seg", None, None, 1.0), ("by_seg", "B", None, 1.0),
                   ("money", "A", None, 3.75), ("money", None, None, 3.0), ("money", "B", None, 0.5),
                   ("both", "x", "A", 1.0), ("both", "y", "A", 1.0), ("both", "x", None, 1.0), ("both", None, "B", 1.0)}
    assert out._jdf.queryExecution().sparkPlan().toString().count("Scan") == 1
    none = {tuple(r) for r in summaries.in_one_pass(df.where("false"), [summaries.Summary("total")]).collect()}
    assert none == {("total", None, None, 0.0)}
