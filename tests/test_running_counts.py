"""Running alert counts: state over runs, replays, null keys."""

import os

from refinery.operators import alerts
from refinery.sources import sinks
from refinery.streaming import alert_feed


def _alerts(spark, rows):
    schema = alerts.ALERT_SCHEMA
    return spark.createDataFrame([("2024-01-01T00:00:00", "T", e, "raw", s, "m") for s, e in rows], schema)


def _totals(spark, tmp):
    return {(r["severity"], r["entity"]): r["alerts"] for r in alert_feed.running_counts(spark, f"{tmp}/totals").collect()}


def _run(spark, tmp, **opts):
    alert_feed.count_stream(spark, f"{tmp}/in", f"{tmp}/totals", f"{tmp}/ck", **opts)


def test_runs_add_up_and_replays_add_nothing(spark, tmp):
    first = [("CRITICAL", "a")] * 3 + [("INFO", None), (None, "b"), ("INFO", "c")]
    second = [("CRITICAL", "a"), (None, "b"), ("WARNING", "d")]
    sinks.append_json(_alerts(spark, first), f"{tmp}/in")
    _run(spark, tmp, max_files_per_trigger=1)
    sinks.append_json(_alerts(spark, second), f"{tmp}/in")
    _run(spark, tmp)
    expected = {(r["severity"], r["entity"]): r["alerts"]
                for r in alerts.counts(_alerts(spark, first + second)).collect()}
    assert _totals(spark, tmp) == expected
    _run(spark, tmp)  # no new file
    assert _totals(spark, tmp) == expected
    # the last batch was written but not committed when its driver was lost: the next run repeats it
    commits = f"{tmp}/ck/commits"
    last = max(int(f) for f in os.listdir(commits) if f.isdigit())
    os.remove(f"{commits}/{last}")
    if os.path.exists(f"{commits}/.{last}.crc"):
        os.remove(f"{commits}/.{last}.crc")
    _run(spark, tmp)
    assert _totals(spark, tmp) == expected


def test_a_batch_holds_changed_totals_only(spark, tmp):
    sinks.append_json(_alerts(spark, [("INFO", str(i)) for i in range(50)]).coalesce(1), f"{tmp}/in")
    _run(spark, tmp)
    sinks.append_json(_alerts(spark, [("INFO", "7")]).coalesce(1), f"{tmp}/in")
    _run(spark, tmp)
    newest = max(int(d.split("=")[1]) for d in os.listdir(f"{tmp}/totals") if d.startswith("batch="))
    rows = spark.read.parquet(f"{tmp}/totals/batch={newest}").collect()
    assert [(r["entity"], r["alerts"]) for r in rows] == [("7", 2)]
