"""Plan shape of the flagship query: pruned scans, partial aggregation, single-pass join."""

from tests.conftest import SF001


def test_flagship_plan_shape(spark):
    import __spark_entry__ as entry
    df = entry.queries()["revenue_by_region"](spark, SF001)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    # orders is read without the unused o_orderstatus column
    assert "o_orderstatus" not in plan and "o_totalprice" in plan
    # dedup and revenue aggregate combine before their shuffles
    assert "partial_max" in plan and "partial_sum" in plan
    # skew handling is one join, not a union of join branches
    assert "Union" not in plan.split("SortAggregate")[0]
