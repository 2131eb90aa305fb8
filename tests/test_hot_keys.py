import random
from collections import Counter

import pytest

from refinery.operators import hot_keys as hk


def _rows(n=20000, seed=1):
    rng = random.Random(seed)
    return [(rng.choice("xy"), 7 if rng.random() < 0.33 else 8 if rng.random() < 0.02 else rng.randrange(100, 9000) if rng.random() < 0.95 else None)
            for _ in range(n)]


def test_exact_counts_of_the_hot_keys(spark):
    rows = _rows()
    df = spark.createDataFrame(rows, "g string, k long").repartition(7)
    keys = Counter(k for _, k in rows if k is not None)
    for share in (0.3, 0.01, 0.0004):
        want = {(k, n, keys.total()) for k, n in keys.items() if n > share * keys.total()}
        tracked = 20000 if share < 0.001 else None
        assert {tuple(r) for r in hk.hot_keys(df, "k", share, tracked=tracked).collect()} == want and want
    assert hk.hot_key_list(df, "k", 0.3) == [7]


def test_groups_are_judged_on_their_own(spark):
    rows = _rows()
    df = spark.createDataFrame(rows, "g string, k long")
    want = set()
    for g in "xy":
        keys = Counter(k for h, k in rows if h == g and k is not None)
        want |= {(g, k, n, keys.total()) for k, n in keys.items() if n > 0.01 * keys.total()}
    assert {tuple(r) for r in hk.hot_keys(df, "k", 0.01, ["g"]).collect()} == want


def test_a_small_sketch_loses_no_hot_key_and_stored_ones_merge(spark, tmp):
    """More distinct keys than counters: the superset holds every hot key, the exact count drops the rest."""
    rows = [(d, k) for d in range(5) for k in [*range(d * 3000, d * 3000 + 3000), *[-1] * 900, *[-2 - d] * 700]]
    random.Random(2).shuffle(rows)
    df = spark.createDataFrame(rows, "d int, k long").repartition(6)
    hk.summarise(df, "k", ["d"], 128).write.parquet(f"{tmp}/summaries")
    whole = hk.merged(spark.read.parquet(f"{tmp}/summaries"), tracked=128)
    total = len(rows)
    keys = Counter(k for _, k in rows)
    hot = {k for k, n in keys.items() if n > 0.05 * total}
    found = {r["item"]: r["estimate"] for r in hk.superset(whole, 0.05, tracked=128).collect()}
    assert hot <= set(found) and all(found[k] >= keys[k] for k in found)
    assert all(found[k] - keys[k] <= 2.7 / 128 * total for k in found)
    got = hk.hot_keys(df.select("k"), "k", 0.05, tracked=128, summaries=whole).collect()
    assert {r["k"]: r["rows"] for r in got} == {k: keys[k] for k in hot} == {-1: 4500}


def test_empty_tables_and_shares_too_small_for_the_sketch(spark):
    none = spark.createDataFrame([], "g string, k string")
    assert hk.hot_keys(none, "k", 0.1).count() == 0 and hk.hot_keys(none, "k", 0.1, ["g"]).count() == 0
    assert hk.hot_key_list(spark.createDataFrame([(None,)], "k string"), "k", 0.1) == []
    with pytest.raises(ValueError):
        hk.hot_keys(none, "k", 0.01, tracked=100)


def test_text_and_date_keys(spark):
    df = spark.sql("SELECT IF(id % 2 = 0, 'hot', concat('k', id)) AS k, date_add(DATE'2024-01-01', CAST(IF(id % 3 = 0, 0, id) AS INT)) AS d FROM range(3000)")
    assert hk.hot_key_list(df, "k", 0.4) == ["hot"]
    assert [str(d) for d in hk.hot_key_list(df, "d", 0.3)] == ["2024-01-01"]
