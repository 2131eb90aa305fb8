"""Hot-key fixtures (one key holds a third of all rows) against a brute-force pandas answer."""

import random

import pandas as pd

from refinery.operators import cleaning as cl
from refinery.operators.joins import enrich_left


def _fixture(n=3000, seed=7):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        key = "HOT" if i % 3 == 0 else (None if i % 17 == 0 else f"k{rnd.randrange(400)}")
        rows.append((key, rnd.randrange(5), f"v{rnd.randrange(1000):04d}"))
    return rows


def test_dedup_with_hot_key_matches_brute_force(spark):
    rows = _fixture()
    df = spark.createDataFrame(rows, "k string, seq int, v string").repartition(6)
    got = sorted(map(tuple, cl.dedup(df, "k", "seq").collect()), key=repr)
    pdf = pd.DataFrame(rows, columns=["k", "seq", "v"])
    pdf["kk"] = pdf["k"].fillna("\0null")
    best = pdf.sort_values(["seq", "v"], ascending=False).groupby("kk", sort=False).head(1)
    want = [((None if r.kk == "\0null" else r.kk), r.seq, r.v) for r in best.itertuples()]
    assert got == sorted(want, key=repr)


def test_join_with_hot_key_matches_brute_force(spark):
    rows = _fixture()
    fact = spark.createDataFrame([(f"s{i}", r[0]) for i, r in enumerate(rows)], "sale string, client string")
    dim_rows = [("HOT", "H", "RH")] + [(f"k{i}", f"S{i % 5}", f"R{i % 7}") for i in range(0, 400, 2)]
    dim = spark.createDataFrame(dim_rows, "id string, segment string, region string")
    lookup = {r[0]: (r[1], r[2]) for r in dim_rows}
    want = sorted((f"s{i}", r[0]) + lookup.get(r[0], (None, None)) for i, r in enumerate(rows))
    for kw in ({}, {"hot_keys": ["HOT"]}, {"detect_hot_share": 0.05}):
        out = enrich_left(fact, dim, "client", "id", ["segment", "region"], **kw)
        assert sorted(map(tuple, out.collect()), key=repr) == sorted(want, key=repr)
