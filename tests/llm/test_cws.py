import re
from collections import Counter

import numpy as np

from refinery.llm import cws
from tests.llm.helpers import documents, empty, sha, words


def weights(t):
    return Counter(w for w in re.split(r"[\x20\x09-\x0D]+", t) if w)


def jaccard(a, b):
    top = sum(max(a[k], b[k]) for k in a | b)
    return sum(min(a[k], b[k]) for k in a & b) / top if top else 1.0


def test_gamma_variates(spark):
    r = spark.range(20000).selectExpr(f"{cws.gamma('id', 5)} AS g", f"{cws.uniform('id', 6, False)} AS u").toPandas()
    assert abs(r.g.mean() - 2) < 0.05 and abs(r.g.var() - 2) < 0.15 and abs(r.u.mean() - 0.5) < 0.01
    assert abs((r.g < 1).mean() - (1 - 2 / np.e)) < 0.01


def test_against_plain_edits(spark, monkeypatch):
    monkeypatch.setattr(cws, "RANGE_ROWS", 5)
    rows = [(i * i - 50, " ".join(words(30 + 7 * i, i % 6, 40))) for i in range(40)]
    rows += [(-7, None), (-8, ""), (-9, " \t"), (10**12, "\U0001f600 éè x" * 3), (10**12 + 1, " ".join(words(20000, 3))), (5, "tie b"), (5, "tie a"), (6, "twin"), (6, "twin"),
             (None, "no name"), (None, "no name at all")]
    got = cws.compare_with_next(documents(spark, rows)).collect()
    assert len(got) == len(rows)
    for ids in ([k for k, _ in rows if k not in (None, 5, 6)],):
        order = sorted({k for k, _ in rows if k is not None}, reverse=True)
        text = dict(rows)
        near = []
        for r in got:
            k = r["doc_id"]
            follow = order[order.index(k) + 1] if k in order and order.index(k) + 1 < len(order) else None
            if k not in ids or follow in (None, 5, 6):
                continue
            own, after = text[k] or "", text[follow] or ""
            half = len(own) // 2
            edit = own[:len(own) - half] + after[:half]
            assert (r["n_chars"], r["edited_sha256"]) == (len(own), sha(edit))
            near.append((r["near_edited"] - jaccard(weights(own), weights(edit)), r["near_next"] - jaccard(weights(own), weights(after))))
        near = np.array(near)
        assert len(near) > 30 and np.abs(near.mean(axis=0)).max() < 0.05 and near.std(axis=0).max() < 0.12
    twins = {r["fingerprint"] for r in got if r["doc_id"] == 6}
    assert len(twins) == 1
    void = [r for r in got if r["doc_id"] in (-7, -8, -9)]
    assert {r["fingerprint"] for r in void} == {"0" * cws.SAMPLES * cws.DIGITS}


def test_few_rows(spark):
    assert cws.compare_with_next(empty(spark)).count() == 0
    (one,) = cws.compare_with_next(documents(spark, [(1, "abcd")])).collect()
    assert (one["n_chars"], one["edited_sha256"], one["near_next"]) == (4, sha("abab"), 1.0)
    null = cws.compare_with_next(documents(spark, [(None, "abcd"), (None, "abcd")])).collect()
    assert [r["near_next"] for r in null] == [1.0, 1.0]


def test_weights_are_respected(spark):
    """Samples of two texts agree as often as their generalised Jaccard similarity, over many samples."""
    a, b = "x " * 8 + "y " * 2 + "z", "x " * 4 + "y " * 2 + "w " * 3
    rows = spark.createDataFrame([(1, a), (2, b)], "k int, text string")
    fp = {r["k"]: r["fp"] for r in cws.signatures(rows, ["k"], "text", 256).collect()}
    same = np.mean([fp[1][i:i + 8] == fp[2][i:i + 8] for i in range(0, 2048, 8)])
    assert abs(same - jaccard(weights(a), weights(b))) < 0.1
