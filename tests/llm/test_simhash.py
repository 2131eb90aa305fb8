import re

import pytest
import xxhash
from hypothesis import given, settings, strategies as st

from refinery.llm import simhash
from refinery.llm.common import connected_components
from tests.llm.helpers import documents, empty, rows_of, words


def plain(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    shingles = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h)) if h else 0


def components(pairs):
    """Smallest id reachable over fingerprints within two bits; pairs are (id, fingerprint)."""
    label = list(range(len(pairs)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(pairs)):
        for j in range(i):
            if (pairs[i][1] ^ pairs[j][1]).bit_count() <= 2:
                label[find(i)] = find(j)
    low = {}
    for i, (k, _) in enumerate(pairs):
        if k is not None:
            low[find(i)] = min(k, low.get(find(i), k))
    return [low.get(find(i)) for i in range(len(pairs))]


@given(st.text(alphabet="aBc \n\t\u00c9\u2003x", max_size=60))
@settings(max_examples=60, deadline=None)
def test_fingerprint_is_the_plain_one(text):
    assert simhash.fingerprint(text) % (1 << 64) == plain(text)


def test_covering_masks_miss_no_pair():
    masks = simhash.covering_masks(2)
    for i in range(64):
        for j in range(i, 64):
            assert any(not m >> i & 1 and not m >> j & 1 for m in masks)
    inner = simhash.covering_masks(2, masks[0])
    assert all(m & masks[0] == masks[0] for m in inner)


def test_components_against_brute_force(spark):
    w = words(120)
    near = [" ".join(w[:i] + ["edit"] + w[i + 1:]) for i in range(0, 120, 6)]
    texts = [" ".join(w), " ".join(w), *near, None, "", "one", "ONE", "two words", " ".join(words(3000, 5)), "\u00c9 x\ty"]
    rows = [(100 - i, t) for i, t in enumerate(texts)] + [(None, "one"), (7, "again again"), (7, "again again")]
    got = rows_of(simhash.near_duplicates(documents(spark, rows)), "doc_id", "component_id")
    assert got == sorted(zip([k for k, _ in rows], components([(k, plain(t)) for k, t in rows])), key=repr)
    assert simhash.near_duplicates(empty(spark)).count() == 0


def test_hot_buckets_go_deeper(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BUCKET", 4)
    base = 0x0123456789ABCDEF
    fps = {base ^ (1 << a) ^ (1 << b) for a in range(0, 64, 3) for b in range(a, 64, 5)} | {base ^ 0xFFFF << 20}
    signed = [(simhash._signed(x),) for x in fps]
    edges = simhash.links(spark.createDataFrame(signed, "fp long"), 2)
    found = {r["node"]: r["root"] for r in connected_components(edges).collect()}
    label = components([(simhash._signed(x), x) for x in fps])
    for (fp,), want in zip(signed, label):
        assert found.get(fp, fp) == want
    assert all(((r["src"] ^ r["dst"]) % (1 << 64)).bit_count() <= 2 for r in edges.collect())


def test_keep_one(spark):
    rows = [(3, "same text here"), (1, "same text here"), (1, "same text here"), (None, "same text here"), (9, "other words stand here")]
    left = simhash.keep_one(documents(spark, rows))
    assert rows_of(left, "doc_id", "text") == rows_of(documents(spark, [rows[1], rows[3], rows[4]]), "doc_id", "text")
    assert left.columns == documents(spark, rows).columns


@pytest.mark.parametrize("rows,kept", [
    ([(5, "aa bb cc dd"), (5, "xx yy zz ww"), (2, "xx yy zz ww")], [(5, "aa bb cc dd"), (2, "xx yy zz ww")]),
    ([(5, "aa bb cc dd"), (5, "kk ll mm nn oo")], [(5, "aa bb cc dd"), (5, "kk ll mm nn oo")]),
    ([(5, "aa bb cc dd"), (5, "aa bb cc dd"), (5, "kk ll mm nn oo"), (5, "kk ll mm nn oo"), (7, "kk ll mm nn oo")],
     [(5, "aa bb cc dd"), (5, "kk ll mm nn oo")]),
    ([(None, "aa bb cc dd"), (3, "aa bb cc dd"), (None, None)], [(None, "aa bb cc dd"), (3, "aa bb cc dd"), (None, None)])])
def test_keep_one_judges_rows_not_ids(spark, rows, kept):
    assert rows_of(simhash.keep_one(documents(spark, rows)), "doc_id", "text") == sorted(kept, key=repr)


def test_keep_one_leaves_one_of_near_rows_with_one_id(spark):
    left = simhash.keep_one(documents(spark, [(4, None), (4, ""), (4, None), (9, " ")]))
    assert left.count() == 1 and left.first()["doc_id"] == 4


@pytest.mark.parametrize("n", [1, 40])
def test_connected_components_of_a_path(spark, n):
    edges = spark.createDataFrame([(i, i + 1) for i in range(n)] + [(5000, 5000), (None, 3)], "src long, dst long")
    found = {r["node"]: r["root"] for r in connected_components(edges).collect()}
    assert found == {i: 0 for i in range(n + 1)} | {5000: 5000}
