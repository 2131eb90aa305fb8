import random

import pytest
from hypothesis import given, settings, strategies as st

from refinery.llm import substrings as S
from tests.llm.helpers import documents, empty, words


def plain(rows, length=50):
    """(id, bytes, removed, spans, kept) of every row, by a table of all strings."""
    least = {}
    texts = [(k, (t or "").encode()) for k, t in rows]
    for k, b in texts:
        if k is not None:
            for i in range(len(b) - length + 1):
                w = b[i:i + length]
                least[w] = min(k, least.get(w, k))
    out = []
    for k, b in texts:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if k is not None and least[b[i:i + length]] < k:
                gone[i:i + length] = b"\1" * length
        runs = sum(1 for i in range(len(b)) if gone[i] and (not i or not gone[i - 1]))
        out.append((k, len(b), sum(gone), runs, bytes(c for c, g in zip(b, gone) if not g)))
    return sorted(out, key=repr)


def found(df):
    return sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], len(r["spans"]), bytes(r["kept"])) for r in df.collect()), key=repr)


def table():
    rng = random.Random(3)
    base = " ".join(words(300, 1))
    line = "Licensed under terms that many documents share, word by word, in one very common line."
    rows = [(50 - i, base[rng.randrange(200):][:rng.randrange(60, 1500)]) for i in range(25)]
    rows += [(100 + i, " ".join(words(20, 50 + i)) + f"\n{line}\n" + " ".join(words(30, 90 + i))) for i in range(12)]
    rows += [(200, "is on. " * 120), (201, "x is on. " + "is on. " * 60), (202, "a" * 400), (203, "b" + "a" * 49), (204, "a" * 50 + "b"), (205, "éè" * 40),
             (206, "z" + "èé" * 40), (207, "\x00" * 70), (208, "\x00" * 60 + "q"), (300, None), (301, ""), (302, "short"), (None, base), (7, base), (7, base), (7, base[40:400]),
             (303, " ".join(words(30000, 9))), (304, "q" + " ".join(words(30000, 9))[1000:90000])]
    return rows


def test_against_all_strings(spark, monkeypatch):
    rows = table()
    want = plain(rows)
    assert found(S.remove_repeats(documents(spark, rows))) == want
    assert sum(w[2] for w in want) > 50000
    assert S.remove_repeats(empty(spark)).count() == 0


def test_blocks_hot_anchors_and_a_small_filter(spark, monkeypatch):
    rows = [r for r in table() if r[0] not in (303, 304)]
    monkeypatch.setattr(S, "BLOCK", 64)
    monkeypatch.setattr(S, "MOST_WORDS", 64)
    monkeypatch.setattr(S, "BATCH", 3)
    monkeypatch.setattr(S, "LEAST_SHARDS", 4)
    assert found(S.remove_repeats(documents(spark, rows))) == plain(rows)
    before = S._stretches

    def all_hot(source, filter_, hot, length, shards):
        import numpy as np
        shared = S._shared_keys(S._packed_keys(source, length, shards))
        return before(source, filter_, np.sort(np.array([r["key"] for r in shared.collect()], np.int64)), length, shards)

    monkeypatch.setattr(S, "_stretches", all_hot)
    assert found(S.remove_repeats(documents(spark, rows))) == plain(rows)


@given(st.lists(st.binary(min_size=6, max_size=9).map(lambda b: bytes(x % 3 for x in b)), min_size=1, max_size=12, unique=True), st.data())
@settings(max_examples=80, deadline=None)
def test_column_wise_order(bodies, data):
    """Strings of 6 with grams of 16 replaced by 3: the anchor at ``off`` of each stretch lines the columns up."""
    import numpy as np
    docs = np.array(data.draw(st.lists(st.integers(0, 5), min_size=len(bodies), max_size=len(bodies))))
    offs = np.array([len(b) - 6 for b in bodies])
    gram, S.GRAM = S.GRAM, 3
    try:
        got = S.least_holders(bodies, offs, docs, 6)
    finally:
        S.GRAM = gram
    for i, b in enumerate(bodies):
        for p in range(len(b) - 5):
            same = [docs[j] for j, c in enumerate(bodies) for q in range(len(c) - 5) if offs[j] - q == offs[i] - p and c[q:q + 6] == b[p:p + 6]]
            assert got[i, p] == min(same)


@pytest.mark.parametrize("block", [64, 1 << 20])
def test_equal_strings_have_equal_anchors(monkeypatch, block):
    monkeypatch.setattr(S, "BLOCK", block)
    text = (" ".join(words(60, 2)) * 2 + "ab" * 80).encode()
    named = {}
    for first, last, at, key in S.anchors(text, 50):
        for a, b, x, k in zip(first, last, at, key):
            for p in range(a, b + 1):
                assert 0 <= x - p <= 34
                assert named.setdefault(text[p:p + 50], (x - p, k)) == (x - p, k)
    assert len(named) == len({text[i:i + 50] for i in range(len(text) - 49)})


def test_passes(spark, monkeypatch):
    rows = [r for r in table() if r[0] not in (303, 304)]
    for name, value in (("SENT_BYTES", 2000), ("MOST_HELD", 100), ("BLOCK", 500), ("LEAST_SHARDS", 7)):
        monkeypatch.setattr(S, name, value)
    taken = []
    before = S._stretches
    monkeypatch.setattr(S, "_stretches", lambda *a: taken.append(a) or before(*a))
    monkeypatch.setattr(S, "_passes", lambda *_: (3, 10))
    assert found(S.remove_repeats(documents(spark, rows))) == plain(rows)
    assert len(taken) == 3


def test_a_pass_sends_less_than_the_text(spark, monkeypatch):
    """Every text stands three times, in different tasks: together the stretches are several times the texts."""
    texts = [" ".join(words(400, 1000 + i)) for i in range(100)]
    rows = [[(1000 * c + i, t) for i, t in enumerate(texts)] for c in range(3)]
    df = documents(spark, rows[0]).coalesce(1).union(documents(spark, rows[1]).coalesce(1)).union(documents(spark, rows[2]).coalesce(1))
    before, sent = S._stretches, []

    def watched(*a):
        out = before(*a)
        sent.append(sum(len(v) for r in out.collect() for v in r if isinstance(v, (bytes, bytearray))))
        return out

    monkeypatch.setattr(S, "_stretches", watched)
    assert found(S.remove_repeats(df)) == plain([r for part in rows for r in part])
    assert max(sent) < 3 * sum(map(len, texts))


def test_no_shuffle_files_are_left(spark):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffles():
        blocks = disk.getAllBlocks()
        return {b for b in (blocks.apply(i).name() for i in range(blocks.size())) if b.startswith("shuffle_")}

    old = shuffles()
    out = S.remove_repeats(documents(spark, [r for r in table() if r[0] not in (303, 304)]))
    assert not shuffles() - old
    assert out.count() == len(table()) - 2


@pytest.mark.parametrize("keys, held, total", [(0, 0, 0), (1, 2, 60), (7 << 20, 15 << 20, 864 << 20), (576 << 20, 576 << 20, 10368 << 20)])
def test_number_of_passes(keys, held, total):
    passes, deals = S._passes(keys, held, total, 50)
    assert 1 <= passes <= 8 and deals >= passes
    assert held * S.STRETCH_BYTES <= passes * S.MOST_SENT * max(1, total) or total < 1000
