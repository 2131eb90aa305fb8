import random
import zlib

import numpy as np
import pyarrow.parquet as pq

from refinery.llm import toxicity as T
from tests.conftest import SF01
from tests.llm.helpers import documents, empty, rows_of, words

BAD = ["idiotic", "vile", "scummy"]


BAG = words(600, 1)


def draw(n, seed):
    """Words of one language, as in a corpus (``helpers.words`` has another one for each seed)."""
    return random.Random(seed).choices(BAG, k=n)


def sample(n, seed, bad):
    texts = []
    for i in range(n):
        w = draw(20 + (i * 37) % 150 + 800 * (i % 10 == 9), seed + i)
        if bad:
            for b in range(3):
                w.insert((i * 13 + 7 * b) % len(w), BAD[(i + b) % 3])
        texts.append(" ".join(w))
    return texts


TRAINED = []


def net():
    if not TRAINED:
        TRAINED.append(T.train(sample(60, 0, True) + sample(120, 1000, False), [1] * 60 + [0] * 120))
    return TRAINED[0]


def test_gradients_are_the_numeric_ones():
    rng = np.random.default_rng(1)
    model = T.Network({"a": 1, "b": 2}, np.array([0.0, 1.0, -1.0]))
    model.p = {k: v.astype(np.float64) for k, v in model.p.items()}
    gate = {s: rng.standard_normal((6, 3, 3 * T.HIDDEN)) for s in "fb"}
    mask = np.array([[1] * 6, [1, 1, 1, 0, 0, 0], [1] * 6], bool)
    tape, y = {}, np.array([1.0, 0.0, 1.0])

    def loss():
        p = T._sigmoid(model.logits(gate, mask).astype(np.float64))
        return -(y * np.log(p) + (1 - y) * np.log(1 - p)).sum()

    p = T._sigmoid(model.logits(gate, mask, tape))
    grads, dgate = model.gradients(tape, gate, p - y)
    for name in ("Uf", "Ub", "att", "att_v", "att_b", "out", "out_b"):
        at = tuple(rng.integers(0, n) for n in model.p[name].shape)
        keep, e = model.p[name][at], 1e-3
        model.p[name][at] = keep + e
        up = loss()
        model.p[name][at] = keep - e
        down = loss()
        model.p[name][at] = keep
        assert abs((up - down) / (2 * e) - grads[name][at]) < 2e-3
    for s in "fb":
        gate[s][2, 0, 5] += 1e-3
        up = loss()
        gate[s][2, 0, 5] -= 2e-3
        down = loss()
        gate[s][2, 0, 5] += 1e-3
        assert abs((up - down) / 2e-3 - dgate[s][2, 0, 5]) < 2e-3


def test_learns_and_finds_a_word_anywhere():
    memory, rows = {}, T.fresh_rows()
    bad, good = (T.scores(net(), sample(40, 5000 + 500 * b, b), memory, rows) for b in (True, False))
    assert (bad >= 0.5).mean() > 0.9 and (good >= 0.5).mean() < 0.1
    long = draw(5000, 77)
    late = long[:4990] + BAD + long[4990:]
    assert T.scores(net(), [" ".join(late)], memory, rows)[0] > 0.5 > T.scores(net(), [" ".join(long)], memory, rows)[0]


def test_windows_cover_every_word():
    for n in (0, 1, 31, 32, 33, 56, 57, 500):
        at = T.starts(n)
        assert set(range(n)) <= {a + i for a in at for i in range(T.WINDOW)}
        assert all(b - a < T.WINDOW for a, b in zip(at, at[1:])) and at[-1] + T.WINDOW <= max(n, T.WINDOW)


def test_small_memory_changes_nothing(monkeypatch):
    texts = sample(30, 9000, True)
    want = T.scores(net(), texts, {}, T.fresh_rows())
    monkeypatch.setattr(T, "REMEMBERED", 10)
    memory, rows = {}, T.fresh_rows()
    got = np.concatenate([T.scores(net(), texts[i:i + 3], memory, rows) for i in range(0, 30, 3)])
    assert np.allclose(got, want, atol=1e-5)


def test_scores_of_a_table(spark):
    rows = [(1, "so vile an idiotic scummy thing"), (2, None), (3, ""), (None, "fine"), (4, "..."), (4, "..."), (5, " ".join(draw(40000, 2)))]
    got = T.score(documents(spark, rows), net())
    assert rows_of(got, "doc_id") == sorted([(k,) for k, _ in rows], key=repr)
    assert all(0 <= r["score"] <= 1 for r in got.collect())
    by = {r["doc_id"]: r["score"] for r in got.collect()}
    assert by[1] > 0.5 and by[2] == by[3] < 0.5
    left = T.keep_clean(documents(spark, rows), net())
    assert rows_of(left, "doc_id") == sorted([(k,) for k, _ in rows if k != 1], key=repr) and left.columns == documents(spark, rows).columns
    assert T.score(empty(spark), net()).count() == 0 == T.keep_clean(empty(spark), net()).count()


def test_sample_reads_no_held_out_label(spark):
    rows = [(i, f"text {i}") for i in range(60)] + [(None, "x"), (61, None), (62, "")]
    labels = spark.createDataFrame([(i, i % 2, "x") for i in range(63)] + [(None, 1, "x"), (5, None, "x"), (4, 1, "x")], "doc_id long, toxic int, text string")
    texts, y = T.training_sample(documents(spark, rows), labels)
    want = {f"text {i}": int(i % 2 or i == 4) for i in range(60) if zlib.crc32(str(i).encode()) % 5}
    assert dict(zip(texts, y)) == want
    few, _ = T.training_sample(documents(spark, rows), labels, rows=5)
    assert len(few) == 10
    assert T.training_sample(empty(spark), labels) == ([], [])
    for none in ([], [0, 0]):
        flat = T.train(["a b"] * len(none), none)
        assert T.scores(flat, ["x", ""], {}, T.fresh_rows()).max() < 0.5


def test_held_out_accuracy():
    docs = {r["doc_id"]: r["text"] for r in pq.read_table(f"{SF01}/documents.parquet").to_pylist()}
    rows = [(docs[r["doc_id"]], r["toxic"], zlib.crc32(str(r["doc_id"]).encode()) % 5) for r in pq.read_table(f"{SF01}/labels.parquet").to_pylist()]
    by = {t: y for t, y, b in rows if b}
    model = T.train(list(by), list(by.values()))
    held = [(t, y) for t, y, b in rows if not b]
    p = T.scores(model, [t for t, _ in held], {}, T.fresh_rows()) >= 0.5
    assert (p == np.array([y for _, y in held])).mean() >= 0.9


def test_reads_words_without_spaces_to_their_end():
    glued = "".join(draw(400, 31))
    for text in (glued, f"so {glued} on", "x" * 64, "x" * 65, "", "字" * 200):
        assert "".join(T.words_of(text)) == "".join(text.lower().split()) and all(len(w) <= T.PIECE for w in T.words_of(text))
    head = "".join(draw(40, 33))[:128]
    clean, bad = T.scores(net(), [head + "table", head + "idiotic"], {}, T.fresh_rows())
    assert bad > 0.5 > clean


def plain_scores(model, text):
    """One word, one window and one direction at a time, from the parameters alone."""
    p, sig = {k: v.astype(float) for k, v in model.p.items()}, lambda x: 1 / (1 + np.exp(-x))

    def vector(word):
        w = T.bare(word)
        i = model.vocab.get(w, 0)
        told = ("<" + w + ">").encode()
        slots = [int((((np.uint32(a) * np.uint32(65599) + np.uint32(b)) * np.uint32(65599) + np.uint32(c)) * np.uint32(2654435761)) >> np.uint32(20))
                 % T.CHAR_SLOTS for a, b, c in zip(told, told[1:], told[2:])]
        return np.concatenate([p["word"][i], p["char"][slots].sum(axis=0) / len(w.encode()), [float(model.odds[i])]])

    def states(xs, side):
        h, out = np.zeros(T.HIDDEN), []
        for x in xs if side == "f" else xs[::-1]:
            g, r = x @ p[f"W{side}"] + p[f"c{side}"], h @ p[f"U{side}"]
            n = T.HIDDEN
            z, reset = sig(g[:n] + r[:n]), sig(g[n:2 * n] + r[n:2 * n])
            new = np.tanh(g[2 * n:] + reset * r[2 * n:])
            h = (1 - z) * new + z * h
            out.append(h)
        return out if side == "f" else out[::-1]

    words, best = T.words_of(text), -np.inf
    for a in T.starts(len(words)):
        xs, pooled = [vector(w) for w in words[a:a + T.WINDOW]], np.zeros(2 * T.HIDDEN)
        if xs:
            hs = np.array([np.concatenate(x) for x in zip(states(xs, "f"), states(xs, "b"))])
            e = np.exp(np.tanh(hs @ p["att"] + p["att_b"]) @ p["att_v"])
            pooled = (e / e.sum()) @ hs
        best = max(best, pooled @ p["out"] + p["out_b"][0])
    return sig(best * model.scale[0] + model.scale[1])


def test_scores_are_those_of_a_plain_loop():
    texts = ["", "one", "vile!", *sample(6, 700, True), *sample(6, 800, False), " ".join(draw(33, 3)), " ".join(draw(400, 4)), "été 你好 ..."]
    with np.errstate(over="ignore"):
        assert np.allclose(T.scores(net(), texts, {}, T.fresh_rows()), [plain_scores(net(), t) for t in texts], atol=2e-3)


def test_a_phrase_of_half_a_window_lies_whole_in_some_window():
    for n in (33, 48, 49, 200):
        at = T.starts(n)
        assert all(any(a <= i and i + 17 <= a + T.WINDOW for a in at) for i in range(n - 16))
