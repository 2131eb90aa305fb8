import hashlib
import random
import re

import numpy as np
import pytest

from refinery.llm import fim
from tests.llm.helpers import documents, empty, words


def plainly(key, text, seed=7, rate=100, spm=50):
    """The contract, word by word."""
    text = text or ""
    units = re.findall("[^\n]*\n|[^\n]+", text)
    h = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i:i + 8], 16) for i in range(0, 32, 8))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return len(units), "plain", None, None, text
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if h4 % 100 < spm:
        return len(units), "spm", len(p), len(p) + len(m), "<S>" + s + "<P>" + p + "<M>" + m
    return len(units), "psm", len(p), len(p) + len(m), "<P>" + p + "<S>" + s + "<M>" + m


@pytest.mark.parametrize("values,kind", [
    (np.arange(0, 60000, 37), fim.Array), (np.flatnonzero(np.arange(fim.CHUNK) % 3), fim.Bitmap),
    (np.concatenate([np.arange(100, 9000), np.arange(20000, 65536)]), fim.Runs), (np.array([0]), fim.Array),
    (np.array([65535]), fim.Array), (np.arange(fim.CHUNK), fim.Runs)])
def test_each_container_selects(values, kind):
    made = fim.container(values)
    assert type(made) is kind
    for k in {0, len(values) - 1, len(values) // 2, len(values) // 3, *random.Random(1).choices(range(len(values)), k=300)}:
        assert made.select(k) == values[k]
    for other in (fim.Array, fim.Bitmap, fim.Runs):
        assert [other(values).select(k) for k in (0, len(values) // 2, len(values) - 1)] == [
            values[0], values[len(values) // 2], values[-1]]


def texts():
    rng = random.Random(5)
    edge = fim.CHUNK
    yield from ("", "\n", "a", "a\n", "\n\n\n", "a\n\nb", "\u00e9\U0001f600\n\U0001f600", "x" * (edge - 1), "x" * edge, "x" * (edge + 1))
    for n in (edge - 2, edge - 1, edge, edge + 1):
        yield "x" * n + "\n"
        yield "x" * n + "\nend"
    yield "\n" * (2 * edge + 5)
    yield "".join(rng.choice("ab\n") for _ in range(3 * edge + 17))  # bitmaps
    yield "a" * (2 * edge) + "\n" * 10 + "b\n" * 40000
    for _ in range(30):
        yield "".join(rng.choice("ab\n\u4f60") for _ in range(rng.randrange(60)))


def test_cuts_are_the_plain_ones():
    for i, text in enumerate(texts()):
        ends = [m.end() for m in re.finditer("[^\n]*\n|[^\n]+", text)]
        lines = fim.Boundaries(text)
        assert len(lines) == len(ends)
        ranks = range(len(ends)) if len(ends) < 3000 else random.Random(i).sample(range(len(ends)), 1000)
        assert all(lines.select(k) == ends[k] for k in ranks)
        for key in (i, -i, 10**12 + i):
            n, form, a, b = fim.cuts(text, 7, key)
            out = fim.joined(text, form, a, b)
            assert (n, form, *((None, None) if form == "plain" else (a, b)), out) == plainly(key, text)
            assert fim.rebuilt(out, form) == text


def test_marks_half_formed_at_the_cuts_are_no_marks():
    for text in ("<\nS>\n<\nM>\nP>", "S>\n<\n<S\n", "<<\n>>\n<S"):
        for form in ("psm", "spm"):
            for a in range(len(text) + 1):
                for b in range(a, len(text) + 1):
                    assert fim.rebuilt(fim.joined(text, form, a, b), form) == text


def test_a_table(spark, monkeypatch):
    monkeypatch.setattr(fim, "BATCH_CHARS", 100)
    rows = [(1, "a\nb\nc"), (2, None), (3, ""), (None, "x\ny"), (4, "same\nrow"), (4, "same\nrow"), (5, "a <P>\nb"),
            (6, "\n".join(words(40000, 2))), (-7, "\n\n"), (8, "one line")]
    names = ("doc_id", "n", "form", "first_cut", "second_cut", "output", "restored")
    got = sorted((tuple(r[c] for c in names) for r in fim.transform(documents(spark, rows)).collect()), key=repr)
    assert got == sorted(((k, *plainly(k, t), t or "") for k, t in rows), key=repr)
    half = fim.transform(documents(spark, rows), rate=40, spm=10, seed=3).collect()
    assert sorted((tuple(r[c] for c in names[:6]) for r in half), key=repr) == sorted(
        ((k, *plainly(k, t, 3, 40, 10)) for k, t in rows), key=repr)
    assert fim.transform(empty(spark)).count() == 0
