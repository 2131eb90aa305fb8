import base64

import numpy as np
import public_tokenizers as P
import tiktoken
from hypothesis import given, settings, strategies as st

from refinery.llm import bpe
from tests.llm.helpers import documents, empty, words

PATH = P.path("byte_bpe_50k.tiktoken")
BLOB = open(PATH, "rb").read()
VOCAB = bpe.Vocabulary(BLOB)
TOKTOK = tiktoken.Encoding("own", pat_str=P.PATTERN, special_tokens={},
                           mergeable_ranks={base64.b64decode(a): int(b) for a, b in map(bytes.split, BLOB.splitlines())})


@given(st.lists(st.text(max_size=40), max_size=6))
@settings(max_examples=60, deadline=None)
def test_encoding_is_the_library_s(texts):
    import regex
    got = bpe._encode_texts(VOCAB, regex.compile(P.PATTERN), {}, texts)
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == [TOKTOK.encode_ordinary(t) for t in texts]


def test_long_pieces_take_the_same_merges():
    for n in (255, 256, 257, 5000):
        piece = "".join(words(n))[:n]
        assert np.frombuffer(VOCAB.encode_pieces([piece.encode()])[0], "<u4").tolist() == TOKTOK.encode_ordinary(piece)
    assert VOCAB._heap(b"thatthatthat") == VOCAB._matrix([b"thatthatthat"], 16)[0]


def test_round_trip_of_a_table(spark, monkeypatch):
    rows = [(1, "It's 12 o'clock.\n\n  \u00e9t\u00e9 \u4f60\u597d \U0001f600"), (2, None), (3, ""), (None, "a b"), (4, "same"), (4, "same"),
            (5, " ".join(words(30000, 3)))]
    ids = bpe.encode(documents(spark, rows), "doc_id", "text", PATH, P.PATTERN)
    got = sorted(((r["doc_id"], bytes(r["ids"]), bytes(r["decoded"])) for r in bpe.decode(ids, "doc_id", PATH).collect()), key=repr)
    want = sorted(((k, np.array(TOKTOK.encode_ordinary(t or ""), "<u4").tobytes(), (t or "").encode()) for k, t in rows), key=repr)
    assert got == want
    both = bpe.round_trip(documents(spark, rows), "doc_id", "text", PATH, P.PATTERN)
    assert sorted(((r["doc_id"], bytes(r["ids"]), bytes(r["decoded"])) for r in both.collect()), key=repr) == want
    assert bpe.round_trip(empty(spark), "doc_id", "text", PATH, P.PATTERN).count() == 0
    assert bpe.decode(bpe.encode(empty(spark), "doc_id", "text", PATH, P.PATTERN), "doc_id", PATH).count() == 0


def test_small_memory_and_cut_texts_change_nothing(monkeypatch):
    import regex
    texts = [" ".join(words(500, s)) for s in range(3)]
    want = bpe._encode_texts(VOCAB, regex.compile(P.PATTERN), {}, texts)
    monkeypatch.setattr(bpe, "REMEMBERED", 50)
    monkeypatch.setattr(bpe, "LONG_TEXT", 100)
    assert bpe._encode_texts(VOCAB, regex.compile(P.PATTERN), {}, texts) == want
