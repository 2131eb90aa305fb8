import os
import sys

os.environ["TOKENIZERS_PARALLELISM"] = "false"

import public_tokenizers as P
import pytest
import regex
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from refinery.llm import token_counts as tc
from tests.llm.helpers import documents, empty, rows_of, words

PATH = P.path("byte_bpe_50k.json")
BLOB = open(PATH, encoding="utf-8").read()
LIBRARY = Tokenizer.from_file(PATH)
PIECES = tc.Pieces(BLOB)


def library(text):
    return len(LIBRARY.encode(text or "", add_special_tokens=False).ids)


def test_both_engines_agree_on_the_code_points_that_are_cut_here():
    cut = regex.compile(P.PATTERN)
    for c in range(sys.maxunicode + 1):
        if 0xD800 <= c < 0xE000 or tc.AGREED.search(chr(c)):
            continue
        text = f"a{chr(c)}a1{chr(c)}1.{chr(c)}. {chr(c)} \n{chr(c)}{chr(c)}a"
        assert [m.span() for m in cut.finditer(text)] == [x[1] for x in PIECES.library.pre_tokenizer.pre_tokenize_str(text)], hex(c)


@given(st.lists(st.one_of(st.text(max_size=40), st.text("ab 's1\n\t.<|endoftext|>", max_size=60),
                          st.lists(st.sampled_from(["<|endoftext|>", " the", "\u00e9t\u00e9", "  ", "\n", "'ll"]), max_size=8).map("".join)),
                max_size=6))
@settings(max_examples=150, deadline=None)
def test_counts_are_the_library_s(texts):
    table = tc.LengthTable(dict(zip([" the", "a", "  "], PIECES.lengths([" the", "a", "  "]))))
    assert tc.Counting(PIECES, table).counts(texts) == [library(t) for t in texts]


def test_the_table_answers_what_it_holds_and_nothing_else(monkeypatch):
    names = sorted({*words(3000, 1, 2000), "\u4f60\u597d", " "})
    held = {p: i % 9 + 1 for i, p in enumerate(names)}
    table = tc.LengthTable(held)
    assert table.lookup(names) == list(held.values())
    assert not any(table.lookup([p + "!" for p in names]))
    assert tc.LengthTable({}).lookup(["a"]) == [0]
    monkeypatch.setattr(tc.xxhash, "xxh3_64_intdigest", lambda x: 5)  # all hashes alike
    table = tc.LengthTable(dict(list(held.items())[:60]))
    assert table.lookup(names[:70]) == list(held.values())[:60] + [0] * 10


def test_cut_texts_and_small_memories_change_nothing(monkeypatch):
    texts = [" ".join(words(2000, s)) + "\n\n \u4f60\u597d \u0558 <|endoftext|> x" for s in range(3)] + ["y" * 5000, " " * 3000]
    want = [library(t) for t in texts]
    monkeypatch.setattr(tc, "BATCH_CHARS", 200)
    monkeypatch.setattr(tc, "REMEMBERED", 20)
    monkeypatch.setattr(tc, "LONG_PIECE", 5)
    assert tc.Counting(PIECES, tc.LengthTable({})).counts(texts) == want


def test_a_table_of_texts(spark):
    rows = [(1, "It's 12 o'clock.\n\n  \u00e9t\u00e9 \u4f60\u597d \U0001f600 \ua7ce"), (2, None), (3, ""), (None, "a b"), (4, "same"),
            (4, "same"), (5, " ".join(words(60000, 3))), (6, "<|endoftext|>x<|endoftext|>")]
    got = rows_of(tc.count(documents(spark, rows), PATH), "doc_id", "n_bytes", "n_tokens")
    assert got == sorted(((k, len((t or "").encode()), library(t)) for k, t in rows), key=repr)
    assert tc.count(empty(spark), PATH).count() == 0


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError):
        tc.Pieces(open(P.path("word_bpe_49k.json"), encoding="utf-8").read())
