import importlib.util
import re

import numpy as np
import public_tokenizers as P
import pytest

import corpus_pipeline as C
from refinery.llm import decontam, queries, toxicity
from tests.conftest import SF001
from tests.llm.helpers import rows_of, sha, words
from tests.llm.test_bpe import TOKTOK
from tests.llm.test_secret_scan import spans
from tests.llm.test_simhash import components, plain


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """(input, output) rows of every stage over sf0.001, each written and read again."""
    docs, out, root = spark.read.parquet(f"{SF001}/documents.parquet"), {}, tmp_path_factory.mktemp("stages")
    for name, f in C.STAGES:
        f(spark, docs, SF001).write.parquet(f"{root}/{name}")
        after = spark.read.parquet(f"{root}/{name}")
        out[name] = (docs.collect(), after.collect(), after.columns)
        docs = after
    return out


def test_toxicity_stage(spark, stages):
    before, after, columns = stages["toxicity"]
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    net = toxicity.train(*toxicity.training_sample(docs.select("doc_id", "text"), spark.read.parquet(f"{SF001}/labels.parquet")))
    p = toxicity.scores(net, [r["text"] for r in before], {}, toxicity.fresh_rows())
    assert sorted(after) == sorted(r for r, x in zip(before, p) if x < 0.5) and columns == C.COLUMNS
    assert len(after) >= 0.8 * len(before)


def test_near_duplicate_stage(stages):
    before, after, columns = stages["simhash_near_dedup"]
    roots = components([(r["doc_id"], plain(r["text"])) for r in before])
    assert sorted(after) == sorted(r for r, root in zip(before, roots) if r["doc_id"] == root) and columns == C.COLUMNS


def test_decontamination_stage(spark, stages):
    before, after, _ = stages["benchmark_decontamination"]
    items = [decontam.normal(r["text"]) for r in spark.read.parquet(f"{SF001}/benchmark.parquet").collect()]
    keep = [r for r in before if not any(i in decontam.normal(r["text"]) for i in items)]
    assert sorted(after) == sorted(keep)


def test_secret_stage(stages):
    before, after, columns = stages["secret_scans"]
    want = []
    for r in before:
        at, text = 0, ""
        for s, _, e in spans(r["text"]):
            if s >= at:
                text += r["text"][at:s] + "[SECRET]"
            at = max(at, e)
        text += r["text"][at:]
        want.append((r["doc_id"], text, r["lang"], r["source"], len(text) if at else r["n_chars"]))
    assert sorted(map(tuple, after)) == sorted(want) and columns == C.COLUMNS


def test_token_stage(stages):
    before, after, _ = stages["byte_bpe"]
    want = []
    for r in before:
        ids = np.array(TOKTOK.encode_ordinary(r["text"]), "<u4")
        want.append((r["doc_id"], len(ids), sha(ids.tobytes()), sha(r["text"])))
    assert sorted(map(tuple, after)) == sorted(want)


def test_run_gives_what_the_stages_give(spark, stages):
    assert sorted(C.run(spark, SF001).collect()) == sorted(stages["byte_bpe"][1])


def test_odd_documents_pass_the_stages(spark):
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (None, "some words", "en", "s", 10), (4, "same words here", "en", "s", 15), (4, "same words here", "en", "s", 15),
            (5, "token = abcdefgh", "en", "s", 16), (6, " ".join(words(20000, 3)), "en", "s", 1)]
    for chosen in (rows, []):
        docs = spark.createDataFrame([(*r, "x") for r in chosen], "doc_id long, text string, lang string, source string, n_chars long, fp string")
        for _, f in C.STAGES[:-1]:
            docs = f(spark, docs, SF001)
            assert docs.columns == C.COLUMNS
        assert rows_of(docs, "doc_id") == sorted([(k,) for k in ((1, 4, 5, 6, None) if chosen else ())], key=repr)
        if chosen:
            assert ("[SECRET]", 8) in {(r["text"], r["n_chars"]) for r in docs.collect()}
        assert C.STAGES[-1][1](spark, docs, SF001).count() == (5 if chosen else 0)


def test_every_operator_is_registered():
    assert importlib.util.find_spec("refinery.llm") and {int(re.match(r"op(\d+)_", q)[1]) for q in queries.QUERIES} == set(range(1, 14))
    assert P.path("byte_bpe_50k.tiktoken")
