import re

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from refinery.llm import secret_scan as S
from tests.llm.helpers import documents, empty, rows_of, words

PLAIN = [(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6), (r"AKIA[A-Z0-9]+", 0, 20),
         (r"[0-9a-f]+", 0, 24), (r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1), (r"gh[opsu]_[A-Za-z0-9]+", 0, 40),
         (r"xox[abprs]-[A-Za-z0-9-]+", 0, 15), (r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+", 0, 20)]


def spans(text):
    return sorted((m.start(), k, m.end()) for k, (p, g, n) in enumerate(PLAIN) for m in re.finditer(p, text or "") if len(m[g]) >= n)


def holds(text, query):
    return query is None or any(all(g in text.lower() for g in alt) for alt in query)


TEXTS = [
    "password: token: abcdefgh", "PassWd = 'abc123'x", "secret=token=abcdef", "api_key:\"a.b/c+d=e-f\" apikey  12 Token='12345'", "\U0001f600é password:abcdef",
    "AKIA" + "A1" * 8, "AKIA" + "A1" * 7 + "A", "xAKIAAKIA" + "Z" * 20, "0" * 24 + "g" + "f" * 23, "a" * 24 + "A" + "b" * 30, "password=" + "deadbeef" * 4,
    "-----BEGIN RSA PRIVATE KEY-----", "ghp_" + "a" * 36, "ghp_" + "a" * 35, "xoxb-1234567890-ab", "eyJhbGci.eyJzdWIi12345", "secret" + "\x00=x" + " secret:abcdefg",
    " ".join(words(20000, 3)) + " token=abcdef " + "deadbeef" * 9, None, "", "tok ken oke secret"]


def test_spans_of_a_table(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(1, TEXTS[1]), (None, TEXTS[2])]
    found = S.scan(documents(spark, rows))
    got = sorted(((r["doc_id"], [tuple(x) for x in r["found"]]) for r in found.collect()), key=repr)
    assert got == sorted(((k, spans(t)) for k, t in rows), key=repr)
    assert found.columns[:-1] == [c for c in documents(spark, rows).columns if c != "found"]
    assert S.scan(empty(spark)).count() == 0


def test_redaction(spark):
    rows = [(1, "a password: abcdef b"), (2, "password=" + "deadbeef" * 4 + "!"), (3, "none"), (4, None), (5, "secret: abcdef")]
    found = S.scan(documents(spark, rows))
    got = found.select("doc_id", S.redact(found["text"], found["found"]).alias("t"))
    assert rows_of(got, "doc_id", "t") == [(1, "a [SECRET] b"), (2, "[SECRET]!"), (3, "none"), (4, None), (5, "[SECRET]")]


def test_many_matches_in_one_text(spark):
    many = "\u00e9 ".join(f"token={i:07d} " + "f" * (20 + i % 9) for i in range(20000))
    rows = [(i, " ".join(f"secret:abcdef{'!' * j}" for j in range(i))) for i in range(12)] + [(99, many)]
    found = S.scan(documents(spark, rows)).withColumn("t", S.redact(F.col("text"), F.col("found")))
    for r in found.collect():
        assert [tuple(x) for x in r["found"]] == spans(r["text"])
        out, at = [], 0
        for a, _, b in spans(r["text"]):
            if a >= at:
                out += [r["text"][at:a], "[SECRET]"]
            at = max(at, b)
        assert r["t"] == "".join(out) + r["text"][at:]


def test_rules_of_one_sort_only(spark):
    rows = documents(spark, [(1, "f" * 30), (2, "AKIA" + "B" * 16)])
    for rules in (S.BASE[2:], S.BASE[1:2]):
        got = {r["doc_id"]: len(r["found"]) for r in S.scan(rows, rules=rules).collect()}
        assert got == ({1: 1, 2: 0} if rules == S.BASE[2:] else {1: 0, 2: 1})


def test_queries_demand_what_they_should():
    assert S.trigram_query(r"[0-9a-f]{24,}") is None and S.trigram_query("ab") is None and S.trigram_query("(abc)?x*") is None
    assert S.trigram_query("abcd|Xyz") == [frozenset({"abc", "bcd"}), frozenset({"xyz"})]
    assert S.trigram_query("(abc|de)f+") is None or holds("def", S.trigram_query("(abc|de)f+"))


@given(st.sampled_from([p for p, _, _ in PLAIN] + [r"(foo|ba[rz])+qu{2,3}x?", r"a(bc)?d{3}[xy]z"]), st.data())
@settings(max_examples=80, deadline=None)
def test_every_match_satisfies_its_query(pattern, data):
    text = data.draw(st.from_regex(pattern, fullmatch=True))
    assert holds(text, S.trigram_query(pattern))
