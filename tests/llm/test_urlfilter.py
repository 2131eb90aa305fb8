import re

from refinery.llm import urlfilter
from refinery.llm.queries import URL_RULES
from tests.llm.helpers import rows_of

URLS = [None, "", "no scheme", "http://", "http://A.Example.NET/en/x?y#z", "http://example.net/en", "https://net", "https://net/", "ftp://x.org/fr/",
        "http://myexample.com/de/", "http://b.example.com/de/?q", "http://b.example.com/DE/", "http://www.bad.org/p/", "https://m.bad.org/p?x=1",
        "http://bad.org/P", "x://y://z/w", "http://h\n.net/a", "HTTP://WWW.BAD.ORG/p///#f", "http://\u00c9.ORG/fr/a", "http://bad.org/p"]


def judge(url, listed):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (re.sub("[A-Z]", lambda c: c[0].lower(), m[1]), m[2]) if m else ("", "")
    fits = [(len(h + p), h + p, a) for a, h, p in URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    if fits:
        return host, path, max(fits)[1], max(fits)[2]
    key = re.sub(r"^(www|m)\.", "", host) + re.sub(r"/+\Z", "", path)
    return host, path, None, "block" if key in listed else "allow"


def pages(spark, urls):
    rows = [(i if i % 7 else None, u, "x", "x", True) for i, u in enumerate(urls)]
    return spark.createDataFrame(rows, "page_id long, url string, key string, block string, maybe boolean")


def test_judged_as_by_hand(spark, monkeypatch):
    listed = ["bad.org/p", "bad.org/p", None, *[f"h{i}.org/{i}" for i in range(300)]]
    urls = URLS + URLS + [f"http://h{i}.org/{i}" for i in range(0, 900, 3)]
    want = sorted(((i if i % 7 else None, *judge(u, set(listed))) for i, u in enumerate(urls)), key=repr)
    frame = spark.createDataFrame([(x,) for x in listed], "url string")
    for most in (urlfilter.MOST_BLOCKS, 1):  # a filter that is far too small passes more and stays right
        monkeypatch.setattr(urlfilter, "MOST_BLOCKS", most)
        assert rows_of(urlfilter.judge(pages(spark, urls), frame, URL_RULES), "page_id", "host", "path", "rule", "verdict") == want


def test_filter_has_no_false_negatives_and_few_false_positives(spark):
    listed = spark.range(2000).selectExpr("concat('u', id) AS url")
    rows = spark.range(20000).selectExpr("concat('u', id) AS key")
    seen = urlfilter.possible(rows, listed, 125)
    assert seen.where("maybe").count() < 2000 + 18000 * 0.02
    assert seen.where("maybe and cast(substring(key, 2) as int) < 2000").count() == 2000


def test_empty_tables(spark):
    none = spark.createDataFrame([], "url string")
    assert urlfilter.judge(pages(spark, []), none, URL_RULES).count() == 0
    assert rows_of(urlfilter.judge(pages(spark, ["http://a.b/"]), none, []), "rule", "verdict") == [(None, "allow")]
