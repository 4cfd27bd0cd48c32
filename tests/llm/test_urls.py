from urllib.parse import urlsplit

from shelfwise.llm import urls
from shelfwise.llm.common import table
from shelfwise.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]
PAGE = "page_id long, url string, html string"


def plain(url):
    if not url or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:].split("?")[0].split("#")[0]
    fit = [(len(h + p), h + p, v) for v, h, p in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *(max(fit)[1:] if fit else (None, None)))


def test_whole_table(spark):
    rows = QUERIES["op7_url_filter"](spark, SF).collect()
    want = {r.page_id: plain(r.url) for r in table(spark, SF, "pages").collect()}
    assert len(rows) == len(want)
    for r in rows:
        host, path, rule, verdict = want[r.page_id]
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == (verdict or ("block" if r.score >= 0.5 else "allow"))
    ruled = [(r.score >= 0.5) == (want[r.page_id][3] == "block") for r in rows if r.rule]
    assert sum(ruled) / len(ruled) > 0.8
    assert urlsplit("http://a.net/x").hostname == plain("http://a.net/x")[0]


def test_odd_urls(spark):
    urls_ = [None, "", "no scheme.net/x", "http://A.Example.NET/en/x?y=1#z", "http://example.net?x=/en/", "http://net/", "http://xnet/", "http://a.net",
             "http://a.example.com/de/#?", "x://É.org/fr/a", "://org/fr/", "http://a.org/fr", "http://a//b://c", "http://" + "d" * 5000 + ".net/", "http://a.net/\nb"]
    pages = spark.createDataFrame([(i, u, None) for i, u in enumerate(urls_)] + [(None, "http://a.net/", None)] * 2, PAGE).selectExpr("*", "1 as host", "2 as score", "3 as rule")
    rows = urls.judged(pages, RULES).collect()
    assert len(rows) == len(urls_) + 2
    for r in rows:
        host, path, rule, verdict = plain(urls_[r.page_id] if r.page_id is not None else "http://a.net/")
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert verdict in (None, r.verdict) and r.verdict in ("allow", "block")


def test_no_labels_one_kind_and_empty(spark):
    one = spark.createDataFrame([(1, "http://a.test/", None), (2, "http://b.net/", None)], PAGE)
    assert {r.verdict for r in urls.judged(one, []).collect()} == {"allow"}
    assert {r.verdict for r in urls.judged(one, RULES).collect()} == {"block"}
    assert urls.judged(one.where("false"), RULES).count() == 0
