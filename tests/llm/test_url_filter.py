import re

import pytest

from riskweave.llm import url_filter as uf
from riskweave.llm.queries import URL_RULES

URLS = [
    "https://Www.EXAMPLE.org/es/1?q", "http://example.org/en/12", "http://example.org/en/2", "https://a.b.com/fr/x#y", "x://com/de/", "x://com/de",
    "http://spam-farm.example.net/en/", "http://my.cheap-pills.com/de/1", "http://spam-farm.org/", "http://notorg/", "ftp://org?/es/", "org/", "",
    None, "http://example.org:80/es/", "://org/a://com/de/", "http://ÄÖ.org/es/", "a://x.com/fr/\nb", "http://example.org/es/" + "x" * 50_000, "http:///es/",
]


def brute(url):
    host, path = "", ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.split(r"[/?#]", rest, maxsplit=1)[0]
        path = re.split(r"[?#]", rest[len(host):], maxsplit=1)[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    rules = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]
    fits = [(len(name), name, verdict) for verdict, name in rules for h, p in [(name.split("/")[0], name[name.index("/"):])]
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    if fits:
        _, name, verdict = max(fits)
        return host, path, name, verdict
    return host, path, None, "block" if re.match(r"(.*\.)?(spam-farm|cheap-pills)\.", host) else "allow"


def test_same_as_brute_force_with_clashing_columns(spark):
    rows = [(n, u, "was", None) for n, u in enumerate(URLS)] * 2 + [(None, None, None, 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, Host string, extra int")
    got = uf.judge(pages, URL_RULES)
    assert got.columns == ["page_id", "url", "extra", "host", "path", "rule", "verdict"]
    want = sorted(((n, *brute(u)) for n, u, _, _ in rows), key=str)
    assert sorted(((r.page_id, r.host, r.path, r.rule, r.verdict) for r in got.collect()), key=str) == want


def test_native_and_without_shuffle(spark):
    plan = uf.judge(spark.createDataFrame([(1, "http://a.org/")], "page_id long, url string"), URL_RULES)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Exchange|Python|Arrow|Pandas", plan)


def test_only_rules_filed_under_a_token_of_the_url_are_tried(spark):
    rules = [uf.path_rule("block", f"site{n}.example/p{n}/") for n in range(300)] + [uf.pattern("block", "(", "never")]  # no expression
    pages = spark.createDataFrame([(n, f"http://www.site{n}.example/p{n}/x") for n in range(0, 600, 7)], "page_id long, url string")
    got = {r.page_id: r.rule for r in uf.judge(pages, rules).collect()}
    assert got == {n: f"site{n}.example/p{n}/" if n < 300 else None for n in range(0, 600, 7)}


def test_more_rules_than_a_table(spark, monkeypatch):
    monkeypatch.setattr(uf, "TABLE_RULES", 2)
    pages = spark.createDataFrame(list(enumerate(URLS)), "page_id long, url string")
    assert {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in uf.judge(pages, URL_RULES).collect()} == {n: brute(u) for n, u in enumerate(URLS)}


def test_empty_table_no_rules_and_rules_without_token(spark):
    empty = spark.createDataFrame([], "page_id long, url string")
    assert uf.judge(empty, URL_RULES).count() == 0
    assert uf.judge(spark.createDataFrame([(1, "x")], "page_id long, url string"), []).first().verdict == "allow"
    with pytest.raises(ValueError):
        uf.judge(empty, [uf.pattern("block", "x")])


def test_rules_with_dots_in_their_path(spark):
    rules = [uf.path_rule("block", "example.com/v1.2/"), uf.path_rule("block", "Example.net/a.b/c.html")]
    urls = ["http://www.example.com/v1.2/x", "http://example.com/v1/2/x", "http://example.net/a.b/c.html?q", "http://example.net/a.b/c"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    assert [r.verdict for r in uf.judge(pages, rules).orderBy("page_id").collect()] == ["block", "allow", "block", "allow"]
    with pytest.raises(ValueError):
        uf.judge(pages, [uf.pattern("block", "v1", "v1.2")])
