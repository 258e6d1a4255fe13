import pytest

from tabulary.llm import url_filter as uf
from tabulary.llm.queries import URL_RULES

SCHEMA = "page_id long, url string, host string, rule string"


def plain(url, rules, default="allow"):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1].split("?")[0].split("#")[0]
        cut = rest.find("/")
        host, path = (rest, "") if cut < 0 else (rest[:cut], rest[cut:])
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fit = [(len(h + p), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fit, default=None)
    return (host, path, best and best[1], best[2] if best else default)


URLS = [
    None, "", "no scheme", "http://", "http://com/", "http://Example.COM/en/x", "https://www.example.com/en/", "https://a.www.example.com/en/1?x=/fr/", "https://example.com/en", "https://example.com",
    "https://x.net/es/", "https://x.net/es", "https://x.net/fr/#/es/", "https://xnet/fr/", "https://example.com:80/en/", "ftp://a.com//en/", "https://a.com?x://b.net/es/", "a://b://c.com/", "https://é.com/", "https://.com/",
]


def test_against_plain_python(spark):
    rows = [(i, u, "h", "r") for i, u in enumerate(URLS)] + [(None, "http://a.com/", None, None), (1, "", None, None)]
    got = uf.judge_urls(spark.createDataFrame(rows, SCHEMA), URL_RULES).collect()
    want = [(r[0], *plain(r[1], URL_RULES)) for r in rows]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


@pytest.mark.parametrize("url", ["http://a.b.com/x/y/z", "http://b.com/x/yy", "http://b.com/x", "http://c.b.com/xyz/", "http://b.com/"])
def test_any_rules(spark, url):
    rules = [("b.com", "/x/y", "block"), ("com", "/x", "allow"), ("a.b.com", "", "allow"), ("b.com", "/x/y/", "allow"), ("c.b.com", "/xy", "block"), ("com", "/", "block")]
    host, path = uf.split_url(url)
    found = uf.look_up(uf.build_trie(rules), host, path)
    assert (host, path, *(found or (None, "allow"))) == plain(url, rules)


def test_many_rules_are_joined(spark, monkeypatch):
    monkeypatch.setattr(uf, "MAX_TRIE_BYTES", 0)
    rules = [*URL_RULES, ("b.com", "/x/y", "block"), ("com", "/x", "allow"), ("a.b.com", "", "allow"), ("b.com", "/x/y/", "allow"), ("c.b.com", "/xy", "block"), ("c.b.com", "/xy", "allow")]
    urls = [*URLS, "http://a.b.com/x/y/z", "http://b.com/x/yy", "http://b.com/x", "http://c.b.com/xyz/", "http://c.b.com/xy", "http://a.b.com"]
    rows = [(i, u, "h", "r") for i, u in enumerate(urls)] + [(1, "", None, None)]
    got = uf.judge_urls(spark.createDataFrame(rows, SCHEMA), rules).collect()
    want = [(r[0], *plain(r[1], [x for x in rules if x != ("c.b.com", "/xy", "allow")])) for r in rows]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_no_rows_and_no_rules(spark):
    assert uf.judge_urls(spark.createDataFrame([], SCHEMA), URL_RULES).count() == 0
    assert uf.judge_urls(spark.createDataFrame([(1, "http://a.com/", "", "")], SCHEMA), [], default="block").collect()[0].verdict == "block"
    with pytest.raises(ValueError):
        uf.build_trie([("", "/", "allow")])
