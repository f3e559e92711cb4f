import compare as cmp
from pricecast.llm import queries, url_filter


def test_matches_sql(spark):
    con = cmp.connect("/root/testdata/sf0.001")
    ok, text, _ = cmp.compare(spark, con, "/root/testdata/sf0.001", queries.QUERIES["op5_url_filter"], queries.ORACLE["op5_url_filter"])
    assert ok, text


CASES = [
    (None, "", "", None, "allow"),
    ("no scheme.net/x", "", "", None, "allow"),
    ("", "", "", None, "allow"),
    ("HTTP://NET/x", "net", "/x", "net/", "block"),
    ("http://a.NET", "a.net", "", None, "allow"),
    ("http://example.net/en/1?q", "example.net", "/en/1", "example.net/en/", "allow"),
    ("http://Sub.example.net/EN/1", "sub.example.net", "/EN/1", "net/", "block"),
    ("http://badexample.net/en/1", "badexample.net", "/en/1", "net/", "block"),
    ("http://example.com/de/#x", "example.com", "/de/", "example.com/de/", "block"),
    ("http://example.com/de", "example.com", "/de", None, "allow"),
    ("http://x.org/fr/://y.net/", "x.org", "/fr/://y.net/", "org/fr/", "allow"),
    ("http://casino-win.org/fr/a", "casino-win.org", "/fr/a", "org/fr/", "allow"),
    ("http://casino-win.org/en/a\nb", "casino-win.org", "/en/a\nb", None, "block"),
    ("http://casinos.org/en/a", "casinos.org", "/en/a", None, "allow"),
    ("http://h?x/net/", "h", "", None, "allow"),
]


def test_cases(spark):
    pages = spark.createDataFrame([(i, u, "h") for i, (u, *_) in enumerate(CASES)] + [(0, None, "again")], "page_id long, url string, host string")
    got = url_filter.judge(pages, queries.RULES).orderBy("page_id").collect()
    assert [(r.url, r.host, r.path, r.rule, r.verdict) for r in got] == [CASES[0], *CASES]
    assert url_filter.judge(pages.filter("1 = 0"), queries.RULES).count() == 0


def test_rule_without_whole_token_always_runs(spark):
    pages = spark.createDataFrame([(1, "http://x.y/abc"), (2, "http://z.q/abd")], "page_id long, url string")
    rules = [url_filter.Rule("ab", "block", r"(?s).*/abc$", ())]
    assert [r.verdict for r in url_filter.judge(pages, rules).orderBy("page_id").collect()] == ["block", "allow"]
