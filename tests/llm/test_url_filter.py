"""URL filter: rules by hand, mined rules against counting token sets."""

from itertools import combinations

from ouzel.llm import url_filter as U
from ouzel.llm.url_filter import RULES

CASES = [
    ("http://a.org/x", "a.org", "/x", "org/", "allow"),
    ("https://EXAMPLE.org/es/1?q=/en/", "example.org", "/es/1", "example.org/es/", "block"),
    ("https://m.example.org/en/12#t", "m.example.org", "/en/12", "example.org/en/1", "block"),
    ("https://myexample.org/en/12", "myexample.org", "/en/12", "org/", "allow"),
    ("https://example.org", "example.org", "", None, "allow"),
    ("https://example.org?x=/", "example.org", "", None, "allow"),
    ("ftp://www.shop.com/fr/", "www.shop.com", "/fr/", "com/fr/", "allow"),
    ("ftp://www.shop.com/de/x://y.org/", "www.shop.com", "/de/x://y.org/", "com/de/", "block"),
    ("com/de/", "", "", None, "allow"), ("", "", "", None, "allow"), (None, "", "", None, "allow"),
    ("://", "", "", None, "allow"), ("http:///de/", "", "/de/", None, "allow"), ("x://com/de/\n", "com", "/de/\n", "com/de/", "block"),
]


def pages(spark, urls):
    return spark.createDataFrame([(i, u, "h", "k") for i, u in enumerate(urls)], "page_id long, url string, host string, key string")


def none(spark):
    return spark.createDataFrame([], "url string, bad boolean")


def test_the_callers_rules(spark):
    rows = U.filter_urls(pages(spark, [c[0] for c in CASES] * 2), none(spark), RULES).orderBy("page_id").collect()
    assert len(rows) == 2 * len(CASES)
    for r, c in zip(rows, CASES * 2):
        f = r.url_filter
        assert (r.url, f.host, f.path, f.rule, f.verdict, f.mined) == (*c, False)
        assert (r.host, r.key) == ("h", "k")
    assert U.filter_urls(pages(spark, ["a"]).limit(0), none(spark), RULES).count() == 0


def test_mined_rules_against_counting(spark):
    urls = ([("http://spam.net/win/a", True)] * 30 + [("http://spam.net/win/b", False)] * 6 + [("http://ok.net/win/a", False)] * 40
            + [("http://spam.net/news", False)] * 40 + [("http://bad.net/x", True)] * 12 + [(None, None), ("http://q.net/", None)])
    labelled = spark.createDataFrame(urls, "url string, bad boolean")
    got = U.filter_urls(pages(spark, [u for u, _ in urls]), labelled, [], min_support=.05, min_confidence=.7)
    tokens = lambda u: frozenset({f"h:{x}" for x in u.split("/")[2].split(".")} | {f"p:{x}" for x in u.split("/")[3:] if x})
    known = [(tokens(u), b) for u, b in urls if b is not None]
    sets = {frozenset(c) for t, _ in known for n in range(1, len(t) + 1) for c in combinations(t, n)}
    rules = set()
    for s in sets:
        n, bad = sum(s <= t for t, _ in known), sum(s <= t and b for t, b in known)
        if bad >= .05 * len(known) and bad / n >= .7:
            rules.add(s)
    assert rules
    for r in got.collect():
        mined = r.url is not None and any(s <= tokens(r.url) for s in rules)
        assert r.url_filter.mined == mined and r.url_filter.verdict == ("block" if mined else "allow")


def test_rules_need_a_count_and_to_beat_the_base_rate(spark):
    """Equal shares of bad rows at two sizes: chance never makes a rule, a real one needs ten bad rows."""
    def mined(urls, **limits):
        labelled = spark.createDataFrame(urls, "url string, bad boolean")
        rows = U.filter_urls(pages(spark, sorted({u for u, _ in urls})), labelled, [], **limits).collect()
        return {r.url for r in rows if r.url_filter.mined}

    for n in (4, 20):
        noise = [(f"http://a{i}.net/w{i}", i % 7 == 0) for i in range(50 * n)]             # a token each, a seventh bad
        spam = [(f"http://spam.org/s{i}", True) for i in range(n)]
        assert mined(noise + spam) == ({u for u, _ in spam} if n >= 10 else set())
    # three quarters are bad everywhere: 0.6 alone would block every page
    common = [(f"http://h{i % 3}.net/x{i // 4 % 2}", i % 4 > 0) for i in range(240)]
    assert mined(common) == set()


def test_no_python_on_the_way(spark):
    plan = U.filter_urls(pages(spark, ["http://a.b/c"]), none(spark), RULES)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
