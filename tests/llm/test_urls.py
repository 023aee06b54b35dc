import random

from strata.llm import urls as U

PAGES = [(1, "HTTP://Www.Example.COM/de/x?b=2&a=1&utm_source=q#top"), (2, "https://example.com/de/x/?a=1&b=2"), (3, "ftp://a.example.net/en/1"),
         (4, "x://example.net/EN/1"), (5, None), (6, ""), (7, "no scheme /a?b"), (8, "http://org/fr/"), (9, "http://aorg/fr/"), (10, "http://a.b.org/fr"),
         (11, "http://net"), (12, "http://net/"), (13, "http://evil.test/a.html"), (14, "http://evil.test/a"), (15, "http://good.test/a"),
         (None, "http://evil.test/a/"), (15, "http://good.test/a"), (16, "s://h\n.x/p\nq?z#" + "y" * 50_000)]


def brute(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        end = min([rest.find(c) for c in "/?#" if c in rest] + [len(rest)])
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:end])
        rest = rest[end:]
        path = rest[:min([rest.find(c) for c in "?#" if c in rest] + [len(rest)])]
    best = None
    for h, p, v in U.RULES:
        if (host == h or host.endswith("." + h)) and path.startswith(p) and (best is None or len(h + p) > len(best[0])):
            best = (h + p, v)
    return host, path, best


def test_rules_and_list(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string").selectExpr("*", "'x' AS rule", "1 AS listed")
    listed = spark.createDataFrame([("evil.test/a",), ("evil.test/a",), ("",), (None,)], "key string")
    out = U.filter_urls(pages, listed, U.rule_table(spark)).collect()
    assert len(out) == len(PAGES)
    for r in out:
        host, path, best = brute(r.url)
        assert (r.host, r.path) == (host, path)
        assert r.rule == (best and best[0])
        assert r.verdict == (best[1] if best else "block" if r.canonical_url == "evil.test/a" else "allow")
    by = {r.page_id: r.canonical_url for r in out}
    assert by[1] == by[2] == "example.com/de/x?a=1&b=2" and by[13] == by[14]


def test_filter_has_no_false_negatives_and_few_false_positives(spark):
    rng = random.Random(4)
    keys = [f"host{rng.randrange(10**9)}.test/{k}" for k in range(3000)]
    listed = spark.createDataFrame([(k,) for k in keys[:1500]], "key string")
    urls = spark.createDataFrame([(k,) for k in keys], "u string")
    got = {r.u: r.listed for r in U.in_list(urls, "u", listed, "key").collect()}
    assert got == {k: i < 1500 for i, k in enumerate(keys)}
    blocks = U.bloom_blocks(listed, "key", 94)
    assert blocks.count() <= 94


def test_without_list_rules_or_pages(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string")
    none = spark.createDataFrame([], "key string")
    rules = spark.createDataFrame([], "host string, path string, verdict string")
    assert {r.verdict for r in U.filter_urls(pages, none, rules).collect()} == {"allow"}
    assert U.filter_urls(pages.limit(0), none, U.rule_table(spark)).count() == 0


def test_plan_is_native(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string")
    plan = U.filter_urls(pages, U.repeated_urls(pages), U.rule_table(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
