
from loomline.operators.frontier import delay_gate, discovered, generated_urls, normalized_items, robots_allowed, robots_rules, robots_summary, sitemap_closure, sitemap_entries
from loomline.operators.warehouse import pending_urls
from pyspark.sql import functions as F

ROBOTS = """# comment
User-agent: *
Disallow: /private
Crawl-delay: 3
no colon here
Allow: /private/open
Allow: /same
Disallow: /same
Disallow:
Crawl-delay: soon
User-agent: other
Disallow: /
Sitemap: https://h.example/a.xml
sitemap:https://h.example/b.xml
"""


def test_robots(spark):
    files = spark.createDataFrame([("h.example", ROBOTS), ("slow.example", "User-agent: *\r\nCrawl-delay: 31"), ("none.example", ""), ("null.example", None)], "domain string, text string")
    rules = robots_rules(files)
    assert {(r.allow, r.path) for r in rules.collect()} == {(False, "/private"), (True, "/private/open"), (True, "/same"), (False, "/same")}
    urls = ["/public", "/private/data", "/private/open/x", "/same/y", "", "/x?/private"]
    df = spark.createDataFrame([(f"https://h.example{u}",) for u in urls] + [("https://free.example/private",), (None,)], "url string")
    got = {r.url: r.allowed for r in robots_allowed(df, rules).collect()}
    assert [got[f"https://h.example{u}"] for u in urls] == [True, False, True, True, True, True] and got["https://free.example/private"] and got[None]
    summary = {r.domain: r for r in robots_summary(files).collect()}
    assert summary["h.example"].crawl_delay == 3 and summary["h.example"].sitemaps == ["https://h.example/a.xml", "https://h.example/b.xml"]
    gate = {r.domain: (r.accepted, r.min_delay) for r in delay_gate(robots_summary(files)).collect()}
    assert gate == {"h.example": (True, 3.0), "slow.example": (False, 31.0)}


def test_sitemaps(spark):
    ns = 'xmlns="http://www.sitemaps.org/schemas/sitemap/0.9"'
    files = spark.createDataFrame([
        ("s1", f"<urlset {ns}><url><loc> https://a.example/p </loc><priority>0.7</priority><lastmod>2024-05-01T00:00:00Z</lastmod></url><url><loc>https://a.example/sitemap/q</loc><priority>high</priority></url><url><loc></loc></url></urlset>"),
        ("s2", "<sitemapindex><sitemap><loc>https://a.example/more</loc></sitemap></sitemapindex>"), ("s3", "<urlset><url>"), ("s4", None), ("s5", "no xml"),
    ], "url string, xml string")
    got = {r["loc"]: r for r in sitemap_entries(files).collect()}
    assert {k: (r.source, r.priority, r.nested) for k, r in got.items()} == {"https://a.example/p": ("s1", 0.7, False), "https://a.example/sitemap/q": ("s1", None, True), "https://a.example/more": ("s2", None, True)}
    page = discovered(sitemap_entries(files), F.expr("timestamp'2024-01-01'")).collect()
    assert [(r.url, r.domain, r.crawl_status, float(r.priority)) for r in page] == [("https://a.example/p", "a.example", "pending", 0.7)]


def test_closure_ends_on_cycles(spark):
    links = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("c", "d"), ("x", "y")], "source string, loc string")
    assert {(r.url, r.depth) for r in sitemap_closure(links, spark.createDataFrame([("a",)], "url string")).collect()} == {("a", 0), ("b", 1), ("c", 2), ("d", 3)}


def test_queue_order_and_items(spark):
    urls = spark.createDataFrame([("new", None, None, "2020-01-02", None), ("old", None, "pending", "2020-01-01", None), ("top", 0.9, "pending", "2021-01-01", None), ("done", 1.0, "completed", "2019-01-01", None)], "id string, priority double, crawl_status string, created_at string, last_crawl_at string")
    assert [r.id for r in pending_urls(urls).collect()] == ["top", "old", "new"]
    items = normalized_items(spark.createDataFrame([(("u", "0.5", "2024-01-01T00:00:00Z"),), (("v", None, "never"),)], "item struct<url:string,priority:string,lastmod:string>")).collect()
    assert [(r.url, r.priority, r.lastmod is None) for r in items] == [("u", 0.5, False), ("v", None, True)]
    assert normalized_items(spark.createDataFrame([("u",)], "item string")).first().url == "u"
    assert generated_urls(spark, 10_000).distinct().count() == 10_000




def test_closure_of_deep_sitemaps(spark):
    links = spark.createDataFrame([(f"s{i}", f"s{i + 1}") for i in range(45)] + [("s45", "s0")], "source string, loc string")
    got = {r.url: r.depth for r in sitemap_closure(links, spark.sql("SELECT 's0' AS url")).collect()}
    assert got == {f"s{i}": i for i in range(46)}


def test_a_host_with_many_rules(spark):
    import random

    from loomline.operators.frontier import robots_allowed

    rng = random.Random(6)
    rules = [("h", rng.random() < 0.5, "/" + "".join(rng.choice("ab/") for _ in range(rng.randrange(13)))) for _ in range(10_000)] + [("g", False, "/")]
    urls = [(i, f"https://{rng.choice('hhhhg')}/" + "".join(rng.choice("ab/") for _ in range(rng.randrange(16))) + rng.choice(("", "?q", "#f"))) for i in range(400)] + [(400, "https://k/x"), (401, None), (0, "https://h")]
    best = {}
    for host, allow, path in rules:
        best[host, path] = best.get((host, path), False) or allow

    def plain(url):
        if url is None:
            return True
        host, _, path = url.removeprefix("https://").partition("/")
        path = "/" + path.split("?")[0].split("#")[0]
        return next((best[host, path[:n]] for n in range(len(path), 0, -1) if (host, path[:n]) in best), True)

    out = robots_allowed(spark.createDataFrame(urls, "id int, url string"), spark.createDataFrame(rules, "domain string, allow boolean, path string"))
    assert sorted(((r.id, r.url, r.allowed) for r in out.collect()), key=str) == sorted(((i, u, plain(u)) for i, u in urls), key=str)
