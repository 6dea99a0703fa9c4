import pytest
from pyspark.sql import functions as F

from relayframe.llm import components, urls

RULES = "host string, path string, action string"


def judged(spark, pages, rules, edges=()):
    rows = spark.createDataFrame(pages, "page_id long, url string, html string, node string, rule string")
    links = urls.link_edges(rows).unionByName(spark.createDataFrame(list(edges), "u string, v string"))
    found = urls.judge_urls(rows, spark.createDataFrame(rules, RULES), links)
    return {(r["page_id"], r["url"]): r for r in found.collect()}


def page(i, url, html=None):
    return i, url, html, "other", "other"


@pytest.mark.parametrize(("url", "host", "path"), [
    ("HTTP://A.Example.COM/En/X?q#f", "a.example.com", "/En/X"), ("x://h", "h", ""), ("x://h?q/p", "h", ""),
    ("x://h#f://z/p", "h", ""), ("://", "", ""), ("nothing", "", ""), ("a://b\nc/d\ne", "b\nc", "/d\ne"),
    ("http:///p", "", "/p"), ("http://ÄB/", "Äb", "/")])
def test_host_and_path(spark, url, host, path):
    row = spark.createDataFrame([(url,)], "url string").select(
        urls.url_host(F.col("url")).alias("h"), urls.url_path(F.col("url")).alias("p")).first()
    assert (row["h"], row["p"]) == (host, path)


def test_longest_rule_of_host_and_subdomains(spark):
    found = judged(spark, [
        page(1, "http://a.com/x"), page(2, "http://www.example.com/en/1"), page(3, "http://example.com/en/1"),
        page(4, "http://m.example.com/en/1"), page(5, "http://example.com/fr/1"), page(6, "http://notexample.com/en/"),
        page(7, "http://x.net/es/1"), page(8, "http://net/fr/"), page(9, "http://x.net/esx"), page(10, "http://com"),
        page(11, None), page(12, "no scheme"), page(None, "http://a.com/x"), page(1, "http://a.com/x")], urls.RULES)
    rules = {k[0]: (r["rule"], r["verdict"]) for k, r in found.items()}
    assert rules == {
        1: ("com/", "allow"), 2: ("www.example.com/en/", "allow"), 3: ("example.com/en/", "block"),
        4: ("example.com/en/", "block"), 5: ("com/", "allow"), 6: ("com/", "allow"), 7: ("net/es/", "block"),
        8: ("net/fr/", "block"), 9: (None, "allow"), 10: (None, "allow"), 11: (None, "allow"), 12: (None, "allow"),
        None: ("com/", "allow")}


def test_repeated_pages_keep_their_rows(spark):
    pages = spark.createDataFrame([page(1, "http://a.com/x")] * 3 + [page(2, None)] * 2,
                                  "page_id long, url string, html string, node string, rule string")
    rules = spark.createDataFrame(urls.RULES, RULES)
    assert urls.judge_urls(pages, rules, urls.link_edges(pages)).count() == 5


def test_blocks_reach_aliases_and_an_allow_goes_first(spark):
    canonical = '<link href="{}" rel="canonical">'
    rules = [("bad.org", "/", "block"), ("good.org", "/", "allow")]
    found = judged(spark, [
        page(1, "http://a.org/1#x", canonical.format("http://b.org/1")),
        page(2, "http://b.org/1", '<META http-equiv=Refresh content="0; url=http://BAD.org/1">'),
        page(3, "http://c.org/1", canonical.format("http://d.org/")),
        page(4, "http://e.org/1"),
        page(5, "http://d.org/", canonical.format("//bad.org/2")),
        page(6, "http://f.org/p/q", canonical.format("../r")),
        page(7, "http://good.org/9", canonical.format("http://c.org/1")),
        page(8, "http://bad.org/7"),
    ], rules, [("http://e.org/1", "http://bad.org/7")])
    verdicts = {k[0]: r["verdict"] for k, r in found.items()}
    # 3, 5 and 7 are one component with bad.org/2: the allowed member decides for the others.
    assert verdicts == {1: "block", 2: "block", 3: "allow", 4: "block", 5: "allow", 6: "allow", 7: "allow", 8: "block"}
    assert found[1, "http://a.org/1#x"]["component"] == "http://a.org/1"


def test_query_equals_sql_on_linked_pages(spark, tmp_path):
    import duckdb

    hosts = ["a.com", "www.example.com", "example.com", "x.net", "y.org", "Z.ORG"]
    paths = ["/en/1", "/fr/2", "/es/3?q=1#f", "", "?x", "/a/b"]
    rows = []
    for i in range(60):
        target = f"http://{hosts[i * 7 % 6]}{paths[i * 5 % 6]}" if i % 4 else ["/en/1", "//y.org/a/b", "q"][i % 3]
        link = [f"<link rel='canonical' href='{target}'>", f'<meta http-equiv="refresh" content="1;URL={target}">', "", None][i % 4]
        rows.append((i, f"HTTP://{hosts[i % 6]}{paths[i * i % 6]}", link))
    rows += [(60, None, rows[0][2]), (61, "none", rows[0][2]), (None, rows[1][1], None),
             (62, "http://q.org/1", "<link rel=canonical href=http://x.net/es/9>")]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(str(tmp_path / "pages.parquet"))
    got = sorted((tuple(r) for r in urls.op1_url_filter(spark, str(tmp_path)).collect()), key=repr)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    assert got == sorted(con.execute(urls.SQL_OP1).fetchall(), key=repr)
    assert {r[-1] for r in got if r[3] is None} == {"allow", "block"}


def test_empty_tables(spark):
    assert judged(spark, [], urls.RULES) == {}
    assert judged(spark, [page(1, "http://a.com/")], [])[1, "http://a.com/"]["verdict"] == "allow"


def test_components_equal_union_find(spark):
    import random

    rng = random.Random(3)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(330)] + [(i, i + 1) for i in range(1000, 1200)]
    edges += [(5, 5), (7, None), (5, 6), (6, 5)]
    up = {}

    def top(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        if b is not None and a != b:
            a, b = top(a), top(b)
            up[max(a, b)] = min(a, b)
    found = components.components(spark.createDataFrame(edges, "u long, v long"))
    rows = [(r["node"], r["component"]) for r in found.collect()]
    assert len(rows) == len(set(rows)) and dict(rows) == {x: top(x) for x in list(up)}


@pytest.mark.parametrize(("url", "href", "node"), [
    ("https://a.com/x/p", "https://a.com/p?x=1&amp;y=2", "https://a.com/p?x=1&y=2"), ("https://a.com/x/p", "/q?a&#38;b&#x26;c&#X26;d", "https://a.com/q?a&b&c&d"),
    ("https://a.com/x/p?z=1", "?page=2", "https://a.com/x/p?page=2"), ("https://A.com", "?page=2", "https://a.com/?page=2"),
    ("https://a.com/x/p", "?to=https://b.com/", "https://a.com/x/p?to=https://b.com/"), ("https://a.com/x/p?q", "#top", "https://a.com/x/p?q"),
    ("https://a.com/x/y/p", "./q", "https://a.com/x/y/q"), ("https://a.com/x/y/p", "../q?a=../b", "https://a.com/x/q?a=../b"),
    ("https://a.com/x/p", "../../../q", "https://a.com/q"), ("https://a.com/x/y/p", "..", "https://a.com/x/"), ("https://a.com/x/p", ".", "https://a.com/x/"),
    ("https://a.com/x/p", "/a/./b/../c", "https://a.com/a/c"), ("https://a.com/x/p", "q...r/.s", "https://a.com/x/q...r/.s")])
def test_addresses_are_read_as_browsers_read_them(spark, url, href, node):
    pages = spark.createDataFrame([(url, f'<link rel="canonical" href="{href}">')], "url string, html string")
    assert [r["v"] for r in urls.link_edges(pages).collect()] == [node]


def test_decisions_reach_pages_behind_such_addresses(spark):
    pages = spark.createDataFrame([(1, "https://b.org/p?x=1&y=2", ""), (2, "https://bad.com/z", '<link rel=canonical href="https://b.org/p?x=1&amp;y=2">')],
                                  "page_id long, url string, html string")
    rules = spark.createDataFrame([("bad.com", "/", "block")], "host string, path string, action string")
    found = urls.judge_urls(pages, rules, urls.link_edges(pages)).collect()
    assert {r["page_id"]: r["verdict"] for r in found} == {1: "block", 2: "block"}
