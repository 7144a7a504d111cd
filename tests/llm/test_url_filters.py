from clickflow.llm import url_filters
from clickflow.llm.url_filters import Rule


def verdicts(spark, urls, edges=(), rules=url_filters.RULES):
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)], "page_id long, url string, component string")
    links = spark.createDataFrame(list(edges), "source string, target string")
    judged = url_filters.url_filter(pages, url_filters.rule_table(spark, rules), links)
    assert judged.columns[:3] == pages.columns
    return {r.page_id: (r["__host"], r["__path"], r["__rule"]["rule"], r["__verdict"]) for r in judged.collect()}


def test_hosts_paths_and_longest_rules(spark):
    found = verdicts(
        spark,
        [
            "HTTP://WWW.Example.COM/en/1?x#y",
            "http://a.example.com/en/2",
            "http://example.com/fr/",
            "http://notexample.com",
            "http://x.net/es/?q=://",
            "http://net/es/a",
            "no scheme",
            None,
            "",
            "http://host.org#frag/?",
            "http://com?x=1",
        ],
    )
    assert found[0] == ("www.example.com", "/en/1", "www.example.com/en/", "allow")
    assert found[1] == ("a.example.com", "/en/2", "example.com/en/", "block")
    assert found[2] == ("example.com", "/fr/", "com/", "allow")
    assert found[3] == ("notexample.com", "", None, "allow")
    assert found[4] == ("x.net", "/es/", "net/es/", "block")
    assert found[5] == ("net", "/es/a", "net/es/", "block")
    assert found[6] == found[7] == found[8] == ("", "", None, "allow")
    assert found[9] == ("host.org", "", None, "allow")
    assert found[10] == ("com", "", None, "allow")


def test_blocks_reach_aliases_and_allow_wins(spark):
    rules = (Rule("bad.org", "/", "block"), Rule("good.org", "/", "allow"))
    edges = [
        ("http://bad.org/a", "http://one.org/a"),
        ("http://two.org/a", "http://one.org/a"),
        ("http://three.org/", "http://two.org/a#x"),
        ("http://bad.org/b", "http://four.org/b"),
        ("http://four.org/b", "http://good.org/b"),
        ("http://five.org/never-fetched-target", "http://sub.bad.org/c"),
        (None, "http://one.org/a"),
    ]
    urls = ["http://one.org/a", "https://www.three.org/?utm_source=f", "http://four.org/b", "http://bad.org/b", "http://good.org/b", "http://five.org/never-fetched-target", "http://six.org/"]
    found = [verdicts(spark, urls, edges, rules)[i][3] for i in range(len(urls))]
    assert found == ["block", "block", "allow", "block", "allow", "block", "allow"]


def test_canonical_forms(spark):
    urls = ["https://www.A.org/p/?utm_source=x&id=1&ref=y#z", "http://a.org/p.html?id=1", "http://m.a.org/p?id=1", "http://a.org/p?id=2", "x"]
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    forms = [r[0] for r in df.select(url_filters.canonical(df.url)).collect()]
    assert forms == ["a.org/p?id=1"] * 3 + ["a.org/p?id=2", None]


def test_edges_of_pages(spark):
    pages = [
        ("http://a.org", '<link href="http://b.org/x" rel="canonical">'),
        ("http://c.org", "<META http-equiv='refresh' content='0; url=http://d.org/'>"),
        ("http://e.org", '<link rel="stylesheet" href="http://f.org">'),
        ("http://g.org", None),
        (None, '<link rel=canonical href=http://h.org>'),
    ]
    df = spark.createDataFrame(pages, "url string, html string")
    assert sorted(map(tuple, url_filters.page_edges(df).collect())) == [("http://a.org", "http://b.org/x"), ("http://c.org", "http://d.org/")]


def test_edges_in_every_writing(spark):
    page = "http://a.org/dir/page?q=1#f"
    writings = {
        '<link rel="canonical" href="/x">': "http://a.org/x",
        "<link rel=canonical href=//b.org/x>": "http://b.org/x",
        '<META content="0;url=http://b.org/" http-equiv="refresh">': "http://b.org/",
        """<meta http-equiv=refresh content="0;url='http://b.org/y'">""": "http://b.org/y",
        """<meta http-equiv='Refresh' content='1.5; URL="http://b.org/z"'/>""": "http://b.org/z",
        '<meta http-equiv="refresh" content="5, http://b.org/w">': "http://b.org/w",
        '<link rel="alternate canonical" href="http://b.org/v">': "http://b.org/v",
        '<link href="http://b.org/?a=1&amp;b=2" rel="canonical">': "http://b.org/?a=1&b=2",
        '<link rel="canonical" href="http&#58;&#x2F;&#47;b.org/u">': "http://b.org/u",
        '<link rel="canonical" href="next">': "http://a.org/dir/next",
        '<link rel="canonical" href=" ../up/./on/.. ">': "http://a.org/up/",
        '<link rel="canonical" href="/../../top">': "http://a.org/top",
        '<link rel="canonical" href="?q=2">': "http://a.org/dir/page?q=2",
        '<link rel="canonical"\n  href\n=\n"http://b.org/t">': "http://b.org/t",
    }
    none = [
        '<link rel="canonical" href="#top">', '<link rel="canonical" href="">', '<link rel="canonical" href="mailto:a@b.c">',
        '<link rel="canonically" href="http://b.org">', '<meta name="refresh" content="0;url=http://b.org">',
        '<meta http-equiv="refresh" content="30">', '<linked rel="canonical" href="http://b.org">', '<link rel="canonical" href="/x"',
    ]
    rows = [(page, html) for html in [*writings, *none]]
    rows += [("no host", '<link rel="canonical" href="/x">'), ("no host", '<link rel="canonical" href="http://b.org/s">')]
    df = spark.createDataFrame(rows, "url string, html string")
    found = [tuple(r) for r in url_filters.page_edges(df).collect()]
    assert sorted(found) == sorted([(page, target) for target in writings.values()] + [("no host", "http://b.org/s")])
    both = spark.createDataFrame([(page, "".join(writings))], df.schema)
    assert sorted(r.target for r in url_filters.page_edges(both).collect()) == sorted(writings.values())


def test_repeated_urls_long_pages_and_clashing_names(spark):
    rules = (Rule("bad.org", "/", "block"),)
    html = "x" * 1_000_000 + '<link rel="canonical" href="//bad.org/a">' + "<link " * 50_000
    rows = [(1, "http://a.org/1", html), (1, "http://a.org/1", html), (None, "http://a.org/1", None), (2, "http://a.org/2", None)]
    df = spark.createDataFrame([(*r, 5, "c", "v") for r in rows], "page_id long, url string, html string, labels int, component string, verdict string")
    judged = url_filters.url_filter(df.drop("html"), url_filters.rule_table(spark, rules), url_filters.page_edges(df))
    found = sorted((str(r.page_id), r["__verdict"], r.verdict) for r in judged.collect())
    assert found == [("1", "block", "v"), ("1", "block", "v"), ("2", "allow", "v"), ("None", "block", "v")]


def test_empty_tables(spark):
    assert verdicts(spark, []) == {}


def test_no_python_runs(spark):
    pages = spark.createDataFrame([(1, "http://a.net/es/", None)], "page_id long, url string, html string")
    judged = url_filters.url_filter(pages, url_filters.rule_table(spark), url_filters.page_edges(pages))
    plan = judged._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
