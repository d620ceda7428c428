import random

import pytest

from ledgerline.llm.components import components
from ledgerline.llm.url_filter import RULES, Rule, judge


def canon(href):
    return f'<html><head><LINK href="{href}" rel="Canonical"></head></html>'


def refresh(url):
    return f"<meta http-equiv=refresh content='0; URL={url}'>"


PAGES = [
    (1, "http://a.example.org/es/x", None, "example.org/es/", "block"),
    (2, "http://b.net/1", canon("http://a.example.org/es/x"), None, "block"),
    (3, "HTTP://B.net/2#frag", refresh("/1"), None, "block"),                       # relative, through page 2
    (4, "http://c.net/x", canon("//b.net/y"), None, "allow"),
    (5, "http://org/es/", refresh("http://b.net/1"), "org/", "allow"),               # explicit allow: the component's aliases stay
    (6, "http://d.com/de/z?q=1", None, "com/de/", "block"),
    (7, "http://e.net/p/q.html", canon("r.html"), None, "block"),                    # relative to the folder
    (8, "http://e.net/p/r.html", refresh("http://d.com/de/z?q=1"), None, "block"),
    (9, None, canon("http://d.com/de/z?q=1"), None, "allow"),
    (10, "no scheme/de/", canon("http://d.com/de/z?q=1"), None, "allow"),
    (11, "", None, None, "allow"),
    (12, "http://example.org/en/19?x#y", "", "example.org/en/1", "block"),
    (13, "http://notexample.org/es/", None, "org/", "allow"),
    (14, "http://x.org", None, None, "allow"),                                        # the path does not start with /
    (15, "http://f.net/self", canon("http://f.net/self"), None, "allow"),
    (None, "http://X.Example.ORG/es/", None, "example.org/es/", "block"),
]


@pytest.mark.parametrize("times", [1, 3])
def test_rules_and_aliases(spark, times):
    pages = [p for p in PAGES if p[0] != 5] * times
    df = spark.createDataFrame([(i, u, h, "x", "y") for i, u, h, *_ in pages], "page_id long, url string, html string, node string, host string")
    got = sorted((str(r.id), r.rule, r.verdict) for r in judge(df).collect())
    assert got == sorted((str(i), r, v) for i, _, _, r, v in pages)


def test_explicit_allow_takes_precedence(spark):
    df = spark.createDataFrame([p[:3] for p in PAGES], "page_id long, url string, html string")
    got = {r.id: r.verdict for r in judge(df).collect()}
    assert got[5] == "allow" and got[2] == "allow" and got[3] == "allow" and got[1] == "block" and got[7] == "block"


def test_host_path_and_extra_redirects(spark):
    df = spark.createDataFrame([(1, "ftp://u@H.x:80?a://b/c", None), (2, "http://s.net/a", None)], "page_id long, url string, html string")
    more = spark.createDataFrame([("http://s.net/a", "http://t.com/de/"), (None, "http://s.net/a")], "a string, b string")
    rows = {r.id: r for r in judge(df, redirects=more).collect()}
    assert (rows[1].host, rows[1].path) == ("u@h.x:80", "") and rows[2].verdict == "block"
    assert judge(df.limit(0)).count() == 0
    assert {r.verdict for r in judge(df, rules=(Rule("block", "net", "/"),)).collect()} == {"allow", "block"}
    assert len(RULES) == 5


@pytest.mark.parametrize("seed", [1, 2])
def test_components_equal_union_find(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)]
    edges += [(1000, 1001 + i) for i in range(200)] + [(2000 + i, 2001 + i) for i in range(150)] + [(5, 5), (None, 3), (7, None)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x
    for a, b in edges:
        if a is not None and b is not None and a != b:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert sorted((r.node, r.root) for r in got) == sorted((x, find(x)) for x in list(root))
