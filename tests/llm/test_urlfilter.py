"""Rules, aliases and the component algorithm against brute force."""

import random

from reelrank.llm import urlfilter as uf
from reelrank.llm.common import connected_components

SCHEMA = "page_id long, url string, html string, verdict string, form string"


def link(u):
    return f'<head><LINK rel="canonical" href="{u}"></head>'


def move(u):
    return f'<meta http-equiv="refresh" content="0; url={u}">'


def test_rules_aliases_precedence_and_odd_rows(spark):
    rows = [
        (1, "http://a.example.com/en/1", None),                  # blocked by rule
        (2, "http://www.example.com/en/1", None),                # explicit allow is longer
        (3, "https://x.org/1", link("http://shop.net/es/2")),    # alias of a blocked URL
        (4, "http://www.x.org/1.html?utm_source=q#top", None),   # same page as 3
        (5, "https://y.org/", move("https://x.org/1/")),         # redirects to 3
        (6, "https://z.com/keep", link("https://y.org")),        # explicit allow beats aliases
        (7, "https://x.org/1?page=2", None),                     # another page
        (8, None, link("http://shop.net/es/2")), (9, "no scheme", None), (10, "", ""),
        (11, "HTTP://NET/es/", None), (12, "http://notnet/es/", None), (13, "http://q.com", None),
        (3, "https://x.org/1", link("http://shop.net/es/2")), (None, "http://b.net/fr/?x", None),
    ]
    df = spark.createDataFrame([(*r, "?", "?") for r in rows], SCHEMA)
    got = uf.judge(df).collect()
    assert len(got) == len(rows)
    by = {r["page_id"]: r for r in got}
    want = {1: "block", 2: "allow", 3: "block", 4: "block", 5: "block", 6: "allow", 7: "allow",
            8: "allow", 9: "allow", 10: "allow", 11: "block", 12: "allow", 13: "allow", None: "block"}
    assert {k: r["verdict"] for k, r in by.items()} == want
    assert by[1]["rule"] == "example.com/en/" and by[2]["rule"] == "www.example.com/en/"
    assert (by[11]["host"], by[11]["path"], by[11]["rule"]) == ("net", "/es/", "net/es/")
    assert by[13]["rule"] is None and by[13]["path"] == ""       # no path: com/ doesn't fit
    assert (by[8]["host"], by[8]["path"], by[8]["alias"]) == ("", "", None)
    assert by[3]["alias"] == by[4]["alias"] == by[5]["alias"] == by[6]["alias"]
    more = spark.createDataFrame([("http://notnet/es/", "http://c.net/fr/9"), (None, "http://c.net/fr/1")],
                                 "source string, target string")
    got = {r["page_id"]: r["verdict"] for r in uf.judge(df, redirects=more).collect()}
    assert got == {**want, 12: "block"}
    assert uf.judge(df.limit(0)).count() == 0
    assert {r["verdict"] for r in uf.judge(df, rules=()).collect()} == {"allow"}


def test_components_equal_union_find(spark):
    rnd = random.Random(5)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(220)]
    edges += [(1000 + i, 1001 + i) for i in range(60)] + [(2000, 2001 + i) for i in range(50)]
    edges += [(7, 7), (None, 3), (4, None)]
    up = {}

    def find(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x
    for a, b in edges:
        if a is not None and b is not None and a != b:
            a, b = sorted((find(a), find(b)))
            up[b] = a
    df = spark.createDataFrame(edges, "u long, v long")
    got = {r["node"]: r["component"] for r in connected_components(df).collect()}
    assert got == {x: find(x) for x in up}
    assert connected_components(df.limit(0)).count() == 0


def test_relative_targets_are_resolved(spark):
    from pyspark.sql import functions as F
    base = "https://X.net/a/b/c.html?q=1#f"
    want = {"/es/2": "https://X.net/es/2", "page.html": "https://X.net/a/b/page.html", "//shop.net/es/2": "https://shop.net/es/2",
            "../d?x=http://y.org/": "https://X.net/a/d?x=http://y.org/", "./": "https://X.net/a/b/", "../../../up": "https://X.net/up",
            "?p=2": "https://X.net/a/b/c.html?p=2", "http://o.org/1": "http://o.org/1", "#top": None, "": None, "mailto:a@b.c": None}
    df = spark.createDataFrame([(base, t) for t in want], "url string, t string")
    assert {r["t"]: r["r"] for r in df.select("t", uf.resolved(F.col("t"), F.col("url")).alias("r")).collect()} == want
    rows = [(1, "https://x.net/a", link("/es/2")), (2, "https://y.org/p/q", move("//shop.net/fr/2")),
            (3, "http://shop.net/es/deep/1", None), (4, "https://x.net/s/t", link("../es/2")),
            (5, "https://x.net/s/u", link("page.html")), (6, "no host", link("/es/2")), (7, "https://w.org", link("es/2"))]
    pages = spark.createDataFrame([(*r, "?", "?") for r in rows], SCHEMA)
    assert {r["page_id"]: r["verdict"] for r in uf.judge(pages).collect()} == {
        1: "block", 2: "block", 3: "block", 4: "block", 5: "allow", 6: "allow", 7: "allow"}
