from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tallyworks.llm.url_filters import filter_urls, host_links, matching_rule, url_host, url_path

RULES = [("allow", "org/"), ("block", "bad.org/x/"), ("block", "com/de/"), ("allow", "com/fr/")]
ROWS = [
    (1, "http://a.org/1", '<a href="http://n1.net/p">x</a> <a class=q href=//N2.net?q>y</a>'),
    (2, "HTTP://n1.net/1", "<A HREF='http://n3.net/'>x</A><a href=\"/inside\">y</a>"),
    (3, "http://n2.net", '<a href="http://c.com/de/1"></a>' * 3),
    (4, "http://c.com/de/9#f", None),
    (5, "http://c.com/en", ""),
    (6, None, '<a href="http://a.org/">x</a>'),
    (7, "no scheme", "<a href=http://a.org>x</a>"),
    (8, "http://w.bad.org/x/1?y", '<a href="http://n1.net/">x</a>'),
    (9, "http://notbad.org/x/", "<img src=http://z.net/>"),
    (10, "http://n4.net/", '<a href="http://w.bad.org/x/">x</a><a href="http://n4.net/self">s</a>'),
    (10, "http://n4.net/", '<a href="http://w.bad.org/x/">x</a><a href="http://n4.net/self">s</a>'),
    (None, "http://BÄD.com://two/de/a", None),
]


def pages(spark, rows=ROWS):
    return spark.createDataFrame([(*r, "s", "d") for r in rows], "page_id long, url string, html string, src string, host string").repartition(3)


def test_parts_of_urls(spark):
    got = {r[0]: (r.h, r.p) for r in pages(spark).select("url", url_host(F.col("url")).alias("h"), url_path(F.col("url")).alias("p")).collect()}
    assert got[None] == got["no scheme"] == ("", "")
    assert got["http://n2.net"] == ("n2.net", "")
    assert got["http://w.bad.org/x/1?y"] == ("w.bad.org", "/x/1")
    assert got["http://BÄD.com://two/de/a"] == ("bÄd.com:", "//two/de/a")
    assert got["HTTP://n1.net/1"] == ("n1.net", "/1")


def test_links_between_hosts(spark):
    got = {(r.src, r.dst): r.n for r in host_links(pages(spark)).collect()}
    assert got == {
        ("a.org", "n1.net"): 1,
        ("a.org", "n2.net"): 1,
        ("n1.net", "n3.net"): 1,
        ("n2.net", "c.com"): 3,
        ("w.bad.org", "n1.net"): 1,
        ("n4.net", "w.bad.org"): 2,
    }


def walk(seeds, links, turns=24, d=0.85):
    out = Counter()
    for (a, _), n in links.items():
        out[a] += n
    mass = {h: (1 - d) * s for h, s in seeds.items()}
    for _ in range(turns):
        new = defaultdict(float, {h: (1 - d) * s for h, s in seeds.items()})
        for (a, b), n in links.items():
            new[b] += d * mass.get(a, 0.0) * n / out[a]
        mass = new
    return mass


def test_verdicts_follow_rules_then_links(spark):
    got = {(r.page_id, r.host): (r.rule, r.verdict) for r in filter_urls(pages(spark), RULES).collect()}
    assert got[1, "a.org"] == ("org/", "allow")
    assert got[8, "w.bad.org"] == ("bad.org/x/", "block")
    assert got[9, "notbad.org"] == ("org/", "allow")
    assert got[6, ""] == got[7, ""] == (None, "allow")
    links = {(r.src, r.dst): r.n for r in host_links(pages(spark)).collect()}
    trust = walk({"a.org": 1, "notbad.org": 1}, links)
    distrust = walk({"c.com": 1, "w.bad.org": 1}, {(b, a): n for (a, b), n in links.items()})
    for (_, host), (rule, verdict) in got.items():
        if rule is None and host:
            t, b = trust.get(host, 0.0), distrust.get(host, 0.0)
            assert verdict == ("block" if t + b > 0 and b / (t + b) > 0.5 else "allow"), host
    assert got[10, "n4.net"] == (None, "block")  # it links to a blocked host
    assert got[2, "n1.net"] == (None, "allow")  # a trusted host links to it
    assert filter_urls(pages(spark), RULES).count() == len(ROWS)


def test_empty_table_and_bad_rules(spark):
    none = pages(spark, ROWS).limit(0)
    assert filter_urls(none, RULES).collect() == []
    for bad in [("deny", "org/")], [("allow", "org")], [("allow", "/x")]:
        with pytest.raises(ValueError, match="not a rule"):
            matching_rule(F.col("h"), F.col("p"), bad)
    with pytest.raises(ValueError, match="more than"):
        matching_rule(F.col("h"), F.col("p"), RULES * 500)
