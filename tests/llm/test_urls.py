"""URL filters against a plain search over the links, and the reading of declared links."""

from collections import defaultdict
from urllib.parse import urljoin

import pytest
from pyspark.sql import functions as F

from tabscope.llm import urls

SCHEMA = "page_id long, url string, html string, host string, rule string, verdict string, form string"
BLOCKED, FREE = "https://a.com/de/x", "http://other.net/"


def link(to):
    return f'<head><LINK data-x="1" rel="canonical"  href="{to}"></head>'


def refresh(to):
    return f"<meta http-equiv=refresh content='0; URL={to}'>"


PAGES = [
    (1, BLOCKED, "<p>blocked by a rule</p>"),
    (2, "http://mirror.net/1", link(BLOCKED)),
    (3, "http://mirror.net/2?utm_source=feed", refresh("/1")),
    (4, "https://www.mirror.net/2/#top", "no links, an alias by its form"),
    (5, "http://kept.org/1", link("http://mirror.net/1")),
    (6, "http://behind.net/", link("http://kept.org/1")),
    (7, FREE, link("//other.net/y?a=1&amp;b=2")),
    (8, "http://other.net/y?a=1&b=2", None),
    (9, None, link(BLOCKED)),
    (10, "no scheme", link(BLOCKED)),
    (11, "", ""),
    (12, "http://EXAMPLE.org/es/1", ""),
    (13, "http://example.org/en/1/2", ""),
    (14, "http://sub.example.org/en/2", ""),
    (15, "http://notexample.org/es/", ""),
    (16, "http://x.com/fr/1?q=/de/", ""),
    (17, "http://x.com?/de/", ""),
    (18, "http://u.net/?u=http://a.com/de/", ""),
    (19, "http://outside.net/", link("http://never.seen.com/de/1")),
    (20, "http://second.net/", refresh("http://never.seen.com/de/1")),
    (21, "http://self.net/p/q", link("r/../x")),
    (22, "http://open.net/", "<link rel=canonical href=" + "<link " * 1000),
    (23, "http://star.net/0", ""),
    (2, "http://mirror.net/1", link(BLOCKED)),
    (None, "http://mirror.net/1", ""),
    (24, "http://long.net/" + "x/" * 20000, "y" * 300000 + link("http://star.net/0")),
    (25, "ftp://" + "a." * 3000 + "com/de/", ""),
]
PAGES += [(100 + k, f"http://star.net/{k}", link("http://star.net/0")) for k in range(1, 40)]
PAGES += [(200 + k, f"http://chain.net/{k}", link(f"http://chain.net/{k + 1}")) for k in range(20)]
PAGES += [(300, "http://chain.net/20", refresh("http://x.com/de/"))]


def parts(url):
    if not url or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest] + [len(rest)])
    host, tail = rest[:cut].lower(), rest[cut:]
    path = tail.split("#")[0].split("?")[0]
    query = tail.split("#")[0].partition("?")[2]
    fields = "&".join(f for f in query.split("&") if f and not f.startswith("utm_"))
    form = host.removeprefix("www.") + path.rstrip("/") + ("?" + fields if fields else "")
    return host, path, form if host else None


def rule_of(url):
    host, path, _ = parts(url)
    fits = [(len(h + p), h + p, v) for h, p, v in urls.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


def expected(pages, links):
    near = defaultdict(set)
    guilty = []
    for a, b in links:
        a, b = parts(a)[2], parts(b)[2]
        if a and b:
            near[a].add(b)
            near[b].add(a)
    for url in {u for _, u, _ in pages} | {u for pair in links for u in pair}:
        if rule_of(url)[1] == "block" and parts(url)[2]:
            guilty.append(parts(url)[2])
    shut = set(guilty)
    while guilty:
        for x in near[guilty.pop()]:
            if x not in shut:
                shut.add(x)
                guilty.append(x)
    out = []
    for i, url, _ in pages:
        host, path, form = parts(url)
        rule, verdict = rule_of(url)
        out.append((str(i), host, path, str(rule), verdict or ("block" if form in shut else "allow")))
    return sorted(out)


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(i, u, h, "x", "x", "x", None) for i, u, h in PAGES], SCHEMA)


def judged(pages, links, rules):
    return sorted((str(r.page_id), r.host, r.path, str(r.rule), r.verdict) for r in urls.judge_urls(pages, rules, links).collect())


def test_links_are_read_and_resolved(pages):
    found = {(r.from_url, r.to_url) for r in urls.declared_links(pages).collect()}
    by_id = {i: u for i, u, _ in PAGES}
    want = {
        (by_id[2], BLOCKED), (by_id[3], urljoin(by_id[3], "/1")), (by_id[5], by_id[2]), (by_id[6], by_id[5]),
        (FREE, by_id[8]), (by_id[21], "http://self.net/p/r/../x"), (by_id[19], "http://never.seen.com/de/1"),
        (by_id[20], "http://never.seen.com/de/1"), (by_id[24], "http://star.net/0"), (by_id[300], "http://x.com/de/"),
    }
    want |= {(f"http://star.net/{k}", "http://star.net/0") for k in range(1, 40)}
    want |= {(f"http://chain.net/{k}", f"http://chain.net/{k + 1}") for k in range(20)}
    assert found == want


def test_verdicts_match_a_plain_search(spark, pages):
    links = [(r.from_url, r.to_url) for r in urls.declared_links(pages).collect()]
    got = judged(pages, urls.declared_links(pages), urls.rule_table(spark))
    assert got == expected(PAGES, links)
    verdict = {i: v for i, *_, v in got}
    assert [verdict[str(i)] for i in (2, 3, 4, 5, 6, 7, 19, 20, 25, 110, 200)] == [
        "block", "block", "block", "allow", "block", "allow", "block", "block", "block", "allow", "block"
    ]


def test_redirects_of_a_crawl_log(spark, pages):
    log = [("http://star.net/7", "https://a.com/de/x?utm_medium=x"), (None, BLOCKED), ("http://u.net/", None), ("x", "y")]
    links = spark.createDataFrame(log, "from_url string, to_url string").unionAll(urls.declared_links(pages))
    both = [(r.from_url, r.to_url) for r in links.collect()]
    got = judged(pages, links, urls.rule_table(spark))
    assert got == expected(PAGES, both)
    assert dict((i, v) for i, *_, v in got)["139"] == "block"


def test_rules_may_be_many_repeated_or_missing(spark, pages):
    none = spark.createDataFrame([], "from_url string, to_url string")
    assert {v for *_, v in judged(pages, none, urls.rule_table(spark, ()))} == {"allow"}
    rules = [(f"h{k}.net", "/", "block") for k in range(3000)] + [("star.net", "/1", "block"), ("star.net", "/1", "allow")]
    table = spark.createDataFrame([*rules, (None, "/", "block"), ("a.com", "/", "perhaps")], "host string, path string, verdict string")
    got = {i: (rule, v) for i, _, _, rule, v in judged(pages, none, table)}
    assert got["110"] == ("star.net/1", "allow") and got["1"] == ("None", "allow")


def test_empty_table(spark, pages):
    empty = pages.where(F.lit(False))
    assert urls.judge_urls(empty, urls.rule_table(spark), urls.declared_links(empty)).count() == 0


def test_one_address_of_a_third_of_all_rows(spark):
    rows = spark.range(30000).selectExpr("id AS page_id", "if(id % 3 = 0, 'http://hot.net/', concat('http://n.net/', id)) AS url", "if(id = 0, '<link rel=canonical href=http://z.com/de/>', '') AS html")
    judged = urls.judge_urls(rows, urls.rule_table(spark), urls.declared_links(rows))
    assert judged.where("verdict = 'block'").count() == 10000


def test_main_path_is_native(spark, pages):
    plan = urls.judge_urls(pages, urls.rule_table(spark), urls.declared_links(pages))._jdf.queryExecution().toString()
    assert "Python" not in plan and "InArrow" not in plan and "InPandas" not in plan
