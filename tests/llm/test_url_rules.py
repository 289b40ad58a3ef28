"""Url rules against plain Python and against the SQL."""

import random
import re

import duckdb
import pyarrow as pa
import pytest

from tourney.llm.url_rules import ORACLE_SQL, RULES, judge_urls, rules_table

PAGES = "page_id bigint, url string, html string, host string"


def place(url):
    if url is None or "://" not in url:
        return "", "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    query = re.match(r"[^#]*", rest[len(host) + len(path) :])[0]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    return host, path, query


def location(url):
    host, path, query = place(url)
    return host and host + path + query


def fitting(url, rules):
    host, path, _ = place(url)
    fits = [
        (len(h + p), verdict == "allow", h + p, verdict)
        for verdict, h, p in rules
        if host and (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    return max(fits)[2:] if fits else (None, None)


def plain(pages, links, rules=RULES):
    """Verdicts with (from, to) links by walking them."""
    near = {}
    for a, b in links:
        a, b = location(a), location(b)
        if a and b:
            near.setdefault(a, set()).add(b)
            near.setdefault(b, set()).add(a)
    out = []
    for page_id, url, *_ in pages:
        rule, verdict = fitting(url, rules)
        if verdict is None:
            seen, todo = set(), [location(url)]
            while todo:
                here = todo.pop()
                if here and here not in seen:
                    seen.add(here)
                    todo += near.get(here, ())
            found = {fitting(f"x://{there}", rules)[1] for there in seen}
            verdict = "allow" if "allow" in found else "block" if "block" in found else "allow"
        out.append((page_id, *place(url)[:2], rule, verdict))
    return sorted(out, key=str)


def judged(spark, pages, rules=RULES, links=None):
    table = spark.createDataFrame([(*p, "x") for p in pages], PAGES)
    found = None if links is None else spark.createDataFrame(links, "from_url string, to_url string")
    rows = judge_urls(table, rules_table(spark, rules), found).collect()
    return sorted(map(tuple, rows), key=str)


def by_sql(pages):
    names = ("page_id", "url", "html")
    table = pa.table(
        {n: pa.array(c, pa.int64() if n == "page_id" else pa.string())
         for n, c in zip(names, zip(*pages, strict=True), strict=True)}
    )
    with duckdb.connect() as db:
        db.register("pages", table)
        return sorted(db.sql(ORACLE_SQL).fetchall(), key=str)


def canonical(url):
    return f"<html><head><link rel='canonical' href=\"{url}\"></head></html>"


URLS = [
    None, "", "no scheme", "://", "http://", "http://net", "http://NET/x", "http://a.b.net/en/",
    "https://example.net/en/1", "https://www.example.net/en", "https://badexample.net/en/1",
    "http://example.com/de/9?x=/#y", "http://m.example.com/fr/", "http://a.org/fr/1",
    "http://org/fr/?q", "http://a.org/de#fr", "http://net:80/x", "http://net./x", "//net/x",
    "http://u@net/x", "ftp://a.net?x=1", "http://x.org/a?u=http://y.net/", "http://ÀB.net/é",
    "http://a\n.net/b\nc", "http://.net/", "http://a..net/",
]


def test_rules_on_odd_urls(spark):
    pages = [(i, url, None if i % 2 else "") for i, url in enumerate(URLS)]
    pages += pages[:5] + [(None, "http://a.net/x", "<p>")]
    want = plain(pages, [])
    assert judged(spark, pages) == want
    assert by_sql(pages) == want


LINKS = [
    (canonical("http://a.net/blocked"), "block"),
    ('<LINK HREF=https://a.net/x?y&amp;z REL="alternate  Canonical"/>', "block"),
    ('<meta content="0; URL=\'http://a.net/x\'" http-equiv=Refresh>', "block"),
    ("<meta http-equiv='refresh' content='5;url=//a.net/x'>", "block"),
    (canonical("//example.net/en/x"), "allow"),
    ("<!-- " + canonical("http://a.net/blocked") + " -->", "allow"),
    ("<script>" + canonical("http://a.net/blocked") + "</script>", "allow"),
    ("<script>" + canonical("http://a.net/blocked"), "allow"),
    ('<link data-href="http://a.net/x" rel=canonical>', "allow"),
    ('<link rel=alternate href="http://a.net/x"> canonical', "allow"),
    ('<a rel="canonical" href="http://a.net/x">', "allow"),
    ("<link rel=canonical href='#top'><link rel=canonical href=mailto:x@a.net>", "allow"),
    ("<link <link rel=canonical>" * 50 + " " * 3000 + "<meta " + " " * 3000, "allow"),
    ("<!--" * 2000 + "canonical", "allow"),
    (canonical("/blocked"), "block"),
    (canonical("blocked"), "allow"),
    (canonical("?blocked"), "block"),
]


def test_declared_links(spark):
    pages = [(i, f"http://site{i}.com/p/q", html) for i, (html, _) in enumerate(LINKS)]
    wanted = [(i, verdict) for i, (_, verdict) in enumerate(LINKS)]
    pages += [
        (101, "http://site14.com/blocked", canonical("http://b.net/1")),
        (102, "http://site15.com/p/other", canonical("http://b.net/2")),
        (103, "http://site16.com/p/q?blocked", canonical("http://b.net/3")),
    ]
    got = judged(spark, pages)
    assert [(row[0], row[4]) for row in sorted(got) if row[0] < 100] == wanted
    assert by_sql(pages) == got


@pytest.mark.parametrize("seed", [1, 2])
def test_random_links(spark, seed):
    draw = random.Random(seed)
    hosts = ["a.net", "example.net", "example.com", "b.com", "c.com", "d.org", "e.info"]
    urls = [
        f"http://{draw.choice(hosts)}/{draw.choice(['en', 'de', 'fr', 'x'])}/{i}" for i in range(400)
    ]
    links = [(draw.choice(urls), draw.choice(urls)) for _ in range(170)]
    # A long chain and a page with very many aliases.
    links += [(f"http://b.com/c/{i}", f"http://b.com/c/{i + 1}") for i in range(60)]
    links += [("http://b.com/c/60", "http://b.net/blocked")]
    links += [(f"http://c.com/s/{i}", "HTTPS://c.com/hub#x") for i in range(200)]
    links += [("http://c.com/hub", "http://b.org/fr/1"), ("http://c.com/hub", "http://c.net/1")]
    links += [(None, "http://a.net/1"), ("http://b.com/c/0", None), ("x", "y")]
    pages = [(i, url, None) for i, url in enumerate(urls)]
    pages += [(500 + i, a, None) for i, (a, _) in enumerate(links)]
    want = plain(pages, links)
    assert judged(spark, pages, links=links) == want
    declared = [(i, a, canonical(b) if b else "") for i, (a, b) in enumerate(links)]
    assert judged(spark, declared) == by_sql(declared) == plain(declared, links)


def test_rules_of_many_shapes(spark):
    draw = random.Random(9)
    hosts = ["net", "a.net", "b.a.net", "com", "x.com"]
    rules = [
        (draw.choice(["allow", "block"]), draw.choice(hosts), draw.choice(["", "/", "/p", "/p/q"]))
        for _ in range(25)
    ] + [("block", "", "/"), ("block", "A.Com", "/Z")]
    pages = [
        (i, f"http://{draw.choice(['c.', 'b.', 'q.b.', ''])}{draw.choice([*hosts, 'a.com'])}"
         f"{draw.choice(['', '/', '/p', '/p/q/r', '/P', '/Z'])}", None)
        for i in range(200)
    ]
    plain_rules = [(v, h.lower(), p) for v, h, p in rules if h]
    assert judged(spark, pages, rules) == plain(pages, [], plain_rules)
    assert {row[4] for row in judged(spark, pages, [])} == {"allow"}
    assert judged(spark, [], rules) == []


def test_test_table_against_sql(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select(*PAGES.split()[0::2][:3])
    pages = [tuple(row) for row in table.collect()]
    got = judged(spark, pages)
    assert got == by_sql(pages) == plain(pages, [])
    assert {row[4] for row in got} == {"allow", "block"}
