"""URL verdicts: rules against a plain loop, aliases against a search over the links."""

from __future__ import annotations

import random
import re
from urllib.parse import urljoin

import pytest
from pyspark.sql import functions as F

from navstream.llm import url_filter
from navstream.llm.url_filter import ALLOW, BLOCK, RULES, judge_urls

SCHEMA = "page_id long, url string, html string"


def place(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), re.match(r"[^?#]*", rest[len(host) :]).group()


def rule_of(url, rules=RULES):
    host, path = place(url)
    fits = [(len(r), r, v) for v, r in rules for h, _, p in [r.partition("/")] if (host == h or host.endswith("." + h)) and path.startswith("/" + p)]
    return max(fits)[1:] if fits else (None, None)


def slow(pages, links, rules=RULES):
    """``links``: pairs of nodes."""
    group = {}
    for a, b in links:
        joined = group.get(a, {a}) | group.get(b, {b})
        group.update({x: joined for x in joined})
    out = []
    for page, url, _ in pages:
        rule, verdict = rule_of(url, rules)
        around = group.get(node(url), set())
        said = {rule_of(x, rules)[1] for x in around} - {None}
        out.append((page, *place(url), rule, verdict or (BLOCK if said == {BLOCK} else ALLOW), min(around, default=None)))
    return sorted(out, key=repr)


def node(url):
    if url is None or not re.match(r"[A-Za-z][\w+.\-]*://", url):
        return None
    host, path = place(url)
    return url.split("://")[0].lower() + "://" + host + (path or "/") + (re.match(r"[^?#]*(\?[^#]*)?", url).group(1) or "")


def got(spark, pages, rules=RULES, **more):
    df = spark.createDataFrame(pages, SCHEMA).withColumns({c: F.lit("clash") for c in ("id", "host", "node", "fit", "component", "verdict")})
    return sorted((tuple(r) for r in judge_urls(df, rules, **more).select("id", "host", "path", "rule", "verdict", "alias_of").collect()), key=repr)


URLS = [
    None, "", "nourl", "://", "http://", "http://ORG", "http://org/", "https://A.Example.ORG/es/1", "http://example.org/es", "http://example.org/en/1?x#y",
    "http://x.example.org/en/123.html", "http://myexample.org/en/1", "https://shop.com/de/#top", "https://com/de/x", "http://a.com/fr/", "http://user@b.com:80/fr/x",
    "a://b://c.org/x", "http://c.net?x=/org/", "http://d.net#http://org/", "http://é.org/ü", "HTTP://UP.NET/X",
]


def test_rules_match_a_plain_loop(spark):
    pages = [(k, u, None) for k, u in enumerate(URLS)] + [(3, URLS[7], None), (None, URLS[8], "")]
    assert got(spark, pages) == slow(pages, [])


@pytest.mark.parametrize("inline", [0, 64])
def test_joined_rules_match_a_plain_loop(spark, monkeypatch, inline):
    monkeypatch.setattr(url_filter, "INLINE", inline)
    rng = random.Random(13)
    rules = list(RULES) + [(rng.choice((ALLOW, BLOCK)), f"{h}/{p}") for h in ("net", "a.net", "b.a.net", "c.org") for p in ("", "x", "x/", "x/y", "é") if rng.random() < 0.8]
    urls = URLS + [f"http://{h}/{p}" for h in ("a.net", "q.b.a.net", "net", "c.org", "a.net.") for p in ("", "x", "x/yz", "éé", "X")]
    pages = [(k, u, None) for k, u in enumerate(urls)]
    assert got(spark, pages, rules) == slow(pages, [], rules)


def test_references_resolve_as_in_a_browser(spark):
    refs = ["b", "./b", "../b", "../../../b", "/b", "/a/./b/../c", "//h.net/b", "?q=1", "http://H.net", "https://h.net/b#f", "b/..", "b/c?x=/../y", "../b/."]
    pages = [(k, f"https://s.net/p{k}/q/r?z=1", f'<link href="{r}" rel="canonical">') for k, r in enumerate(refs)]
    links = [(node(u), node(urljoin(u, r))) for (_, u, _), r in zip(pages, refs, strict=True)]
    want = {a: min(a, b) for a, b in links}
    df = spark.createDataFrame(pages, SCHEMA)
    found = {tuple(r) for r in url_filter.page_links(df).collect()}
    assert found == set(links) and len(want) == len(refs)


def test_blocks_reach_aliases_and_allows_come_first(spark):
    link = '<html><LINK REL="nofollow Canonical" href={}></html>'.format
    pages = [
        (1, "https://a.net/1", link("https://shop.com/de/1")), (2, "https://a.net/2#top", '<meta http-equiv="refresh" content="5; URL=\'1\'">'),
        (3, "https://a.net/3", "<!-- " + link("/1") + " --><script>" + link("/1") + "</script>"), (4, "https://b.net", link("https://shop.com/fr/1")),
        (5, "https://b.net/", link("https://shop.com/de/9")), (6, "https://shop.com/de/9", None), (7, "https://shop.com/fr/2", link("https://shop.com/de/1")),
        (8, "https://c.net/", link("mailto:x@y")), (9, "https://c.net/9", link("https://c.net/9#x")), (10, "https://a.net/1", None), (11, None, link("/1")),
        (12, "https://a.net/4", "<link rel=stylesheet href=/1><meta name=refresh content='0;url=/1'>"),
    ]
    links = [
        ("https://a.net/1", "https://shop.com/de/1"), ("https://a.net/2", "https://a.net/1"), ("https://b.net/", "https://shop.com/fr/1"),
        ("https://b.net/", "https://shop.com/de/9"), ("https://shop.com/fr/2", "https://shop.com/de/1"),
    ]
    assert got(spark, pages) == slow(pages, links)


def test_observed_redirects_join_random_components(spark):
    rng = random.Random(31)
    urls = [f"https://{h}/{p}/{k}" for h in ("a.net", "b.org", "c.com", "example.org") for p in ("de", "fr", "es", "x") for k in range(6)]
    pages = [(k, u, None) for k, u in enumerate(urls)]
    links = [tuple(rng.sample(urls, 2)) for _ in range(45)]
    table = spark.createDataFrame([*links, (None, urls[0]), (urls[1], None), (urls[2], urls[2])], "source string, target string")
    assert got(spark, pages, redirects=table, html_col=None) == slow(pages, links)


def test_no_rows(spark):
    assert got(spark, []) == []
