"""The trie against every rule tried one by one, and against the joins for long rule lists."""

from __future__ import annotations

import random

import pytest

from tandem.llm import urls as U

RULES = [
    ("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"),
    ("block", "b.net", "/e"), ("allow", "b.net", "/es/x"), ("block", "org", ""), ("allow", "org", ""),
]


def brute(url, rules, default="allow"):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([i for i in map(rest.find, "/?#") if i >= 0] or [len(rest)])
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
        rest = rest[cut:]
        path = rest.split("?")[0].split("#")[0] if rest.startswith("/") else ""
    fits = [
        (h.count("."), len(p), a == "block", h + p, a)
        for a, h, p in rules
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    return (host, path, *(max(fits)[3:] if fits else (None, default)))


def sample(n=400):
    rng = random.Random(4)
    hosts = ["example.com", "www.example.com", "WWW.Example.COM", "a.b.net", "b.net", "net", "x.org", "com", "", "b.net:80", "b.net."]
    paths = ["", "/", "/en/", "/en", "/es/", "/es/x/y", "/e", "/es/?q=://", "#/en/", "?a=/en/", "/en/#t", "//en/"]
    made = [f"{rng.choice(['http', 'https', ''])}://{rng.choice(hosts)}{rng.choice(paths)}" for _ in range(n)]
    return [*made, None, "", "no scheme/en/", "http:/one", "://", "a://b://c"]


def test_each_rule_one_by_one():
    trie = U.build_trie(RULES)
    for url in sample():
        host, path = U.split_url(url)
        rule, verdict = U.look_up(trie, host, path) or (None, "allow")
        assert (host, path, rule, verdict) == brute(url, RULES), url


@pytest.mark.parametrize("broadcast", [100, 0])
def test_rows_with_the_trie_and_with_joins(spark, broadcast):
    rows = [(i, u, "h") for i, u in enumerate(sample(120))] + [(0, "http://b.net/es/x", "h"), (None, "http://b.net/es/x", "h")]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string")
    got = U.judge_urls(pages, RULES, broadcast_rules=broadcast)
    assert got.columns == ["page_id", "host", "path", "rule", "verdict"]
    expected = sorted([(i, *brute(u, RULES)) for i, u, _ in rows], key=str)
    assert sorted(map(tuple, got.collect()), key=str) == expected


def test_no_rules_and_no_rows(spark):
    pages = spark.createDataFrame([(1, "http://a.com/")], "page_id long, url string")
    assert [tuple(r) for r in U.judge_urls(pages, [], default="block").collect()] == [(1, "a.com", "/", None, "block")]
    assert U.judge_urls(pages.where("false"), RULES).count() == 0
