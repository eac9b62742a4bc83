import re

import numpy as np
from weirflow.llm.url_graph import RULES, judge, propagate

PAGE = "page_id long, url string, html string"


def plain_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split(r"[/?#]", rest, maxsplit=1)[0]
    path = re.split(r"[?#]", rest[len(host) :], maxsplit=1)[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def plain_rule(host, path):
    fits = []
    for rule, verdict in RULES:
        h, _, p = rule.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p):
            fits.append((len(rule), rule, verdict))
    return max(fits)[1:] if fits else (None, None)


URLS = [
    None, "", "no address", "http://", "http://ORG/", "https://a.Example.org/en/1x?q#f", "https://example.org/es/", "http://example.org", "http://x.com/fr/1", "http://x.com/de/1",
    "http://notexample.org/es/1", "http://com/de/9", "http://Ä.com/fr/", "ftp://h.net?x://y.org/", "http://a.b.com#/de/", "://example.org/es/x", "http://x.com/de/1", "http://example.com/other", "http://x.com:80/fr/", "http://h.net/a\nb",
]


def test_hosts_paths_and_rules_equal_plain_ones(spark):
    rows = {r.page_id: r for r in judge(spark.createDataFrame([(k, u, None) for k, u in enumerate(URLS)], PAGE)).collect()}
    assert len(rows) == len(URLS)
    for k, url in enumerate(URLS):
        host, path = plain_parts(url)
        rule, verdict = plain_rule(host, path)
        assert (rows[k].host, rows[k].path, rows[k].rule) == (host, path, rule), url
        assert rows[k].verdict == verdict if rule else rows[k].verdict in ("allow", "block")


def power(edges, seeds, rounds, damping=0.85):
    """Ranks with rank of hosts without edges going back to the seeds, by dense matrices."""
    hosts = sorted({h for e in edges for h in e} | set(seeds))
    at = {h: k for k, h in enumerate(hosts)}
    m = np.zeros((len(hosts),) * 2)
    for s, d in edges:
        m[at[d], at[s]] = 1
    out = m.sum(axis=0)
    seed = np.array([seeds.get(h, 0.0) for h in hosts])
    seed /= seed.sum()
    m = np.where(out > 0, m / np.maximum(out, 1), seed[:, None])
    rank = seed
    for _ in range(rounds):
        rank = damping * (m @ rank) + (1 - damping) * seed
    return dict(zip(hosts, rank))


def test_ranks_equal_dense_power_iteration(spark):
    edges = [("a", "b"), ("b", "c"), ("c", "a"), ("a", "d"), ("d", "e"), ("f", "a"), ("f", "e")]
    seeds = [("trust", "a", 2.0), ("trust", "f", 1.0), ("distrust", "e", 1.0)]
    got = {r.host: (r.trust, r.distrust) for r in propagate(spark.createDataFrame(edges, "src string, dst string"), spark.createDataFrame(seeds, "kind string, host string, weight double")).collect()}
    trust = power(edges, {"a": 2.0, "f": 1.0}, 400)
    distrust = power([(d, s) for s, d in edges], {"e": 1.0}, 400)
    for host, (t, d) in got.items():
        assert abs(t - trust[host]) < 1e-7 and abs(d - distrust[host]) < 1e-7


def test_distrust_reaches_the_end_of_a_long_chain(spark):
    link = lambda h: f'<a href="https://{h}/x">x</a>'
    pages = [(0, "http://bad.com/de/1", "")] + [(k, f"http://h{k}.net/a", link("bad.com" if k == 1 else f"h{k - 1}.net")) for k in range(1, 41)]
    pages += [(100, "http://good.com/fr/1", ""), (101, "http://far.net/", None)]
    rows = {r.page_id: r for r in judge(spark.createDataFrame(pages, PAGE)).collect()}
    assert {rows[k].verdict for k in range(41)} == {"block"}
    assert rows[100].verdict == rows[101].verdict == "allow"
    assert all(rows[k].distrust > 0 for k in range(41))


def test_distrust_flows_back_along_links_and_trust_forward(spark):
    link = lambda *hosts: "".join(f'<a HREF="https://{h}/x">x</a>' for h in hosts)
    pages = [
        (1, "http://good.com/fr/1", link("friend.net")),
        (2, "http://bad.com/de/1", ""),
        (3, "http://points.net/a", link("bad.com")),
        (4, "http://friend.net/a", "<a href='/own'>"),
        (5, "http://alone.net/a", None),
        (6, "http://good.com/fr/2", link("friend.net")),
    ]
    rows = {r.page_id: r for r in judge(spark.createDataFrame(pages, PAGE)).collect()}
    assert [rows[k].verdict for k in range(1, 7)] == ["allow", "block", "block", "allow", "allow", "allow"]
    assert rows[3].distrust > rows[3].trust and rows[4].trust > rows[4].distrust and rows[5].trust == rows[5].distrust == 0


def test_empty_no_seeds_repeats_and_clashing_names(spark):
    assert judge(spark.createDataFrame([], PAGE)).count() == 0
    page = [(1, "http://a.net/x", "<a href=//b.net>")] * 3
    rows = judge(spark.createDataFrame(page, PAGE).selectExpr("*", "1 AS host", "2 AS trust")).collect()
    assert [(r.host, r.verdict) for r in rows] == [("a.net", "allow")] * 3
