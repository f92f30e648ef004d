import re

import numpy as np
from llm.tables import rows

from signalwatch.llm import link_trust as op

EXTRA = ", host string, path string, trust string, verdict string, n string"


def pages(spark, some):
    return spark.createDataFrame([(*r, *"abcde") for r in some],
                                 "page_id long, url string, html string" + EXTRA)


def plain_parts(url):
    if not url or "://" not in url:
        return "", ""
    rest = url[url.index("://") + 3:]
    host = re.split("[/?#]", rest)[0]
    return "".join(c.lower() if c.isascii() else c for c in host), \
        re.split("[?#]", rest[len(host):])[0]


def plain_rule(host, path):
    best = None
    for rule in op.RULES:
        if (host == rule.host or host.endswith("." + rule.host)) and path.startswith(rule.path) \
                and (best is None or len(rule.pattern) > len(best.pattern)):
            best = rule
    return best


URLS = [None, "", "nope", "http://", "HTTP://A.Example.ORG/fr/x?y#z", "http://example.net",
        "https://a.com?x/y", "http://c.com#/u", "http://notexample.net/en/q", "ftp://net/",
        "http://x.example.net/en/", "http://x.example.net/en", "http://xnet/", "http://net/a\nb?c",
        "http://example.com/de/x", "http://www.example.com/fr/", "x://y://z/w", "http://É.Org/fr/"]


def test_hosts_paths_and_rules(spark):
    found = op.judge_urls(pages(spark, [(k, u, "") for k, u in enumerate(URLS)]))
    by_id = {r.page_id: r for r in found.collect()}
    for k, url in enumerate(URLS):
        host, path = plain_parts(url)
        rule = plain_rule(host, path)
        assert (by_id[k].host, by_id[k].path) == (host, path)
        assert by_id[k].rule == (rule.pattern if rule else None)
        assert by_id[k].verdict == (rule.verdict if rule else "allow")


def test_pagerank_against_matrices(spark):
    rng = np.random.default_rng(3)
    n = 12
    links = rng.integers(0, 4, (n, n)) * (rng.random((n, n)) < 0.3)
    np.fill_diagonal(links, 0)
    links[4] = 0  # a host without links
    edges = spark.createDataFrame([(f"h{i}", f"h{j}", int(links[i, j])) for i in range(n)
                                   for j in range(n) if links[i, j]],
                                  "source string, target string, n long")
    seeds = [0, 5]
    start = np.zeros(n)
    start[seeds] = 1 / len(seeds)
    rank = start
    for _ in range(op.MOST_ROUNDS):
        total = links.sum(1, keepdims=True)
        moved = rank @ np.divide(links, total, where=total > 0, out=np.zeros((n, n)))
        rank = op.DAMPING * moved + (1 - op.DAMPING * moved.sum()) * start
    found = op.personalised_pagerank(
        edges, spark.createDataFrame([(f"h{i}",) for i in seeds], "host string"), "test")
    got = dict(found.select("host", "rank").collect())
    assert np.allclose([got.get(f"h{i}", 0.0) for i in range(n)], rank, atol=1e-4)


def test_a_long_chain_against_a_solved_system(spark):
    n, d = 31, op.DAMPING  # each host links to the next one, and only the last is blocked
    graph = spark.createDataFrame([(f"h{k}", "bad.net" if k == n - 2 else f"h{k + 1}", 1)
                                   for k in range(n - 1)], "source string, target string, n long")
    found = {r.host: r for r in op.host_trust(
        pages(spark, []), (op.Rule("block", "net/"),), graph).collect()}
    # distrust walks from the last host back; what the first one holds goes back to the seed
    step = np.zeros((n, n))
    step[np.arange(1, n), np.arange(n - 1)] = 1
    step[0, n - 1] = 1
    start = np.eye(n)[n - 1]
    rank = np.linalg.solve(np.eye(n) - d * step.T, (1 - d) * start)
    got = [found["bad.net" if k == n - 1 else f"h{k}"].distrust for k in range(n)]
    assert np.allclose(got, rank, atol=1e-5) and min(got) > 0
    assert all(r.blocked and r.trust == 0 for r in found.values())


def test_distrust_goes_against_links_and_trust_along(spark):
    link = '<p><A class=x HREF="http://{}/p">l</a> <a href=\'//{}?q\'>m</a><a href="/own">o</a>'
    some = [(1, "http://friend.com/", ""), (2, "http://b.example.net/en/", link.format("good.com", "good.com")),
            (3, "http://good.com/x", ""), (4, "http://spam.com/", link.format("bad.net", "worse.net")),
            (5, "http://mixed.com/", link.format("bad.net", "friend.com"))]
    by_id = {r.page_id: r for r in op.judge_urls(pages(spark, some)).collect()}
    assert by_id[3].trust > 0 == by_id[3].distrust and by_id[3].verdict == "allow"
    assert by_id[4].distrust > 0 == by_id[4].trust and by_id[4].verdict == "block"
    assert by_id[5].verdict == "block" and by_id[1].verdict == "allow"
    assert rows(op.host_graph(pages(spark, some)), "source", "target", "n") == [
        ("b.example.net", "good.com", 2), ("mixed.com", "bad.net", 1), ("mixed.com", "friend.com", 1),
        ("spam.com", "bad.net", 1), ("spam.com", "worse.net", 1)]


def test_awkward_rows(spark):
    some = [(1, None, None), (1, None, None), (None, "http://net/", "x"), (2, "http://a.b/", None)]
    found = op.judge_urls(pages(spark, some))
    assert rows(found, "page_id", "host", "verdict") == [(1, "", "allow"), (1, "", "allow"),
                                                         (2, "a.b", "allow")]
    assert op.judge_urls(pages(spark, some).where("page_id > 9")).count() == 0
