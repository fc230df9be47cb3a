import numpy as np
import pytest

from martspark.llm import url_filter as U
from martspark.llm.queries import URL_RULES


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = next((i for i, c in enumerate(rest) if c in "/?#"), len(rest))
    tail = rest[cut:]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut]), tail[: next((i for i, c in enumerate(tail) if c in "?#"), len(tail))]


def test_rules_by_hand(spark):
    urls = [None, "", "no scheme", "http://a.net", "http://a.net/", "HTTP://WWW.Example.NET/en/1?x#y", "http://example.net/EN/", "https://m.example.com/de/x", "http://example.com/fr/",
            "http://xexample.com/de/", "ftp://b.org/fr/?u=http://c.net/", "http://org/fr/a", "://net/x", "http://É.net/x#/y", "http://net?/x", "http://a.net#x/", "x" * 5000 + "://a.net/"]
    rows = spark.createDataFrame([(i, u, None, "h", "p") for i, u in enumerate(urls)], "page_id long, url string, html string, host string, path string")
    got = {r.page_id: r for r in U.judge(rows.drop("host", "path").selectExpr("*", "'a' trust"), URL_RULES).collect()}
    for i, url in enumerate(urls):
        host, path = parts(url)
        fits = [r for r in URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        best = max(fits, key=lambda r: len(r.text), default=None)
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, best and best.text)
        if best:
            assert got[i].verdict == best.verdict


def test_propagation_against_dense_matrix(spark):
    pick = np.random.default_rng(2)
    n, links = 12, {}
    for _ in range(40):
        a, b = pick.integers(0, n, 2)
        if a != b:
            links[int(a), int(b)] = links.get((int(a), int(b)), 0) + 1
    edges = spark.createDataFrame([(f"h{a}", f"h{b}", w) for (a, b), w in links.items()], "src string, dst string, weight long")
    seeds = spark.createDataFrame([(f"h{i}", 1.0 if i == 0 else 0.0, 1.0 if i == 5 else 0.0) for i in range(n)], "host string, trust double, distrust double")
    got = {r.host: r for r in U.propagate(edges, seeds, tolerance=1e-7, rounds=100).collect()}
    m = np.zeros((n, n))
    for (a, b), w in links.items():
        m[a, b] = w
    for side, by, seed in (("trust", m, 0), ("distrust", m.T, 5)):
        p = np.divide(by, by.sum(axis=1, keepdims=True), out=np.zeros_like(by), where=by.sum(axis=1, keepdims=True) > 0)
        s = np.eye(n)[seed]
        expected = np.linalg.solve(np.eye(n) - 0.85 * p.T, s)
        for i in range(n):
            assert abs((got[f"h{i}"][side] if f"h{i}" in got else 0.0) - expected[i]) < 1e-4


def test_a_long_chain_is_followed_to_the_tolerance(spark):
    edges = spark.createDataFrame([(f"h{i}", f"h{i + 1}", 1) for i in range(41)], "src string, dst string, weight long").coalesce(1)
    seeds = spark.createDataFrame([("h0", 1.0, 0.0)], "host string, trust double, distrust double").coalesce(1)
    got = {r.host: r.trust for r in U.propagate(edges, seeds).collect()}
    assert all(abs(got[f"h{i}"] - 0.85 ** i) < 1e-9 for i in range(42))
    with pytest.raises(RuntimeError):
        U.propagate(edges, seeds, rounds=3)


def test_distrust_reaches_hosts_that_link_to_blocked_ones(spark):
    pages = [(1, "http://farm.com/x", '<a href="http://bad.spam.com/">x</a>'), (2, "http://good.com/x", "<a HREF='https://fine.com/y'>y</a>"), (3, "http://bad.spam.com/", None), (4, "http://fine.com/", "")]
    rows = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = {r.page_id: r.verdict for r in U.judge(rows, [], trusted="^good[.]com$", blocked="spam").collect()}
    assert got == {1: "block", 2: "allow", 3: "block", 4: "allow"}
    assert U.judge(rows.limit(0), URL_RULES).count() == 0
    assert U.judge(rows.unionByName(rows), URL_RULES).count() == 8
