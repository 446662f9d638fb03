"""Addresses and rules by hand, posteriors against plain Python."""

from __future__ import annotations

import math

from millrace.llm import reputation
from millrace.llm.queries import QUERIES, URL_RULES


def slow_address(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
    host, rest = rest[:cut], rest[cut:]
    end = min((rest.find(c) for c in "?#" if c in rest), default=len(rest))
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), rest[:end]


def slow_rule(host, path):
    fits = [(name + start, verdict) for name, start, verdict in URL_RULES
            if (host == name or host.endswith("." + name)) and path.startswith(start)]
    return max(fits, key=lambda x: len(x[0])) if fits else (None, None)


URLS = [None, "", "nourl", "HTTP://User@WWW.Example.COM:80/en/x?y#z", "x://a.b.example.com/en/", "http://net/es/",
        "http://x.net?u=/es/", "http://com", "http://com/", "http://internet/es/", "see http://y.com/a://b.net/es/", "a://É.NET/fr/",
        "://", "http://www.example.com/en/1", "http://example.com/EN/", "http://m.x.net/fr/a\nb?c", "http://a.b./x"]


def test_addresses_and_rules(spark):
    pages = spark.createDataFrame([(i, u) for i, u in enumerate([*URLS, URLS[4]])], "page_id long, url string")
    pages = pages.selectExpr("*", "1 as host", "2 as p", "3 as page")
    texts = spark.createDataFrame([], "page_id long, text string")
    docs = spark.createDataFrame([], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    rows = {r["page_id"]: r for r in reputation.judge(pages, texts, docs, labels, URL_RULES).collect()}
    assert len(rows) == len(URLS) + 1
    for i, url in enumerate(URLS):
        host, path = slow_address(url)
        rule, verdict = slow_rule(host, path)
        assert (rows[i]["host"], rows[i]["path"]) == (host, path)
        assert (rows[i]["rule"], rows[i]["verdict"]) == (rule, verdict or "allow")
    assert reputation.judge(pages.limit(0), texts, docs, labels, URL_RULES).count() == 0


def test_bad_host_is_blocked_and_shrunk(spark):
    good, bad = "fine words here", "spam spam"
    docs = spark.createDataFrame([(1, good), (2, bad), (3, bad)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 0), (9, None)], "doc_id long, quality int")
    urls = [("good.example.org", good)] * 40 + [("bad.example.org", bad)] * 40 + [("one.example.org", bad)] + [("new.example.org", "unknown")]
    pages = spark.createDataFrame([(i, f"http://{h}/x") for i, (h, _) in enumerate(urls)], "page_id long, url string")
    texts = spark.createDataFrame([(i, f"Headline\n{t}") for i, (_, t) in enumerate(urls)], "page_id long, text string")
    rows = reputation.judge(pages, texts, docs, labels, URL_RULES).collect()
    by_host = {r["host"]: r for r in rows}
    assert {h: r["verdict"] for h, r in by_host.items()} == {
        "good.example.org": "allow", "bad.example.org": "block", "one.example.org": "allow", "new.example.org": "allow"
    }
    assert by_host["bad.example.org"]["n_outcomes"] == 40 and by_host["new.example.org"]["n_outcomes"] == 0

    # The same posteriors in plain Python.
    counts = {"good.example.org": (40, 40), "bad.example.org": (40, 0), "one.example.org": (1, 0), "new.example.org": (0, 0)}

    def strength(groups, mean):
        groups = [(n, k) for n, k in groups if n]
        total = sum(n for n, _ in groups)
        spread = sum(n * (k / n - mean) ** 2 / (mean * (1 - mean)) for n, k in groups)
        weight = total - sum(n * n for n, _ in groups) / total - (len(groups) - 1)
        between = (spread - (len(groups) - 1)) / weight if weight > 0 else None
        if between is None:
            return 1000.0
        return max(1.0, 1 / max(min(between, 0.5), 1 / 1001) - 1)

    mean = (40 + 1) / (81 + 2)
    for _ in ("suffix", "domain"):
        weight = strength([(81, 40)], mean)
        mean = (40 + weight * mean) / (81 + weight)
    weight = strength(counts.values(), mean)
    for host, (n, k) in counts.items():
        share = (k + weight * mean) / (n + weight)
        bound = min(1.0, share + 1.645 * math.sqrt(share * (1 - share) / (n + weight + 1)))
        assert math.isclose(by_host[host]["share"], share) and math.isclose(by_host[host]["bound"], bound)


def test_query(spark, small):
    pages = {r["page_id"]: r["url"] for r in spark.read.parquet(f"{small}/pages.parquet").collect()}
    rows = QUERIES["op9_urls"](spark, small).collect()
    assert len(rows) == len(pages)
    for row in rows:
        host, path = slow_address(pages[row["page_id"]])
        rule, verdict = slow_rule(host, path)
        assert (row["host"], row["path"], row["rule"]) == (host, path, rule)
        assert row["verdict"] in ("allow", "block") and verdict in (None, row["verdict"])
    assert sum(r["n_outcomes"] for r in {r["host"]: r for r in rows}.values()) > 0


def test_domains_and_suffixes(spark):
    hosts = {
        "a.b.co.uk": ("b.co.uk", "co.uk"), "co.uk": ("co.uk", "co.uk"), "x.com.au:80": ("x.com.au", "com.au"),
        "www.example.com": ("example.com", "com"), "com": ("com", "com"), "10.1.2.3:8080": ("10.1.2.3", "number"),
        "u@10.1.2.3": ("10.1.2.3", "number"), "[::1]:80": ("[::1]", "number"), "a.b.co.uk.": ("b.co.uk.", "co.uk."),
        "1.2.3.4.net": ("4.net", "net"), "x" * 50_000 + ".org": ("x" * 50_000 + ".org", "org"),
    }
    pages = spark.createDataFrame([(i, f"http://{host}/x") for i, host in enumerate(hosts)], "page long, url string")
    found = {r["page"]: (r["domain"], r["suffix"]) for r in reputation.with_address(pages, ["page"]).collect()}
    assert [found[i] for i in range(len(hosts))] == list(hosts.values())


def test_pages_with_and_without_a_headline_have_outcomes(spark):
    docs = spark.createDataFrame([(1, "one two\n\nthree"), (2, ""), (3, None), (4, "Head")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 1), (3, 1), (4, 0)], "doc_id long, quality int")
    texts = [(1, "one two\n\nthree"), (2, "Head\n\none  two\n\nthree"), (3, ""), (4, None), (5, "Head"), (6, "one two")]
    shown = spark.createDataFrame(texts * 2, "page long, text string")
    assert sorted(map(tuple, reputation.outcomes(shown, docs, labels).collect())) == [(1, 1), (2, 1), (5, 0)]
