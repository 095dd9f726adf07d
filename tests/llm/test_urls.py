from __future__ import annotations

import random

from caremarts.llm import urls as U

URLS = [
    "https://a.example.net/en/1", "http://A.EXAMPLE.net/de/1", "http://x.net/", "http://x.net", "net://net/a",
    "https://example.com/de/?q=/en/", "https://b.example.com/DE/", "https://c.org/fr/x#y", "https://org/fr/", "ftp://notnet/",
    "https://free-bets.example.org/en/", "https://free-bets.example.net/en/1", "https://spam.org", "no scheme", "", None,
    "x://", "x://#frag", "x://h?q://z/", "https://www.casino-win.de/a b", "https://notexample.com/de/", "https://É.net/",
]


def plain(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        n = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(c.lower() if c.isascii() else c for c in rest[:n])
        path = rest[n:].split("?")[0].split("#")[0]
    best = None
    for h, p, v in U.RULES:
        if host and (host == h or host.endswith("." + h)) and path.startswith(p):
            if best is None or len(h + p) > len(best[0]):
                best = (h + p, v)
    words = {w for label in host.split(".") for w in label.split("-")}
    other = "block" if words & set(U.UNWANTED) else "allow"
    return host, path, best[0] if best else None, best[1] if best else other


def test_verdicts_as_the_rules_read(spark):
    rows = spark.createDataFrame([(i, u, "h") for i, u in enumerate(URLS)], "page_id long, url string, HOST string")
    got = {r.page_id: r for r in U.url_verdicts(rows).collect()}
    for i, u in enumerate(URLS):
        assert (got[i].host, got[i].path, got[i].rule, got[i].verdict) == plain(u), u
    assert U.url_verdicts(rows.limit(0)).count() == 0
    assert U.filter_urls(rows.union(rows)).count() == 2 * len(URLS)


def test_longest_rule_wins(spark):
    rules = (("net", "/", "block"), ("a.net", "/", "allow"), ("a.net", "/x/", "block"))
    rows = spark.createDataFrame([(1, "s://a.net/x/y"), (2, "s://a.net/y"), (3, "s://b.net/")], "page_id long, url string")
    got = {r.page_id: (r.rule, r.verdict) for r in U.filter_urls(rows, rules).collect()}
    assert got == {1: ("a.net/x/", "block"), 2: ("a.net/", "allow"), 3: ("net/", "block")}


def universe(spark, listed_share=0.3, n=4000):
    rnd = random.Random(4)
    rows = [(f"key{i}.example/{rnd.randrange(9)}", rnd.random() < listed_share) for i in range(n)]
    return rows, spark.createDataFrame(rows, "key string, listed boolean")


def test_cascade_is_exact_for_every_key(spark, monkeypatch):
    monkeypatch.setattr(U, "RATES", (0.3, 0.5))  # more levels
    rows, frame = universe(spark)
    (levels,) = U.fit_cascade(frame)
    assert len(levels) > 3
    assert U.member(levels, [k for k, _ in rows]).tolist() == [y for _, y in rows]


def test_blocks_give_the_same_answers(spark, monkeypatch):
    rows, frame = universe(spark)
    monkeypatch.setattr(U, "BLOCK_KEYS", 300)
    cascade = U.fit_cascade(frame)
    assert len(cascade) > 3
    asked = spark.createDataFrame([(i, [k for k, _ in rows[i : i + 40]]) for i in range(0, len(rows), 40)], "n long, keys array<string>")
    got = {r.n: r.found for r in U.listed_among(asked, "keys", cascade, "found").collect()}
    assert got == {i: [k for k, y in rows[i : i + 40] if y] for i in range(0, len(rows), 40)}


def test_empty_list_and_full_list(spark):
    for share in (0.0, 1.1):
        rows, frame = universe(spark, share, 50)
        (levels,) = U.fit_cascade(frame)
        assert U.member(levels, [k for k, _ in rows]).tolist() == [y for _, y in rows]
