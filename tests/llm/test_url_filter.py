"""URL filters against a comparison with every rule in plain Python."""

import random

import pytest

from riskloom.llm.url_filter import Trie, cut_urls, judge

RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("Example.COM", "/de", "block"),
    ("example.com", "/de/x/", "allow"),
    ("a.b.c", None, "block"),
    ("a.b.c", "/", "block"),
    ("a.b.c", "/", "allow"),
    (None, "/private/", "block"),
    ("org", "/f", "allow"),
]
RULE_SCHEMA = "host string, path string, verdict string"
URLS = [
    "http://x.example.net/en/1?q=/de/",
    "HTTP://EXAMPLE.net/EN/",
    "http://example.net",
    "http://example.net/",
    "http://notexample.com/de/",
    "http://w.example.com/de",
    "https://example.com/dex/",
    "https://example.com/de/x/y#z",
    "://a.b.c",
    "://z.a.b.c/q",
    "x://net.a?/",
    "ftp://o.org/fr/",
    "ftp://org/f",
    "http:///private/a",
    "/private/",
    "no scheme",
    "",
    None,
    "http://a\nb.net/\nx?y",
    "http://é.net/é://net/",
    "http://" + "a." * 5000 + "net/" + "seg/" * 50_000,
]


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    at = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    path = rest[at:]
    end = min([path.find(c) for c in "?#" if c in path] or [len(path)])
    return "".join(c.lower() if c.isascii() else c for c in rest[:at]), path[:end]


def expected(url, rules, default="allow"):
    host, path = parts(url)
    fitting = []
    for own_host, own_path, verdict in rules:
        h, p = (own_host or "").lower(), own_path or ""
        if (not h or host == h or host.endswith("." + h)) and path.startswith(p):
            fitting.append(((len(h.split(".")) if h else 0, len(p), verdict == "block"), h + p, verdict))
    best = max(fitting, default=(None, None, default))
    return host, path, best[1], best[2]


@pytest.mark.parametrize("most", [1 << 20, 1])  # the trie, and the join for long lists
def test_every_rule_in_plain_python(spark, most):
    rows = [(i, u, "own", "own") for i, u in enumerate([*URLS, URLS[0]])]
    pages = spark.createDataFrame(rows, "page_id long, url string, Host string, judged string")
    found = judge(pages, spark.createDataFrame(RULES, RULE_SCHEMA), default="block", most=most)
    assert found.columns == ["page_id", "url", "host", "judged", "path", "rule", "verdict"]
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in found.collect()}
    assert got == {i: expected(u, RULES, "block") for i, u, *_ in rows}
    assert {r["judged"] for r in found.collect()} == {"own"}


def test_many_random_rules_and_urls():
    rng = random.Random(5)

    def host():
        return ".".join(rng.choice(["a", "b", "ab", ""]) for _ in range(rng.randrange(1, 5)))

    def path():
        return "".join("/" + rng.choice(["a", "b", "ab", ""]) for _ in range(rng.randrange(0, 4)))

    rules = [(host(), path(), rng.choice(["allow", "block"])) for _ in range(400)]
    trie = Trie(rules)
    for _ in range(3000):
        h, p = host(), path()
        found = trie.find(h, p)
        rule, verdict = expected(f"x://{h}{p}", rules, None)[2:]
        assert (found or (None, None)) == (rule, verdict)


def test_empty_tables_and_bad_verdicts(spark):
    pages = spark.createDataFrame([(1, "http://a.net/"), (None, None)], "page_id long, url string")
    rules = spark.createDataFrame(RULES, RULE_SCHEMA)
    assert [r["verdict"] for r in judge(pages, rules.limit(0)).collect()] == ["allow", "allow"]
    assert judge(pages.limit(0), rules).count() == 0
    assert cut_urls(pages.limit(0)).count() == 0
    with pytest.raises(Exception, match="allow or block"):
        judge(pages, spark.createDataFrame([("a", "/", "maybe")], RULE_SCHEMA)).collect()
