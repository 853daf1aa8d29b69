"""Rules, features and trees of the URL filter, against plain versions."""

import math
import re

import numpy as np
import pytest

from tidemark.llm import queries, url_filter
from tidemark.llm.url_filter import Rule

SMALL = "/root/testdata/sf0.001"
AWKWARD = [
    (1, "https://a.example.org/es/1?x=1&y=2#z"),
    (2, None),
    (3, ""),
    (4, "no separator/en/"),
    (5, "HTTP://WWW.EXAMPLE.ORG/en/12"),
    (6, "http://notexample.org/es/"),
    (7, "http://org/es"),
    (8, "://com/de/"),
    (9, "x://COM?/fr/"),
    (10, "x://É.com#/"),
    (11, "http://a.com/fr/" + "ä1/" * 40_000 + ".tar.gz"),
    (12, "http://h\nost.com/de/\n?q"),
    (13, "a://b://c.org/"),
    (1, "https://a.example.org/es/1?x=1&y=2#z"),
]


def split(url):
    _, found, rest = (url or "").partition("://")
    if not found:
        return "", ""
    end = re.search(r"[/?#]|\Z", rest).start()
    host = re.sub("[A-Z]", lambda m: m.group().lower(), rest[:end])
    return host, re.split(r"[?#]", rest[end:])[0]


def ruled(url, rules):
    host, path = split(url)
    fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: (len(str(r)), r.block, str(r)), default=None)


def test_whole_table(spark):
    out = queries.op11_url_filter(spark, SMALL)
    urls = {r.page_id: r.url for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()}
    rows = out.collect()
    assert sorted(r.page_id for r in rows) == sorted(urls)
    for r in rows:
        rule = ruled(urls[r.page_id], queries.URL_RULES)
        assert (r.host, r.path) == split(urls[r.page_id])
        assert r.rule == (str(rule) if rule else None)
        blocked = rule.block if rule else r.score >= 0.5
        assert r.verdict == ("block" if blocked else "allow") and 0 <= r.score <= 1


def test_awkward_urls(spark):
    pages = spark.createDataFrame(AWKWARD, "page_id int, url string").selectExpr("*", "'x' AS host", "1 AS Score", "'y' AS _kept")
    model = url_filter.train(pages, queries.URL_RULES)
    out = url_filter.judge(pages, queries.URL_RULES, model)
    assert out.columns == ["page_id", "url", "_kept", "host", "path", "rule", "verdict", "score"]
    got = sorted((r.page_id, r.host, r.path, r.rule) for r in out.collect())
    wanted = []
    for i, url in AWKWARD:
        rule = ruled(url, queries.URL_RULES)
        wanted.append((i, *split(url), str(rule) if rule else None))
    assert repr(got) == repr(sorted(wanted))
    assert "host" in url_filter.judge(pages, queries.URL_RULES, model, prefix="url_").columns
    empty = url_filter.judge(pages.where("false"), queries.URL_RULES, model)
    assert empty.isEmpty() and empty.columns == out.columns


def test_without_examples_and_with_one_class(spark):
    pages = spark.createDataFrame(AWKWARD, "page_id int, url string")
    none = url_filter.train(pages, [])
    assert {r.score for r in url_filter.judge(pages, [], none).collect()} == {0.5}
    only = url_filter.train(pages, [Rule("org", "/", block=False)])
    assert all(r.verdict == "allow" for r in url_filter.judge(pages, [], only).collect())
    with pytest.raises(ValueError, match="at most"):
        url_filter.train(pages, [Rule(str(i), "/", True) for i in range(501)])


def test_longest_rule_wins_and_blocks_in_a_tie(spark):
    rules = [Rule("b.c", "/xx", False), Rule("a.b.c", "/", True), Rule("c", "/", False)]
    df = spark.createDataFrame([("t://a.b.c/xx",), ("t://b.c/xx",), ("t://c/",), ("t://xc/",)], "url string")
    names = url_filter.rule_of(url_filter.host_of(df.url), url_filter.path_of(df.url), rules)
    got = [tuple(r) for r in df.select(names[0].alias("r"), names[1].alias("b")).collect()]
    assert got == [("a.b.c/", True), ("b.c/xx", False), ("c/", False), (None, None)]


def entropy(text):
    raw = text.encode()
    return -sum(raw.count(b) / len(raw) * math.log2(raw.count(b) / len(raw)) for b in set(raw)) if raw else 0.0


def test_features():
    urls = [u or "" for _, u in AWKWARD]
    parts = [split(u) for u in urls]
    got = url_filter.lexical_features(urls, [h for h, _ in parts], [p for _, p in parts])
    for url, (host, path), row in zip(urls, parts, got):
        query = url.split("#")[0].partition("?")[2]
        h, p = host.encode(), path.encode()
        wanted = [
            len(url.encode()),
            len(h),
            len(p),
            host.count(".") + 1 if host else 0,
            path.count("/"),
            len(re.findall("[0-9]", host)) / max(len(h), 1),
            len(re.findall("[0-9]", path)) / max(len(p), 1),
            host.count("-"),
            entropy(host),
            entropy(path),
            query.count("&") + 1 if query else 0,
            len(query.encode()),
            "#" in url,
        ]
        assert np.allclose(row, wanted)
    assert url_filter.suffixes_of("a.b.co.uk", "/x/y.tar.gz") == ("uk", "co.uk", "gz")
    assert url_filter.suffixes_of("", "") == ("", "", "")


def test_suffix_rates_are_smoothed_counts():
    found = [("org", "a.org", "html")] * 30 + [("com", "b.com", "")] * 10
    rates = url_filter.SuffixRates.count(found, np.r_[np.ones(15), np.zeros(25)])
    prior = 15 / 40
    assert np.allclose(rates([("org", "b.com", "pdf")])[0], [(15 + 20 * prior) / 50, (20 * prior) / 30, prior])


def test_a_tree_is_the_best_cut_by_brute_force():
    rng = np.random.default_rng(3)
    x = rng.integers(0, 12, (400, 3)).astype(float)
    labels = ((x[:, 1] > 6) ^ (rng.random(400) < 0.1)).astype(float)
    model = url_filter.boost(x, labels, url_filter.SuffixRates(0.5, [{}, {}, {}]), trees=1)
    p = labels.mean() + 0.0
    p = (labels.sum() + 0.5) / (len(labels) + 1)
    g, h = p - labels, np.full(400, p * (1 - p))

    def gain(f, cut):
        left = x[:, f] <= cut
        score = sum(g[s].sum() ** 2 / (h[s].sum() + 1) for s in (left, ~left))
        return score if min(h[left].sum(), h[~left].sum()) >= 1 else -1

    best = max(((f, c) for f in range(3) for c in range(11)), key=lambda fc: gain(*fc))
    tree = model.trees[0]
    assert (tree.features[0], tree.thresholds[0]) == best
    node = np.zeros(400, int)
    for _ in range(url_filter.DEPTH):
        node = 2 * node + 1 + (x[np.arange(400), tree.features[node]] > tree.thresholds[node])
    for leaf in np.unique(node):
        rows = node == leaf
        assert np.isclose(tree.leaves[leaf - 15], -url_filter.RATE * g[rows].sum() / (h[rows].sum() + 1))


def test_held_out_accuracy_on_learnable_urls(spark):
    """Hosts with digits and long parameters are blocked by rules; the same kind elsewhere is found."""
    good = [(i, f"https://site{'abcdef'[i % 6]}.good.org/articles/{'xyz'[i % 3]}/page.html") for i in range(300)]
    bad = [(i, f"http://x{i * 7919}-{i}.bad.com/{i * 104729}?a={i}&b={i * 31}&c=1") for i in range(300)]
    rules = [Rule("good.org", "/", False), Rule("bad.com", "/", True)]
    model = url_filter.train(spark.createDataFrame(good + bad, "id int, url string"), rules)
    new = [(0, "https://siteb.fine.net/articles/y/page.html"), (1, "http://x55433-7.other.net/733103?a=7&b=217&c=1")]
    judged = url_filter.judge(spark.createDataFrame(new, "id int, url string"), rules, model)
    assert [r.verdict for r in judged.orderBy("id").collect()] == ["allow", "block"]
