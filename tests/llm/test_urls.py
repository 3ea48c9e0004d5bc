"""The URL filter: rules and features against plain code, trees against
exhaustive search, held-out accuracy."""

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from regiostat.llm import url_filter
from regiostat.llm.url_filter import FEATURES, Rule, Settings, Tree, best_splits, filter_urls, host_path, judge, train

RULES = [Rule("block", "net/"), Rule("allow", "example.net/en/"), Rule("block", "example.com/de/"), Rule("allow", "org/fr/")]
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def parse(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url[url.index("://") + 3:]
    host = re.match(r"[^/?#]*", rest)[0]
    return host.translate(LOWER), re.match(r"[^?#]*", rest[len(host):])[0]


def ruled(host, path):
    fit = [r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fit, key=lambda r: len(r.place), default=None)


URLS = ["https://www.Example.NET/en/1", "http://example.net/EN/1", "http://badnet/x", "ftp://net/", "ftp://net", "a.net/en/", "https://x.example.com/de/1?a=b&c=d#top", "https://example.com?u=http://net/",
        "http://org/fr/", "http://my.org/fr", "http://my.org/fr/#?", "HTTP://É.NET/ö//", "", None, "://", "http://net\n/x", "x" * 20_000 + "://a.net/" + "7" * 20_000, "http://example.com/en/" + "😀é" * 300]


def test_hosts_paths_rules(spark):
    pages = spark.createDataFrame([(k, u, 1, "x", "y") for k, u in enumerate(URLS + URLS[:2])] + [(None, "http://a.com/de/", 1, "x", "y")], "page_id long, url string, score long, host string, fold string")
    got = sorted((tuple(r) for r in filter_urls(pages, RULES).select("page_id", "host", "path", "rule", "verdict").collect()), key=str)
    assert len(got) == len(URLS) + 3
    want = {k: (parse(u), ruled(*parse(u))) for k, u in enumerate(URLS + URLS[:2])} | {None: (parse("http://a.com/de/"), None)}
    for k, host, path, rule, verdict in got:
        assert (host, path) == want[k][0]
        assert rule == (want[k][1].place if want[k][1] else None)
        assert verdict == want[k][1].verdict if want[k][1] else verdict in ("allow", "block")
    assert filter_urls(pages.limit(0), RULES).collect() == []


def test_features(spark):
    df = spark.createDataFrame([(u,) for u in URLS], "u string")
    host, path = host_path(F.col("u"))
    stats = F.array(*[F.array(F.lit(0.25))] * 3)
    rows = df.select("u", url_filter.features(F.col("u"), host, path, stats, F.lit(0)).alias("x")).collect()
    for u, x in rows:
        (host, path), u = parse(u), u or ""
        n = max(1, len(u))
        query = re.search(r"\?([^#]*)", u)
        entropy = -sum(c / n * math.log2(c / n) for c in Counter(u).values())
        want = [len(u), len(host), len(path), len(re.findall("[^/]+", path)), len(re.findall("[^.]+", host)), host.count("-"), len(re.findall("[0-9]", u)) / n, len(re.findall("[^A-Za-z0-9]", u)) / n,
                len(re.findall("[^&]+", query[1])) if query else 0, entropy, 0.25, 0.25, 0.25]
        assert x == pytest.approx(want, abs=1e-9), u[:50]


def test_best_split_is_the_best():
    rng = random.Random(4)
    rows = [([rng.randrange(4) for _ in range(3)], rng.uniform(-1, 1), rng.random()) for _ in range(300)]
    sums = Counter(), Counter()
    for x, g, h in rows:
        for f, b in enumerate(x):
            sums[0][f, b] += g * url_filter._STEP
            sums[1][f, b] += h * url_filter._STEP
    s = Settings()
    gain = lambda part: sum(g for _, g, _ in part) ** 2 / (sum(h for *_, h in part) + s.ridge)
    tried = {(f, b): gain([r for r in rows if r[0][f] <= b]) + gain([r for r in rows if r[0][f] > b]) - gain(rows) for f in range(3) for b in range(3)}
    best, _ = best_splits([(0, f, b, g, sums[1][f, b]) for (f, b), g in sums[0].items()], [[0, 1, 2, math.inf]] * 3, s)
    won, f, most, left, right = best[0]
    assert won == pytest.approx(max(tried.values())) and tried[f, most] == pytest.approx(won)


def spam(rng, bad):
    host = f"{'win-free-' if bad and rng.random() < 0.5 else ''}site{rng.randrange(30)}.{'click' if bad else rng.choice(['com', 'org'])}"
    if rng.random() < 0.1:
        host = f"site{rng.randrange(30)}.{rng.choice(['com', 'org', 'click'])}"
    tail = "".join(rng.choice("0123456789abcdef") for _ in range(30)) + "?a=1&b=2&c=3" if bad else "/".join(rng.choice(["news", "sport", "week"]) for _ in range(3))
    return f"https://{host}/{tail}"


def test_held_out_accuracy_and_same_trees_again(spark):
    rng = random.Random(8)
    rows = [(k, spam(rng, k % 3 == 0), k % 3 == 0) for k in range(3000)]
    df = spark.createDataFrame(rows, "page_id long, url string, blocked boolean")
    known = df.where("page_id % 2 = 0").select("url", "blocked")
    model = train(df.select("url"), known, Settings(trees=4))
    got = judge(df.where("page_id % 2 = 1"), [], model).join(df.select("page_id", "blocked"), "page_id").collect()
    assert sum((r.verdict == "block") == r.blocked for r in got) > 0.97 * len(got)
    again = train(df.repartition(5).select("url"), known.repartition(7), Settings(trees=4))
    assert model.trees == again.trees and len(model.trees) == 4
    # scores of the plan against the trees walked by hand
    host, path = host_path(F.col("url"))
    joined = df.select("page_id", "url", host.alias("host"), path.alias("path")).join(model.hosts, "host")
    x = {r[0]: r[1] for r in joined.select("page_id", url_filter.features(F.col("url"), F.col("host"), F.col("path"), F.col("stats"), F.lit(0))).collect()}

    def walk(tree: Tree, v, node=0):
        while node in tree.splits:
            f, most = tree.splits[node]
            node = 2 * node + (1 if v[FEATURES[f]] <= most else 2)
        return tree.leaves[node]

    for r in got[:200]:
        margin = model.base + sum(walk(t, x[r.page_id]) for t in model.trees)
        assert r.score == pytest.approx(1 / (1 + math.exp(-margin)))


def test_labels_of_one_kind(spark):
    df = spark.createDataFrame([(1, "http://a.com/"), (2, None)], "page_id long, url string")
    for blocked, verdict in ((True, "block"), (False, "allow")):
        model = train(df.select("url"), df.select("url", F.lit(blocked).alias("blocked")))
        assert {r.verdict for r in judge(df, [], model).collect()} == {verdict}
    assert {r.verdict for r in judge(df, [], train(df.select("url"), df.select("url", F.lit(None).cast("boolean").alias("blocked")))).collect()} == {"allow"}
