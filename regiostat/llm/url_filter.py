"""URL filter: rules first, gradient-boosted trees on lexical features for the rest.

Features of a URL: lengths (url, host, path), depth, host labels, host hyphens,
digit ratio, ratio of other signs, parameter count, entropy of its characters,
and for the host's last one, two and three labels the smoothed share of blocked
URLs among the labelled ones with that suffix.

Training.  Suffix counts cover all labelled URLs (``host`` sums first, then
suffixes, so a frequent suffix is summed per task).  A labelled URL must not see
its own label: it gets the counts of the other folds (a URL's fold is its crc32).
Trees are fitted on a sample of at most about ``max_rows`` labelled URLs (by hash
of the URL, so reruns agree), binned at exact quantiles.  Every level of every
tree is one aggregate job, whose result (nodes x features x bins) gives the best
split of each node by the second-order gain.  Gradients are summed as whole
numbers, so the order of rows changes nothing.

Scoring is one projection: the trees become CASE expressions over a struct of
features that is computed once per row.  Statistics come by a join on the host.

Results: one row per page.  A null URL, or one without ``://``, has an empty host and
path, fits no rule and is scored by its features (null: those of the empty
text).  Repeated rows give repeated rows; an empty table gives an empty result.
Without labels, or with labels of one kind, there are no trees and the verdict
is that of the labels' majority (none: allow).  Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regiostat.llm.common import LOWER, UPPER
from regiostat.session import materialize

FEATURES = ("url_length", "host_length", "path_length", "depth", "labels", "hyphens", "digits", "signs", "parameters", "entropy", "suffix1", "suffix2", "suffix3")
SUFFIXES = 3
#: Gradients are summed in steps of this size.
_STEP = 1 << 24


@dataclass(frozen=True)
class Rule:
    """``place`` is a host and the beginning of a path, like ``example.org/a/``."""
    verdict: str
    place: str

    @property
    def host(self) -> str:
        return self.place[:self.place.index("/")]

    @property
    def path(self) -> str:
        return self.place[self.place.index("/"):]


@dataclass(frozen=True)
class Settings:
    trees: int = 10
    depth: int = 3
    rate: float = 0.4
    bins: int = 16
    least_weight: float = 1.0     # second derivatives on either side of a split
    ridge: float = 1.0
    least_gain: float = 1e-3
    smoothing: float = 5.0        # labelled URLs that the prior of a suffix counts as
    folds: int = 5
    max_rows: int = 200_000


@dataclass
class Tree:
    """``splits[node]`` is (feature, threshold), left if at most that; node
    ``i`` has the children ``2 i + 1`` and ``2 i + 2``; ``leaves[node]`` a value."""
    splits: dict[int, tuple[int, float]] = field(default_factory=dict)
    leaves: dict[int, float] = field(default_factory=dict)

    def fold(self, value, choose, node: int = 0):
        """The tree as nested choices: ``choose(feature, threshold, left, right)``."""
        if node in self.splits:
            f, most = self.splits[node]
            return choose(f, most, self.fold(value, choose, 2 * node + 1), self.fold(value, choose, 2 * node + 2))
        return value(node)


@dataclass
class Model:
    base: float
    trees: list[Tree]
    hosts: DataFrame | None       # host, stats: blocked shares by suffix and fold (0: no fold left out)
    prior: float

    def margin(self, x: Column) -> Column:
        """Log-odds of blocked, of a struct of features."""
        total = F.lit(self.base)
        for tree in self.trees:
            total = total + tree.fold(lambda n, t=tree: F.lit(t.leaves[n]), lambda f, most, left, right: F.when(x[FEATURES[f]] <= most, left).otherwise(right))
        return total


def host_path(url: Column) -> tuple[Column, Column]:
    at = F.locate("://", F.coalesce(url, F.lit("")))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    return (F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER), F.regexp_extract(rest, r"^[^/?#]*+([^?#]*)", 1))


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict (null: none fits)."""
    place, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.place), len(r.host))):  # the last that fits wins
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        place, verdict = F.when(fits, F.lit(r.place)).otherwise(place), F.when(fits, F.lit(r.verdict)).otherwise(verdict)
    return place, verdict


def suffix(host: Column, labels: int) -> Column:
    """The host's last labels; with fewer, the host itself after a mark."""
    parts = F.split(host, r"\.")
    return F.when(F.size(parts) >= labels, F.array_join(F.slice(parts, -labels, labels), ".")).otherwise(F.concat(F.lit("^"), host))


def entropy(text: Column) -> Column:
    """Bits per character, from the runs of equal characters of the sorted text."""
    chars = F.array_join(F.array_sort(F.split(text, "")), "")
    runs = F.transform(F.regexp_extract_all(chars, F.lit(r"(?s)(.)\1*+"), F.lit(0)), lambda r: F.length(r).cast("double"))
    n = F.length(text).cast("double")
    return F.when(n > 0, F.log2(n) - F.aggregate(runs, F.lit(0.0), lambda a, c: a + c * F.log2(c)) / n).otherwise(0.0)


def features(url: Column, host: Column, path: Column, stats: Column, fold: Column) -> Column:
    u = F.coalesce(url, F.lit(""))
    n = F.greatest(F.lit(1), F.length(u))
    query = F.regexp_extract(u, r"\?([^#]*)", 1)
    count = lambda c, pattern: F.regexp_count(c, F.lit(pattern)).cast("double")
    values = [F.length(u).cast("double"), F.length(host).cast("double"), F.length(path).cast("double"), count(path, "[^/]+"), count(host, "[^.]+"), count(host, "-"),
              count(u, "[0-9]") / n, count(u, "[^A-Za-z0-9]") / n, count(query, "[^&]+"), entropy(u), *(F.get(F.get(stats, F.lit(k)), fold) for k in range(SUFFIXES))]
    return F.struct(*[v.alias(name) for v, name in zip(values, FEATURES)])


def host_statistics(urls: DataFrame, labelled: DataFrame, prior: float, s: Settings) -> DataFrame:
    """``host, stats`` of every host of ``urls``: for each suffix length the
    blocked share without any fold left out, then without each fold."""
    per_host = labelled.groupBy("host", "fold").agg(F.sum(F.col("y")).alias("b"), F.count(F.lit(1)).alias("n"))
    kinds = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), suffix(F.col("host"), k + 1).alias("s")) for k in range(SUFFIXES)])).alias("x")
    sums = [F.sum(F.when(F.col("fold") == f, F.col(c)).otherwise(0)).alias(f"{c}{f}") for c in "bn" for f in range(s.folds)]
    counts = per_host.select("b", "n", "fold", kinds).groupBy("x").agg(F.sum("b").alias("b"), F.sum("n").alias("n"), *sums)
    share = lambda b, n: (b + s.smoothing * prior) / (n + s.smoothing)
    shares = F.array(share(F.col("b"), F.col("n")), *[share(F.col("b") - F.col(f"b{f}"), F.col("n") - F.col(f"n{f}")) for f in range(s.folds)])
    counts = counts.select("x", shares.alias("shares"))
    hosts = urls.groupBy("host").agg(F.lit(1).alias("one")).select("host", kinds)
    unknown = F.array(*[F.lit(prior)] * (1 + s.folds))
    joined = hosts.join(counts, "x", "left").select("host", F.struct(F.col("x.k").alias("k"), F.coalesce("shares", unknown).alias("shares")).alias("v"))
    return joined.groupBy("host").agg(F.transform(F.array_sort(F.collect_list("v")), lambda v: v["shares"]).alias("stats"))  # three rows a host


def best_splits(sums: list[tuple], edges: list[list[float]], s: Settings) -> tuple[dict[int, tuple], dict[int, tuple[float, float]]]:
    """Of rows (node, feature, bin, gradient, weight): the best split of each
    node with its sums left and right, and the sums of each node."""
    table: dict[int, dict[int, dict[int, tuple[float, float]]]] = {}
    for node, f, b, g, h in sums:
        table.setdefault(node, {}).setdefault(f, {})[b] = (g / _STEP, h / _STEP)
    best, whole = {}, {}
    for node, by_feature in table.items():
        g_all, h_all = (sum(x[i] for x in by_feature[0].values()) for i in (0, 1))
        whole[node] = (g_all, h_all)
        gain = lambda g, h: g * g / (h + s.ridge)
        for f in sorted(by_feature):
            g = h = 0.0
            for b in sorted(by_feature[f])[:-1]:
                g, h = g + by_feature[f][b][0], h + by_feature[f][b][1]
                if min(h, h_all - h) < s.least_weight:
                    continue
                won = gain(g, h) + gain(g_all - g, h_all - h) - gain(g_all, h_all)
                if won > s.least_gain and (node not in best or won > best[node][0] + 1e-9):
                    best[node] = (won, f, edges[f][b], (g, h), (g_all - g, h_all - h))
    return best, whole


def grow(rows: DataFrame, edges: list[list[float]], base: float, s: Settings) -> list[Tree]:
    """Boosted trees over ``rows(bins, y, n)``: binned features, label, number."""
    def where(tree: Tree, value) -> Column:
        bin_of = lambda f, most: F.col("bins")[f] <= edges[f].index(most)
        return tree.fold(lambda n: F.lit(value(n)), lambda f, most, left, right: F.when(bin_of(f, most), left).otherwise(right))

    trees: list[Tree] = []
    margin = F.lit(base)
    for _ in range(s.trees):
        p = F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("margin")))
        scored = materialize(rows.withColumn("margin", margin).select("bins", "y", "n", F.round((F.col("y") - p) * _STEP).cast("bigint").alias("g"), F.round(p * (1 - p) * _STEP).cast("bigint").alias("h")), "gradients")
        tree, ends = Tree(), {}
        for level in range(s.depth):
            at = scored.select(where(tree, lambda n: n).alias("node"), (F.col("g") * F.col("n")).alias("g"), (F.col("h") * F.col("n")).alias("h"), F.posexplode("bins").alias("f", "bin"))
            sums = at.where(F.col("node") >= (1 << level) - 1).groupBy("node", "f", "bin").agg(F.sum("g"), F.sum("h")).collect()  # nodes x features x bins
            best, whole = best_splits([tuple(r) for r in sums], edges, s)
            if level == 0:
                ends.update(whole)
            for node, (_, f, most, left, right) in best.items():
                tree.splits[node] = (f, most)
                ends[2 * node + 1], ends[2 * node + 2] = left, right
            if not best:
                break
        if not tree.splits:
            break
        tree.leaves = {n: s.rate * g / (h + s.ridge) for n, (g, h) in ends.items() if n not in tree.splits}
        trees.append(tree)
        margin = margin + where(tree, lambda n, t=tree: t.leaves[n])
    return trees


def train(urls: DataFrame, labelled: DataFrame, settings: Settings = Settings()) -> Model:
    """A model from ``labelled(url, blocked)``, and statistics of every host
    of ``urls(url)``."""
    s = settings

    def parsed(df: DataFrame, *more: Column) -> DataFrame:
        host, path = host_path(F.col("url"))
        return df.select("url", host.alias("host"), path.alias("path"), *more)

    rows = parsed(labelled.where(F.col("blocked").isNotNull()), F.col("blocked").cast("int").alias("y"), (F.crc32(F.coalesce("url", F.lit("")).cast("binary")) % s.folds).cast("int").alias("fold"))
    n, blocked = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("y"), F.lit(0))).first()
    prior = blocked / n if n else 0.0
    base = math.log((blocked + 1) / (n - blocked + 1)) if n else -1.0
    if blocked in (0, n):
        return Model(base, [], None, prior)
    hosts = materialize(host_statistics(parsed(urls), rows, prior, s), "hosts")
    share = min(1.0, s.max_rows / n)
    sample = rows.where(F.pmod(F.xxhash64("url"), F.lit(1 << 20)) < math.ceil(share * (1 << 20)))
    x = features(F.col("url"), F.col("host"), F.col("path"), F.col("stats"), F.col("fold") + 1)
    sample = materialize(sample.join(hosts, "host").select(x.alias("x"), "y"), "sample")
    cuts = [k / s.bins for k in range(1, s.bins)]
    found = sample.agg(*[F.percentile(F.col("x")[f], F.array(*[F.lit(c) for c in cuts])) for f in FEATURES]).first()
    edges = [sorted(set(v or [])) for v in found]
    bins = F.array(*[sum((F.when(F.col("x")[f] > e, 1).otherwise(0) for e in edges[k]), F.lit(0)) for k, f in enumerate(FEATURES)])
    edges = [[*e, math.inf] for e in edges]
    binned = materialize(sample.select(bins.alias("bins"), "y").groupBy("bins", "y").agg(F.count(F.lit(1)).alias("n")), "binned")
    return Model(base, grow(binned, edges, base, s), hosts, prior)


def judge(pages: DataFrame, rules: Sequence[Rule], model: Model, id_col: str = "page_id", url_col: str = "url", threshold: float = 0.5) -> DataFrame:
    """``id, host, path, rule, verdict, score`` of every page."""
    host, path = host_path(F.col(url_col))
    rows = pages.select(F.col(id_col), F.col(url_col).alias("u"), host.alias("host"), path.alias("path"))
    if model.hosts is not None:
        rows = rows.join(model.hosts, "host", "left")
    unknown = F.array(*[F.array(F.lit(model.prior))] * SUFFIXES)
    stats = F.coalesce("stats", unknown) if model.hosts is not None else unknown
    x = features(F.col("u"), F.col("host"), F.col("path"), stats, F.lit(0))
    margin = F.get(F.transform(F.array(x), model.margin), F.lit(0))  # the variable holds the features once
    place, verdict = rule_of(F.col("host"), F.col("path"), rules)
    score = F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))
    rows = rows.select(id_col, "host", "path", place.alias("rule"), verdict.alias("ruled"), score.alias("score"))
    return rows.select(id_col, "host", "path", "rule", F.coalesce("ruled", F.when(F.col("score") >= threshold, "block").otherwise("allow")).alias("verdict"), "score")


def filter_urls(pages: DataFrame, rules: Sequence[Rule], settings: Settings = Settings(), id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """Pages judged by rules, and where none fits by trees that learned from
    the URLs which the rules judge."""
    host, path = host_path(F.col("url"))
    urls = pages.select(F.col(url_col).alias("url"))
    labelled = urls.select("url", (rule_of(host, path, rules)[1] == "block").alias("blocked")).where(F.col("blocked").isNotNull())
    return judge(pages, rules, train(urls, labelled, settings), id_col, url_col)
