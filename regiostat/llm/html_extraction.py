"""Main text of web pages by a tree-structured graphical model.

Every DOM node has a hidden state: clutter, content or mixed (a container of
both).  Node potentials are a log-linear function of the node's tag, of what
its class, id and role say, and of its text and links; parent-child potentials
tie the states along the tree.  Sum-product message passing, once upward and
once downward, gives the exact marginals of all nodes; text of nodes whose
content marginal is at least one half is the main text.

Training: at most ``sample`` pages (least hash of the id; the only bound) that
mark their main element (one ``article``, ``main`` or the like) label their
own nodes.  Node potentials are the maximum a posteriori fit around stated
prior weights, so what the labelled pages never show keeps its prior;
parent-child potentials are counts added to pseudo-counts.  Every labelled page
adds the same evidence, without a bound.  Only sums over equal node descriptions
leave the tasks.

Results: one row per page.  Null or empty html gives an empty text.  Whole
pages of any length are read.  Repeated rows give repeated rows; empty tables
give empty results; other columns are not read.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regiostat.llm.common import batch, map_rows
from regiostat.llm.html_tree import Node, read

CLUTTER, CONTENT, MIXED = 0, 1, 2

# What names of classes, ids and roles say (parts between other characters).
HINTS = {
    "menu": "nav navbar navigation menu menubar breadcrumb breadcrumbs pagination pager toc topbar toolbar skip",
    "foot": "footer foot colophon copyright legal contentinfo disclaimer",
    "head": "masthead banner siteheader header topnav logo",
    "side": "sidebar aside rail widget widgets complementary secondary tagcloud",
    "notice": "cookie cookies consent gdpr notice notices alert popup modal overlay dialog toast paywall message warning",
    "advert": "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promoted promotion banner_ad adsense adbox adslot outbrain taboola",
    "form": "form search searchbox signup signin login subscribe subscription newsletter register contact",
    "talk": "comment comments commentlist discussion disqus replies reply respond reviews",
    "share": "share sharing social follow like related recommended recommendations more trending popular readmore",
    "hidden": "hidden invisible offscreen sronly",
    "main": "article articlebody content main post entry story body text maincontent postbody entrycontent page",
    "heading": "title headline subtitle heading",
}
_HINT = {word: hint for hint, words in HINTS.items() for word in words.split()}
GOOD = {"main", "heading"}

# Prior weights (clutter, content, mixed) of the features.
PRIOR = {
    "tag:nav": (6, -5, -2), "tag:aside": (6, -5, -2), "tag:footer": (6, -5, -2), "tag:header": (1.5, -0.5, -0.5), "tag:form": (6, -5, -2), "tag:control": (6, -5, -3),
    "tag:article": (-3, 4, 0), "tag:main": (-3, 4, 1.5), "tag:page": (-4, -6, 8), "tag:body": (-4, -2, 6), "tag:head": (6, -6, -4), "tag:div": (0, 0, 0.5), "tag:section": (0, 0.5, 0.3),
    "tag:p": (0, 1, -2), "tag:h1": (0, 1, -2), "tag:heading": (0, 0.5, -2), "tag:list": (0.3, 0, -1), "tag:quote": (0, 1, -2), "tag:table": (0, 0, -1), "tag:dialog": (4, -4, -2),
    "name:menu": (7, -5, -2), "name:foot": (6, -4, -2), "name:head": (3, -1.5, -1), "name:side": (7, -5, -2), "name:notice": (7, -5, -2), "name:advert": (8, -6, -3),
    "name:form": (6, -5, -2), "name:talk": (10, -8, -4), "name:share": (6, -4, -2), "name:hidden": (8, -6, -3), "name:main": (-2, 3, 1.5), "name:heading": (0, 0.7, 0),
    "own:none": (0, 0, 1), "own:short": (0.5, 0, -1), "own:some": (0, 0.5, -1.5), "own:long": (-0.5, 1.5, -2), "own:very long": (-1.5, 2.5, -2), "own:sentence": (0, 0.7, 0),
    "links:own": (2.5, -1, -0.5), "links:below": (2, -0.5, 0), "below:long": (-0.5, 0.5, 0.5), "says:copyright": (4, -2, -1), "always": (0, 0, 0),
}
FEATURES = {name: i for i, name in enumerate(PRIOR)}
_TAGS = {"button": "control", "select": "control", "option": "control", "optgroup": "control", "label": "control", "output": "control", "datalist": "control", "legend": "control",
         "fieldset": "form", "search": "form", "#page": "page", "html": "page", "h2": "heading", "h3": "heading", "h4": "heading", "h5": "heading", "h6": "heading", "hgroup": "heading",
         "ul": "list", "ol": "list", "li": "list", "dl": "list", "dt": "list", "dd": "list", "menu": "list", "dir": "list", "blockquote": "quote", "pre": "quote", "figure": "quote",
         "figcaption": "quote", "table": "table", "tr": "table", "td": "table", "th": "table", "tbody": "table", "thead": "table", "tfoot": "table", "caption": "table"}
# Pseudo-counts of (parent state, child state).
PAIRS = np.array([[400.0, 0.2, 0.2], [6.0, 100.0, 0.2], [20.0, 16.0, 12.0]])

_PARTS = re.compile(r"[a-z]+")
_SENTENCE = re.compile(r"[.!?。！？](?:\s|$)")


def hints(names: dict[str, str]) -> set[str]:
    found = set()
    for key, said in names.items():
        if key in ("hidden",) or (key == "aria-hidden" and said == "true") or (key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", said)):
            found.add("hidden")
        elif key in ("class", "id", "role", "itemprop", "aria-label"):
            for name in said.split():
                parts = _PARTS.findall(name)
                found.update(_HINT[p] for p in (*parts, "".join(parts)) if p in _HINT)
    if found & GOOD and found - GOOD:
        # "article-footer", "post-comments": the clutter word is the noun
        found -= {"main"}
    return found


def is_clutter(names: dict[str, str]) -> bool:
    return bool(hints(names) - GOOD)


def describe(nodes: list[Node], runs: list[tuple[int, bool, str]]) -> list[tuple[int, ...]]:
    """Feature numbers of every node."""
    n = len(nodes)
    below, linked = [x.chars for x in nodes], [x.links for x in nodes]
    for i in range(n - 1, 0, -1):
        below[nodes[i].parent] += below[i]
        linked[nodes[i].parent] += linked[i]
    said: dict[int, set[str]] = {}
    for node, _, text in runs:
        if "©" in text or "opyright" in text:
            said.setdefault(node, set()).add("says:copyright")
        if _SENTENCE.search(text):
            said.setdefault(node, set()).add("own:sentence")
    out = []
    for i, x in enumerate(nodes):
        f = {"always"}
        tag = f"tag:{_TAGS.get(x.tag, x.tag)}"
        if tag in FEATURES:
            f.add(tag)
        if x.names:
            f.update(f"name:{h}" for h in hints(x.names))
        own = x.chars
        f.add("own:none" if not own else "own:short" if own < 25 else "own:some" if own < 80 else "own:long" if own < 300 else "own:very long")
        if own and 2 * x.links > own:
            f.add("links:own")
        if below[i] and 2 * linked[i] > below[i]:
            f.add("links:below")
        if below[i] >= 300:
            f.add("below:long")
        f |= said.get(i, set())
        out.append(tuple(sorted(FEATURES[k] for k in f)))
    return out


def own_labels(nodes: list[Node]) -> list[int] | None:
    """States that a page's own markup gives its nodes: None unless it marks
    exactly one main element.  Within it, elements that HTML itself sets apart are
    clutter; one that only a name calls so is clutter as well, unless it holds
    most of the main element's unlinked text: then the name misleads."""
    mains = [i for i, x in enumerate(nodes) if x.tag in ("article", "main") or x.names.get("role") == "main" or "articlebody" in x.names.get("itemprop", "")]
    end, prose = list(range(len(nodes))), [x.chars - x.links for x in nodes]
    for i in range(len(nodes) - 1, 0, -1):  # nodes come in page order: a subtree is a range
        end[nodes[i].parent] = max(end[nodes[i].parent], end[i])
        prose[nodes[i].parent] += prose[i]
    tops: list[int] = []
    for i in mains:
        if not tops or i > end[tops[-1]]:
            tops.append(i)
    if len(tops) != 1:
        return None
    # the innermost single main element within
    root = tops[0]
    while len(inner := [i for i in mains if root < i <= end[root]]) == 1:
        root = inner[0]
    state = [CLUTTER] * len(nodes)
    state[root] = CONTENT
    for i in range(root + 1, end[root] + 1):
        x = nodes[i]
        if state[x.parent] == CONTENT:
            cut = x.tag in ("nav", "aside", "footer", "form", "dialog") or _TAGS.get(x.tag) in ("control", "form") or (x.names and is_clutter(x.names) and 2 * prose[i] <= prose[root])
            state[i] = CLUTTER if cut else CONTENT
    up = nodes[root].parent
    while up >= 0:
        state[up], up = MIXED, nodes[up].parent
    return state


@dataclass
class Model:
    weight: np.ndarray  # feature x state
    pair: np.ndarray    # log potentials (parent state, child state)


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis=axis)) + top.squeeze(axis)


def marginals(potential: np.ndarray, parent: np.ndarray, depth: np.ndarray, pair: np.ndarray) -> np.ndarray:
    """State marginals of all nodes of a forest (parent -1: a root).  The
    messages of all nodes of a depth are computed together."""
    order = np.argsort(depth, kind="stable")
    levels = np.split(order, np.searchsorted(depth[order], np.arange(1, (depth.max() if len(depth) else 0) + 1)))
    up, sent = potential.copy(), np.zeros_like(potential)
    for level in reversed(levels[1:]):
        sent[level] = _logsum(up[level][:, None, :] + pair[None], 2)
        np.add.at(up, parent[level], sent[level])
    belief = up.copy()
    for level in levels[1:]:
        rest = belief[parent[level]] - sent[level]
        belief[level] = up[level] + _logsum(rest[:, :, None] + pair[None], 1)
    return np.exp(belief - _logsum(belief, 1)[:, None])


def _read_pages(html: pa.Array):
    """Nodes, runs and features of the pages of a column."""
    for h in html:
        nodes, runs = read(h.as_py() or "", is_clutter)
        yield nodes, runs, describe(nodes, runs)


def train(pages: DataFrame, sample: int = 2_000, id_col: str = "page_id", html_col: str = "html", spread: float = 1.0, unit: float = 2.0, steps: int = 300, rate: float = 0.1) -> Model:
    """Fit on the pages of a bounded sample that label themselves; a page weighs
    ``unit`` against the prior (of variance ``spread`` squared), so what many pages
    show outweighs it."""
    ids = pages.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("i")).distinct().orderBy(F.xxhash64("i"), "i").limit(sample)
    rows = pages.select(F.col(id_col).alias("i"), F.col(html_col).alias("h")).join(F.broadcast(ids), "i", "left_semi")

    def tally(part: pa.RecordBatch):
        seen: dict[tuple[str, int], int] = {}
        for nodes, _, features in _read_pages(part["h"]):
            state = own_labels(nodes)
            if state is None:
                continue
            seen["page", 0] = seen.get(("page", 0), 0) + 1
            for x, s, f in zip(nodes, state, features):
                for key in ((" ".join(map(str, f)), s), *([("pair", 3 * state[x.parent] + s)] if x.parent >= 0 else [])):
                    seen[key] = seen.get(key, 0) + 1
        yield batch(what=pa.array([k for k, _ in seen], pa.string()), state=pa.array([s for _, s in seen], pa.int64()), n=pa.array(list(seen.values()), pa.int64()))

    found = map_rows(rows, tally, "what string, state bigint, n bigint").groupBy("what", "state").agg(F.sum("n").alias("n")).orderBy("what", "state").toPandas()
    # nodes of a page are no independent witnesses: together they weigh ``unit``
    weight_of_all = unit * float(found[found.what == "page"].n.sum())
    pairs, found = found[found.what == "pair"], found[~found.what.isin(["pair", "page"])]
    seen = np.zeros((3, 3))
    for s, n in zip(pairs.state, pairs.n):
        seen[int(s) // 3, int(s) % 3] += n
    counts = PAIRS + seen * weight_of_all / max(1.0, seen.sum())
    mean = np.array(list(PRIOR.values()), dtype=float)
    weight = mean.copy()
    if len(found):
        x = np.zeros((len(found), len(mean)))
        for row, what in enumerate(found.what):
            x[row, [int(i) for i in what.split()]] = 1
        y = np.eye(3)[found.state.to_numpy().astype(int)]
        n = found.n.to_numpy(dtype=float)
        n = n / n.sum() * weight_of_all
        first, second = np.zeros_like(weight), np.zeros_like(weight)
        for step in range(1, steps + 1):
            z = x @ weight
            p = np.exp(z - _logsum(z, 1)[:, None])
            g = x.T @ ((p - y) * n[:, None]) + (weight - mean) / spread ** 2
            first += 0.1 * (g - first)
            second += 0.01 * (g * g - second)
            weight -= rate / np.sqrt(step) * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.99 ** step)) + 1e-8)
    return Model(weight, np.log(counts / counts.sum(axis=1, keepdims=True)))


def extract(pages: DataFrame, model: Model, id_cols: tuple[str, ...] = ("page_id", "url"), html_col: str = "html") -> DataFrame:
    """``id columns, text`` of every page."""
    shared = pages.sparkSession.sparkContext.broadcast(model)

    def run(rows: pa.RecordBatch):
        model, step = shared.value, 64
        for start in range(0, rows.num_rows, step):
            part = rows.slice(start, step)
            parent, depth, features, first, every = [], [], [], [0], []
            for nodes, runs, described in _read_pages(part["h"]):
                base = first[-1]
                parent += [x.parent + base if x.parent >= 0 else -1 for x in nodes]
                depth += [x.depth for x in nodes]
                features += described
                first.append(base + len(nodes))
                every.append(runs)
            ends = np.cumsum([len(f) for f in features])
            potential = np.add.reduceat(model.weight[np.concatenate([np.array(f) for f in features])], np.concatenate([[0], ends[:-1]]), axis=0)
            content = marginals(potential, np.array(parent), np.array(depth), model.pair)[:, CONTENT] >= 0.5
            yield pa.RecordBatch.from_arrays([*(part[c] for c in id_names), pa.array([_text(runs, content[base:]) for runs, base in zip(every, first)], pa.string())], names=[*id_names, "text"])

    id_names = [f"c{i}" for i in range(len(id_cols))]
    types = ", ".join(f"{a} {pages.schema[c].dataType.simpleString()}" for a, c in zip(id_names, id_cols))
    out = map_rows(pages.select(*[F.col(c).alias(a) for a, c in zip(id_names, id_cols)], F.col(html_col).alias("h")), run, f"{types}, text string")
    return out.toDF(*id_cols, "text")


def _text(runs: list[tuple[int, bool, str]], content: np.ndarray) -> str:
    """Blocks of content runs; white space inside a block becomes one blank."""
    blocks, block, broken = [], [], False
    for node, new_block, raw in runs:
        broken |= new_block
        if content[node]:
            if broken and block:
                blocks.append("".join(block))
                block = []
            broken = False
            block.append(raw)
    blocks.append("".join(block))
    return " ".join(" ".join(b.split()) for b in blocks if b.strip())
