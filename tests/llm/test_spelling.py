"""Spelling variants against a comparison of all pairs of words."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from llm_helpers import LOWER, as_docs
from regiostat.llm.spelling_variants import near_in, variants


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    a, b = sorted((a, b), key=len)
    p = next((i for i in range(len(a)) if a[i] != b[i]), len(a))
    return a[p:] == b[p + 1:] if len(a) < len(b) else a[p + 1:] == b[p + 1:]


def naive(rows, every=97):
    count = Counter()
    for d, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            if h % every == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            count[run] += 1
    n = {w: c for w, c in count.items() if len(w) >= 5 and c >= 3}
    others = {w: [v for v in n if near(w, v)] for w in n}
    form = {}
    for w, vs in others.items():
        best = min(vs, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(others[w]), n[form[w]] if form[w] else None))
    return sorted(out, key=str)


def corpus(seed, docs, letters="abcé"):
    rng = random.Random(seed)
    stems = ["".join(rng.choice(letters) for _ in range(rng.randint(4, 9))) for _ in range(60)]
    weights = [1 / (i + 1) for i in range(60)]
    rows = []
    for d in range(docs):
        out = []
        for w in rng.choices(stems, weights, k=120):
            if rng.random() < 0.2:
                i = rng.randrange(len(w))
                w = rng.choice([w[:i] + w[i + 1:], w[:i] + rng.choice(letters) + w[i:], w[:i] + rng.choice(letters) + w[i + 1:]])
            out.append(w.upper() if rng.random() < 0.1 else w)
        rows.append((d, " ".join(out)))
    return rows


def got(df):
    return sorted([tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()], key=str)


@pytest.mark.parametrize("block_words", [4096, 8])
def test_against_all_pairs(spark, block_words):
    rows = corpus(3, 80)
    assert got(variants(as_docs(spark, rows), block_words=block_words)) == naive(rows)


def test_odd_rows(spark, odd, odd_rows, none):
    assert got(variants(odd)) == naive([(r[0], r[1]) for r in odd_rows])
    assert got(variants(none)) == []
    long = "y" * 3000
    rows = [(None, "words Words WORDS wordz wordz wordz"), (1, None), (2, ""), (3, "aaaaa×÷ÿ " * 3), (4, f"{long} {long}x {long[:-1]} " * 3), (4, f"{long} {long}x {long[:-1]} " * 3), (5, "abcde-abcde_abcde9abcd abcd abcd")]
    assert got(variants(as_docs(spark, rows))) == naive(rows)


def test_every_cut_of_the_common_beginning_finds_each_pair_once():
    rng = random.Random(5)
    words = sorted({"".join(rng.choice("ab") for _ in range(rng.choice([6, 7]))) for _ in range(400)})
    want = Counter((a, b) for a in words for b in words if len(a) == 6 and near(a, b))
    for cuts in ([0, 7], [0, 3, 7], [0, 1, 2, 3, 4, 5, 6, 7], [0, 2, 6, 7]):
        found = Counter()
        for lo, hi in zip(cuts[:-1], cuts[1:]):
            tail = max(0, 6 - hi)
            order = sorted(words, key=lambda w: (w[:lo], w[len(w) - tail:]))
            keys = [(w[:lo], w[len(w) - tail:]) for w in order]
            block = np.array([sorted(set(keys)).index(k) for k in keys])
            q, w = near_in(6, lo, hi, block, order)
            found.update((order[i], order[j]) for i, j in zip(q, w))
        assert found == want
