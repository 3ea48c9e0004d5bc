"""The language model against a plain Gibbs sampler, customer by customer."""

import math
import random
from collections import defaultdict

from pyspark.sql import functions as F

from llm_helpers import as_docs, words
from regiostat.llm import lm_scoring

END = "</s>"


class Restaurants:
    """Context restaurants over one unigram restaurant, seated one by one."""

    def __init__(self, vocabulary, s, seed):
        self.s, self.v, self.rng = s, len(vocabulary), random.Random(seed)
        self.tables, self.t_u, self.c_u = defaultdict(list), defaultdict(int), defaultdict(int)
        self.root, self.root_t, self.root_c = defaultdict(list), 0, 0

    def p_root(self, w):
        s, sizes = self.s, self.root.get(w, ())
        return (sum(sizes) - s.root_discount * len(sizes) + (s.root_strength + s.root_discount * self.root_t) / (self.v + 1)) / (s.root_strength + self.root_c)

    def p(self, u, w):
        s, sizes = self.s, self.tables.get((u, w), ())
        return (sum(sizes) - s.discount * len(sizes) + (s.strength + s.discount * self.t_u.get(u, 0)) * self.p_root(w)) / (s.strength + self.c_u.get(u, 0))

    def _sit(self, sizes, discount, new):
        x = self.rng.random() * (sum(sizes) - discount * len(sizes) + new)
        for i, n in enumerate(sizes):
            x -= n - discount
            if x < 0:
                sizes[i] += 1
                return False
        sizes.append(1)
        return True

    def _leave(self, sizes):
        i = self.rng.choices(range(len(sizes)), sizes)[0]
        sizes[i] -= 1
        if sizes[i] == 0:
            del sizes[i]
            return True
        return False

    def add(self, u, w):
        s = self.s
        if self._sit(self.tables[u, w], s.discount, (s.strength + s.discount * self.t_u[u]) * self.p_root(w)):
            self.t_u[u] += 1
            if self._sit(self.root[w], s.root_discount, (s.root_strength + s.root_discount * self.root_t) / (self.v + 1)):
                self.root_t += 1
            self.root_c += 1
        self.c_u[u] += 1

    def remove(self, u, w):
        if self._leave(self.tables[u, w]):
            self.t_u[u] -= 1
            if self._leave(self.root[w]):
                self.root_t -= 1
            self.root_c -= 1
        self.c_u[u] -= 1


def zipf_texts(seed, n, length, vocabulary=150):
    """Texts in which every word has a few likely followers."""
    rng = random.Random(seed)
    names = [f"w{i}" for i in range(vocabulary)]
    weights = [1 / (i + 1) for i in range(vocabulary)]
    after = {w: random.Random(i).choices(names, weights, k=4) for i, w in enumerate(names)}
    out = []
    for _ in range(n):
        w, text = rng.choices(names, weights)[0], []
        for _ in range(length):
            text.append(w)
            w = rng.choice(after[w]) if rng.random() < 0.6 else rng.choices(names, weights)[0]
        out.append(" ".join(text))
    return out


def test_scores_are_those_of_a_plain_sampler(spark):
    texts = zipf_texts(3, 90, 39)
    learn, held = range(50), range(50, 90)  # 2,000 tokens to learn from
    pairs = lambda t: list(zip([END, *words(t)], [*words(t), END]))
    customers = [p for i in learn for p in pairs(texts[i])]
    s = lm_scoring.Settings(block_tokens=300, bucket_tokens=600, max_contexts=64)
    rooms = Restaurants({w for _, w in customers}, s, 1)
    for u, w in customers:
        rooms.add(u, w)
    sums, kept = defaultdict(float), 0
    for sweep in range(40):
        for u, w in customers:
            rooms.remove(u, w)
            rooms.add(u, w)
        if sweep >= 20:
            kept += 1
            for i in held:
                for k, (u, w) in enumerate(pairs(texts[i])):
                    sums[i, k] += rooms.p(u, w)
    want = {i: sum(math.log10(sums[i, k] / kept) for k in range(len(pairs(texts[i])))) for i in held}
    got = {r.doc_id: r.score for r in lm_scoring.lm_scores(as_docs(spark, list(enumerate(texts))), F.col("doc_id") < 50, s).collect()}
    n = sum(len(pairs(texts[i])) for i in held)
    gap = sum(got[i] - want[i] for i in held) / n
    base = sum(want.values()) / n
    assert abs(gap) < 0.03 * abs(base), (gap, base)
    spread = (sum((got[i] - want[i]) ** 2 for i in held) / len(held)) ** 0.5 / 40
    assert spread < 0.05 * abs(base)
