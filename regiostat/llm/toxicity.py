"""Toxicity by a factorization machine over hashed terms.

    score = sigmoid(b + sum_i w_i + 1/2 sum_f ((sum_i v_if)^2 - sum_i v_if^2))

over the hashed terms ``i`` a text has (presence only, so repetition does not
add up): its words and their first 4, 5 and 6 bytes, lower-cased.  The rank-8
factors give every pair of terms a weight of its own, also pairs too rare to
be learned one by one.

Learning takes at most ``sample`` labelled rows (those with the least hash of
their id), a parameter.  A term enters the machine if it tells the labels apart
by itself (``min_z`` standard errors; at most ``max_terms``, a parameter), or if it
does so together with another one: words that are neutral alone are counted in
pairs (:func:`separating_words`), on at most ``pair_rows`` rows of each label,
a parameter too.  Selection counts are summed by Spark (2^18 rows at most); the
bounded sample is then fitted by Adam on the driver and the model (fixed size,
about 9 MB) is broadcast for scoring whole texts.

Results: one row per document row, score in [0, 1].  Null or empty text has
no terms and scores the intercept.  A document with several label rows is
toxic if one says so; null labels are ignored; without both classes the score
is the smoothed share of toxic rows (0.5 without any).  Repeated rows get
equal scores; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regiostat.llm.common import batch, filter_rows, map_rows
from regiostat.llm.textvec import ALNUM, Words, spans_hash, text_blocks

BITS = 18
PREFIXES = (4, 5, 6)


def terms(data: np.ndarray, offsets: np.ndarray, prefixes: tuple[int, ...] = PREFIXES) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashed terms of each text of a block: ``(text, term)``."""
    w = Words(data, offsets, ALNUM)
    doc = np.repeat(np.arange(len(offsets) - 1), w.counts).astype(np.int64)
    shift = np.uint64(64 - BITS)
    keys = [doc << BITS | (w.hashes >> shift).astype(np.int64)]
    for n in prefixes:
        long = w.ends - w.starts >= n
        start = w.starts[long]
        h = spans_hash(w.raw, start, start + n) * np.uint64(2 * n + 1)  # unlike the word of the same bytes
        keys.append(doc[long] << BITS | (h >> shift).astype(np.int64))
    key = np.unique(np.concatenate(keys))
    return key >> BITS, key & ((1 << BITS) - 1)


@dataclass
class Machine:
    bias: float
    weight: np.ndarray  # 2^BITS
    factor: np.ndarray  # chosen x rank, by ``place``
    place: np.ndarray   # term -> row of factor, -1: not chosen

    def margin(self, n: int, doc: np.ndarray, term: np.ndarray) -> np.ndarray:
        used = self.place[term] >= 0
        doc, term = doc[used], term[used]
        linear = np.bincount(doc, weights=self.weight[term], minlength=n)
        v = self.factor[self.place[term]]
        pair = np.zeros(n)
        for f in range(v.shape[1]):
            pair += np.bincount(doc, weights=v[:, f], minlength=n) ** 2 - np.bincount(doc, weights=v[:, f] ** 2, minlength=n)
        return self.bias + linear + 0.5 * pair


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit_machine(label: np.ndarray, doc: np.ndarray, term: np.ndarray, rank: int = 8, epochs: int = 60, rate: float = 0.05, decay: float = 2e-4, batches: int = 16, seed: int = 7) -> Machine:
    """Adam on the log loss; ``doc``/``term`` list the chosen terms of the
    rows.  Deterministic: fixed seed and order."""
    rng, n = np.random.default_rng(seed), len(label)
    chosen, at = np.unique(term, return_inverse=True)
    place = np.full(1 << BITS, -1, dtype=np.int32)
    place[chosen] = np.arange(len(chosen))
    prior = (label.sum() + 1) / (n + 2)
    params = [np.array([np.log(prior / (1 - prior))]), np.zeros(len(chosen)), rng.normal(0, 0.02, (len(chosen), rank))]
    if len(chosen) and 0 < label.sum() < n:
        first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
        step = 0
        part = rng.integers(0, batches, n)
        for _ in range(epochs):
            for b in range(batches):
                rows = np.flatnonzero(part == b)
                if not len(rows):
                    continue
                number = np.full(n, -1)
                number[rows] = np.arange(len(rows))
                inside = number[doc] >= 0
                d, t = number[doc[inside]], at[inside]
                v = params[2][t]
                total = np.stack([np.bincount(d, weights=v[:, f], minlength=len(rows)) for f in range(rank)], axis=1)
                square = np.bincount(d, weights=(v ** 2).sum(1), minlength=len(rows))
                margin = params[0][0] + np.bincount(d, weights=params[1][t], minlength=len(rows)) + 0.5 * ((total ** 2).sum(1) - square)
                err = (_sigmoid(margin) - label[rows]) / len(rows)
                own = err[d]
                grad = [np.array([err.sum()]), np.bincount(t, weights=own, minlength=len(chosen)) + decay * params[1],
                        np.stack([np.bincount(t, weights=own * (total[d, f] - v[:, f]), minlength=len(chosen)) for f in range(rank)], axis=1) + decay * params[2]]
                step += 1
                for p, g, m, s in zip(params, grad, first, second):
                    m += 0.1 * (g - m)
                    s += 0.001 * (g * g - s)
                    p -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(s / (1 - 0.999 ** step)) + 1e-8)
    weight = np.zeros(1 << BITS)
    weight[chosen] = params[1]
    return Machine(float(params[0][0]), weight.astype(np.float32), params[2].astype(np.float32), place)


def separating_words(label: np.ndarray, rows: list[np.ndarray], min_rows: int, min_z: float, bits: int = 22, part: int = 1 << 20) -> np.ndarray:
    """Terms of the pairs that separate the labels.  ``rows`` lists the sorted
    terms of each row; a pair counts in the rows that have both.  Pairs are
    counted hashed first, those of suspicious counters then one by one."""
    mask = np.int64((1 << bits) - 1)

    def row_pairs(t: np.ndarray):
        for a in range(0, len(t), 1_000):  # rows of any length, in pieces
            left = t[a:a + 1_000]
            i, j = np.triu_indices(len(left), 1)
            yield left[i] << BITS | left[j]
            for b in range(a + 1_000, len(t), 1_000):
                yield (left[:, None] << BITS | t[None, b:b + 1_000]).ravel()

    def pairs():
        held, of, n = [], [], 0
        for y, t in zip(label.astype(np.int8), rows):
            for key in row_pairs(t):
                held.append(key)
                of.append(np.full(len(key), y, np.int8))
                n += len(key)
                if n >= part:
                    yield np.concatenate(held), np.concatenate(of)
                    held, of, n = [], [], 0
        if held:
            yield np.concatenate(held), np.concatenate(of)

    def place(key: np.ndarray) -> np.ndarray:
        return ((key * np.int64(0x9E3779B97F4A7C1)) >> np.int64(64 - bits - 8)) & mask

    share = float(label.mean()) if len(label) else 0.0
    if not 0 < share < 1:
        return np.zeros(0, np.int64)

    def z(n: np.ndarray, pos: np.ndarray) -> np.ndarray:
        return np.abs(pos - share * n) / np.sqrt(np.maximum(n, 1) * share * (1 - share))

    n, pos = np.zeros(1 << bits, np.int32), np.zeros(1 << bits, np.int32)
    for key, y in pairs():
        at = place(key)
        n += np.bincount(at, minlength=1 << bits).astype(np.int32)
        pos += np.bincount(at[y > 0], minlength=1 << bits).astype(np.int32)
    hot = (n >= min_rows) & (z(n, pos) >= min_z * 0.75)  # other pairs of a counter may hide a part
    key, n, pos = np.zeros(0, np.int64), np.zeros(0), np.zeros(0)
    for more, y in pairs():  # summed part by part: what is held are different pairs, not each place of a pair
        h = hot[place(more)]
        key, which = np.unique(np.concatenate([key, more[h]]), return_inverse=True)
        n = np.bincount(which, weights=np.concatenate([n, np.ones(int(h.sum()))]), minlength=len(key))
        pos = np.bincount(which, weights=np.concatenate([pos, y[h]]), minlength=len(key))
    key = key[(n >= min_rows) & (z(n, pos) >= min_z)]
    return np.unique(np.concatenate([key >> BITS, key & ((1 << BITS) - 1)]))


def _labelled(docs: DataFrame, labels: DataFrame, learn: Column | None, sample: int, id_col: str, text_col: str, label_col: str) -> DataFrame:
    marks = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
    if learn is not None:
        marks = marks.where(learn)
    marks = marks.groupBy(F.col(id_col).alias("i")).agg(F.max(F.col(label_col).cast("int")).alias("y"))
    marks = marks.orderBy(F.xxhash64("i"), "i").limit(sample)  # bounded, so it may be broadcast
    return docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t")).join(F.broadcast(marks), "i").select("i", "t", "y")


def train(docs: DataFrame, labels: DataFrame, learn: Column | None = None, sample: int = 24_000, min_rows: int = 4, min_z: float = 4.0, max_terms: int = 20_000,
          pair_rows: int = 2_000, min_pair_rows: int = 8, min_pair_z: float = 6.0, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Machine:
    """Fit on the labelled rows for which ``learn`` (a column of ``labels``) holds."""
    rows = _labelled(docs, labels, learn, sample, id_col, text_col, label_col)

    def tally(part: pa.RecordBatch):
        y = part["y"].to_numpy(zero_copy_only=False)
        n, pos = np.zeros(1 << BITS, np.int64), np.zeros(1 << BITS, np.int64)
        for start, data, offsets in text_blocks(part["t"]):
            doc, term = terms(data, offsets)
            n += np.bincount(term, minlength=1 << BITS)
            pos += np.bincount(term, weights=y[start + doc] > 0, minlength=1 << BITS).astype(np.int64)
        seen = np.flatnonzero(n)
        # term -1: the rows themselves
        yield batch(term=np.append(seen, -1), n=np.append(n[seen], len(y)), pos=np.append(pos[seen], (y > 0).sum()))

    counts = map_rows(rows.select("t", "y"), tally, "term bigint, n bigint, pos bigint").groupBy("term").agg(F.sum("n").alias("n"), F.sum("pos").alias("pos")).toPandas()
    whole = counts[counts.term < 0]
    n_rows, n_pos = int(whole.n.sum()), int(whole.pos.sum())
    share = (n_pos + 0.5) / (n_rows + 1)
    counts = counts[(counts.term >= 0) & (counts.n >= min_rows)]
    z = np.abs(counts.pos - share * counts.n) / np.sqrt(counts.n * share * (1 - share))
    ranked = counts.assign(z=z)[z >= min_z].sort_values(["z", "term"], ascending=[False, True])
    chosen = np.zeros(1 << BITS, dtype=bool)
    chosen[ranked.term.to_numpy()[:max_terms].astype(np.int64)] = True

    # words that are neutral alone but frequent enough to matter in pairs
    open_ = np.zeros(1 << BITS, dtype=bool)
    open_[counts.term.to_numpy()[counts.n.to_numpy() >= min_pair_rows].astype(np.int64)] = True
    open_ &= ~chosen
    shares = [min(1.0, pair_rows / max(1, k)) for k in (n_rows - n_pos, n_pos)]

    def encode(part: pa.RecordBatch):
        for start, data, offsets in text_blocks(part["t"]):
            y = part["y"].slice(start, len(offsets) - 1).cast(pa.int32())
            doc, term = terms(data, offsets)
            word_doc, word = terms(data, offsets, ())
            drawn = part["r"].slice(start, len(offsets) - 1).to_numpy() < np.where(y.to_numpy() > 0, shares[1], shares[0])
            keep = open_[word] & drawn[word_doc]
            word_doc, word = word_doc[keep], word[keep].astype(np.int32)
            out = []
            for d, t in ((doc, term), (word_doc, word)):
                first = np.searchsorted(d, np.arange(len(offsets)))
                out.append([t[a:b].astype(np.int32) for a, b in zip(first[:-1], first[1:])])
            yield batch(y=y, terms=pa.array([t[chosen[t]].tobytes() for t in out[0]], pa.binary()), words=pa.array([t.tobytes() for t in out[1]], pa.binary()))

    drawn = rows.select("t", "y", (F.pmod(F.xxhash64("i"), F.lit(1 << 20)) / float(1 << 20)).alias("r"))
    data = map_rows(drawn, encode, "y int, terms binary, words binary").toPandas().sort_values(["y", "terms", "words"]) if n_rows else None
    if data is None or not len(data):
        return fit_machine(np.zeros(0), np.zeros(0, np.int64), np.zeros(0, np.int64))
    label = (data.y.to_numpy() > 0).astype(float)
    words = [np.frombuffer(w, np.int32).astype(np.int64) for w in data.words]
    some = np.flatnonzero([len(w) > 1 for w in words])
    paired = separating_words(label[some], [words[i] for i in some], min_pair_rows, min_pair_z)
    own = [np.frombuffer(t, np.int32).astype(np.int64) for t in data.terms]
    if len(paired):  # the rows outside the draw have these words too
        second = np.zeros(1 << BITS, dtype=bool)
        second[paired] = True

        def encode_pairs(part: pa.RecordBatch):
            for start, block, offsets in text_blocks(part["t"]):
                doc, term = terms(block, offsets)
                every = chosen | second
                doc, term = doc[every[term]], term[every[term]].astype(np.int32)
                first = np.searchsorted(doc, np.arange(len(offsets)))
                yield batch(y=part["y"].slice(start, len(offsets) - 1).cast(pa.int32()), terms=pa.array([term[a:b].tobytes() for a, b in zip(first[:-1], first[1:])], pa.binary()))

        data = map_rows(rows.select("t", "y"), encode_pairs, "y int, terms binary").toPandas().sort_values(["y", "terms"])
        label, own = (data.y.to_numpy() > 0).astype(float), [np.frombuffer(t, np.int32).astype(np.int64) for t in data.terms]
    return fit_machine(label, np.repeat(np.arange(len(own)), [len(t) for t in own]), np.concatenate(own))


def score(docs: DataFrame, machine: Machine, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, score`` of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(machine)

    def run(rows: pa.RecordBatch):
        for start, data, offsets in text_blocks(rows["t"]):
            doc, term = terms(data, offsets)
            yield batch(i=rows["i"].slice(start, len(offsets) - 1), score=_sigmoid(shared.value.margin(len(offsets) - 1, doc, term)))

    out = map_rows(docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t")), run, f"i {docs.schema[id_col].dataType.simpleString()}, score double")
    return out.withColumnRenamed("i", id_col)


def reject(docs: DataFrame, machine: Machine, threshold: float = 0.7, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``."""
    shared = docs.sparkSession.sparkContext.broadcast(machine)

    def keep(texts: pa.Array) -> np.ndarray:
        parts = [_sigmoid(shared.value.margin(len(offsets) - 1, *terms(data, offsets))) < threshold for _, data, offsets in text_blocks(texts)]
        return np.concatenate(parts) if parts else np.zeros(0, bool)

    return filter_rows(docs, text_col, keep)
