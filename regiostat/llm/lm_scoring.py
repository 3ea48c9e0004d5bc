"""Language-model scores by a hierarchical Pitman-Yor process.

Model.  Two levels of Chinese restaurants: every *context* (the word before)
has a restaurant of its own; all of them share one parent, the unigram
restaurant, over a uniform base of the vocabulary and one unknown word.  With
discount ``d``, strength ``theta``, ``c`` customers and ``t`` tables,

    P(w | u) = (c_uw - d t_uw + (theta + d t_u) P(w)) / (theta + c_u)

Seating is sampled by Gibbs: a customer is taken from its table and seated
anew, at a table of its word by ``size - d``, at a new one by ``(theta + d t_u)
P(w)``.  Of a word's customers in a restaurant the first 16 are seated one by
one, later ones by the rule ``a / (n - d t + a)`` for a new table (``a`` the
rate of new tables, ``n`` customers seated), in steps of ``n / 8`` customers
that each draw a binomial number and then update ``t``.
After ``burn`` sweeps ``samples`` seatings are kept, and the predictive
probabilities of all kept seatings are averaged.

Distribution.  1. Frequent words of every block give the *hot* words (a
``max_contexts``-th of all tokens, or a quarter of a bucket; broadcast, a row per
quarter bucket at most), which only decide where counts are kept.  2. Texts become blocks of about 1 M tokens; a block's distinct (context,
word) pairs with their training counts go, packed, to buckets: by context if
the context is not hot, else by word, or by pair if the word is hot too, so
that nothing is hot.  3. A bucket merges the counts of its pairs over all blocks
and samples their seating.  The totals of a restaurant that is not hot are
exact there and go back with its pairs; those of hot ones, which span buckets,
are estimated from the bucket's own share while sampling (an approximate
distributed Gibbs) and summed exactly afterwards, so the probabilities are
those of one seating and add up to one.  4. Tables of words that are not hot are
summed by word in a second exchange, seated in the unigram restaurant and sent
to the blocks that asked.  5. The texts are read again; blocks, joined with their
answers and the totals of the hot words, score them.
The number of buckets grows with the tokens, and a context as large as a quarter
of a bucket is hot, so a bucket's size does not grow.  Only answers are kept as
tables; pieces and blocks are in shuffles alone.  The texts are read three times
and must come in the same order each time, as those of a stored table do (a
difference is an error).

Results: one row per document row.  Null or empty text is the end token alone.
Documents that do not learn are scored like the others.  Without training
documents every probability is 1.  Repeated rows give repeated rows (and count
as often in training); empty tables give empty results; other columns are not
read.
"""

from __future__ import annotations

import ctypes
import gc
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regiostat.llm.common import batch, find_package, starts_of
from regiostat.llm.textvec import Words, mix64, text_blocks
from regiostat.session import materialize

END = np.uint64(0x6A09E667F3BCC909)
_ODD = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Settings:
    max_contexts: int = 1 << 14
    discount: float = 0.8
    strength: float = 2.0
    root_discount: float = 0.6
    root_strength: float = 50.0
    burn: int = 2
    samples: int = 2
    seats: int = 16
    block_tokens: int = 1_000_000
    bucket_tokens: int = 3_000_000


_KINDS = (np.uint8, np.uint16, np.uint32, np.uint64)


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays of whole numbers as one compressed text: a list of (type,
    length), then the values, all first bytes before all second ones."""
    heads, bodies = [len(arrays)], []
    for a in arrays:
        top = int(a.max()) if len(a) else 0
        kind = next(k for k, most in enumerate((1 << 8, 1 << 16, 1 << 32, 1 << 64)) if top < most)
        heads += [kind, len(a)]
        bodies.append(a.astype(_KINDS[kind]).view(np.uint8).reshape(len(a), 1 << kind).T.tobytes())
    return zstandard.ZstdCompressor(level=1).compress(np.array(heads, dtype=np.uint32).tobytes() + b"".join(bodies))


def unpack(data: bytes) -> list[np.ndarray]:
    raw, out = zstandard.ZstdDecompressor().decompress(data), []
    n = int(np.frombuffer(raw, np.uint32, 1)[0])
    heads, at = np.frombuffer(raw, np.uint32, 2 * n, 4), 4 + 8 * n
    for kind, size in heads.reshape(n, 2).tolist():
        planes = np.frombuffer(raw, np.uint8, size << kind, at).reshape(1 << kind, size)
        out.append(np.ascontiguousarray(planes.T).reshape(-1).view(_KINDS[kind]))
        at += size << kind
    return out


def _release() -> None:
    """Give freed memory of this worker back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def _tidy(run):
    """``run`` on a group, with its memory given back at the end."""
    def tidy(group: pa.Table) -> pa.Table:
        try:
            return run(group)
        finally:
            _release()
    return tidy


def _place(table: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Index in a sorted table, -1 if absent."""
    if not len(table):
        return np.full(len(h), -1, np.int64)
    at = np.searchsorted(table, h)
    at[at == len(table)] = 0
    return np.where(table[at] == h, at, -1)


def _tokens(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of a block, each text closed by the end token, and the
    number of tokens of each text."""
    n = len(w.first) - 1
    out = np.empty(len(w.hashes) + n, dtype=np.uint64)
    doc = np.repeat(np.arange(n), w.counts)
    out[np.arange(len(w.hashes)) + doc] = w.hashes
    out[w.first[1:] + np.arange(n)] = END
    return out, w.counts + 1


def _gather(batches, size: int):
    """Blocks of about ``size`` tokens over the batches of a partition:
    (token hashes, tokens per text, learns, ids)."""
    held, n = [], 0
    for rows in batches:
        for start, data, offsets in text_blocks(rows["t"]):
            h, count = _tokens(Words(data, offsets))
            part = rows.slice(start, len(count))
            held.append((h, count, part["learn"].to_numpy(zero_copy_only=False).astype(bool), part["i"]))
            n += len(h)
            if n >= size:
                yield tuple(np.concatenate(x) for x in list(zip(*held))[:3]) + (pa.concat_arrays([x[3] for x in held]),)
                held, n = [], 0
    if held:
        yield tuple(np.concatenate(x) for x in list(zip(*held))[:3]) + (pa.concat_arrays([x[3] for x in held]),)


def contexts(docs: DataFrame, s: Settings) -> tuple[int, np.ndarray, np.ndarray]:
    """Training tokens, and hash and share of the frequent words (sorted): those
    with ``1 / max_contexts`` of all tokens, or a quarter of a bucket.  A block
    tells the words it has four times or more."""
    def heavy(batches):
        for h, count, learn, _ in _gather(batches, s.block_tokens):
            h = h[np.repeat(learn, count)]
            u, c = np.unique(h, return_counts=True)
            often = (c >= 4) | (c * 2 * s.max_contexts >= len(h))
            yield batch(w=np.append(u[often].view(np.int64), 0), n=np.append(c[often], 0), tokens=np.append(np.zeros(often.sum(), np.int64), len(h)))

    found = docs.mapInArrow(heavy, "w bigint, n bigint, tokens bigint").groupBy("w").agg(F.sum("n").alias("n"), F.sum("tokens").alias("tokens"))
    found = materialize(found, "heavy")
    total = found.agg(F.sum("tokens")).first()[0] or 0
    least = min(total / s.max_contexts, s.bucket_tokens / 4)
    rows = found.where(F.col("n") >= least).where("n > 0").select("w", "n").toPandas()  # a row per quarter bucket at most
    h = rows.w.to_numpy(dtype=np.int64).view(np.uint64)
    order = np.argsort(h)
    return int(total), h[order], rows.n.to_numpy(dtype=float)[order] / max(total, 1)


def _home(words: np.ndarray, buckets: int) -> np.ndarray:
    """Where a word that is not hot has its place in the unigram restaurant."""
    return (mix64(words + _ODD) % np.uint64(buckets)).astype(np.int64)


class Block:
    """The distinct (context, word) pairs of a block, sorted by bucket, and the
    words that are not hot, sorted by home.  Made from the texts alone, so that
    the second reading of the texts finds the order of the first."""

    def __init__(self, h: np.ndarray, count: np.ndarray, learn: np.ndarray, frequent: np.ndarray, buckets: int):
        before = np.empty_like(h)
        before[0], before[1:] = END, h[:-1]  # the token before a text is the end of the one before
        key = mix64(h + mix64(before) * _ODD)
        _, index, which = np.unique(key, return_index=True, return_inverse=True)
        n = np.bincount(which, weights=np.repeat(learn, count), minlength=len(index)).astype(np.int64)
        e_u, e_h = before[index], h[index]
        e_ctx, e_word = _place(frequent, e_u) + 1, _place(frequent, e_h) + 1  # 0: not hot
        bucket = (np.where(e_ctx == 0, mix64(e_u), np.where(e_word > 0, key[index], mix64(e_h))) % np.uint64(buckets)).astype(np.int64)
        kind = np.where(e_ctx == 0, 2, e_word == 0)
        order = np.lexsort((np.where(kind == 2, e_h, e_ctx.astype(np.uint64)), np.where(kind == 2, e_u, e_h), kind, bucket))
        rank = np.empty_like(order)
        rank[order] = np.arange(len(order))
        self.which = rank[which]
        self.u, self.h, self.ctx, self.word, self.n, self.bucket, self.kind = (x[order] for x in (e_u, e_h, e_ctx, e_word, n, bucket, kind))
        self.first = np.append(starts_of(self.bucket), len(self.bucket))
        # words that are not hot, asked for by home
        asked, at = np.unique(self.h[self.word == 0], return_inverse=True)
        home = _home(asked, buckets)
        by_home = np.argsort(home, kind="stable")
        rank_home = np.empty_like(by_home)
        rank_home[by_home] = np.arange(len(by_home))
        self.asked, self.home, self.at = asked[by_home], home[by_home], rank_home[at]

    def pieces(self) -> list[tuple[int, bytes]]:
        """The pairs and their training counts for each bucket, and the words
        asked for (``-1 - home``)."""
        out = []
        for a, b in zip(self.first[:-1], self.first[1:]):
            m, r = (a + np.searchsorted(self.kind[a:b], (1, 2))).tolist()
            new, room, rare = starts_of(self.h[m:r]), starts_of(self.u[r:b]), self.word[r:b] == 0
            out.append((int(self.bucket[a]), pack(self.word[a:m], self.ctx[a:m], self.n[a:m], self.h[m:r][new], np.diff(np.append(new, r - m)), self.ctx[m:r], self.n[m:r],
                                                  self.u[r:b][room], np.diff(np.append(room, b - r)), self.word[r:b], self.h[r:b][rare], self.n[r:b])))
        cut = np.append(starts_of(self.home), len(self.home))
        return out + [(-1 - int(self.home[a]), pack(self.asked[a:b])) for a, b in zip(cut[:-1], cut[1:])]

    def own(self, count: np.ndarray) -> bytes:
        """What scoring needs besides the answers."""
        runs = [np.diff(np.append(starts_of(self.u[r:b]), b - r)) for a, b in zip(self.first[:-1], self.first[1:]) for r in [a + int(np.searchsorted(self.kind[a:b], 2))]]
        return pack(self.which, self.ctx, self.word, count, np.concatenate(runs), self.at)


def blocks(docs: DataFrame, frequent: np.ndarray, buckets: int, own: bool, s: Settings) -> DataFrame:
    """``block, bucket, data`` of the pieces of every block; with ``own`` instead
    one row per block with its texts' pairs and ids (bucket null)."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent)
    id_type = docs.schema["i"].dataType.simpleString()

    def run(batches):
        frequent, task = shared.value, TaskContext.get().partitionId()
        for number, (h, count, learn, ids) in enumerate(_gather(batches, s.block_tokens)):
            place, block = (task << 24) + number, Block(h, count, learn, frequent, buckets)
            del h
            if own:
                yield pa.RecordBatch.from_arrays([pa.array([place], pa.int64()), pa.array([None], pa.int64()), pa.array([block.own(count)], pa.binary()),
                                                  pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids)], names=["block", "bucket", "data", "ids"])
            else:
                to, data = zip(*block.pieces())
                yield pa.RecordBatch.from_arrays([pa.array([place] * len(to), pa.int64()), pa.array(to, pa.int64()), pa.array(data, pa.binary())], names=["block", "bucket", "data"])
                del data
            del block
            _release()

    return docs.mapInArrow(run, "block bigint, bucket bigint, data binary" + (f", ids array<{id_type}>" if own else ""))


class Seating:
    """Tables of many words' customers, each word on its own given the rate
    ``a`` at which new tables open."""

    def __init__(self, customers: np.ndarray, seats: int):
        self.c, self.seats = customers, seats
        first = np.minimum(customers, seats)
        self.groups = []
        for m in range(2, seats + 1):
            rows = np.flatnonzero(first == m)
            if len(rows):
                size = np.zeros((len(rows), m), dtype=np.float32)
                size[:, 0] = m
                self.groups.append((rows, size, np.zeros((len(rows), m), dtype=np.int8)))

    def sweep(self, rng: np.random.Generator, a: np.ndarray, d: float) -> None:
        """Every seated customer leaves its table and sits down anew."""
        for rows, size, table in self.groups:
            line, new_rate = np.arange(len(rows)), a[rows].astype(np.float32)
            for j in range(size.shape[1]):
                size[line, table[:, j]] -= 1
                weight = np.cumsum(np.where(size > 0, size - np.float32(d), 0), axis=1)
                u = rng.random(len(rows), dtype=np.float32) * (weight[:, -1] + new_rate)
                to = np.where(u >= weight[:, -1], (size == 0).argmax(axis=1), (weight <= u[:, None]).sum(axis=1).clip(max=size.shape[1] - 1))
                table[:, j] = to
                size[line, to] += 1

    def tables(self, rng: np.random.Generator, a: np.ndarray, d: float) -> np.ndarray:
        t = np.minimum(self.c, 1).astype(np.int64)
        for rows, size, _ in self.groups:
            t[rows] = (size > 0).sum(axis=1)
        # the seating rule a / (n - d t + a), in steps of an eighth of the customers seated
        late, n = np.flatnonzero(self.c > self.seats), self.seats
        while len(late):
            new_rate, now, k = a[late], t[late], np.minimum(max(1, n // 8), self.c[late] - n)
            half = (k - 1) / 2
            opens = new_rate / (n - d * now + new_rate)
            opens = new_rate / (n + half - d * (now + opens * half) + new_rate)  # in the middle of the step
            t[late] = now + rng.binomial(k, opens)
            n += max(1, n // 8)
            late = late[self.c[late] > n]
        return t


def _root_tables(rng: np.random.Generator, customers: np.ndarray, s: Settings) -> np.ndarray:
    """Tables of words in the unigram restaurant; a new one opens at the rate
    ``(theta + d T) / (V + 1)``, where ``T / V`` is about the words' own."""
    full = customers > 0
    seating, rate = Seating(customers, s.seats), np.full(len(customers), s.root_discount * 1.3)
    for _ in range(s.burn):
        seating.sweep(rng, rate, s.root_discount)
        t = seating.tables(rng, rate, s.root_discount)
        rate[:] = s.root_discount * t.sum() / max(1, full.sum())
    return seating.tables(rng, rate, s.root_discount)


SEATED = "block bigint, bucket bigint, data binary, what string, place bigint, v array<double>"


def _seated(rows: list[tuple]) -> pa.Table:
    schema = pa.schema([("block", pa.int64()), ("bucket", pa.int64()), ("data", pa.binary()), ("what", pa.string()), ("place", pa.int64()), ("v", pa.list_(pa.float64()))])
    return pa.table(dict(zip(schema.names, map(list, zip(*rows)))) if rows else {n: [] for n in schema.names}, schema=schema)


def seat(pieces: DataFrame, tokens: int, share: np.ndarray, buckets: int, s: Settings) -> DataFrame:
    """Answers for every piece (block, bucket, data), totals of the hot words
    (what, place, sums), tables of the others for their homes (bucket, data,
    what), and the words that blocks ask for."""
    shared = pieces.sparkSession.sparkContext.broadcast(share)

    def run(group: pa.Table) -> pa.Table:
        share = shared.value
        width = len(share) + 1
        group = group.sort_by("block")
        bucket = group["bucket"][0].as_py()
        if bucket < 0:  # words asked for, on their way to the unigram restaurant
            return _seated([(block, bucket, data, "asked", None, None) for block, data in zip(group["block"].to_pylist(), group["data"].to_pylist())])
        rng = np.random.default_rng([bucket, 20_011])
        parts = [unpack(x.as_py()) for x in group["data"]]
        cat = lambda i: np.concatenate([p[i] for p in parts])
        # words: hot ones by place, others after hot contexts, others after other contexts
        b_words, b_which = np.unique(cat(3), return_inverse=True)
        rooms, room_which = np.unique(cat(7), return_inverse=True)
        c_word = cat(9).astype(np.int64)
        c_words, c_which = np.unique(cat(10), return_inverse=True)
        c_word[c_word == 0] = width + len(b_words) + c_which
        n_rooms = width + len(rooms)
        key = np.concatenate([cat(0).astype(np.int64), width + np.repeat(b_which, cat(4).astype(np.int64)), c_word])
        del b_which, c_which, c_word
        key *= n_rooms
        key += np.concatenate([cat(1).astype(np.int64), cat(5).astype(np.int64), width + np.repeat(room_which, cat(8).astype(np.int64))])
        n_words, n_hot = width + len(b_words) + len(c_words), width + len(b_words)
        n, sizes = np.concatenate([cat(2), cat(6), cat(11)]), [[len(p[0]), len(p[5]), len(p[9]), len(p[7])] for p in parts]
        del parts
        dish, which = np.unique(key, return_inverse=True)
        del key
        which = which.astype(np.int32)
        c = np.bincount(which, weights=n, minlength=len(dish)).astype(np.int64)
        del n
        word, ctx = (dish // n_rooms).astype(np.int32), (dish % n_rooms).astype(np.int32)
        del dish
        hot = ctx < width
        seating, t = Seating(c, s.seats), np.minimum(c, 1)
        c_u = np.bincount(ctx, weights=c, minlength=n_rooms)
        c_w = np.bincount(word, weights=c, minlength=n_words)
        c_all = np.append(0.0, share) * tokens
        p = np.append(np.maximum(np.append(0.0, share), 1e-12), np.zeros(n_words - width))
        kept = []
        for sweep in range(s.burn + s.samples):
            # the parent's customers are tables: all of the hot contexts by share, the others' own
            r = np.maximum(np.bincount(word, weights=t, minlength=n_words) - 0.5 * s.root_discount, 0.3)
            p[width:n_hot] = r[width:n_hot] / max(1.0, share.sum() * tokens * max(1, t[hot].sum()) / max(1, c[hot].sum()))
            p[n_hot:] = r[n_hot:] / max(1, t[~hot].sum())
            t_u = np.bincount(ctx, weights=t, minlength=n_rooms)
            t_u[:width] = c_all * (t_u[:width] + 1) / (c_u[:width] + 1)
            rate = (s.strength + s.discount * t_u[ctx]) * p[word]
            seating.sweep(rng, rate, s.discount)
            t = seating.tables(rng, rate, s.discount)
            if sweep >= s.burn:
                kept.append(t)
        tables = [np.bincount(ctx, weights=x, minlength=n_rooms).astype(np.int64) for x in kept]
        sent = [np.bincount(word, weights=x, minlength=n_words).astype(np.int64) for x in kept]
        sizes = np.array(sizes)
        begins = np.cumsum(sizes, axis=0) - sizes + np.array([0, *np.cumsum(sizes.sum(axis=0)[:2]), 0])
        out = []
        for block, size, at in zip(group["block"].to_pylist(), sizes.tolist(), begins.tolist()):
            both = np.concatenate([which[a:a + n] for a, n in zip(at[:3], size)])
            room = width + room_which[at[3]:at[3] + size[3]]
            out.append((block, bucket, pack(c[both], *(x[both] for x in kept), c_u[room].astype(np.int64), *(x[room] for x in tables)), None, None, None))

        def tell(name: str, of: np.ndarray, sums: list[np.ndarray]) -> None:
            some = np.flatnonzero(of[:width])
            out.extend((None, None, None, name, i, v) for i, v in zip(some.tolist(), np.stack([x[some] for x in sums], axis=1).astype(float).tolist()))

        tell("context", c_u, [c_u, *tables])
        tell("word", c_w, [c_w, *sent])
        some = np.flatnonzero(c_w[width:])
        h = np.concatenate([b_words, c_words]).astype(np.uint64)[some]
        home = _home(h, buckets)
        order = np.lexsort((h, home))
        h, home, some = h[order], home[order], width + some[order]
        cut = np.append(starts_of(home), len(home))
        out.extend((None, -1 - int(home[a]), pack(h[a:b], c_w[some[a:b]].astype(np.int64), *(x[some[a:b]] for x in sent)), "tables", bucket, None) for a, b in zip(cut[:-1], cut[1:]))
        return _seated(out)

    return pieces.groupBy("bucket").applyInArrow(_tidy(run), SEATED)


def seat_root(rows: DataFrame, s: Settings) -> DataFrame:
    """The unigram restaurant of the words that are not hot: ``rows`` has the
    words blocks ask for and (block null) the tables that buckets send.
    Customers and tables for every block that asked, and totals."""
    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by([("block", "ascending"), ("place", "ascending")])
        bucket = group["bucket"][0].as_py()
        rng = np.random.default_rng([-1 - bucket, 20_029])
        asking, parts = group["block"].to_pylist(), [unpack(x.as_py()) for x in group["data"]]
        words, which = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
        ends = np.cumsum([len(p[0]) for p in parts])
        at = [which[e - len(p[0]):e] for e, p in zip(ends, parts)]
        sums = [np.zeros(len(words), np.int64) for _ in range(1 + s.samples)]
        for block, p, w in zip(asking, parts, at):
            if block is None:
                for i, x in enumerate(sums):  # a word may come twice
                    np.add.at(x, w, p[1 + i].astype(np.int64))
        sums += [_root_tables(rng, x, s) for x in sums[1:]]
        out = [(block, bucket, pack(*(x[w] for x in sums)), None, None, None) for block, w in zip(asking, at) if block is not None]
        out.append((None, None, None, "rest", 0, [float((sums[0] > 0).sum()), *(float(x.sum()) for x in sums[1:])]))
        return _seated(out)

    return rows.groupBy("bucket").applyInArrow(_tidy(run), SEATED)


def _free(spark) -> None:
    """Spark deletes the shuffle files of finished steps when the driver
    collects its garbage; ask for that now."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


@dataclass
class Totals:
    tokens: int
    words: int            # distinct training words
    c_u: np.ndarray       # by hot context place (0 unused)
    t_u: np.ndarray       # sample x context
    c_w: np.ndarray       # by hot word place
    root_c: np.ndarray    # sample x hot word
    root_t: np.ndarray
    all_c: np.ndarray     # by sample, the whole unigram restaurant
    all_t: np.ndarray


def totals(answers: DataFrame, tokens: int, width: int, s: Settings) -> Totals:
    """Sums over all buckets (two rows per hot word at most)."""
    size = {"context": 1 + s.samples, "word": 1 + s.samples, "rest": 1 + 2 * s.samples}
    found = {k: np.zeros((width if k != "rest" else 1, n)) for k, n in size.items()}
    rows = (answers.where(F.col("v").isNotNull()).groupBy("what", "place")
            .agg(F.array(*[F.sum(F.get("v", F.lit(i))) for i in range(1 + 2 * s.samples)]).alias("v")).toPandas())
    for what, place, v in zip(rows.what, rows.place, rows.v):
        found[what][int(place)] = [float(x) for x in v[:size[what]]]
    c_u, t_u = found["context"][:, 0], found["context"][:, 1:].T
    c_w, root_c = found["word"][:, 0], found["word"][:, 1:].T
    rng = np.random.default_rng(20_021)
    root_t = np.stack([_root_tables(rng, x.astype(np.int64), s) for x in root_c])
    rest = found["rest"][0]
    return Totals(tokens, int(rest[0] + (c_w > 0).sum()), c_u, t_u, c_w, root_c, root_t,
                  root_c.sum(axis=1) + rest[1:1 + s.samples], root_t.sum(axis=1) + rest[1 + s.samples:])


def score(parts: DataFrame, known: Totals, id_type: str, s: Settings) -> DataFrame:
    """``i, n_tokens, n_known, base_score, score`` of every text; ``parts``
    holds the blocks and the answers to them."""
    shared = parts.sparkSession.sparkContext.broadcast(known)

    def run(group: pa.Table) -> pa.Table:
        k, n_s = shared.value, s.samples
        own = group.filter(pa.compute.is_null(group["bucket"]))
        place = group["bucket"].combine_chunks()
        seated = group.filter(pa.compute.greater_equal(place, 0)).sort_by("bucket")
        rooted = group.filter(pa.compute.less(place, 0)).sort_by([("bucket", "descending")])
        which, e_ctx, e_word, count, runs, at = unpack(own["data"][0].as_py())
        e_ctx, e_word, hot, rare = e_ctx.astype(np.int64), e_word.astype(np.int64), e_ctx > 0, e_word == 0
        got = [np.concatenate(x).astype(float) for x in zip(*(unpack(x.as_py()) for x in seated["data"]))]
        if len(got[0]) != len(e_ctx):
            raise RuntimeError("the documents were not the same, or not in the same order, when they were read again")
        rest = [np.concatenate(x).astype(float) for x in zip(*(unpack(x.as_py()) for x in rooted["data"]))]

        def words(table: np.ndarray, i: int) -> np.ndarray:
            out = table[e_word].astype(float)
            if rest:
                out[rare] = rest[i][at]
            return out

        def rooms(table: np.ndarray, i: int) -> np.ndarray:
            out = table[e_ctx].astype(float)
            out[~hot] = np.repeat(got[1 + n_s + i], runs.astype(np.int64))
            return out

        base_p = 1.0 / (k.words + 1)
        p, c_word, c, c_u = np.zeros(len(e_ctx)), words(k.c_w, 0), got[0], rooms(k.c_u, 0)
        for i in range(n_s):
            r, r_t = words(k.root_c[i], 1 + i), words(k.root_t[i], 1 + n_s + i)
            root = (np.maximum(r - s.root_discount * r_t, 0) + (s.root_strength + s.root_discount * k.all_t[i]) * base_p) / (s.root_strength + k.all_c[i])
            p += (np.maximum(c - s.discount * got[1 + i], 0) + (s.strength + s.discount * rooms(k.t_u[i], 1 + i)) * root) / (s.strength + c_u) / n_s
        ends = np.cumsum(count.astype(np.int64))
        starts = ends - count
        sums = lambda per_entry: np.add.reduceat(per_entry[which], starts)
        base = np.log10((c_word + 1) / (k.tokens + k.words + 1))
        return pa.table({"i": own["ids"].combine_chunks().flatten(), "n_tokens": pa.array(count.astype(np.int64)), "n_known": pa.array(sums((c_word > 0).astype(np.int64))),
                         "base_score": pa.array(sums(base)), "score": pa.array(sums(np.log10(p)))})

    return parts.groupBy("block").applyInArrow(_tidy(run), f"i {id_type}, n_tokens bigint, n_known bigint, base_score double, score double")


def lm_scores(docs: DataFrame, learn: Column, settings: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, n_tokens, n_known, train_tokens, base_score, score`` of every row;
    rows for which ``learn`` holds train the model."""
    s = settings
    find_package(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("i"), F.coalesce(learn, F.lit(False)).alias("learn"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    tokens, frequent, share = contexts(rows, s)
    buckets = max(8, -(-tokens // s.bucket_tokens))
    seated = materialize(seat(blocks(rows, frequent, buckets, False, s), tokens, share, buckets, s), "seatings")
    _free(docs.sparkSession)
    columns = ["block", "bucket", "data", "place"]
    roots = materialize(seat_root(seated.where("what IN ('asked', 'tables')").select(*columns), s), "roots")
    answers = seated.where("what IS NULL OR what IN ('context', 'word')").unionByName(roots)
    known = totals(answers, tokens, len(share) + 1, s)
    own = blocks(rows, frequent, buckets, True, s)
    back = answers.where(F.col("what").isNull()).select("block", "bucket", "data", F.lit(None).cast(own.schema["ids"].dataType).alias("ids"))
    out = score(own.unionByName(back), known, docs.schema[id_col].dataType.simpleString(), s)
    return out.select(F.col("i").alias(id_col), "n_tokens", "n_known", F.lit(tokens).cast("bigint").alias("train_tokens"), "base_score", "score")
