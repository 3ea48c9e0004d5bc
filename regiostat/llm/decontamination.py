"""Benchmark decontamination by winnowing.

Texts become word hashes; of every ``window - k + 1`` neighbouring k-grams the
one with the least hash (the rightmost among equals) is kept as fingerprint.
Equal spans of ``window`` words keep the same fingerprint on both sides, so
joining document and benchmark fingerprints misses no shared span of that
length; each joined fingerprint is then extended to the whole windows around
it, which are compared in full.  Items shorter than a window lie below that
guarantee and are looked up as they are, by their own length.

The benchmark is the stated query set.  It goes to the tasks in blocks of at
most ``block_words`` words (a size that is checked, not assumed); a larger
benchmark is handled block by block and the hits of the blocks are united, so
every size gives the same result.

Results: one row per document row.  Null or empty text has no words and no
hits; null or empty items match nothing; a null item id counts as ''.  Items
with equal ids count once.  Repeated document rows give repeated rows; empty
tables give no rows or no hits; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regiostat.llm.common import batch, filter_rows, map_rows, starts_of
from regiostat.llm.textvec import ALNUM, Words, doc_windows, text_blocks, windows

#: Words as a regular expression for Spark (of lower-cased text); ``ALNUM`` in bytes.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def winnow(h: np.ndarray, doc: np.ndarray, width: int) -> np.ndarray:
    """Indexes of the k-grams kept: the rightmost least of each ``width``
    neighbours of one text.  ``h``, ``doc``: all k-grams in order."""
    n = len(h) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    least = h[:n].copy()
    for j in range(1, width):
        np.minimum(least, h[j:j + n], out=least)
    at = np.zeros(n, dtype=np.int64)
    for j in range(width):
        np.copyto(at, j, where=h[j:j + n] == least)
    at += np.arange(n)
    return np.unique(at[doc[:n] == doc[width - 1:]])


class BenchmarkIndex:
    """Fingerprints and whole windows of a block of items."""

    def __init__(self, ids: list[str], texts: list[str | None], window: int, k: int):
        self.window, self.k = window, k
        grams: list[np.ndarray] = []
        found: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        names = {x: i for i, x in enumerate(sorted(set(ids)))}
        self.items = list(names)
        for first, data, offsets in text_blocks(pa.array(texts, pa.large_string())):
            w = Words(data, offsets, ALNUM)
            item = np.array([names[x] for x in ids[first:first + len(offsets) - 1]], dtype=np.int64)
            h, _, doc = doc_windows(w, k)
            grams.append(h[winnow(h, doc, window - k + 1)])
            h, _, doc = doc_windows(w, window)
            found.setdefault(window, []).append((h, item[doc]))
            for i in np.flatnonzero((w.counts > 0) & (w.counts < window)):
                n = int(w.counts[i])
                found.setdefault(n, []).append((windows(w.hashes[w.first[i]:w.first[i + 1]], n), item[i:i + 1]))
        self.grams = np.unique(np.concatenate(grams)) if grams else np.zeros(0, np.uint64)
        #: length -> (window hashes in order, first entry of each, items)
        self.whole = {}
        for n, parts in found.items():
            h, item = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
            if len(h):
                order = np.lexsort((item, h))
                h, item = h[order], item[order]
                new = starts_of(h)
                self.whole[n] = (h[new], np.append(new, len(h)), item)

    def matches(self, w: Words) -> list[tuple[np.ndarray, int, np.ndarray, tuple]]:
        """Windows found: (first words, length, numbers of the windows, table)."""
        out = []
        for n, entry in self.whole.items():
            if n == self.window:
                at, h = self._extended(w)
            else:
                h, at, _ = doc_windows(w, n)
            which, ok = _lookup(entry[0], h)
            out.append((at[ok], n, which[ok], entry))
        return out

    def _extended(self, w: Words) -> tuple[np.ndarray, np.ndarray]:
        h, at, doc = doc_windows(w, self.k)
        kept = winnow(h, doc, self.window - self.k + 1)
        _, ok = _lookup(self.grams, h[kept])
        hits, of = at[kept[ok]], doc[kept[ok]]
        steps = np.arange(self.window - self.k + 1)
        begin = (hits[:, None] - steps).ravel()
        of = np.repeat(of, len(steps))
        fits = (begin >= w.first[of]) & (begin + self.window <= w.first[of + 1])
        begin = np.unique(begin[fits])
        if not len(begin):
            return begin, np.zeros(0, np.uint64)
        return begin, windows(w.hashes[begin[:, None] + np.arange(self.window)].T, self.window)[0]


def _lookup(table: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(table):
        return np.zeros(len(h), np.int64), np.zeros(len(h), bool)
    at = np.searchsorted(table, h)
    at[at == len(table)] = 0
    return at, table[at] == h


def _scan(docs: DataFrame, index: BenchmarkIndex) -> DataFrame:
    """``i, k, n_words, hits, items`` of every row for one block of items."""
    shared = docs.sparkSession.sparkContext.broadcast(index)

    def scan(rows: pa.RecordBatch):
        index = shared.value
        for start, data, offsets in text_blocks(rows["t"]):
            w, n = Words(data, offsets, ALNUM), len(offsets) - 1
            marks = np.zeros(len(w.hashes) + 1, dtype=np.int32)
            pairs = []
            for at, length, which, (_, first, item) in index.matches(w):
                np.add.at(marks, at, 1)
                np.add.at(marks, at + length, -1)
                doc = np.searchsorted(w.first, at, side="right") - 1
                many = first[which + 1] - first[which]
                entry = np.repeat(first[which] - np.cumsum(many) + many, many) + np.arange(many.sum())
                pairs.append(np.repeat(doc, many) * len(index.items) + item[entry])
            hit = np.cumsum(marks[:-1]) > 0
            # runs of hit words, cut at the ends of texts, as offsets in the text
            edge = np.zeros(len(hit) + 1, dtype=bool)
            edge[w.first] = True
            begin = np.flatnonzero(hit & (edge[:-1] | ~np.concatenate([[False], hit[:-1]])))
            end = np.flatnonzero(hit & (edge[1:] | ~np.concatenate([hit[1:], [False]]))) + 1
            doc = np.searchsorted(w.first, begin, side="right") - 1
            spans = pa.ListArray.from_arrays(
                pa.array(np.searchsorted(doc, np.arange(n + 1)).astype(np.int32)),
                pa.StructArray.from_arrays([pa.array(begin - w.first[doc]), pa.array(end - w.first[doc])], names=["s", "e"]))
            pair = np.unique(np.concatenate(pairs)) if pairs else np.zeros(0, np.int64)
            doc, item = pair // max(len(index.items), 1), pair % max(len(index.items), 1)
            items = pa.ListArray.from_arrays(pa.array(np.searchsorted(doc, np.arange(n + 1)).astype(np.int32)),
                                             pa.array([index.items[x] for x in item], pa.string()))
            yield batch(i=rows["i"].slice(start, n), k=rows["k"].slice(start, n), n_words=w.counts.astype(np.int64), hits=spans, items=items)

    return map_rows(docs, scan, f"i {docs.schema['i'].dataType.simpleString()}, k bigint, n_words bigint, hits array<struct<s:bigint,e:bigint>>, items array<string>")


def covered(spans: Column) -> Column:
    """Words under a union of spans ``(s, e)``."""
    zero = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("e"))
    return F.aggregate(F.array_sort(spans), zero, lambda a, x: F.struct(
        (a["n"] + F.greatest(F.lit(0), x["e"] - F.greatest(x["s"], a["e"]))).alias("n"), F.greatest(a["e"], x["e"]).alias("e")))["n"]


def _blocks(benchmark: DataFrame, window: int, k: int, block_words: int, item_col: str, item_text_col: str) -> Iterator[BenchmarkIndex]:
    """Indexes of the benchmark, one block of items after the other."""
    items = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("id"), F.coalesce(F.col(item_text_col), F.lit("")).alias("text"))
    # a word takes two bytes at least, its separator counted
    size = items.agg(F.sum(F.octet_length("text") + 1)).first()[0] or 0
    blocks = max(1, -(-size // (2 * block_words)))
    for b in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == b).collect()
        yield BenchmarkIndex([r["id"] for r in rows], [r["text"] for r in rows], window, k)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = 10, k: int = 5, block_words: int = 4_000_000,
                      text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without a hit."""
    for index in _blocks(benchmark, window, k, block_words, item_col, item_text_col):
        docs = filter_rows(docs, text_col, _clean(docs.sparkSession.sparkContext.broadcast(index)))
    return docs


def _clean(shared):
    def keep(texts: pa.Array) -> np.ndarray:
        mask = np.ones(len(texts), dtype=bool)
        for start, data, offsets in text_blocks(texts):
            w = Words(data, offsets, ALNUM)
            for at, _, _, _ in shared.value.matches(w):
                mask[start + np.searchsorted(w.first, at, side="right") - 1] = False
        return mask
    return keep


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = 10, k: int = 5, block_words: int = 4_000_000,
                  id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``id, n_words, n_hit, hits (word spans), items, contaminated`` of every
    document row."""
    blocks = _blocks(benchmark, window, k, block_words, item_col, item_text_col)
    source = docs.select(F.col(id_col).alias("i"), F.xxhash64(text_col).alias("k"), F.col(text_col).alias("t"))

    first, *more = (_scan(source, index) for index in blocks)
    found = first
    if more:
        # equal rows have equal hits in every block: unite them by row content
        found = (reduce(DataFrame.unionAll, more, first)
                 .groupBy("i", "k", "n_words").agg(F.count("*").alias("n"), F.flatten(F.collect_list("hits")).alias("hits"), F.flatten(F.collect_list("items")).alias("items"))
                 .withColumn("copy", F.explode(F.sequence(F.lit(1), (F.col("n") / (1 + len(more))).cast("int")))))
    return found.select(F.col("i").alias(id_col), "n_words", covered(F.col("hits")).alias("n_hit"), "hits",
                        F.array_sort(F.array_distinct("items")).alias("items"), (F.size("hits") > 0).alias("contaminated"))
