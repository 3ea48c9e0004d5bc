"""MinHash near-duplicates verified by odd sketches.

1. One pass turns every text into its set of word shingles (64-bit hashes):
   the set's size, a 128-bit fingerprint of the set, ``bands * rows`` MinHash
   samples folded into band keys, and an *odd sketch*: the parity bitmap of
   the samples.  Documents with equal sets form one class from here on, so
   exact copies cost one row, not pairs.
2. Classes that share a band key are candidates.  In a bucket of more than
   ``small_bucket`` classes all are compared with one pivot, its least one,
   never all with all.
3. A candidate pair is dropped if the sizes rule the similarity out, or if the
   XOR of the sketches has so many bits that the estimate
   ``1 + n / 4k * ln(1 - 2 z / n)`` lies ``slack`` below the threshold (more
   than five standard errors); all others are compared on their full sets.
4. Components of the links are taken.  Large buckets whose classes still lie
   in several components are taken up again with one further pivot, then by
   pairs from different components, each looked at in the first band it shares,
   with all tests inside the join, so that only links come out of it.  Thus every pair with a common band key is either joined, in one component
   already, or refused by a test.

With 32 bands of 4 rows a pair at similarity 0.8 shares no band with a
probability of 5e-8, and less above.

Results: one row per document row.  Null or empty text (no words) has an
empty set, links with nothing and is its own component.  Rows that repeat a
doc_id are one node.  A null doc_id links like any other row, but names no
component (its component is null if it has no partner with an id).  Empty
tables give empty results; other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regiostat.llm.common import batch, join_ids, map_rows
from regiostat.llm.components import components
from regiostat.llm.textvec import Words, doc_windows, mix64, text_blocks, windows
from regiostat.session import materialize

BANDS, ROWS = 32, 4
SKETCH_BITS = 256
#: Rounds for buckets with several components; the last one is exhaustive.
TURNS = 2


def shingle_sets(data: np.ndarray, offsets: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each text of a block, in order: ``(text, hash)``;
    a text with fewer words is one shingle."""
    w = Words(data, offsets)
    h, _, doc = doc_windows(w, words)
    for i in np.flatnonzero((w.counts > 0) & (w.counts < words)):
        h = np.append(h, windows(w.hashes[w.first[i]:w.first[i + 1]], int(w.counts[i])))
        doc = np.append(doc, i)
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    return doc[new], h[new]


def _coefficients(n: int) -> tuple[np.ndarray, np.ndarray]:
    x = mix64(np.arange(1, 2 * n + 1, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407))
    return x[:n] | np.uint64(1), x[n:]


def sketches(docs: DataFrame, words: int, id_col: str, text_col: str) -> DataFrame:
    """``i, n, h1, h2, bands, sketch (4 longs)`` of every row."""
    k = BANDS * ROWS

    def run(rows: pa.RecordBatch):
        a, b = _coefficients(k)
        for start, data, offsets in text_blocks(rows["t"]):
            n = len(offsets) - 1
            doc, h = shingle_sets(data, offsets, words)
            size = np.bincount(doc, minlength=n)
            full = np.flatnonzero(size)
            first = np.concatenate([[0], np.cumsum(size[full])[:-1]]).astype(np.int64)
            bands, h1, h2 = np.zeros((n, BANDS), np.uint64), np.zeros(n, np.uint64), np.zeros(n, np.uint64)
            parity = np.zeros((n, SKETCH_BITS), dtype=np.uint8)
            if len(full):
                with np.errstate(over="ignore"):
                    h1[full] = np.add.reduceat(mix64(h), first)
                    h2[full] = np.bitwise_xor.reduceat(mix64(h ^ np.uint64(0x5851F42D4C957F2D)), first)
                    for j in range(k):
                        least = np.minimum.reduceat(h * a[j] + b[j], first)
                        sample = mix64(least + np.uint64(j))
                        bands[full, j // ROWS] = mix64(bands[full, j // ROWS] + sample + np.uint64(j // ROWS + 1))
                        parity[full, (sample >> np.uint64(56)).astype(np.int64)] ^= 1
            bits = np.packbits(parity, axis=1).view(np.int64).reshape(n, SKETCH_BITS // 64)
            lists = lambda x: pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * x.shape[1]), pa.array(x.view(np.int64).ravel()))
            yield batch(i=rows["i"].slice(start, n), n=size.astype(np.int64), h1=h1.view(np.int64), h2=h2.view(np.int64), bands=lists(bands), sketch=lists(bits))

    return map_rows(docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t")), run,
                    f"i {docs.schema[id_col].dataType.simpleString()}, n bigint, h1 bigint, h2 bigint, bands array<bigint>, sketch array<bigint>")


def most_bits(threshold: float) -> int:
    """Odd bits up to which the estimate reaches ``threshold``."""
    return math.floor(SKETCH_BITS / 2 * (1 - math.exp((threshold - 1) * 4 * BANDS * ROWS / SKETCH_BITS)))


def _likely(a: str, b: str, percent: int, slack: float) -> Column:
    """Size and sketch test of a pair of classes with columns n, sketch."""
    sizes = 100 * F.least(F.col(f"{a}.n"), F.col(f"{b}.n")) >= percent * F.greatest(F.col(f"{a}.n"), F.col(f"{b}.n"))
    x, y = F.col(f"{a}.sketch"), F.col(f"{b}.sketch")
    odd = F.bit_count(x[0].bitwiseXOR(y[0]))
    for i in range(1, SKETCH_BITS // 64):
        odd = odd + F.bit_count(x[i].bitwiseXOR(y[i]))
    return sizes & (odd <= most_bits(percent / 100 - slack))


class _Finder:
    def __init__(self, docs: DataFrame, classes: DataFrame, words: int, percent: int, slack: float, id_col: str, text_col: str):
        self.docs, self.classes = docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t")), classes
        self.words, self.percent, self.slack = words, percent, slack
        self.links: list[DataFrame] = []

    def likely(self, pairs: DataFrame) -> DataFrame:
        """Distinct pairs ``(a, b)`` that pass the size and sketch tests."""
        side = self.classes.select("rep", "n", "sketch")
        tested = (pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
                  .join(side.select(F.col("rep").alias("a"), F.struct("n", "sketch").alias("x")), "a")
                  .join(side.select(F.col("rep").alias("b"), F.struct("n", "sketch").alias("y")), "b"))
        return tested.where(_likely("x", "y", self.percent, self.slack)).select("a", "b")

    def sets(self, ids: DataFrame) -> DataFrame:
        """``i, s``: the full shingle sets of the documents ``ids(i)``."""
        words = self.words

        def run(rows: pa.RecordBatch):
            for start, data, offsets in text_blocks(rows["t"]):
                n = len(offsets) - 1
                doc, h = shingle_sets(data, offsets, words)
                yield batch(i=rows["i"].slice(start, n), s=pa.ListArray.from_arrays(pa.array(np.searchsorted(doc, np.arange(n + 1)).astype(np.int32)), pa.array(h.view(np.int64))))

        texts = join_ids(self.docs, materialize(ids.distinct(), "ids"), "i", "left_semi")
        return materialize(map_rows(texts, run, f"i {texts.schema['i'].dataType.simpleString()}, s array<bigint>"), "sets")

    def similar(self, x: str, y: str) -> Column:
        """The exact test of two sets."""
        common = F.size(F.array_intersect(x, y))
        return 100 * common >= self.percent * (F.size(x) + F.size(y) - common)

    def confirm(self, pairs: DataFrame) -> DataFrame:
        """Those pairs whose full sets are similar enough."""
        pairs = materialize(pairs, "pairs")
        sets = self.sets(pairs.select(F.explode(F.array("a", "b")).alias("i")))
        both = (pairs.join(sets.select(F.col("i").alias("a"), F.col("s").alias("x")), "a")
                .join(sets.select(F.col("i").alias("b"), F.col("s").alias("y")), "b"))
        return both.where(self.similar("x", "y")).select("a", "b").distinct()

    def across(self, rest: DataFrame) -> DataFrame:
        """Links between different components of a bucket.  Every pair is
        looked at in the first band it shares only, and the size, sketch and
        exact tests are all part of the join, so that nothing but links
        comes out of it."""
        sets = self.sets(rest.select(F.col("rep").alias("i")))
        before = F.slice("bands", F.lit(1), (F.array_position("bands", F.col("bucket")) - 1).cast("int"))
        side = materialize(rest.select("bucket", "rep", "component").join(self.classes.select("rep", "n", "sketch", "bands"), "rep")
                           .join(sets.select(F.col("i").alias("rep"), "s"), "rep").withColumn("before", before).drop("bands"), "unsettled")
        meet = (F.col("x.bucket") == F.col("y.bucket")) & (F.col("x.component") < F.col("y.component"))
        # keys of different bands differ, so a common key is a common band
        tests = _likely("x", "y", self.percent, self.slack) & ~F.arrays_overlap("x.before", "y.before") & self.similar("x.s", "y.s")
        return side.alias("x").join(side.alias("y"), meet & tests).select(F.col("x.rep").alias("a"), F.col("y.rep").alias("b")).distinct()

    def add(self, links: DataFrame) -> DataFrame:
        """Take in confirmed links; the components of all links so far."""
        self.links.append(materialize(links, "confirmed"))
        every = self.links[0]
        for more in self.links[1:]:
            every = every.unionAll(more)
        return components(every)


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, slack: float = 0.25, small_bucket: int = 8,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, n_shingles, component_id, kept`` of every row: documents are
    linked if their sets of ``words``-word shingles have at least ``percent``
    of their union in common."""
    rows = materialize(sketches(docs, words, id_col, text_col), "sketches")
    classes = materialize(rows.where("n > 0").groupBy("h1", "h2", "n").agg(F.min("i").alias("rep"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch"))
                          .where("rep IS NOT NULL"), "classes")
    finder = _Finder(docs, classes, words, percent, slack, id_col, text_col)
    banded = classes.select("rep", F.explode("bands").alias("bucket"))
    buckets = materialize(banded.groupBy("bucket").agg(F.min("rep").alias("pivot"), F.count("*").alias("size")).where("size > 1"), "buckets")
    members = materialize(banded.join(buckets, "bucket"), "members")

    # small buckets: every pair; large ones: every class with the pivot
    small = members.where(F.col("size") <= small_bucket).select("bucket", "rep")
    every = small.withColumnRenamed("rep", "a").join(small.withColumnRenamed("rep", "b"), "bucket").where("a < b").select("a", "b")
    star = members.where((F.col("size") > small_bucket) & (F.col("rep") != F.col("pivot"))).select(F.col("pivot").alias("a"), F.col("rep").alias("b"))
    component = finder.add(finder.confirm(finder.likely(every.unionByName(star))))
    large, used = members.where(F.col("size") > small_bucket).select("bucket", "rep"), None
    for turn in range(TURNS):
        rest = _unsettled(large, component)
        if rest is None:
            break
        if turn < TURNS - 1:
            # the next pivot: the least class outside the component of the bucket's least
            pivots = rest.where("component != least")
            if used is not None:
                pivots = pivots.join(used, ["bucket", "rep"], "left_anti")
            pivots = materialize(pivots.groupBy("bucket").agg(F.min(F.struct("rep", "component")).alias("p")).select("bucket", "p.*"), "pivots")
            mine = pivots.select("bucket", F.col("rep").alias("pivot"), F.col("component").alias("own"))
            pairs = rest.join(mine, "bucket").where("component != own").select(F.col("rep").alias("a"), F.col("pivot").alias("b"))
            links = finder.confirm(finder.likely(pairs))
            used = pivots.select("bucket", "rep") if used is None else used.unionAll(pivots.select("bucket", "rep"))
        else:
            links = finder.across(rest)
        component = finder.add(links)

    named = (classes.join(component.select(F.col("node").alias("rep"), "component"), "rep", "left")
             .select("h1", "h2", "n", F.coalesce("component", "rep").alias("component")))
    out = rows.select("i", "n", "h1", "h2").join(named, ["h1", "h2", "n"], "left")
    component_id = F.when(F.col("n") == 0, F.col("i")).otherwise(F.col("component"))
    return out.select(F.col("i").alias(id_col), F.col("n").alias("n_shingles"), component_id.alias("component_id"), F.col("i").eqNullSafe(component_id).alias("kept"))


def deduplicate(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group, the one with the least id (rows
    without an id come last).  Every row takes part under a key of its own, so rows
    without an id and rows that repeat one are searched like others; rows without
    words are nobody's copies, and stay."""
    keyed = materialize(docs.select(F.monotonically_increasing_id().alias("k"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("d")), "keyed")
    found = near_duplicates(keyed.select("k", F.col(f"d.`{text_col}`").alias("t")), words, percent, id_col="k", text_col="t")
    found = materialize(found.where("n_shingles > 0").select("k", "component_id"), "groups")
    named = found.join(keyed.select("k", F.col(f"d.`{id_col}`").alias("i")), "k")
    least = named.groupBy("component_id").agg(F.count(F.lit(1)).alias("size"), F.min(F.struct(F.col("i").isNull().alias("none"), "i", "k")).alias("x")).where("size > 1")
    gone = named.join(least.select("component_id", F.col("x.k").alias("keeper")), "component_id").where("k != keeper").select("k")
    return join_ids(keyed, materialize(gone, "gone"), "k", "left_anti").select("d.*")


def _unsettled(members: DataFrame, component: DataFrame) -> DataFrame | None:
    """``bucket, rep, component, least`` of the buckets with several
    components; None if there is no such bucket."""
    now = (members.join(component.select(F.col("node").alias("rep"), "component"), "rep", "left")
           .withColumn("component", F.coalesce("component", "rep")))
    several = materialize(now.groupBy("bucket").agg(F.min("component").alias("least"), F.max("component").alias("most")).where("least != most").drop("most"), "several")
    return None if several.isEmpty() else materialize(now.join(several, "bucket"), "open")
