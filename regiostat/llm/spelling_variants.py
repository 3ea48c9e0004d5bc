"""Spelling variants by a bit-sliced position index.

Words.  Runs of Latin letters are counted over the whole corpus with SQL
functions (partial sums per task, so a frequent word never gathers anywhere).

Near words (one inserted, deleted or replaced code point).  The vocabulary is
cut into blocks; 64 words of a block are a *lane*, and the index holds, for each
lane, position and letter, one 64-bit set of the words with that letter there.
A query word walks its letters once and keeps, word-parallel, the set with no
error (``E``: position ``i`` matches), the set with one replacement (``R``), and
the set with one inserted letter (``I``: position ``i + 1`` matches from there on):

    I = I & at[i + 1][q_i] | E'      R = R & at[i][q_i] | E      E' = E & at[i][q_i]

Deletions are insertions seen from the other word.  All queries of a task do
this together as array operations.

Blocks.  For a pair whose shorter word has ``m`` letters, let ``p`` be the length
of the common beginning (at most ``m``).  A pair with ``lo <= p < hi`` agrees in its
first ``lo`` letters and its last ``m - hi``: these are the key of block
``(m, lo, hi)``, and the recurrences take an error only at positions of ``[lo, hi)``,
so every pair is found in exactly one block.  A block with more than
``block_words`` words is halved, ``[lo, mid)`` and ``[mid, hi)``, with longer keys,
until it is small or one position wide (then at most alphabet squared words): no
frequent beginning or ending meets in one task, and no pair is lost.

Results.  One row per word.  Null texts have no words; a null id counts as empty text
in the crc32.  Ties of the form go to the least word by code point.  Repeated
rows count as often as they occur.  An empty table has no words.  Other columns are
not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regiostat.llm.common import LOWER, UPPER, find_package, starts_of
from regiostat.session import materialize

#: Letters of a word: all below 256, so a word is a row of Latin-1 bytes.
LETTERS = r"[A-Za-zÀ-ÿ]+"
_CODE = np.full(256, -1, np.int64)
_CODE[[*range(0x61, 0x7B), *range(0xC0, 0x100)]] = np.arange(26 + 64)
_ALPHABET = 26 + 64
_PAIRS = 1 << 19       # (query, lane) pairs in one go
_ONE = np.uint64(1)


def vocabulary(docs: DataFrame, typo_every: int = 97, least_length: int = 5, least_count: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``word, n`` of all words of ``least_length`` code points or more that
    occur ``least_count`` times or more."""
    runs = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("d"),
                       F.explode(F.regexp_extract_all(F.col(text_col), F.lit(LETTERS), F.lit(0))).alias("run"))
    lowered = runs.select("d", F.translate("run", UPPER, LOWER).alias("run")).where(F.length("run") >= least_length)
    h, n = F.crc32(F.concat("d", F.lit(":"), "run").cast("binary")), F.length("run")
    at = (h % n).cast("int")
    word = F.when(h % typo_every == 0, F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, n))).otherwise(F.col("run"))
    return (lowered.select(word.alias("word")).where(F.length("word") >= least_length).groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_count))


def _key(rows: DataFrame) -> DataFrame:
    """The key text of a word in block ``(m, lo, hi)``."""
    tail = F.greatest(F.lit(0), F.col("m") - F.col("hi"))
    return rows.withColumn("key", F.concat(F.substring(F.col("word"), F.lit(1), F.col("lo")), F.lit("|"), F.substring(F.col("word"), F.length("word") - tail + 1, tail)))


def blocks(words: DataFrame, block_words: int) -> DataFrame:
    """``m, lo, hi, key, word, n``: every word in all its blocks, none of
    which is large."""
    length = F.length("word")
    start = words.select("word", "n", F.explode(F.array(length, length - 1)).alias("m"))
    half = F.floor(F.col("m") / 2).cast("int")
    start = _key(start.select("word", "n", "m", F.explode(F.array(F.struct(F.lit(0).alias("lo"), half.alias("hi")), F.struct(half.alias("lo"), (F.col("m") + 1).alias("hi")))).alias("x"))
                 .select("word", "n", "m", "x.lo", "x.hi"))
    done, open_ = None, materialize(start, "blocks")
    block = ["m", "lo", "hi", "key"]
    while True:
        large = open_.groupBy(*block).agg(F.count(F.lit(1)).alias("size")).where((F.col("size") > block_words) & (F.col("hi") - F.col("lo") > 1)).select(*block)
        large = materialize(large, "large")
        if large.isEmpty():
            return open_ if done is None else done.unionByName(open_)
        small = open_.join(large, block, "left_anti")
        done = small if done is None else done.unionByName(small)
        mid = ((F.col("lo") + F.col("hi")) / 2).cast("int")
        halves = open_.join(large, block, "left_semi").withColumn("x", F.explode(F.array(F.struct(F.col("lo"), mid.alias("hi")), F.struct(mid.alias("lo"), F.col("hi")))))
        open_ = materialize(_key(halves.select("word", "n", "m", "x.lo", "x.hi")), "blocks")


def near_in(m: int, lo: int, hi: int, block: np.ndarray, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (index of a word of ``m`` letters, index of a near word of ``m``
    or ``m + 1``) whose common beginning is in ``[lo, hi)``; ``block`` numbers the
    sorted blocks of the words."""
    raw = np.frombuffer("".join(words).encode("latin-1"), np.uint8)
    length = np.array([len(w) for w in words], np.int64)
    offset = np.cumsum(length) - length
    # lanes of 64 words of one block
    first = starts_of(block)
    size = np.diff(np.append(first, len(block)))
    lanes = -(-size // 64)
    lane0 = np.cumsum(lanes) - lanes
    place = np.arange(len(block)) - np.repeat(first, size)
    lane, bit = np.repeat(lane0, size) + place // 64, _ONE << (place % 64).astype(np.uint64)
    owner = np.full((int(lanes.sum()), 64), -1, np.int64)
    owner[lane, place % 64] = np.arange(len(block))
    stop = min(hi, m)                        # letters of a query that can err
    width = stop - lo + 1                    # positions lo..stop of the index
    at = np.zeros((width, int(lanes.sum()), _ALPHABET), np.uint64)
    for i in range(width):
        have = np.flatnonzero(length > lo + i)
        np.bitwise_or.at(at[i], (lane[have], _CODE[raw[offset[have] + lo + i]]), bit[have])
    same, longer = np.zeros(int(lanes.sum()), np.uint64), np.zeros(int(lanes.sum()), np.uint64)
    np.bitwise_or.at(same, lane[length == m], bit[length == m])
    np.bitwise_or.at(longer, lane[length == m + 1], bit[length == m + 1])
    # every query with every lane of its block
    query = np.flatnonzero(length == m)
    of = (np.cumsum(np.bincount(first, minlength=len(block))) - 1)[query]
    many = lanes[of]
    ends = np.cumsum(many)
    found_q, found_w = [], []
    cut = 0
    while cut < len(query):
        to = max(cut + 1, int(np.searchsorted(ends, (ends[cut - 1] if cut else 0) + _PAIRS, side="right")))
        q = np.repeat(query[cut:to], many[cut:to])
        into = np.arange(len(q)) - np.repeat(ends[cut:to] - many[cut:to] - (ends[cut - 1] if cut else 0), many[cut:to])
        ln = lane0[np.repeat(of[cut:to], many[cut:to])] + into
        none = same[ln] | longer[ln]
        replaced, inserted = np.zeros_like(none), np.zeros_like(none)
        for i in range(lo, stop):            # letter i of the query
            c = _CODE[raw[offset[q] + i]]
            here = at[i - lo, ln, c]
            inserted = (inserted | none) & at[i - lo + 1, ln, c]
            replaced = (replaced & here) | (none & ~here)
            none = none & here
        # insertion behind the last letter; what agrees further than hi is another block's
        inserted = (inserted | none if hi > m else inserted & ~none) & longer[ln]
        replaced = replaced & same[ln] & ~none
        for hits in (replaced, inserted):
            some = np.flatnonzero(hits)
            if len(some):
                bits = np.unpackbits(hits[some].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
                r, b = np.nonzero(bits)
                found_q.append(q[some[r]])
                found_w.append(owner[ln[some[r]], b])
        cut = to
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *found_q]), np.concatenate([none, *found_w])


def near_pairs(placed: DataFrame, task_words: int = 200_000) -> DataFrame:
    """``word, other, n_other`` of all near words, in both directions."""
    find_package(placed.sparkSession)

    def solve(rows: pa.Table):
        def columns():
            return (*(rows[k].to_numpy().astype(np.int64) for k in ("m", "lo", "hi")), pa.concat_arrays(rows["key"].chunks).dictionary_encode().indices.to_numpy().astype(np.int64))

        def changes(*values: np.ndarray) -> np.ndarray:
            return np.append(np.flatnonzero(np.concatenate([[True], np.logical_or.reduce([v[1:] != v[:-1] for v in values])])), len(values[0]))

        size = np.diff(changes(*columns()))
        rows = rows.filter(pa.array(np.repeat(size > 1, size)))  # a word alone in its block has no near word there
        if not len(rows):
            return
        m, lo, hi, key = columns()
        words, n = rows["word"].to_pylist(), rows["n"].to_numpy()
        kinds = changes(m, lo, hi)
        for a, b in zip(kinds[:-1].tolist(), kinds[1:].tolist()):
            # at most 4 M sets of the index in one go, cut between blocks
            most = max(1, (1 << 22) // (_ALPHABET * int(min(hi[a], m[a]) - lo[a] + 1)))
            start = np.append(a + starts_of(key[a:b]), b)
            x = 0
            while x < len(start) - 1:
                y = max(x + 1, int(np.searchsorted(start, start[x] + most, side="right")) - 1)
                s, e = int(start[x]), int(start[y])
                q, w = near_in(int(m[a]), int(lo[a]), int(hi[a]), key[s:e], words[s:e])
                x = y
                if len(q):
                    q, w = q + s, w + s
                    longer = np.array([len(words[i]) for i in w.tolist()]) > m[a]
                    # equal lengths are found from both sides, others from the shorter word
                    one, two = np.concatenate([q, w[longer]]), np.concatenate([w, q[longer]])
                    yield pa.RecordBatch.from_arrays([pa.array([words[i] for i in one.tolist()], pa.string()), pa.array([words[i] for i in two.tolist()], pa.string()), pa.array(n[two], pa.int64())], names=["word", "other", "n_other"])

    def run(batches):
        held, size = [], 0
        for rows in batches:
            if not rows.num_rows:
                continue
            held.append(rows)
            size += rows.num_rows
            if size >= task_words:  # keep the last block, it may go on
                rows = pa.Table.from_batches(held).combine_chunks()
                last = [rows[k][-1].as_py() for k in ("m", "lo", "hi", "key")]
                same = np.ones(len(rows), bool)
                for k, v in zip(("m", "lo", "hi", "key"), last):
                    same &= pa.compute.equal(rows[k], v).to_numpy()
                cut = int(np.flatnonzero(~same)[-1]) + 1 if (~same).any() else 0
                if cut:
                    yield from solve(rows.slice(0, cut))
                    held, size = rows.slice(cut).to_batches(), len(rows) - cut
        if held:
            yield from solve(pa.Table.from_batches(held))

    block = ["m", "lo", "hi", "key"]
    return placed.repartition(*block).sortWithinPartitions(*block).select(*block, "word", "n").mapInArrow(run, "word string, other string, n_other bigint")


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` of the words of ``forms(word, form)``: forms followed to the
    last.  Counts at least double from word to form, so a chain is short, and
    every round doubles the steps taken."""
    up = materialize(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        over = up.select(F.col("word").alias("root"), F.col("root").alias("next"))
        up = materialize(up.join(over, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        if up.where("moved").isEmpty():
            return up.drop("moved")
        up = up.drop("moved")


def variants(docs: DataFrame, typo_every: int = 97, least_length: int = 5, least_count: int = 3, ratio: int = 2, block_words: int = 4096, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word of the corpus."""
    words = materialize(vocabulary(docs, typo_every, least_length, least_count, id_col, text_col), "vocabulary")
    near = near_pairs(blocks(words, block_words))
    best = F.min(F.struct((-F.col("n_other")).alias("n"), F.col("other").alias("w")))
    found = near.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    joined = words.join(found, "word", "left").withColumn("ok", F.coalesce(-F.col("best.n") >= ratio * F.col("n"), F.lit(False)))
    told = materialize(joined.select("word", F.when(F.col("ok"), F.col("best.w")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
                                     F.when(F.col("ok"), -F.col("best.n")).alias("form_n")), "forms")
    return told.join(roots(told.where("form IS NOT NULL")), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def oracle(typo_every: int = 97, least_length: int = 5, least_count: int = 3, ratio: int = 2) -> str:
    """The same in DuckDB SQL: near words share what is left when one code
    point is deleted."""
    byte = "CAST('0x' || substr(x, 2 * i + 1, 2) AS BIGINT)"
    return rf"""
WITH RECURSIVE tab AS MATERIALIZED (
  SELECT list_transform(range(256), lambda b: list_reduce([b] || range(8), lambda c, k: xor(c >> 1, 3988292384 * (c & 1)))) AS tab),
runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS d, translate(unnest(regexp_extract_all(text, '{LETTERS}')), '{UPPER}', '{LOWER}') AS run FROM documents),
distinct_runs AS (SELECT d, run, count(*) AS n, hex(encode(d || ':' || run)) AS x FROM runs WHERE length(run) >= {least_length} GROUP BY d, run),
marked AS (
  SELECT run, n, xor(list_reduce([4294967295::BIGINT] || list_transform(range(0, length(x) // 2), lambda i: {byte}),
                                 lambda c, b: xor(c >> 8, tab[xor(c & 255, b) + 1])), 4294967295) AS h FROM distinct_runs, tab),
words AS (
  SELECT CASE WHEN h % {typo_every} = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, CAST(sum(n) AS BIGINT) AS n
  FROM marked GROUP BY 1 HAVING length(word) >= {least_length} AND sum(n) >= {least_count}),
short AS (
  SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS v FROM (SELECT word, n, CAST(unnest(range(1, length(word) + 1)) AS BIGINT) AS i FROM words)),
near AS (
  SELECT DISTINCT a.word, b.word AS other, b.n FROM short a JOIN short b ON a.i = b.i AND a.v = b.v AND a.word <> b.word AND length(a.word) = length(b.word)
  UNION SELECT a.word, b.word, b.n FROM words a JOIN short b ON a.word = b.v
  UNION SELECT b.word, a.word, a.n FROM words a JOIN short b ON a.word = b.v),
best AS (SELECT word, count(*) AS n_near, min(struct_pack(a := -n, b := encode(other))) AS best FROM near GROUP BY word),
forms AS (
  SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN -best.a >= {ratio} * w.n THEN decode(best.b) END AS form, CASE WHEN -best.a >= {ratio} * w.n THEN -best.a END AS form_n
  FROM words w LEFT JOIN best b USING (word)),
chain AS (
  SELECT word, form AS root FROM forms WHERE form IS NOT NULL
  UNION SELECT c.word, f.form FROM chain c JOIN forms f ON f.word = c.root WHERE f.form IS NOT NULL),
ends AS (SELECT c.word, c.root FROM chain c JOIN forms f ON f.word = c.root WHERE f.form IS NULL)
SELECT f.word, f.form, coalesce(e.root, f.word) AS root, f.n, CAST(f.n_near AS BIGINT) AS n_near, CAST(f.form_n AS BIGINT) AS form_n FROM forms f LEFT JOIN ends e USING (word)"""
