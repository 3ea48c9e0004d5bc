"""Mixing sources to target weights by Pareto order sampling.

Targets: the sources, in order of their names, weigh 1, 2, 3, 1, ... and share
the words of all documents; none gets more than ``max_copies`` times its own
words, what it cannot take is shared out again by weight.

Inclusion: inside a source every document gets an expected number of copies
proportional to the weight of its length class (``classes``), at most
``max_copies``, so that the expected words meet the target.  The whole copies
of that number are taken for certain.  The rest is an inclusion probability
``p``: documents are ranked by their random odds divided by their inclusion
odds, ``(u / (1 - u)) / (p / (1 - p))``, and taken in that order as long as
the words left to the target allow it.  One closing draw takes the document,
of those left, that comes nearest to the remaining gap if it narrows it.
``u`` is a hash of seed and id, so reruns agree.

DataFrame functions only, and no source is ever gathered in one task: the
place in the ranking where the words run out is found by two histograms of
4096 steps each (one row per source and step), and exact order is only
needed among the documents of one fine step.  Every document then compares
its own key with its source's cut.

Results: one row per document row.  Null text has size 0, null source is a
source of its own (the last).  Rows with equal id, size and source share one
key and are taken or left together.  Empty tables give empty results; other
columns are passed on by ``mixed`` and not read by ``mix``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from regiostat.session import materialize

WORD = r"[^\x20\x09-\x0D]+"
STEPS = 4096
#: (words from which it holds, weight): documents under 50 words weigh half.
CLASSES = ((0, 1.0), (50, 2.0))


def fill(df: DataFrame, part: list[str], total: str, cap: str, weight: str, out: str) -> DataFrame:
    """Share ``total`` among the rows of a part by ``weight`` with no row
    above its ``cap``; what a full row cannot take goes to the others.  Rows
    fill up in order of cap by weight, so running sums decide it."""
    order = Window.partitionBy(*part).orderBy(F.col("_r"), F.col(cap), F.col(weight))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy(*part)
    ratio = F.when(F.col(weight) > 0, F.col(cap) / F.col(weight)).otherwise(F.lit(0.0))
    level = (F.col(total) - F.coalesce(F.sum(cap).over(before), F.lit(0))) / F.nullif(F.sum(weight).over(every) - F.coalesce(F.sum(weight).over(before), F.lit(0)), F.lit(0))
    df = df.withColumn("_r", ratio).withColumn("_full", F.coalesce(F.col("_r") <= level, F.lit(True)))
    caps, weights = (F.sum(F.when(F.col("_full"), F.col(c)).otherwise(0)).over(every) for c in (cap, weight))
    level = (F.col(total) - caps) / F.nullif(F.sum(weight).over(every) - weights, F.lit(0))
    return df.withColumn(out, F.when(F.col("_full"), F.col(cap).cast("double")).otherwise(level * F.col(weight))).drop("_r", "_full")


def sized(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """``i, source, key, size, class, u`` of every row."""
    size = F.regexp_count(F.coalesce(F.col(text_col), F.lit("")), F.lit(WORD)).cast("bigint")
    return docs.select(F.col(id_col).alias("i"), F.col(source_col).alias("source"), size.alias("size"))


def _keys(rows: DataFrame, seed: int) -> DataFrame:
    key = F.when(F.col("source").isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), F.col("source").cast("string")))
    cls = F.lit(0)
    for n, (least, _) in enumerate(CLASSES):
        cls = F.when(F.col("size") >= least, F.lit(n)).otherwise(cls)
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("i").cast("string"), F.lit(""))).cast("binary"))
    u = (F.conv(F.substring(digest, 1, 13), 16, 10).cast("bigint") + F.lit(0.5)) / F.lit(float(1 << 52))
    return rows.withColumns({"key": key, "class": cls, "u": u})


def plan(rows: DataFrame, weights: tuple[float, ...], max_copies: int) -> DataFrame:
    """``key, class, source_size, target, copies`` for each source and class
    (a few rows per source); ``copies`` is the expected number per document."""
    by_class = rows.groupBy("key", "source", "class").agg(F.sum("size").alias("words"))
    source = by_class.groupBy("key", "source").agg(F.sum("words").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    source = source.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights) + 1).cast("int")))
    source = source.withColumn("total", F.sum("source_size").over(Window.partitionBy())).withColumn("cap", max_copies * F.col("source_size"))
    source = fill(source, [], "total", "cap", "weight", "target").select("key", "source_size", "target")
    weight = F.element_at(F.array(*[F.lit(w) for _, w in CLASSES]), F.col("class") + 1)
    both = by_class.join(source, "key").withColumn("share", weight * F.col("words")).withColumn("cap", max_copies * F.col("words"))
    both = fill(both, ["key"], "target", "cap", "share", "given")
    # a class without words still has documents; they weigh nothing
    copies = F.when(F.col("words") > 0, F.least(F.lit(float(max_copies)), F.col("given") / F.col("words"))).otherwise(F.lit(0.0))
    return both.select("key", "class", "source_size", "target", copies.alias("copies"))


def _cumulated(df: DataFrame, by: list[str], value: str) -> DataFrame:
    order = Window.partitionBy("key").orderBy(*by)
    return df.withColumn("upto", F.sum(value).over(order.rowsBetween(Window.unboundedPreceding, 0)))


def cuts(pool: DataFrame, need: DataFrame) -> DataFrame:
    """Per source the key ``(v, i, size)`` at which the words run out
    (exclusive) and the gap that is left; ``pool`` has ``key, v, i, size``,
    ``need`` ``key, need``."""
    pool = pool.withColumn("b1", F.floor(F.col("v") * STEPS).cast("int")).withColumn("b2", F.floor((F.col("v") * STEPS - F.floor(F.col("v") * STEPS)) * STEPS).cast("int"))
    state = need.withColumn("done", F.lit(0).cast("bigint"))
    inside = pool
    for step in ("b1", "b2"):
        counts = inside.groupBy("key", step).agg(F.sum("size").alias("words"))
        counts = _cumulated(counts, [step], "words").join(state, "key")
        over = counts.where(F.col("done") + F.col("upto") > F.col("need"))
        first = over.groupBy("key").agg(F.min(F.struct(F.col(step).alias("at"), (F.col("done") + F.col("upto") - F.col("words")).alias("done"))).alias("x"))
        state = materialize(need.join(first, "key").select("key", "need", F.col("x.at").alias(f"at_{step}"), F.col("x.done").alias("done")), "cut")
        inside = inside.join(state.select("key", f"at_{step}"), "key").where(F.col(step) == F.col(f"at_{step}"))
    fine = _cumulated(inside.select("key", "v", "i", "size"), ["v", "i", "size"], "size").join(state.select("key", "need", "done"), "key")
    over = fine.where(F.col("done") + F.col("upto") > F.col("need"))
    return over.groupBy("key").agg(F.min(F.struct("v", "i", "size")).alias("cut"))


def mix(docs: DataFrame, weights: tuple[float, ...] = (1, 2, 3), max_copies: int = 3, seed: int = 17,
        id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``id, size, source_size, target, taken, copies`` of every row."""
    rows = _keys(materialize(sized(docs, id_col, text_col, source_col), "sizes"), seed)
    return _decided(rows, weights, max_copies).select(F.col("i").alias(id_col), "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies")


def _decided(rows: DataFrame, weights: tuple[float, ...], max_copies: int) -> DataFrame:
    planned = materialize(plan(rows, weights, max_copies).withColumn("certain", F.floor("copies").cast("bigint")).withColumn("p", F.col("copies") - F.floor("copies")).drop("copies"), "plan")
    ranked = rows.join(planned, ["key", "class"])
    odds = (F.col("u") / (1 - F.col("u"))) / (F.col("p") / (1 - F.col("p")))
    ranked = ranked.withColumn("v", F.when(F.col("p") > 0, odds / (1 + odds)))
    pool = ranked.where(F.col("v").isNotNull()).select("key", "v", "i", "size")
    certain = ranked.groupBy("key").agg((F.max("target") - F.sum(F.col("certain") * F.col("size"))).alias("need"))
    certain = materialize(certain, "need")
    cut = materialize(cuts(pool, certain), "cuts")
    # an absent cut: all of the pool fits
    mine = F.struct("v", "i", "size")
    left = pool.join(cut, "key").where(mine >= F.col("cut"))
    within = F.col("cut").isNull() | (mine < F.col("cut"))
    used = pool.join(cut, "key", "left").groupBy("key").agg(F.sum(F.when(within, F.col("size")).otherwise(0)).alias("used"))
    gap = materialize(certain.join(used, "key").select("key", (F.col("need") - F.col("used")).alias("gap")), "gap")
    closing = (left.join(gap, "key").where(F.abs(F.col("gap") - F.col("size")) < F.col("gap"))
               .groupBy("key").agg(F.min(F.struct(F.abs(F.col("gap") - F.col("size")).alias("off"), "v", "i", "size")).alias("c"))
               .select("key", F.struct("c.v", "c.i", "c.size").alias("closing")))
    closed = materialize(gap.select("key").join(cut, "key", "left").join(closing, "key", "left"), "closing")
    chosen = F.col("v").isNotNull() & (F.col("cut").isNull() | (mine < F.col("cut")) | F.coalesce(mine.eqNullSafe(F.col("closing")), F.lit(False)))
    return ranked.join(closed, "key", "left").withColumn("copies", F.col("certain") + chosen.cast("bigint"))


def mixed(docs: DataFrame, weights: tuple[float, ...] = (1, 2, 3), max_copies: int = 3, seed: int = 17,
          id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as it is taken."""
    names = docs.columns
    size = F.regexp_count(F.coalesce(F.col(text_col), F.lit("")), F.lit(WORD)).cast("bigint")
    rows = materialize(docs.select(F.struct(*names).alias("d"), F.col(id_col).alias("i"), F.col(source_col).alias("source"), size.alias("size")), "sizes")
    out = _decided(_keys(rows, seed), weights, max_copies).where(F.col("copies") > 0)
    return out.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("d.*")


def oracle(docs: str = "documents", weights: tuple[float, ...] = (1, 2, 3), max_copies: int = 3, seed: int = 17) -> str:
    """The same rows as DuckDB SQL, ranked by plain windows."""
    cls = "CASE " + " ".join(f"WHEN size >= {least} THEN {n}" for n, (least, _) in reversed(list(enumerate(CLASSES)))) + " END"
    weight = "[" + ", ".join(f"{float(w)}" for w in weights) + "]"
    class_weight = "[" + ", ".join(f"{w}" for _, w in CLASSES) + "]"

    def filled(name: str, table: str, part: str, total: str, cap: str, w: str, out: str) -> str:
        run = f"{part} ORDER BY r, {cap}, {w} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
        return f"""
{name}_a AS (SELECT *, CASE WHEN {w} > 0 THEN {cap} / {w} ELSE 0 END AS r FROM {table}),
{name}_b AS (SELECT *, coalesce(r <= ({total} - coalesce(sum({cap}) OVER ({run}), 0)) / nullif(sum({w}) OVER ({part}) - coalesce(sum({w}) OVER ({run}), 0), 0), true) AS full_ FROM {name}_a),
{name} AS (SELECT *, CASE WHEN full_ THEN CAST({cap} AS DOUBLE) ELSE ({total} - sum(CASE WHEN full_ THEN {cap} ELSE 0 END) OVER ({part}))
  / nullif(sum({w}) OVER ({part}) - sum(CASE WHEN full_ THEN {w} ELSE 0 END) OVER ({part}), 0) * {w} END AS {out} FROM {name}_b)"""
    return f"""
WITH d AS (SELECT doc_id, source, coalesce('s' || source, 'n') AS key, CAST(len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS BIGINT) AS size,
  (CAST('0x' || substr(md5('{seed}:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) + 0.5::DOUBLE) / {float(1 << 52)}::DOUBLE AS u FROM {docs}),
c AS (SELECT *, {cls} AS class FROM d),
bc AS (SELECT key, source, class, CAST(sum(size) AS DOUBLE) AS words FROM c GROUP BY key, source, class),
s AS (SELECT key, source, sum(words) AS source_size, {max_copies} * sum(words) AS cap FROM bc GROUP BY key, source),
s2 AS (SELECT *, {weight}[(row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(weights)} + 1]::DOUBLE AS weight, sum(source_size) OVER () AS total FROM s),
{filled('sf', 's2', '', 'total', 'cap', 'weight', 'target')},
k AS (SELECT bc.key, class, words, source_size, target, {class_weight}[class + 1]::DOUBLE * words AS share, {max_copies} * words AS ccap FROM bc JOIN sf USING (key)),
{filled('kf', 'k', 'PARTITION BY key', 'target', 'ccap', 'share', 'given')},
p AS (SELECT key, class, source_size, target, CASE WHEN words > 0 THEN least({float(max_copies)}, given / words) ELSE 0 END AS copies FROM kf),
r AS (SELECT c.*, source_size, target, CAST(floor(copies) AS BIGINT) AS certain, copies - floor(copies) AS p FROM c JOIN p USING (key, class)),
q AS (SELECT *, CASE WHEN p > 0 THEN (u / (1 - u)) / (p / (1 - p)) END AS odds FROM r),
v AS (SELECT *, odds / (1 + odds) AS v, target - sum(certain * size) OVER (PARTITION BY key) AS need FROM q),
w AS (SELECT *, CASE WHEN v IS NOT NULL THEN sum(size) OVER (PARTITION BY key, v IS NULL ORDER BY v, doc_id, size ROWS UNBOUNDED PRECEDING) END AS upto FROM v),
cut AS (SELECT key, min({{'v': v, 'i': doc_id, 's': size}}) AS cut FROM w WHERE upto > need GROUP BY key),
x AS (SELECT w.*, v IS NOT NULL AND (cut IS NULL OR {{'v': v, 'i': doc_id, 's': size}} < cut) AS fits FROM w LEFT JOIN cut USING (key)),
y AS (SELECT *, need - sum(CASE WHEN fits THEN size ELSE 0 END) OVER (PARTITION BY key) AS gap FROM x),
z AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY (v IS NOT NULL AND NOT fits AND abs(gap - size) < gap) DESC, abs(gap - size), v, doc_id, size) = 1
  AND v IS NOT NULL AND NOT fits AND abs(gap - size) < gap AS closing FROM y)
SELECT doc_id, size, CAST(source_size AS BIGINT) AS source_size, target, CAST((certain + CASE WHEN fits OR closing THEN 1 ELSE 0 END) * size AS BIGINT) AS taken,
  CAST(certain + CASE WHEN fits OR closing THEN 1 ELSE 0 END AS BIGINT) AS copies FROM z"""
