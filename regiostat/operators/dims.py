"""Dimension lookups and maintenance.

Row-by-row lookups of the original (one SELECT per CSV row) become one
equi-join per dataset against a broadcast (size-checked) dimension; the
get-or-create of time ids becomes an anti-join + dense numbering + union.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from regiostat.config import NUTS_VINTAGE
from regiostat.functions.timefuncs import time_attributes
from regiostat.operators.joins import join_dimension, prefixes
from regiostat.session import materialize


# -- W1 / W2 --------------------------------------------------------------------
def max_id(df: DataFrame, col: str = "id") -> int:
    """Current maximum id (one scalar aggregate; 0 for an empty table)."""
    m = df.agg(F.max(col)).first()[0]
    return int(m) if m is not None else 0


def dense_id(df: DataFrame, order_cols: list[str], start: int = 1, name: str = "id") -> DataFrame:
    """Surrogate ids ``start, start+1, ...`` in ``order_cols`` order.

    One algorithm at every size: a distributed range sort, stored; the rows
    of a partition are numbered by their place in it plus the rows of the
    partitions before (a running sum over one row per partition)."""
    return serial_id(df.orderBy(*order_cols), start, name)


def serial_id(df: DataFrame, start: int = 1, name: str = "id") -> DataFrame:
    """Surrogate ids in storage order, without a sort: the frame is stored
    once with partition and place of each row, then every partition gets the
    offset that the counts of the others leave it."""
    s = materialize(df.withColumns({"_pid": F.spark_partition_id(), "_mono": F.monotonically_increasing_id()}), "numbered")
    counts = s.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"), F.min("_mono").alias("_first"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # one row per partition: a table that is joined, never a literal
    offsets = materialize(counts.select("_pid", (F.lit(start) + before - F.col("_first")).alias("_off")), "offsets")
    return s.join(offsets, "_pid").withColumn(name, (F.col("_mono") + F.col("_off")).cast("bigint")).drop("_pid", "_mono", "_off")


def first_match(df: DataFrame, key: list[str], order_col: str) -> DataFrame:
    """One row per key (the one with the smallest ``order_col``; ties
    broken by the whole row); the original takes whichever row comes first.

    A ``min`` over ``struct(order_col, row)`` per key: partial aggregation
    keeps a key that holds a large share of the rows from landing whole in
    one task (a ranking window would sort that key's rows in one task)."""
    rest = [c for c in df.columns if c not in key]
    ordered = [order_col] + [c for c in rest if c != order_col]
    cols = [F.col(order_col).isNull().alias("_null_last")] + [F.col(c).alias(c) for c in ordered]
    best = df.groupBy(*key).agg(F.min(F.struct(*cols)).alias("_best"))
    return best.select(*key, *[F.col("_best")[c].alias(c) for c in rest]).select(*df.columns)


# -- J1 / J2 / J2b / J2c ------------------------------------------------------------
def region_dimension(regions: DataFrame, code_col: str, vintage: str | None = NUTS_VINTAGE) -> DataFrame:
    """Region table reduced to ``(code, gid)``, one row per code."""
    r = regions
    if vintage is not None and "year" in regions.columns:
        r = r.filter(F.col("year") == F.lit(vintage).cast("date"))
    return first_match(r.select(F.col(code_col).alias("_code"), F.col("gid").alias("_gid")), ["_code"], "_gid")


def region_key_join(fact: DataFrame, key_col: str, regions: DataFrame, code_col: str = "nuts_id",
                    vintage: str | None = NUTS_VINTAGE, out: str = "fk_nuts_gid") -> DataFrame:
    """J1 (NUTS, vintage) / J2 (LAU, ``vintage=None``): ``upper(key)`` ->
    region gid; rows without a match are dropped (inner join)."""
    dim = region_dimension(regions, code_col, vintage)
    f = fact.withColumn("_code", F.upper(F.col(key_col)))
    return join_dimension(f, dim, "_code", "inner").drop("_code").withColumnRenamed("_gid", out)


def unmatched_region_keys(fact: DataFrame, key_col: str, regions: DataFrame, code_col: str = "nuts_id",
                          vintage: str | None = NUTS_VINTAGE) -> DataFrame:
    """Keys without a region, with their row counts."""
    dim = region_dimension(regions, code_col, vintage)
    f = fact.withColumn("_code", F.upper(F.col(key_col)))
    miss = join_dimension(f, dim, "_code", "left_anti")
    return miss.groupBy(F.col(key_col).alias("key")).agg(F.count(F.lit(1)).alias("n_rows"))


def region_key_like_join(fact: DataFrame, key_col: str, regions: DataFrame, code_col: str = "nuts_id",
                         vintage: str | None = NUTS_VINTAGE, out: str = "fk_nuts_gid") -> DataFrame:
    """J2c (compat): ``region.code LIKE upper(key)`` where ``%``/``_`` in the
    data act as wildcards; a row takes the smallest matching gid (W2).

    Keys without wildcards take the equi-join path.  Of the others only the
    *distinct patterns* meet the regions: every pattern joins on the rarest
    of its literal grams (up to three letters, the ends of a code marked, so
    that ``%12`` looks for codes that end so), then takes the LIKE test.
    Patterns of wildcards alone ask for a length of the code, and meet one
    row per length.  The winners go back to the rows by the pattern.  No size
    limit, no nested loop, no key that all regions share."""
    dim = region_dimension(regions, code_col, vintage)
    f = fact.withColumn("_code", F.upper(F.col(key_col)))
    wild = F.col("_code").rlike("[%_]")
    plain = join_dimension(f.filter(~wild), dim, "_code", "inner")
    patterns = f.filter(wild).select("_code").distinct().withColumn("_grams", pattern_grams(F.col("_code")))
    codes = dim.filter(F.col("_code").isNotNull()).select(F.col("_code").alias("_rcode"), "_gid")
    first = _gram_matches(patterns.filter(F.size("_grams") > 0), codes).unionByName(_length_matches(patterns.filter(F.size("_grams") == 0), codes))
    return plain.unionByName(f.filter(wild).join(first, "_code")).drop("_code").withColumnRenamed("_gid", out)


# Marks of the beginning and the end of a code (no letters of one).
_BEGIN, _END = "\u0002", "\u0003"
# What can be escaped in a pattern (the backslash first), and what stands for it.
_ESCAPED, _STAND_IN = "\\%_", "\u0004\u0005\u0006"
GRAM = 3


def _grams(text: Column) -> Column:
    """All distinct pieces of one to ``GRAM`` letters."""
    def of(n: int) -> Column:
        return F.when(F.length(text) >= n, F.transform(F.sequence(F.lit(1), F.length(text) - (n - 1)), lambda i: F.substring(text, i, F.lit(n)))).otherwise(F.expr("CAST(array() AS array<string>)"))
    return F.array_distinct(F.concat(*[of(n) for n in range(1, GRAM + 1)]))


def pattern_grams(pattern: Column) -> Column:
    """Grams that every code which matches a LIKE pattern has (with marked
    ends): the longest pieces of its literal runs.  What a backslash escapes
    is literal."""
    marked = F.concat(F.lit(_BEGIN), pattern, F.lit(_END))
    for escaped, stand_in in zip(_ESCAPED, _STAND_IN):
        marked = F.replace(marked, F.lit("\\" + escaped), F.lit(stand_in))
    runs = F.transform(F.split(marked, "[%_]"), lambda r: F.translate(r, _STAND_IN, _ESCAPED))
    runs = F.filter(runs, lambda r: (F.length(r) > 0) & (r != _BEGIN) & (r != _END))
    pieces = F.flatten(F.transform(runs, lambda r: F.filter(_grams(r), lambda g: F.length(g) == F.least(F.length(r), F.lit(GRAM)))))
    return F.array_distinct(pieces)


def _gram_matches(patterns: DataFrame, codes: DataFrame) -> DataFrame:
    index = codes.select("_rcode", "_gid", F.explode(_grams(F.concat(F.lit(_BEGIN), F.col("_rcode"), F.lit(_END)))).alias("_gram"))
    sizes = index.groupBy("_gram").agg(F.count(F.lit(1)).alias("_n"))
    # a gram that no code has rules the pattern out: it keeps no row here
    found = patterns.select("_code", F.explode("_grams").alias("_gram")).join(sizes, "_gram", "left")
    rarest = found.groupBy("_code").agg(F.min(F.struct(F.coalesce("_n", F.lit(0)).alias("n"), F.col("_gram").alias("g"))).alias("_x")).filter("_x.n > 0").select("_code", F.col("_x.g").alias("_gram"))
    return rarest.join(index, "_gram").filter(F.expr("_rcode LIKE _code")).groupBy("_code").agg(F.min("_gid").alias("_gid"))


def _length_matches(patterns: DataFrame, codes: DataFrame) -> DataFrame:
    """Patterns of ``%`` and ``_`` alone: codes of just that length, or of at
    least that length if there is a ``%``; one row per length of a code."""
    lengths = codes.groupBy(F.length("_rcode").alias("_len")).agg(F.min("_gid").alias("_gid"))
    longer = F.min("_gid").over(Window.orderBy(F.col("_len").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    # lengths asked for between two that exist take the next longer one
    spans = lengths.select("_len", "_gid", longer.alias("_from"), F.coalesce(F.lag("_len").over(Window.orderBy("_len")) + 1, F.lit(0)).alias("_low"))
    spans = spans.select("_len", "_gid", "_from", F.explode(F.sequence("_low", "_len")).alias("_ask"))
    asked = patterns.select("_code", F.length(F.regexp_replace("_code", "%", "")).alias("_ask"), F.contains(F.col("_code"), F.lit("%")).alias("_open"))
    return (asked.join(spans, "_ask").filter(F.col("_open") | (F.col("_ask") == F.col("_len")))
            .select("_code", F.when(F.col("_open"), F.col("_from")).otherwise(F.col("_gid")).alias("_gid")))


# -- J3 / U1 --------------------------------------------------------------------------
TIME_COLUMNS = ["id", "timestamp", "year", "month", "day", "weekday", "season", "hour_of_day",
                "hour_of_year", "date", "granularity"]


def time_rows(keys: DataFrame) -> DataFrame:
    """Time-dimension rows (without id) for ``(timestamp, granularity)`` keys."""
    return keys.select("timestamp", *time_attributes("timestamp"), "granularity")


def time_dim_upsert(time_dim: DataFrame | None, keys: DataFrame) -> DataFrame:
    """Get-or-create for many keys at once.

    New distinct keys (anti-join against the dimension) get ids after the
    current maximum in (timestamp, granularity) order; the result is the
    old dimension plus the new rows.  Running it twice adds nothing.
    """
    k = keys.select("timestamp", "granularity").filter(F.col("timestamp").isNotNull()).distinct()
    if time_dim is None:                       # first load: nothing to look up
        time_dim = empty_time_dim(keys.sparkSession)
        new, start = k, 1
    else:
        new = join_dimension(k, time_dim.select("timestamp", "granularity"), ["timestamp", "granularity"],
                             "left_anti")
        start = max_id(time_dim) + 1
    numbered = dense_id(time_rows(new), ["timestamp", "granularity"], start=start)
    return time_dim.select(*TIME_COLUMNS).unionByName(numbered.select(*TIME_COLUMNS))


def time_lookup(fact: DataFrame, time_dim: DataFrame, ts_col: str = "timestamp",
                gran_col: str = "granularity", out: str = "fk_time_id") -> DataFrame:
    """``(timestamp, granularity)`` -> time id (left join, broadcast dim)."""
    dim = time_dim.select(F.col("timestamp").alias("_dim_ts"), F.col("granularity").alias("_dim_gr"),
                          F.col("id").alias(out))
    cond = (F.col(ts_col) == F.col("_dim_ts")) & (F.col(gran_col) == F.col("_dim_gr"))
    return fact.join(dim, cond, "left").drop("_dim_ts", "_dim_gr")


# -- U2 ---------------------------------------------------------------------------------
def registry_upsert(registry: DataFrame, touched: DataFrame, today: str) -> DataFrame:
    """Repositories ``(name, git_id)`` seen today are inserted with
    ``created = updated = today`` or get ``updated = today``; ids continue
    after the current maximum."""
    t = touched.select("name", "git_id").distinct().withColumn("_touched", F.lit(True))
    r = registry.select("id", "name", "git_id", "created", "updated")
    j = r.join(t, ["name", "git_id"], "full_outer")
    day = F.lit(today).cast("timestamp_ntz")
    j = j.select("id", "name", "git_id", F.coalesce("created", day).alias("created"),
                 F.when(F.col("_touched"), day).otherwise(F.col("updated")).alias("updated"))
    old = j.filter(F.col("id").isNotNull())
    new = dense_id(j.filter(F.col("id").isNull()).drop("id"), ["git_id", "name"], start=max_id(r) + 1)
    return old.unionByName(new.select("id", "name", "git_id", "created", "updated"))


def empty_time_dim(spark) -> DataFrame:
    """An empty time dimension with the full schema."""
    from pyspark.sql import types as T
    schema = T.StructType([
        T.StructField("id", T.LongType()), T.StructField("timestamp", T.TimestampNTZType()),
        T.StructField("year", T.IntegerType()), T.StructField("month", T.IntegerType()),
        T.StructField("day", T.IntegerType()), T.StructField("weekday", T.StringType()),
        T.StructField("season", T.StringType()), T.StructField("hour_of_day", T.IntegerType()),
        T.StructField("hour_of_year", T.IntegerType()), T.StructField("date", T.DateType()),
        T.StructField("granularity", T.StringType())])
    return spark.createDataFrame([], schema)
