"""Secret scans with corpus-wide ownership.

Three base kinds (assignments, access keys, hex strings) and one generic kind
(long tokens of mixed letters and digits that no base span covers) give the
candidates.  Their values are hashed and counted over the whole corpus by
distinct documents, repositories and owners.  A value in three
repositories or more, of three owners or more, or copied into fifty documents or
more (:data:`EXAMPLE`, a parameter) is a widely copied example; one that looks
random and stays within fewer repositories, owners and documents is taken for
a live credential, the rest is undecided.  So one value of two owners is live as
long as neither spread it, and one that a single owner repeats everywhere is an
example.  Base spans always stay in the result; generic ones enter it only as
live credentials.

DataFrame functions only.  Counting goes over distinct (hash, repository,
owner), pre-aggregated before the shuffle, so a value that a third of all
rows have adds one row per owner and task; the verdicts are joined back by a
plain join that Spark may split.

Results: one row per document row.  Null or empty text has no spans.  Null
owners count as one owner of their own.  Repeated rows give repeated rows;
empty tables give empty results; other columns are kept apart (``scan``) or
passed on (``redact``) and may have any names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regiostat.llm.spans import SPAN, Kind, count_kind, find, listing, replace, sql_listing, sql_matches
from regiostat.session import materialize

# The base kinds and their least lengths.
_KEY = "([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
ASSIGN = _KEY + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_VALUE = 12

KINDS = (
    Kind("assign", ASSIGN, lambda m: F.length(F.regexp_extract(m, ASSIGN, 2)) >= ASSIGN_VALUE),
    Kind("access", "AKIA[A-Z0-9]{14,}"),   # 18 characters or more in all
    Kind("hex", "[0-9a-f]{16,}"),
    Kind("generic", "(?:\\G|(?<![A-Za-z0-9+/_=-]))[A-Za-z0-9+/_=-]{20,}+", lambda m: m.rlike("[0-9]") & m.rlike("[a-z]") & m.rlike("[A-Z]"), "[A-Za-z0-9+/_=-]{20,}"),
)
NAMES = tuple(k.name for k in KINDS)
GENERIC = 3


def value(m: Column, kind: Column) -> Column:
    """The secret itself: of an assignment its right side."""
    return F.when(kind == 0, F.regexp_extract(m, ASSIGN, 2)).otherwise(m)


def looks_random(v: Column) -> Column:
    """Digits and letters, at least eight different characters."""
    return v.rlike("[0-9]") & v.rlike("[A-Za-z]") & (F.size(F.array_distinct(F.split(v, ""))) >= 8)


def candidates(text: Column) -> Column:
    """Base spans, and generic ones that overlap none of them."""
    every = find(F.coalesce(text, F.lit("")), KINDS)

    def free(spans):
        return F.filter(spans, lambda x: (x["k"] != GENERIC) | ~F.exists(spans, lambda b: (b["k"] != GENERIC) & (b["s"] < x["e"]) & (x["s"] < b["e"])))

    return F.transform(F.array(every), free)[0]  # binds the spans once


def ownership(found: DataFrame) -> DataFrame:
    """``h, n_docs, n_repos, n_owners`` of every candidate value; ``found``
    has ``h, repo, owner`` and one row per document and value."""
    pairs = found.groupBy("h", "repo", "owner").agg(F.count("*").alias("n"))
    repos = pairs.groupBy("h", "owner").agg(F.sum("n").alias("n"), F.count("*").alias("r"))
    return repos.groupBy("h").agg(F.sum("n").alias("n_docs"), F.sum("r").alias("n_repos"), F.count("*").alias("n_owners"))


def _marked(rows: DataFrame, example: tuple[int, int, int]) -> DataFrame:
    """Adds ``v`` to the spans of ``rows(row, repo, owner, spans)``: example,
    live or unclear."""
    single = rows.where(F.size("spans") > 0).select("row", "repo", "owner", F.explode("spans").alias("x"))
    single = single.select("row", "repo", "owner", "x", F.sha2(value(F.col("x.m"), F.col("x.k")), 256).alias("h"))
    once = single.select("row", "h", "repo", "owner").distinct()
    verdict = materialize(ownership(once), "ownership")
    secret = value(F.col("x.m"), F.col("x.k"))
    spread = F.lit(False)
    for name, least in zip(("n_repos", "n_owners", "n_docs"), example):
        spread = spread | (F.col(name) >= least)
    named = F.when(spread, "example").when(looks_random(secret), "live").otherwise("unclear")
    return (single.join(verdict, "h").select("row", F.struct("x.s", "x.e", "x.k", named.alias("v")).alias("x"))
            .groupBy("row").agg(F.collect_list("x").alias("marked")))


#: From so many repositories, owners or documents on a value is an example.
EXAMPLE = (3, 3, 50)


def scan(docs: DataFrame, example: tuple[int, int, int] = EXAMPLE, id_col: str = "doc_id", text_col: str = "text",
         owner_col: str = "source", repo_cols: tuple[str, ...] = ("source", "lang")) -> DataFrame:
    """``id, spans (s, e, k, v)`` of every row: base spans and live generic ones."""
    repo = F.concat_ws("/", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in repo_cols])
    rows = materialize(docs.select(F.col(id_col).alias("i"), F.col(owner_col).cast("string").alias("owner"), repo.alias("repo"),
                                   candidates(F.col(text_col)).alias("spans"), F.monotonically_increasing_id().alias("row")), "candidates")
    marked = _marked(rows, example)
    out = rows.where(F.size("spans") > 0).select("i", "row").join(marked, "row").select("i", "marked")
    none = rows.where(F.size("spans") == 0).select("i", F.expr("CAST(array() AS array<struct<s:bigint,e:bigint,k:int,v:string>>)").alias("marked"))
    kept = F.filter("marked", lambda x: (x["k"] != GENERIC) | (x["v"] == "live"))
    return out.unionAll(none).select(F.col("i").alias(id_col), kept.alias("spans"))


def redact(docs: DataFrame, example: tuple[int, int, int] = EXAMPLE, text_col: str = "text", owner_col: str = "source",
           repo_cols: tuple[str, ...] = ("source", "lang"), length_col: str | None = "n_chars", mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with live credentials replaced by ``mark``; widely copied
    examples and undecided strings stay.  Rows without candidates pass through."""
    names = docs.columns
    repo = F.concat_ws("/", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in repo_cols])
    spanned = docs.select(F.struct(*names).alias("d"), F.col(owner_col).cast("string").alias("owner"), repo.alias("repo"), candidates(F.col(text_col)).alias("spans"))
    rows = materialize(spanned.where(F.size("spans") > 0).withColumn("row", F.monotonically_increasing_id()), "candidates")
    live = F.filter("marked", lambda x: x["v"] == "live")
    text = replace(F.col(f"d.{text_col}"), live, lambda x: F.lit(mark))
    changed = rows.select("row", "d").join(_marked(rows, example), "row").select("d", text.alias("new"))
    columns = []
    for c in names:
        if c == text_col:
            columns.append(F.col("new").alias(c))
        elif c == length_col:
            columns.append(F.length("new").cast(docs.schema[c].dataType).alias(c))
        else:
            columns.append(F.col(f"d.{c}").alias(c))
    return changed.select(*columns).unionAll(spanned.where(F.size("spans") == 0).select("d.*"))


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    base = F.filter("spans", lambda x: x["k"] != GENERIC)
    live, example = (F.size(F.filter("spans", f)).cast("bigint") for f in (lambda x: x["v"] == "live", lambda x: x["v"] == "example"))
    return found.select(id_col, *[count_kind(F.col("spans"), i).alias(f"n_{n}") for i, n in enumerate(NAMES[:GENERIC])],
                        F.sha2(listing(base, NAMES, by_kind=False), 256).alias("base_sha256"), listing(F.col("spans"), NAMES, by_kind=False).alias("spans"), live.alias("n_live"), example.alias("n_example"))


def oracle(docs: str = "documents", example: tuple[int, int, int] = EXAMPLE) -> str:
    """The same rows as DuckDB SQL."""
    keep = (f"length(regexp_extract($m, '{ASSIGN.replace(chr(39), chr(39) * 2)}', 2)) >= {ASSIGN_VALUE}", "true", "true",
            "regexp_matches($m, '[0-9]') AND regexp_matches($m, '[a-z]') AND regexp_matches($m, '[A-Z]')")
    base = " || ".join(sql_matches("t", k, i, keep[i]) for i, k in enumerate(KINDS[:GENERIC]))
    generic = sql_matches("t", KINDS[GENERIC], GENERIC, keep[GENERIC])
    secret = f"CASE WHEN x.k = 0 THEN regexp_extract(x.m, '{ASSIGN.replace(chr(39), chr(39) * 2)}', 2) ELSE x.m END"
    return f"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS t, coalesce(source, '<null>') AS owner, coalesce(source, '') || '/' || coalesce(lang, '') AS repo FROM {docs}),
b AS (SELECT row, doc_id, owner, repo, {base} AS base, {generic} AS gen FROM d),
c AS (SELECT row, doc_id, owner, repo, base || list_filter(gen, lambda x: len(list_filter(base, lambda y: y.s < x.e AND x.s < y.e)) = 0) AS spans FROM b),
u AS (SELECT row, owner, repo, unnest(spans) AS x FROM c),
w AS (SELECT row, owner, repo, x, {secret} AS secret FROM u),
o AS (SELECT secret, count(DISTINCT repo) AS repos, count(DISTINCT owner) AS owners, count(DISTINCT row) AS docs FROM w GROUP BY secret),
m AS (SELECT row, list({{'s': x.s, 'e': x.e, 'k': x.k, 'v': CASE WHEN repos >= {example[0]} OR owners >= {example[1]} OR docs >= {example[2]} THEN 'example'
  WHEN regexp_matches(secret, '[0-9]') AND regexp_matches(secret, '[A-Za-z]') AND len(list_distinct(string_split(secret, ''))) >= 8 THEN 'live' ELSE 'unclear' END}}) AS marked
  FROM w JOIN o USING (secret) GROUP BY row),
f AS (SELECT doc_id, coalesce(list_filter(marked, lambda x: x.k <> {GENERIC} OR x.v = 'live'), []) AS spans FROM c LEFT JOIN m USING (row))
SELECT doc_id, {', '.join(f"CAST(len(list_filter(spans, lambda x: x.k = {i})) AS BIGINT) AS n_{n}" for i, n in enumerate(NAMES[:GENERIC]))},
  sha256({sql_listing(f'list_filter(spans, lambda x: x.k <> {GENERIC})', NAMES, False)}) AS base_sha256, {sql_listing('spans', NAMES, False)} AS spans,
  {', '.join(f"CAST(len(list_filter(spans, lambda x: x.v = '{v}')) AS BIGINT) AS n_{v}" for v in ('live', 'example'))}
FROM f"""
