"""Personal data with information-theoretic sanitisation.

Base kinds (e-mail, IP address, card number, phone number) are the protected
entities.  A term of the same document may give one away as well: over the
whole corpus,

    PMI(e; t) = log(N n(e,t) / (n(e) n(t))),   IC(e) = log(N / n(e))

with ``N`` documents, ``n(e)`` of them with the entity, ``n(t)`` with the term and
``n(e,t)`` with both, anywhere in the text.  ``PMI / IC`` is the share of the
entity's information that the term discloses (1: whoever sees the term knows
the entity).  In every document that holds the entity, all occurrences of terms
beyond ``remove`` are removed, those of terms beyond ``generalise`` replaced by
their class.  Pairs seen in fewer than ``support`` documents are no evidence (a
word that two documents share by chance would disclose all they hold).

DataFrame functions only.  Entities in fewer than ``support`` documents can have no
pair, and are left out before pairs are made.  All counts are pre-aggregated
before the shuffle; findings go back to their rows by plain joins that Spark
may split.  Terms and entities are counted by 64-bit hashes.

Results: one row per document row.  Null or empty text has no spans.
Repeated rows count as documents of their own and give repeated rows; empty
tables give empty results; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from regiostat.llm.common import LOWER, UPPER
from regiostat.llm.spans import Kind, count_kind, find, listing, matches, replace, sql_listing, sql_matches
from regiostat.session import materialize

_PART = "0*(?:[0-9]|[1-9][0-9]|1[0-9][0-9]|2[0-4][0-9]|25[0-5])"
IP_WHOLE = rf"^(?:{_PART}\.){{3}}{_PART}$"


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Check sum of a string of digits is a multiple of ten."""
    def step(a, i):
        d = F.substring(digits, (F.length(digits) - i + 1).cast("int"), F.lit(1)).cast("int")
        return a + F.when(i % 2 == 1, d).when(d > 4, 2 * d - 9).otherwise(2 * d)
    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), step) % 10 == 0


# The base kinds.  ``plain`` is the same pattern for DuckDB.
KINDS = (
    Kind("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)++", None, r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"),
    Kind("ip", r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", lambda m: m.rlike(IP_WHOLE), r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+"),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", lambda m: F.length(_digits(m)).between(13, 19) & luhn(_digits(m)), r"[0-9](?:[\x20-]?[0-9])+"),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: F.length(_digits(m)).between(9, 15)),
)
NAMES = (*(k.name for k in KINDS), "term")
TERM = len(KINDS)

#: A term: three characters or more of digits, letters or beyond ASCII.
_NO_TERM = r"\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F"
TERM_PATTERN = rf"[^{_NO_TERM}]{{3,}}+"
SPANS = "array<struct<s:bigint,e:bigint,k:int,m:string>>"


def _lower(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def _words(text: Column) -> Column:
    """Distinct terms of a text, lower-cased."""
    return F.array_distinct(F.filter(F.split(_lower(F.coalesce(text, F.lit(""))), f"[{_NO_TERM}]+"), lambda w: F.length(w) >= 3))


def _term_rows(rows: DataFrame) -> DataFrame:
    """``row, t`` (hash) of every distinct term of ``rows(row, text)``."""
    return rows.select("row", F.explode(_words(F.col("text"))).alias("w")).select("row", F.xxhash64("w").alias("t"))


def disclosures(held: DataFrame, rows: DataFrame, words: DataFrame, n: int, support: int, generalise: float, remove: float) -> DataFrame:
    """``h, t, removed`` of the pairs whose term discloses too much: ``held`` has
    ``row, h, n_e``, ``rows`` the texts of these rows, ``words`` the terms of all
    documents (column ``t``)."""
    pair = held.join(_term_rows(rows), "row").groupBy("h", "n_e", "t").agg(F.count(F.lit(1)).alias("n_et")).where(F.col("n_et") >= support)
    pair = materialize(pair, "pairs")
    term = words.groupBy("t").agg(F.count(F.lit(1)).alias("n_t")).join(pair.select("t").distinct(), "t")
    bits = F.log(F.col("n_t") / F.col("n_et"))         # what the term leaves open about the entity
    whole = F.log(F.lit(float(n)) / F.col("n_e"))
    return pair.join(term, "t").where(bits <= (1 - generalise) * whole).select("h", "t", (bits <= (1 - remove) * whole).alias("removed"))


def _free(marks: DataFrame, base: DataFrame) -> DataFrame:
    """Marks ``(row, s, e, removed)`` that overlap no base span ``(row, s, e)``: in
    the order of the starts, the spans before end in time and the next one
    starts late enough."""
    both = marks.select("row", "s", "e", "removed", F.lit(False).alias("b")).unionByName(base.select("row", "s", "e", F.lit(False).alias("removed"), F.lit(True).alias("b")))
    order = Window.partitionBy("row").orderBy("s")
    ended = F.max(F.when(F.col("b"), F.col("e"))).over(order.rangeBetween(Window.unboundedPreceding, Window.currentRow))
    begins = F.min(F.when(F.col("b"), F.col("s"))).over(order.rangeBetween(Window.currentRow, Window.unboundedFollowing))
    both = both.withColumns({"ended": ended, "begins": begins})
    clear = F.coalesce(F.col("ended") <= F.col("s"), F.lit(True)) & F.coalesce(F.col("begins") >= F.col("e"), F.lit(True))
    return both.where(~F.col("b") & clear).select("row", "s", "e", "removed")


def scan(docs: DataFrame, support: int = 3, generalise: float = 0.8, remove: float = 0.95, with_text: bool = False,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, spans (s, e, k, m)`` of every row, base spans and disclosing
    terms (kind 4; ``m`` is 'remove' or 'generalise'); with ``with_text``
    also the sanitised ``text``."""
    spans = find(F.coalesce(F.col(text_col), F.lit("")), KINDS)
    found = docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("text"), spans.alias("spans"), F.monotonically_increasing_id().alias("row"))
    # texts are kept where there is something to protect
    rows = materialize(found.select("i", "row", "spans", F.col("text") if with_text else F.when(F.size("spans") > 0, F.col("text")).alias("text")), "entities")
    some = rows.where(F.size("spans") > 0)
    n = rows.count()
    one = some.select("row", F.explode(F.array_distinct(F.transform("spans", lambda x: F.xxhash64(x["k"], _lower(x["m"]))))).alias("h"))
    entity = one.groupBy("h").agg(F.count(F.lit(1)).alias("n_e")).where((F.col("n_e") >= support) & (F.col("n_e") < n))
    held = materialize(one.join(entity, "h"), "held")
    some = some.join(held.select("row").distinct(), "row", "left_semi")
    words = docs.select(F.explode(_words(F.col(text_col))).alias("w")).select(F.xxhash64("w").alias("t"))
    told = materialize(disclosures(held, some.select("row", "text"), words, n, support, generalise, remove), "disclosures")
    term = held.join(_term_rows(some.select("row", "text")), "row").join(told, ["h", "t"]).groupBy("row", "t").agg(F.max("removed").alias("removed"))
    term = materialize(term, "terms")
    hit = some.join(term.select("row").distinct(), "row", "left_semi")
    places = hit.select("row", F.explode(matches(F.col("text"), TERM_PATTERN, TERM)).alias("x")).select("row", "x.s", "x.e", F.xxhash64(_lower(F.col("x.m"))).alias("t"))
    marks = _free(places.join(term, ["row", "t"]), hit.select("row", F.explode("spans").alias("x")).select("row", "x.s", "x.e"))
    marks = marks.groupBy("row").agg(F.collect_list(F.struct("s", "e", F.lit(TERM).alias("k"), F.when(F.col("removed"), "remove").otherwise("generalise").alias("m"))).alias("terms"))
    keep = ["i", "spans", *(["text"] if with_text else [])]
    out = rows.join(marks, "row", "left").withColumn("spans", F.concat("spans", F.coalesce("terms", F.expr(f"CAST(array() AS {SPANS})")))).select(*keep)
    if not with_text:
        return out.select(F.col("i").alias(id_col), "spans")

    def label(x):
        word = F.substring("text", (x["s"] + 1).cast("int"), (x["e"] - x["s"]).cast("int"))
        names = F.array(*[F.lit(f"[{k.name.upper()}]") for k in KINDS])
        return (F.when(x["k"] < TERM, F.element_at(names, F.least(x["k"], F.lit(TERM - 1)) + 1)).when(x["m"] == "remove", "")
                .when(word.rlike("^[0-9]+$"), "[NUMBER]").otherwise("[WORD]"))

    return out.select(F.col("i").alias(id_col), "spans", replace(F.col("text"), F.col("spans"), label).alias(text_col))


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    base = F.filter("spans", lambda x: x["k"] < TERM)
    return found.select(id_col, *[count_kind(F.col("spans"), i).alias(f"n_{k.name}") for i, k in enumerate(KINDS)],
                        F.sha2(listing(base, NAMES, by_kind=True), 256).alias("base_sha256"), listing(F.col("spans"), NAMES, by_kind=True).alias("spans"),
                        count_kind(F.col("spans"), TERM).alias("n_term"))


def oracle(docs: str = "documents", support: int = 3, generalise: float = 0.8) -> str:
    """The same rows as DuckDB SQL."""
    digits = "regexp_replace($m, '[^0-9]', '', 'g')"
    digit = f"CAST(substr({digits}, length({digits}) - j + 1, 1) AS INT)"
    check = f"list_sum(list_transform(range(1, length({digits}) + 1), lambda j: CASE WHEN j % 2 = 1 THEN {digit} WHEN {digit} > 4 THEN 2 * {digit} - 9 ELSE 2 * {digit} END)) % 10 = 0"
    keep = ("true", f"regexp_matches($m, '{IP_WHOLE}')", f"length({digits}) BETWEEN 13 AND 19 AND {check}", f"length({digits}) BETWEEN 9 AND 15")
    base = " || ".join(sql_matches("t", k, i, keep[i]) for i, k in enumerate(KINDS))
    lower = f"translate({{}}, '{UPPER}', '{LOWER}')"
    term = Kind("term", rf"[^{_NO_TERM}]{{3,}}")
    return f"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS t FROM {docs}),
b AS (SELECT row, doc_id, t, {base} AS spans FROM d),
v AS (SELECT DISTINCT row, x.k || ':' || {lower.format('x.m')} AS h FROM (SELECT row, unnest(spans) AS x FROM b)),
en AS (SELECT h, count(*) AS n_e FROM v GROUP BY h HAVING count(*) >= {support}),
w AS (SELECT row, unnest(list_distinct(regexp_extract_all({lower.format('t')}, '{term.pattern}'))) AS term FROM d),
pr AS (SELECT h, term, count(*) AS n_et FROM v JOIN en USING (h) JOIN w USING (row) GROUP BY h, term HAVING count(*) >= {support}),
tm AS (SELECT term, count(*) AS n_t FROM w GROUP BY term),
told AS (SELECT h, term FROM pr JOIN tm USING (term) JOIN en USING (h), (SELECT count(*) AS n FROM d)
  WHERE n_e < n AND ln(n_t / n_et) <= (1 - {generalise}) * ln(CAST(n AS DOUBLE) / n_e)),
mark AS (SELECT DISTINCT row, term FROM v JOIN told USING (h) JOIN w USING (row, term)),
place AS (SELECT row, spans, unnest({sql_matches('t', term, TERM, 'true')}) AS y FROM b WHERE row IN (SELECT row FROM mark)),
found AS (SELECT row, list({{'s': y.s, 'e': y.e, 'k': {TERM}}}) AS terms FROM (SELECT *, {lower.format('y.m')} AS term FROM place) JOIN mark USING (row, term)
  WHERE len(list_filter(spans, lambda q: q.s < y.e AND y.s < q.e)) = 0 GROUP BY row),
f AS (SELECT doc_id, spans AS base, list_transform(spans, lambda x: {{'s': x.s, 'e': x.e, 'k': x.k}}) || coalesce(terms, []) AS spans FROM b LEFT JOIN found USING (row))
SELECT doc_id, {', '.join(f"CAST(len(list_filter(base, lambda x: x.k = {i})) AS BIGINT) AS n_{k.name}" for i, k in enumerate(KINDS))},
  sha256({sql_listing('base', NAMES, True)}) AS base_sha256, {sql_listing('spans', NAMES, True)} AS spans, CAST(len(list_filter(spans, lambda x: x.k = {TERM})) AS BIGINT) AS n_term
FROM f"""
