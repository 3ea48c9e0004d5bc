"""Spans of regular-expression matches as columns, with code point offsets.

Patterns are written for Spark's regular expressions so that they take linear
time on any text: repeated groups are possessive and a run is only entered at
its start (``\\G`` lets a match begin right behind the one before).  They find
the same leftmost, non-overlapping matches as the plain pattern.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN = "array<struct<s:bigint,e:bigint,k:int,m:string>>"
_LIST = 256


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str                  # for Spark
    keep: object = None           # match column -> condition
    plain: str = ""               # for DuckDB, where it differs


def matches(text: Column, pattern: str, number: int) -> Column:
    """All matches of a text: start, end, kind number and matched text.  The
    gaps between matches (``split``) give the offsets."""
    found, gaps = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    pairs = F.arrays_zip(found.alias("m"), gaps.alias("g"))
    none, nones = F.expr(f"CAST(array() AS {SPAN})"), F.expr(f"CAST(array() AS array<{SPAN}>)")
    zero = F.struct(F.lit(0).cast("bigint").alias("at"), none.alias("new"), nones.alias("out"))

    def step(a, x):
        s = a["at"] + F.length(x["g"])
        e = s + F.length(x["m"])
        span = F.array(F.struct(s.alias("s"), e.alias("e"), F.lit(number).alias("k"), x["m"].alias("m")))
        # appended to a short list, which is put away when it is full: appending copies
        full = F.size(a["new"]) >= _LIST
        more = F.struct(e.alias("at"), F.when(full, span).otherwise(F.concat(a["new"], span)).alias("new"),
                        F.when(full, F.concat(a["out"], F.array(a["new"]))).otherwise(a["out"]).alias("out"))
        # the last pair holds the text behind the last match
        return F.when(x["m"].isNull(), a).otherwise(more)

    spans = F.aggregate(pairs, zero, step, lambda a: F.flatten(F.concat(a["out"], F.array(a["new"]))))
    return F.when(text.rlike(pattern), spans).otherwise(none)


def _keep(spans: Column, condition) -> Column:
    return F.filter(spans, lambda x: condition(x["m"]))


def find(text: Column, kinds: Sequence[Kind]) -> Column:
    """The kept matches of all kinds, kind after kind."""
    parts = []
    for number, kind in enumerate(kinds):
        spans = matches(text, kind.pattern, number)
        if kind.keep is not None:
            spans = _keep(spans, kind.keep)
        parts.append(spans)
    return F.concat(*parts)


def count_kind(spans: Column, number: int) -> Column:
    return F.size(F.filter(spans, lambda x: x["k"] == number)).cast("bigint")


def listing(spans: Column, names: Sequence[str], by_kind: bool) -> Column:
    """``kind:start:end,...`` ordered by kind and start, or by start and kind."""
    name = F.array(*[F.lit(n) for n in names])
    order = (lambda x: F.struct(x["k"], x["s"], x["e"])) if by_kind else (lambda x: F.struct(x["s"], x["k"], x["e"]))
    ordered = F.array_sort(F.transform(spans, lambda x: order(x)))
    return F.array_join(F.transform(ordered, lambda x: F.concat_ws(":", F.element_at(name, x["k"] + 1), x["s"].cast("string"), x["e"].cast("string"))), ",")


def replace(text: Column, spans: Column, label) -> Column:
    """The text with every span replaced by ``label(span)``; a span that
    overlaps an earlier one only replaces what that left."""
    zero = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out"))
    ordered = F.array_sort(spans)

    def step(a, x):
        gap = F.substring(text, (a["at"] + 1).cast("int"), F.greatest(F.lit(0), x["s"] - a["at"]).cast("int"))
        return F.when(x["e"] <= a["at"], a).otherwise(
            F.struct(x["e"].alias("at"), F.concat(a["out"], gap, label(x)).alias("out")))

    return F.aggregate(ordered, zero, step, lambda a: F.concat(a["out"], F.substring(text, (a["at"] + 1).cast("int"), F.length(text))))


# DuckDB twins

def sql_matches(text: str, kind: Kind, number: int, keep: str) -> str:
    """List of ``{s, e, k, m}`` of one kind, as DuckDB SQL; ``keep`` is a
    condition on ``m``."""
    pattern = (kind.plain or kind.pattern).replace("'", "''")
    found, gaps = f"regexp_extract_all({text}, '{pattern}')", f"string_split_regex({text}, '{pattern}')"
    before = "coalesce(list_sum(list_transform(list_slice({0}, 1, {1}), lambda v: length(v))), 0)"
    start = f"CAST({before.format(gaps, 'i')} + {before.format(found, 'i - 1')} AS BIGINT)"
    spans = (f"list_transform(range(1, len({found}) + 1), lambda i: {{'s': {start}, 'e': {start} + length({found}[i]), 'k': {number}, 'm': {found}[i]}})")
    return f"list_filter({spans}, lambda x: {keep.replace('$m', 'x.m')})"


def sql_listing(spans: str, names: Sequence[str], by_kind: bool) -> str:
    table = "[" + ", ".join(f"'{n}'" for n in names) + "]"
    first = "{'a': x.k, 'b': x.s, 'c': x.e}" if by_kind else "{'a': x.s, 'b': x.k, 'c': x.e}"
    kind, start = ("x.a", "x.b") if by_kind else ("x.b", "x.a")
    return (f"array_to_string(list_transform(list_sort(list_transform({spans}, lambda x: {first})), "
            f"lambda x: {table}[{kind} + 1] || ':' || {start} || ':' || x.c), ',')")
