"""Time parsing and time-dimension attributes (F1-F9), as Catalyst expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The accepted date formats, tried in this order (strptime
# notation, first match wins), and the same formats as Spark patterns.
STRPTIME_FORMATS = [
    "%Y/%m/%d %H:%M:%S", "%Y-%m-%d %H:%M:%S", "%d/%m/%Y %H:%M:%S", "%d.%m.%Y %H:%M:%S",
    "%Y/%m/%d %H:%M", "%Y-%m-%d %H:%M", "%d/%m/%Y %H:%M", "%d.%m.%Y %H:%M",
    "%Y/%m/%d", "%Y-%m-%d", "%d/%m/%Y", "%d.%m.%Y",
    "%Y/%m", "%Y-%m", "%m/%Y", "%m.%Y",
    "%Y",
]

# Granularity words, matched as lower-case prefixes in this order.
GRANULARITIES = ["year", "month", "day", "hour", "minute", "second", "quarter", "week"]

_TOKENS = {"%Y": "yyyy", "%m": "M", "%d": "d", "%H": "H", "%M": "m", "%S": "s"}
_PAD_TOKENS = {"%Y": "yyyy", "%m": "MM", "%d": "dd", "%H": "HH", "%M": "mm", "%S": "ss"}


def spark_pattern(fmt: str, padded: bool = False) -> str:
    """strptime format -> Spark datetime pattern (one- or two-digit parts
    accepted when parsing, like strptime)."""
    table = _PAD_TOKENS if padded else _TOKENS
    out = fmt
    for k, v in table.items():
        out = out.replace(k, v)
    return out


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def shape_signature(fmt: str) -> str:
    """Signature of a format: ``%Y`` -> ``Y`` (exactly 4 digits), the other
    fields -> ``N`` (1 or 2 digits), separators kept (``%Y/%m`` -> ``Y/N``)."""
    out = fmt.replace("%Y", "Y")
    for k in ("%m", "%d", "%H", "%M", "%S"):
        out = out.replace(k, "N")
    return out


def text_signature(text) -> Column:
    """The same signature computed from a text: digit runs of length 4 ->
    ``Y``, of length 1-2 -> ``N``; anything else stays and matches nothing."""
    t = _c(text)
    y = F.regexp_replace(t, r"(?<![0-9])[0-9]{4}(?![0-9])", "Y")
    return F.regexp_replace(y, r"(?<![0-9])[0-9]{1,2}(?![0-9])", "N")


def parse_date_multi(text) -> Column:
    """first of the 17 formats that matches the whole text, as
    ``timestamp_ntz``; NULL when none matches (the caller rejects the row).

    The formats have pairwise different shapes (separators, field count and
    field widths, as strptime reads them), so a text can only parse with the
    one format whose shape it has: the shape signature of the text selects
    that format and a single parse runs.  The expression stays small, so it
    can be used in filters and projections of one stage without exceeding
    generated-code limits.
    """
    t = _c(text)
    sigs = F.create_map(*[x for i, f in enumerate(STRPTIME_FORMATS)
                          for x in (F.lit(shape_signature(f)), F.lit(i + 1))])
    pats = F.array(*[F.lit(spark_pattern(f)) for f in STRPTIME_FORMATS])
    fmt = F.try_element_at(pats, F.try_element_at(sigs, text_signature(t)))
    return F.try_to_timestamp(t, fmt).cast("timestamp_ntz")


def format_date(ts, fmt: str) -> Column:
    return F.date_format(_c(ts), spark_pattern(fmt, padded=True))


def normalize_timestamp(ts) -> Column:
    """canonical text ``%Y/%m/%d %H:%M:%S``."""
    return format_date(ts, "%Y/%m/%d %H:%M:%S")


def epoch_to_timestamp(epoch) -> Column:
    """F8: epoch seconds (text or number) -> ``timestamp_ntz`` in UTC,
    independent of the session time zone."""
    secs = _c(epoch).try_cast("double").try_cast("bigint")
    return F.timestamp_add("SECOND", secs, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


def weekday_class(ts) -> Column:
    """``Week`` Monday-Friday, else ``Sat`` / ``Sun``."""
    t = _c(ts)
    return F.when(F.dayofweek(t).isin(1, 7), F.date_format(t, "E")).otherwise(F.lit("Week"))


def weekday_class_compat(ts) -> Column:
    """F3 as written in the original (a text/int comparison that is always
    true): every day is ``Week``."""
    return F.when(_c(ts).isNotNull(), F.lit("Week"))


def season(ts) -> Column:
    """winter 1 Jan-20 Mar and 21-31 Dec, spring 21 Mar-20 Jun, summer
    21 Jun-22 Sep, autumn 23 Sep-20 Dec."""
    t = _c(ts)
    md = F.month(t) * 100 + F.dayofmonth(t)
    # Last day of winter, spring, summer and autumn (month * 100 + day).
    return (F.when(md <= 320, "winter").when(md <= 620, "spring").when(md <= 922, "summer")
             .when(md <= 1220, "autumn").otherwise("winter"))


def hour_of_year(ts) -> Column:
    """``(day_of_year - 1) * 24 + hour``."""
    t = _c(ts)
    return (F.dayofyear(t) - 1) * 24 + F.hour(t)


def hour_of_year_compat(ts) -> Column:
    """F5 as written in the original: ``day_of_year * hour``."""
    t = _c(ts)
    return F.dayofyear(t) * F.hour(t)


def normalize_granularity(text) -> Column:
    """lower-case prefix match on the granularity words; unknown -> ''."""
    low = F.lower(_c(text))
    out = F.lit("")
    for g in reversed(GRANULARITIES):
        out = F.when(low.startswith(g), F.lit(g)).otherwise(out)
    return out


def time_attributes(ts) -> list[Column]:
    """The attribute columns of the time dimension."""
    t = _c(ts)
    return [F.year(t).alias("year"), F.month(t).alias("month"), F.dayofmonth(t).alias("day"),
            weekday_class(t).alias("weekday"), season(t).alias("season"), F.hour(t).alias("hour_of_day"),
            hour_of_year(t).alias("hour_of_year"), F.to_date(t).alias("date")]
