"""Name, key and type-name helpers (P1, F10, F11, F13, F14, boolean text)."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from regiostat.config import MAX_NAME_LENGTH, NAME_TOKEN

# File extensions a resource name must not carry.
BAD_EXTENSIONS = ["csv", "tif", "tiff", "shp", "geojson", "txt"]

# Accepted boolean spellings (PostgreSQL boolean input:
# unique prefixes of true/false/yes/no, on/off, 1/0).
TRUE_TEXT = ["t", "tr", "tru", "true", "y", "ye", "yes", "on", "1"]
FALSE_TEXT = ["f", "fa", "fal", "fals", "false", "n", "no", "of", "off", "0"]

# Geometry type spellings -> canonical type.
GEOMETRY_TYPES = {
    "polygon": "MultiPolygon", "multipolygon": "MultiPolygon",
    "point": "Point", "multipoint": "MultiPoint",
    "linestring": "Linestring", "multilinestring": "MultiLinestring",
}


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sanitize_name(c, token: str = NAME_TOKEN) -> Column:
    """Lower-case, drop ``token``, runs of non-alphanumerics -> ``_``."""
    low = F.lower(_c(c))
    if token:
        low = F.replace(low, F.lit(token), F.lit(""))
    return F.regexp_replace(low, "[^A-Za-z0-9]+", "_")


def sanitize_name_py(name: str, token: str | None = None) -> str:
    """Driver-side twin for schema names (column lists, not data)."""
    n = name.lower()
    if token:
        n = n.replace(token, "")
    return re.sub("[^A-Za-z0-9]+", "_", n)


def file_stem(c) -> Column:
    """``name.split('.')[0]``."""
    return F.split(_c(c), r"\.")[0]


def upper_key(c) -> Column:
    """F10."""
    return F.upper(_c(c))


def parse_boolean(c) -> Column:
    """Boolean text with the explicit spelling lists; else NULL."""
    low = F.lower(F.trim(_c(c)))
    return F.when(low.isin(*TRUE_TEXT), F.lit(True)).when(low.isin(*FALSE_TEXT), F.lit(False))


def geometry_type_normalize(c) -> Column:
    """canonical geometry type, NULL for unsupported ones."""
    m = F.create_map(*[F.lit(x) for kv in GEOMETRY_TYPES.items() for x in kv])
    return F.try_element_at(m, F.lower(_c(c)))


def spatial_resolution_class(c) -> Column:
    """``nuts*`` -> ``nuts``, ``lau*`` -> ``lau``, ``none`` -> ``none``."""
    low = F.lower(_c(c))
    return (F.when(low.startswith("nuts"), "nuts").when(low.startswith("lau"), "lau")
             .when(low == "none", "none"))


def name_too_long(c, limit: int = MAX_NAME_LENGTH) -> Column:
    """more than ``limit`` characters."""
    return F.length(_c(c)) > limit


def has_file_extension(c) -> Column:
    """ends with one of the data file extensions (as written, in lower case)."""
    return _c(c).rlike(r"\.(" + "|".join(BAD_EXTENSIONS) + r")$")
