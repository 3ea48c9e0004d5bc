"""Small column helpers shared by the function modules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and pass it to ``body`` (a lambda binding), so
    an expensive expression used several times inside ``body`` is not copied
    into every use when the optimizer collapses projections."""
    return F.transform(F.array(value), body)[0]
