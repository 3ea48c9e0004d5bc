"""Join helpers shared by the operators.

No operator forces a broadcast.  Spark broadcasts a side whose size in bytes
it knows to be below ``spark.sql.autoBroadcastJoinThreshold``, at planning
time from file sizes or at run time (AQE) from the measured shuffle output;
anything larger is a shuffle join whose skewed partitions AQE splits.  A row
count would be the wrong measure: a region row may carry a polygon.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def join_dimension(fact: DataFrame, dim: DataFrame, on, how: str = "inner") -> DataFrame:
    """Fact-to-dimension equi-join, planned by size in bytes."""
    return fact.join(dim, on, how)


def prefixes(code: Column) -> Column:
    """All non-empty prefixes of a code, shortest first (``'AB1'`` ->
    ``['A', 'AB', 'AB1']``).  Turns a ``LIKE prefix || '%'`` theta join into
    an equi-join on an exploded key."""
    return F.transform(F.sequence(F.lit(1), F.length(code)), lambda i: F.substring(code, 1, i))
