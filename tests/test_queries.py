"""Every registered query runs on sf0.001 and has a clean plan."""

import pytest

from core_helpers import SF001, plan_text
from regiostat.plans.registry import QUERIES, load_all

load_all()
KEYS = sorted(QUERIES)
NESTED_OF_ONE_ROW: dict[str, int] = {}


def test_entry_smoke(spark):
    from __spark_entry__ import entry
    df = entry(spark)
    assert df.count() > 0
    assert set(df.columns) >= {"nuts_id", "stat_levl_", "count", "mean"}


def test_every_query_has_an_oracle():
    from regiostat.plans.registry import ORACLE, QUERIES, load_all
    load_all()
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("key", KEYS)
def test_query_plan(spark, key):
    from __spark_entry__ import queries
    df = queries()[key](spark, SF001)
    df.limit(5).collect()
    p = plan_text(df)
    assert "BatchEvalPython" not in p, key                 # no row-at-a-time Python UDF
    assert "CartesianProduct" not in p, key
    # only against one-row sides made of counts
    assert p.count("NestedLoopJoin") <= NESTED_OF_ONE_ROW.get(key, 0), key


@pytest.mark.parametrize("key", ["zonal_stats_scaled", "zonal_pipeline"])
def test_geometry_parsing_not_pushed_into_source_scans(spark, key):
    """Parsing runs once per zone, never as a pushed-down filter on the rows
    the zones are derived from."""
    from __spark_entry__ import queries
    df = queries()[key](spark, SF001)
    df.limit(1).collect()
    scans = [line for line in plan_text(df).splitlines() if "FileScan" in line or "Filter" in line]
    assert not [s for s in scans if "regexp" in s and "size(" in s], key
