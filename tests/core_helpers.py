"""Helpers of the tests of this folder (a name of its own: other folders have
a conftest too)."""

SF001 = "/root/testdata/sf0.001"


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
