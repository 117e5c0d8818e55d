"""Shared by the core tests: the small tables and the text of a physical plan."""

SF_SMALL = "/root/testdata/sf0.001"


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
