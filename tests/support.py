"""Helpers of the tests; a module of its own, since every folder may have a ``conftest``."""

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


def _none_safe(row):
    return tuple((v is None, v if v is not None else 0) for v in row)


def rows(df, order=None):
    cols = order or df.columns
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=_none_safe)


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()
