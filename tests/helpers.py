"""What several test modules use besides fixtures. Its name is its own: folders below have a ``conftest`` too."""

from __future__ import annotations


def rows_of(df, *cols):
    """Rows as sorted tuples."""
    got = [tuple(r) for r in (df.select(*cols) if cols else df).collect()]
    return sorted(got, key=lambda r: [(x is None, str(x)) for x in r])


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
