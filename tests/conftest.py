import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from stormgrid.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, **{"spark.sql.shuffle.partitions": "4"})
    yield session
    session.stop()


def rows(df, *order):
    """Collected rows as tuples, sorted."""
    out = [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]
    return out if order else sorted(out, key=lambda r: tuple((v is None, str(v)) for v in r))


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
