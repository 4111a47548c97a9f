import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from finlake.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = get_session("local[4]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "4g"})
    yield s
    s.stop()


@pytest.fixture()
def tmp(tmp_path_factory):
    """A fresh scratch folder per test (never reused)."""
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


def rows(df, *cols):
    """Rows as plain tuples, sorted, for order-insensitive comparison."""
    cols = cols or tuple(df.columns)
    out = [tuple(r[c] for c in cols) for r in df.collect()]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))
