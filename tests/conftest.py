import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from alloy.session import get_spark  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = get_spark("alloy-tests", "local[8]", {"spark.sql.shuffle.partitions": "8"})
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="alloy-test-")


def rows(df, order=None):
    """Collected rows as sorted tuples (NULLs sort first)."""
    out = [tuple(r) for r in df.collect()]
    return sorted(out, key=lambda t: tuple((v is not None, v) for v in t))
