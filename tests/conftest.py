import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from contractlens.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "contractlens-tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def rows(df, *columns):
    """Collected rows as sorted tuples (small frames only)."""
    columns = columns or df.columns
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=lambda t: tuple(str(x) for x in t))
