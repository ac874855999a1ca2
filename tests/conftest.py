import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from streamlog.session import drop_scratch, local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "streamlog-tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    drop_scratch(session)
    session.stop()


def rows(df):
    """Rows as a sorted list of tuples, NULLs first."""
    return sorted((tuple(r) for r in df.collect()), key=lambda r: [(v is not None, str(type(v)), v) if not isinstance(v, (dict, list)) else (True, "", str(v)) for v in r])
