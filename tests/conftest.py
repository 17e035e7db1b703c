import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from legtrail.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, shuffle_partitions=4)
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Rows of a DataFrame as sorted tuples, nulls first."""

    def collect(df, *columns):
        taken = [tuple(row) for row in df.select(*(columns or df.columns)).collect()]
        return sorted(taken, key=lambda row: tuple((v is not None, v) for v in row))

    return collect


@pytest.fixture
def plan():
    """Text of the physical plan."""

    def explain(df):
        import contextlib
        import io

        out = io.StringIO()
        with contextlib.redirect_stdout(out):
            df.explain("formatted")
        return out.getvalue()

    return explain
