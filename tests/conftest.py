import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from loanmart.session import local_session, release  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", 4, **{"spark.sql.shuffle.partitions": "4"})
    yield session
    release(session)
    session.stop()


@pytest.fixture
def rows():
    """Rows of a frame as tuples, sorted, nulls first."""

    def collect(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted(
            (tuple(r) for r in picked.collect()),
            key=lambda r: [(v is not None, str(v)) for v in r],
        )

    return collect
