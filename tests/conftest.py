import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from headway.session import local_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "6g")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF


def rows(df, *order):
    """Rows as tuples in a fixed order."""
    out = [tuple(r) for r in df.collect()]
    return sorted(out, key=lambda r: tuple((v is None, str(v)) for v in r)) if not order else [
        tuple(r) for r in df.orderBy(*order).collect()
    ]
