import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from ledgerline.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    session = local_session(8, app="tests", spark__checkpoint__dir=str(shared), spark__sql__shuffle__partitions="4")
    yield session
    session.stop()


def rows(df):
    """Rows as a sorted list of tuples, NULLs first."""
    return sorted((tuple(r) for r in df.collect()), key=lambda t: [(v is not None, str(v)) for v in t])
