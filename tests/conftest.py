from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMOKE_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from touchline.session import local_session

    session = local_session(cores="*", shuffle_partitions=8, app="touchline-tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def smoke_dir() -> str:
    return SMOKE_DIR


def rows(df, order=None):
    """Rows as tuples, sorted (order-insensitive comparisons)."""
    out = [tuple(r) for r in df.collect()]
    return sorted(out, key=lambda r: tuple((v is None, str(v)) for v in r)) if order is None else out
