from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lakeops.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("spark")
    session = build_session(
        "tests",
        "local[4]",
        spark__sql__shuffle__partitions="4",
        spark__driver__memory="4g",
        spark__sql__warehouse__dir=str(folder / "warehouse"),
        spark__checkpoint__dir=str(folder / "checkpoints"),
    )
    session.sparkContext.setLogLevel("FATAL")
    yield session
    session.stop()


def rows(df, *columns):
    """Sorted tuples of the given columns, NULL first."""
    picked = [tuple(r) for r in df.select(*(columns or df.columns)).collect()]
    return sorted(picked, key=lambda r: tuple((v is not None, str(v)) for v in r))


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
