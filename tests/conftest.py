"""One small local session for all tests."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():  # noqa: ANN201
    from corpusloom.session import session

    s = session(
        "tests",
        **{"spark.master": "local[4]", "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "3g", "spark.default.parallelism": "4"},
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


def rows(df) -> list[tuple]:  # noqa: ANN001
    """All rows as sorted tuples, nulls first."""
    return sorted((tuple(r) for r in df.collect()), key=lambda r: [(x is not None, str(x)) for x in r])
