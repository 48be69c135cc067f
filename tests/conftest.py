from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from crosswind.session import session

    shared = tmp_path_factory.mktemp("shared")
    built = session(
        "crosswind-tests",
        master="local[8]",
        spark__sql__shuffle__partitions="8",
        spark__ui__enabled="false",
        spark__checkpoint__dir=str(shared),
        spark__sql__warehouse__dir=str(shared / "warehouse"),
    )
    built.sparkContext.setLogLevel("ERROR")
    yield built
    built.stop()
