from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from loomwork.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(8, spark__checkpoint__dir=str(tmp_path_factory.mktemp("staging")))
    yield session
    session.stop()


@pytest.fixture
def lines(spark, tmp_path):
    """Write lines to a file and return its path."""

    def write(name: str, *content: str) -> str:
        path = tmp_path / name
        path.write_text("".join(f"{line}\n" for line in content), encoding="utf-8")
        return str(path)

    return write


def rows(df) -> list[tuple]:
    return sorted((tuple(row) for row in df.collect()), key=repr)
