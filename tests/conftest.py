from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from lakeops.operators.publish import LakeTable  # noqa: E402
from lakeops.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", 8)
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def lake(tmp_path):
    def make(name: str = "t", fmt: str = "parquet", layer: str = "ods") -> LakeTable:
        return LakeTable(str(tmp_path / "lake"), layer, name, fmt)

    return make
