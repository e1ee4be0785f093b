from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from millrace.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    warehouse = str(tmp_path_factory.mktemp("warehouse"))
    session = build_session(
        "tests",
        "local[4]",
        2,
        extra={"spark.ui.enabled": "false", "spark.sql.warehouse.dir": warehouse},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)


@pytest.fixture
def make(spark):
    """make(schema, rows) -> DataFrame"""
    return lambda schema, data: spark.createDataFrame(data, schema)
