from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

DOCS = "doc_id long, text string, lang string, source string, n_chars long, row_no int, words string"


@pytest.fixture
def docs(spark):
    """docs([(doc_id, text), ...]) with extra columns whose names clash."""

    def build(rows, lang=None):
        full = [(i, t, lang, "s", None if t is None else len(t), 7, "w") for i, t in rows]
        return spark.createDataFrame(full, DOCS)

    return build

