import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

from starlane.llm import importable  # noqa: E402


@pytest.fixture(scope="module", autouse=True)
def workers(spark):
    importable(spark)


@pytest.fixture
def table(spark):
    """Documents with extra columns whose names clash with the operators' own."""
    def make(rows, repeat=1):
        wide = [(i, t, "en", "src", len(t or ""), "x", 1, None) for i, t in rows for _ in range(repeat)]
        return spark.createDataFrame(
            wide, "doc_id long, text string, lang string, source string, n_chars long, kept string, n int, key string"
        ).repartition(3)

    return make
