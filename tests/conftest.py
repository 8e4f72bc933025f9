import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))

from foldgauge.session import local_session  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, shuffle_partitions=4, memory="4g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture(scope="session")
def schema():
    from foldgauge import CorpusSchema

    return CorpusSchema(labels=("a", "b", "c"), id="id", text="text")


@pytest.fixture(scope="session")
def corpus(spark):
    """600 rows, two thirds of them in one label combination, one combination with a single row."""
    rows = []
    for i in range(600):
        a, b, c = int(i % 7 == 0), int(i % 11 == 0), int(i % 13 == 0)
        rows.append((f"id{i:04d}", f"text number {i}", a, b, c))
    return spark.createDataFrame(rows, "id string, text string, a int, b int, c int").repartition(5).cache()
