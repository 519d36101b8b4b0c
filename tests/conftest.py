import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from velomesh.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    from pyspark.sql import SparkSession
    SparkSession.builder.config("spark.sql.warehouse.dir", str(base / "warehouse"))
    session = build_session("local[8]", 4, "velomesh-tests", "12g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
