import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemart.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    session = build_session("tidemart-tests", {
        "spark.sql.shuffle.partitions": "4",
        "spark.default.parallelism": "4",
        "spark.driver.memory": "8g",
        "spark.checkpoint.dir": str(shared),
        "spark.sql.warehouse.dir": str(shared / "warehouse"),
    }, master="local[8]", log_level="ERROR")
    yield session
    session.stop()
