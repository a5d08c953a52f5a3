import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark.session import create_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = create_session(
        "tests",
        "local[8]",
        conf={
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
            "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        },
        log_level="ERROR",
    )
    yield session
    session.stop()
