import os
import sys

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [os.path.dirname(HERE), HERE]

from apiary.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session(
        "local[4]",
        app_name="apiary-tests",
        shuffle_partitions=4,
        extra={"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "4"},
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()

