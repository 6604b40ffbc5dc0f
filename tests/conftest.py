import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from atlaspanel.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    s = build_session(
        "local[4]",
        app_name="atlaspanel-tests",
        shuffle_partitions=4,
        extra={"spark.sql.warehouse.dir": str(base / "warehouse")},
    )
    s.sparkContext.setCheckpointDir(str(base / "checkpoints"))
    yield s
    s.stop()


@pytest.fixture
def scratch(tmp_path):
    return str(tmp_path)
