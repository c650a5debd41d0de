import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from eventide.session import get_session
    s = get_session("local[4]", 4, app="eventide-tests",
                    extra={"spark.sql.streaming.forceDeleteTempCheckpointLocation": "true"})
    yield s
    s.stop()


@pytest.fixture()
def scratch(spark):
    """A fresh folder under the session's checkpoint folder."""
    from eventide.session import shared_path
    path = shared_path(spark, "test")
    os.makedirs(path, exist_ok=True)
    return path


@pytest.fixture()
def hot_keys(spark):
    """More slices than the session's default."""
    spark.conf.set("eventide.ordered.slices", "40")
    yield
    spark.conf.unset("eventide.ordered.slices")
