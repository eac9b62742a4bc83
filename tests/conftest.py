import datetime as dt
import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
os.environ["PYTHONPATH"] = ROOT + os.pathsep + os.environ.get("PYTHONPATH", "")

from weirflow.session import local_session  # noqa: E402

NOW = dt.datetime(2024, 2, 1)


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", "4", shuffle_partitions=4, memory="6g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def messages(spark):
    """Envelopes of one topic from texts."""

    def make(*texts, topic="user.events.v1"):
        from weirflow.sources.envelopes import ENVELOPE

        rows = [(topic, 0, i, None, t, NOW, {}) for i, t in enumerate(texts)]
        return spark.createDataFrame(rows, ENVELOPE)

    return make
