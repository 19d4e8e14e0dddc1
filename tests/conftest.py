import os
import sys
from datetime import datetime, timedelta

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from hourloom.session import local_session

    session = local_session(8)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


START = datetime(2024, 1, 1)


@pytest.fixture(scope="session")
def series(spark):
    """series(values, station): an hourly frame; hours listed in ``skip`` are left out."""

    def build(values, station="a", column="v", start=START, skip=()):
        rows = [
            (station, start + timedelta(hours=i), v) for i, v in enumerate(values) if i not in set(skip)
        ]
        return spark.createDataFrame(rows, f"station_id string, ts timestamp, {column} double")

    return build
