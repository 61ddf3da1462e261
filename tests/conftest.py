from __future__ import annotations

import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from adtally.config import get_session  # noqa: E402
from adtally.schemas import AD_EVENT_SCHEMA  # noqa: E402

T0 = dt.datetime(2024, 1, 1, 12, 0, 0)


@pytest.fixture(scope="session")
def spark():
    s = get_session("local[4]", 4, app_name="adtally-tests")
    s.sparkContext.setLogLevel("ERROR")
    yield s


def at(seconds: float) -> dt.datetime:
    return T0 + dt.timedelta(seconds=seconds)


def ev(event_id, seconds, kind="click", partner=100, group=1, product=1, target="WEB",
       display="display-1", amount=1000):
    return (event_id, at(seconds), kind, partner, group, product, target, display, amount)


def frame(spark, rows):
    return spark.createDataFrame(rows, AD_EVENT_SCHEMA)


@pytest.fixture
def make(spark):
    return lambda rows: frame(spark, rows)
