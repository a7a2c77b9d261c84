from __future__ import annotations

import os
import sys
from datetime import datetime, timedelta, timezone

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from meterline.session import local_session  # noqa: E402

BASE = 1_704_067_200  # a whole hour


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(cores="8", shuffle_partitions=3, memory="8g")
    session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("shared")))
    yield session
    session.stop()


def at(seconds: float) -> datetime:
    """Event time, ``seconds`` after the base hour."""
    return datetime.fromtimestamp(BASE, timezone.utc).replace(tzinfo=None) + timedelta(microseconds=round(seconds * 1e6))


def us(seconds: float) -> int:
    return BASE * 1_000_000 + round(seconds * 1e6)


RIDES = (
    "ride_id string, message_id bigint, event_us bigint, event_ts timestamp, timestamp timestamp, latitude double,"
    " longitude double, meter_increment double, ride_status string, passenger_count int, arrival_ms bigint"
)


def make_rides(spark, rows):
    """Rides from dicts with ``t`` (event second) and any of the other columns."""
    full = []
    for i, r in enumerate(rows):
        t = r["t"]
        full.append(
            (
                r.get("ride_id", "a"),
                r.get("message_id", i),
                us(t),
                at(t),
                at(r.get("payload", t)),
                r.get("latitude", 40.7),
                r.get("longitude", -74.0),
                float(r.get("amount", 1.0)),
                r.get("status", "enroute"),
                1,
                r.get("arrival_ms", us(t) // 1000),
            )
        )
    return spark.createDataFrame(full, RIDES)
