import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lodestrata.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
            "spark.sql.maxMetadataStringLength": "10000",
            "spark.sql.warehouse.dir": f"{scratch}/warehouse",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def scratch():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


TRIP_TYPES = (
    "VendorID bigint, tpep_pickup_datetime string, tpep_dropoff_datetime string, "
    "passenger_count bigint, trip_distance double, RatecodeID bigint, "
    "store_and_fwd_flag string, PULocationID bigint, DOLocationID bigint, payment_type bigint, "
    "fare_amount double, extra double, mta_tax double, tip_amount double, tolls_amount double, "
    "improvement_surcharge double, total_amount double, congestion_surcharge double, "
    "airport_fee double"
)
TRIP_NAMES = [part.split()[0] for part in TRIP_TYPES.split(", ")]
TRIP_ROWS = [
    (1, "2024-12-15 08:30:00", "2024-12-15 08:45:00", 2, 3.5, 1, "N", 161, 237, 1,
     15.5, 1.0, 0.5, 3.5, 0.0, 1.0, 21.5, 2.5, 0.0),
    (2, "2024-12-15 09:00:00", "2024-12-15 09:30:00", 1, 8.2, 1, "N", 132, 48, 2,
     28.0, 0.0, 0.5, 0.0, 6.55, 1.0, 36.05, 2.5, 0.0),
]


@pytest.fixture
def raw_trips(spark):
    """Builds raw trips: the two known rows, or the first one with changes."""

    def build(*changes: dict):
        if not changes:
            return spark.createDataFrame(TRIP_ROWS, TRIP_TYPES)
        rows = [tuple({**dict(zip(TRIP_NAMES, TRIP_ROWS[0])), **c}.values()) for c in changes]
        return spark.createDataFrame(rows, TRIP_TYPES)

    return build


WEATHER_TYPES = (
    "date string, temp_avg_celsius double, temp_min_celsius double, temp_max_celsius double, "
    "precip_total_mm double, wind_avg_ms double, observation_count bigint"
)


@pytest.fixture
def daily_weather(spark):
    """Daily weather rows: (date, average, precipitation), the rest fixed."""

    def build(*rows):
        return spark.createDataFrame(
            [(d, avg, -1.2, 5.8, rain, 3.4, 24) for d, avg, rain in rows], WEATHER_TYPES
        )

    return build


SILVER_TYPES = (
    "pickup_date string, pickup_hour bigint, pickup_location_id bigint, "
    "dropoff_location_id bigint, passenger_count bigint, trip_distance double, "
    "trip_duration_minutes double, fare_amount double, tip_amount double, "
    "total_amount double, payment_type bigint"
)


@pytest.fixture
def silver_trips(spark):
    return spark.createDataFrame(
        [
            ("2024-12-15", 8, 100, 200, 2, 3.0, 10.0, 10.0, 2.0, 14.0, 1),
            ("2024-12-15", 8, 101, 201, 1, 5.0, 20.0, 20.0, 4.0, 26.0, 2),
            ("2024-12-15", 17, 102, 202, 3, 1.0, 6.0, 6.0, 0.0, 6.0, 1),
        ],
        SILVER_TYPES,
    )
