import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).resolve().parents[1]), str(Path(__file__).resolve().parent)]

from demandgrid.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8)
    yield session
    session.stop()


@pytest.fixture
def small_rides(spark):
    """Three weeks of two cities: one hot station, a station with one ride, mixed spellings,
    null attributes, a null station and rides without a city."""
    import datetime as dt
    import random

    rng = random.Random(7)
    start = dt.datetime(2025, 1, 1)
    rows = []
    spell = {"1": ["1", "1.0", " 1 "], "2": ["2"], "x": ["x"]}
    for i in range(1500):
        station = "1" if rng.random() < 0.7 else rng.choice(["2", "x"])
        city = rng.choice(["A", "A", "B"]) if i % 50 else None
        at = start + dt.timedelta(hours=rng.randrange(24 * 22), minutes=rng.randrange(60))
        temperature = None if rng.random() < 0.3 else float(rng.randrange(-5, 30))
        raw = rng.choice(spell[station]) if i % 40 else None
        rows.append(
            (i, at, city, raw, temperature, float(rng.randrange(100)), rng.randrange(9),
             None if rng.random() < 0.5 else "fest", int(at.day == 1), int(at.weekday() < 5))
        )
    rows.append((1500, start + dt.timedelta(hours=5), "A", "lonely", 3.0, 50.0, 2, None, 0, 1))
    rows.append((1501, start + dt.timedelta(hours=24 * 22), "A", "2", 3.0, 50.0, 2, None, 0, 1))
    schema = (
        "event_id bigint, started_at timestamp_ntz, city string, start_station_id string, "
        "apparent_temperature double, relative_humidity_2m double, "
        "office_poi_count_1000m bigint, holiday_name string, holiday int, working_day int"
    )
    return spark.createDataFrame(rows, schema).repartition(6)


@pytest.fixture
def sample_targets(spark):
    """Three target rows: two spellings of one station, and no apparent temperature."""
    return spark.sql("""
        SELECT id, city, start_station_id, hour_ts, hour_ts AS target_hour_start,
               date_format(hour_ts, 'yyyy-MM-dd') AS date, 1 AS weekday, 0 AS weekend,
               0 AS holiday, 1 AS working_day, 50D + id AS relative_humidity_2m, 0D AS rain,
               10D AS cloud_cover, 4D AS wind_speed_10m, 120D AS bike_lane_length_500m,
               90D AS park_area_500m, 2L AS university_count_1000m, 3L AS office_poi_count_1000m,
               4L AS retail_poi_count_1000m, 5L AS restaurant_cafe_count_500m,
               6L AS transit_stop_count_500m, 700D AS distance_to_nearest_rail_station,
               800D AS distance_to_city_center
        FROM VALUES
          (0L, 'A', '77.0', timestamp_ntz'2025-03-04 08:00:00'),
          (1L, 'A', ' 77', timestamp_ntz'2025-03-04 12:00:00'),
          (2L, 'B', 'dock_5', timestamp_ntz'2025-03-04 17:00:00')
          AS t(id, city, start_station_id, hour_ts)""")
