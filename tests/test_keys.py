import datetime as dt

import pytest
from pyspark.sql import functions as F

from demandgrid.functions import keys as K
from demandgrid.operators import demand as D
from demandgrid.schema import ALL_CITIES, MISSING_CITY, MISSING_STATION

STATIONS = {
    "31631": "31631", "31631.0": "31631", " 31631.0 ": "31631", "\t31631\n": "31631",
    "1e3": "1000", "007": "7", "+5": "5", "-0": "0", "-5.0": "-5", "1.": "1",
    "9007199254740993": "9007199254740993",
    "101d": "101d", "5f": "5f", "0x10": "0x10", "1_000": "1_000", "True": "True",
    "inf": "inf", "nan": "nan", "": "", "1e30": "1e30", "12.5": "12.5", ".5": ".5",
    "99999999999999999999": "99999999999999999999", "station_7": "station_7",
    None: MISSING_STATION,
}


def test_station_key_table(spark):
    df = spark.createDataFrame([(s,) for s in STATIONS], "raw string")
    got = {r.raw: r.key for r in df.select("raw", K.station_key("raw").alias("key")).collect()}
    assert got == STATIONS


def test_station_key_of_numbers(spark):
    df = spark.createDataFrame([(101, 101.0, 1.5)], "a bigint, b double, c double")
    row = df.select(*[K.station_key(c).alias(c) for c in "abc"]).first()
    assert tuple(row) == ("101", "101", "1.5")


def test_hours_survive_a_zone_change(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        row = spark.sql("SELECT timestamp_ntz'2024-03-10 02:35:11.5' AS ts").select(
            K.floor_hour(F.col("ts")).alias("h"),
            K.timestamp_text(K.floor_hour(F.col("ts"))).alias("s"),
            K.date_text(F.col("ts")).alias("d"),
        ).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert row.h == dt.datetime(2024, 3, 10, 2)
    assert (row.s, row.d) == ("2024-03-10 02:00:00", "2024-03-10")


def test_calendar(spark):
    df = spark.sql("SELECT timestamp_ntz'2026-01-03 23:00:00' AS t")
    row = K.with_calendar(df, "t").first()
    assert (row.hour, row.weekday, row.weekend, row.date) == (23, 5, 1, "2026-01-03")
    assert row.hour_ts == row.t
    kept = K.with_calendar(df.withColumn("weekend", F.lit(None).cast("int")), "t").first()
    assert kept.weekend is None
    assert df.select(K.weekday_name(F.lit(0)).alias("n")).first().n == "Monday"
    text = K.with_text_times(df.withColumnRenamed("t", "target_hour_start")).first()
    assert text.target_hour_start == "2026-01-03 23:00:00"


def test_keyed_rides_sentinels_and_hour_column(spark):
    df = spark.sql(
        "SELECT cast(null AS string) city, cast(null AS string) start_station_id, "
        "'2025-01-01 10:59:00' hour_ts, '2025-01-01 12:00:00' started_at"
    )
    row = D.keyed_rides(df).first()
    assert (row.city_key, row.station_key) == (MISSING_CITY, MISSING_STATION)
    assert row.target_hour_start == dt.datetime(2025, 1, 1, 10)
    assert D.keyed_rides(df.drop("city")).first().city_key == ALL_CITIES


def test_bad_timestamps(spark):
    df = spark.createDataFrame(
        [("1", "2025-01-01 10:00:00"), ("1", "never"), ("1", None)],
        "start_station_id string, started_at string",
    )
    with pytest.raises(Exception, match="no readable start time"):
        D.demand_cells(D.keyed_rides(df)).collect()
    assert D.keyed_rides(df, on_bad="drop").count() == 1
    held = D.keyed_rides(df, on_bad="quarantine")
    assert held.where("target_hour_start IS NULL").count() == 2
    with pytest.raises(ValueError, match="2 rides"):
        D.assert_timestamps(df)
    with pytest.raises(ValueError, match="station column"):
        D.keyed_rides(df.drop("start_station_id"))
    with pytest.raises(ValueError, match="hour_ts"):
        D.keyed_rides(df.drop("started_at"))
