"""Feature expressions. Null in, null out: greatest/least would hide a null, so limits
are written with when()."""

from __future__ import annotations

from math import pi

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandgrid.functions import keys as K
from demandgrid.schema import ZERO_THRESHOLD

# The weather scores must equal the benchmark's.
COMFORT_TEMPERATURE = 18.0
COMFORT_SPREAD = 12.0
COMFORT_HUMIDITY = 50.0
COMFORT_WEIGHTS = (0.5, 0.3, 0.2)
COMFORT_CLOUD_DEFAULT = 0.5
RAIN_SCALE = 2.0
SNOW_FACTOR = 5.0
WIND_SCALE = 25.0
PARK_SCALE = 100_000.0
LANE_SCALE = 10_000.0
MORNING_RUSH = (7, 9)
EVENING_RUSH = (17, 19)
RUSH_MEAN_LIMIT = 3.0


def at_least(x: Column, low: float) -> Column:
    return F.when(x < low, F.lit(low)).otherwise(x)


def at_most(x: Column, high: float) -> Column:
    return F.when(x > high, F.lit(high)).otherwise(x)


def _unit(x: Column) -> Column:
    return at_most(at_least(x, 0.0), 1.0)


def _num(name: str) -> Column:
    return F.col(name).cast("double")


def comfort_score(columns: list[str]) -> Column | None:
    """Pleasantness of temperature, humidity and sky; None if the inputs do not exist."""
    if "apparent_temperature" not in columns or "relative_humidity_2m" not in columns:
        return None
    off = _num("apparent_temperature") - COMFORT_TEMPERATURE
    temperature = F.exp(-(off * off) / (2 * COMFORT_SPREAD * COMFORT_SPREAD))
    humidity = _unit(
        1.0 - F.abs(_num("relative_humidity_2m") - COMFORT_HUMIDITY) / COMFORT_HUMIDITY
    )
    if "cloud_cover" in columns:
        sky = 1.0 - _unit(_num("cloud_cover") / 100.0)
    else:
        sky = F.lit(COMFORT_CLOUD_DEFAULT)
    a, b, c = COMFORT_WEIGHTS
    return a * temperature + b * humidity + c * sky


def outdoor_pleasantness(columns: list[str]) -> Column:
    """Falls with rain, snow and wind; an input that does not exist counts as zero."""

    def amount(name: str) -> Column:
        return at_least(_num(name), 0.0) if name in columns else F.lit(0.0)

    return (
        F.exp(-amount("rain") / RAIN_SCALE)
        * F.exp(-amount("snowfall") * SNOW_FACTOR)
        * F.exp(-amount("wind_speed_10m") / WIND_SCALE)
    )


def recreational_accessibility(columns: list[str]) -> Column | None:
    if "park_area_500m" not in columns or "bike_lane_length_500m" not in columns:
        return None
    return _num("park_area_500m") / PARK_SCALE + _num("bike_lane_length_500m") / LANE_SCALE


def with_weather_features(df: DataFrame) -> DataFrame:
    made = {
        "comfort_score": comfort_score(df.columns),
        "outdoor_pleasantness": outdoor_pleasantness(df.columns),
        "recreational_accessibility": recreational_accessibility(df.columns),
    }
    return df.withColumns({k: v for k, v in made.items() if v is not None})


def with_rush_features(df: DataFrame) -> DataFrame:
    if "hour" not in df.columns:
        return df
    morning = F.col("hour").between(*MORNING_RUSH).cast("int")
    evening = F.col("hour").between(*EVENING_RUSH).cast("int")
    out = df.withColumns({"is_morning_rush": morning, "is_evening_rush": evening})
    if "station_hour_mean_demand" in df.columns:
        rush = F.greatest("is_morning_rush", "is_evening_rush")
        product = rush * F.col("station_hour_mean_demand")
        out = out.withColumn("rush_x_station_hour_mean", at_most(product, RUSH_MEAN_LIMIT))
    return out


def with_cyclic_features(df: DataFrame, ts_col: str = "hour_ts") -> DataFrame:
    """Optional calendar set: month, day, day of year, cycles and interactions."""
    ts = F.col(ts_col)
    hour, wd = F.hour(ts), K.weekday(ts)
    weekend = K.is_weekend(wd)
    made = {
        "month": F.month(ts),
        "day": F.dayofmonth(ts),
        "day_of_year": F.dayofyear(ts),
        "hour_sin": F.sin(2 * pi * hour / 24),
        "hour_cos": F.cos(2 * pi * hour / 24),
        "weekday_sin": F.sin(2 * pi * wd / 7),
        "weekday_cos": F.cos(2 * pi * wd / 7),
        "hour_x_weekend": hour * weekend,
        "hour_x_weekday": hour * wd,
    }
    if "holiday" in df.columns:
        made["weekday_x_holiday"] = wd * F.col("holiday")
    return df.withColumns(made)


def weekly_mean(lags: list[Column]) -> Column:
    """Mean of the lags that exist; null when none does."""
    total = sum((F.coalesce(x, F.lit(0)) for x in lags[1:]), F.coalesce(lags[0], F.lit(0)))
    found = sum((x.isNotNull().cast("int") for x in lags[1:]), lags[0].isNotNull().cast("int"))
    return F.try_divide(total.cast("double"), found)


def post_process(prediction: Column, threshold: float = ZERO_THRESHOLD) -> Column:
    """Small predictions become zero, and none is negative."""
    p = F.when(prediction < threshold, F.lit(0.0)).otherwise(prediction)
    return at_least(p, 0.0)
