"""Key expressions: station id, city, hour bucket, calendar columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandgrid.schema import ALL_CITIES, MISSING_CITY, MISSING_STATION

_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
_CANONICAL = r"^[1-9][0-9]{0,17}$"
_INTEGER = r"^[+-]?[0-9]+$"
# Doubles in this open interval cast to bigint without overflow.
_BIGINT_LIMIT = 9.2e18

WEEKDAY_NAMES = [
    "Monday",
    "Tuesday",
    "Wednesday",
    "Thursday",
    "Friday",
    "Saturday",
    "Sunday",
]


def station_key(col: Column | str) -> Column:
    """Canonical station id: ``31631``, ``31631.0`` and ``' 31631 '`` are one station.

    The text must look like a decimal number before it is cast, because a Spark
    cast also accepts type suffixes such as ``101d``. Plain integers go straight
    to bigint so that ids above 2**53 stay exact. An id that is canonical already, the
    usual case, is recognised first and skips the rest.
    """
    raw = (F.col(col) if isinstance(col, str) else col).cast("string")
    text = F.regexp_replace(raw, r"(?U)^\s+|\s+$", "")
    number = F.when(text.rlike(_NUMBER), text.try_cast("double"))
    in_range = F.abs(number) < F.lit(_BIGINT_LIMIT)
    whole = F.when(in_range & (number == F.floor(number)), number.try_cast("bigint"))
    exact = F.when(text.rlike(_INTEGER), text.try_cast("bigint"))
    other = F.coalesce(exact.cast("string"), whole.cast("string"), text)
    key = F.when(raw.rlike(_CANONICAL), raw).otherwise(other)
    return F.coalesce(key, F.lit(MISSING_STATION))


def city_key(df: DataFrame, city_col: str = "city") -> Column:
    """City as text; a null city and a table without cities get their own sentinel."""
    if city_col not in df.columns:
        return F.lit(ALL_CITIES)
    return F.coalesce(F.col(city_col).cast("string"), F.lit(MISSING_CITY))


def as_ntz(col: Column | str) -> Column:
    """Timestamp without zone; text that does not parse becomes null."""
    return (F.col(col) if isinstance(col, str) else col).try_cast("timestamp_ntz")


def floor_hour(ts: Column) -> Column:
    """Start of the hour. Stays zone-free, where ``date_trunc`` would go through the
    session zone and lose the hours that zone skips."""
    return ts.cast("date").cast("timestamp_ntz") + F.make_dt_interval(
        F.lit(0), F.hour(ts), F.lit(0), F.lit(0)
    )


def hour_start(
    df: DataFrame, start_time_col: str = "started_at", hour_col: str = "hour_ts"
) -> Column:
    """Hour bucket of a ride: the hour column when the table has one, else its start."""
    for name in (hour_col, start_time_col):
        if name in df.columns:
            return floor_hour(as_ntz(name))
    raise ValueError(f"rides have no time column: neither {hour_col!r} nor {start_time_col!r}")


def hours_between(start: Column, end: Column) -> Column:
    """Whole hours from start to end."""
    return F.timestamp_diff("HOUR", start, end)


def plus_hours(ts: Column, hours: Column | int) -> Column:
    hours = F.lit(hours) if isinstance(hours, int) else hours
    return ts + F.make_dt_interval(F.lit(0), hours.cast("int"), F.lit(0), F.lit(0))


def date_text(ts: Column) -> Column:
    return ts.cast("date").cast("string")


def timestamp_text(ts: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss``; exact for hour-grain values and independent of the zone."""
    return ts.cast("timestamp_ntz").cast("string")


def weekday(ts: Column) -> Column:
    """Monday = 0."""
    return F.weekday(ts)


def weekday_name(number: Column) -> Column:
    names = F.array(*[F.lit(n) for n in WEEKDAY_NAMES])
    return F.element_at(names, number + 1)


def is_weekend(weekday_number: Column) -> Column:
    return weekday_number.isin(5, 6).cast("int")


def with_calendar(df: DataFrame, ts_col: str) -> DataFrame:
    """Hour, weekday, date and hour_ts come from the timestamp; weekend only if absent."""
    ts = F.col(ts_col)
    out = df.withColumns(
        {
            "hour_ts": ts,
            "hour": F.hour(ts),
            "weekday": weekday(ts),
            "date": date_text(ts),
        }
    )
    if "weekend" not in df.columns:
        out = out.withColumn("weekend", is_weekend(weekday(ts)))
    return out


def with_text_times(df: DataFrame) -> DataFrame:
    """Sink format of the two time columns."""
    times = [c for c in ("target_hour_start", "hour_ts") if c in df.columns]
    return df.withColumns({c: timestamp_text(F.col(c)) for c in times})
