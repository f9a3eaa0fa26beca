"""Major cities, city profile and city label encoding."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandgrid.operators.ordering import running_total
from demandgrid.schema import MAJOR_CITY_MIN_RIDES

# More cities than this are never named in a predicate; they are joined instead.
MAX_NAMED_CITIES = 4096
# City-hour tables up to this many rows are sent to every task.
BROADCAST_ROWS = 1_000_000


def major_cities(rides: DataFrame, min_rides: int = MAJOR_CITY_MIN_RIDES) -> DataFrame:
    """Cities with at least ``min_rides`` rides, and their ride count."""
    return (
        rides.where(F.col("city").isNotNull())
        .groupBy(F.col("city").cast("string").alias("city"))
        .agg(F.count("*").alias("n_rides"))
        .where(F.col("n_rides") >= min_rides)
    )


@dataclass(frozen=True)
class CityScope:
    """What one pass over (city, hour) proved about the size of the city tables.

    ``names`` is None when there are more cities than a predicate should name.
    """

    names: tuple[str, ...] | None
    city_hours: int | None

    def fits(self, rows_per_city: int | None = None) -> bool:
        """Whether a city-level table (or, without a factor, a city-hour table) is proven
        small enough to be sent to every task."""
        if self.names is None:
            return False
        rows = self.city_hours if rows_per_city is None else rows_per_city * len(self.names)
        return rows <= BROADCAST_ROWS

    def small(self, df: DataFrame, rows_per_city: int | None = None) -> DataFrame:
        """Broadcast a table that fits; leave the choice to adaptive execution otherwise."""
        return F.broadcast(df) if self.fits(rows_per_city) else df


UNKNOWN_SCOPE = CityScope(None, None)


def city_scope(
    cities: DataFrame, min_rides: int = 1, max_names: int = MAX_NAMED_CITIES
) -> CityScope:
    """Cities of a city-span table with at least ``min_rides`` rides, and their hours.

    Reads at most ``max_names + 1`` rows to the driver.
    """
    hours = F.timestamp_diff("HOUR", F.col("lo"), F.col("hi")) + 1
    rows = (
        cities.where(F.col("rides") >= min_rides)
        .select("city", hours.alias("hours"))
        .limit(max_names + 1)
        .collect()
    )
    if len(rows) > max_names:
        return UNKNOWN_SCOPE
    return CityScope(tuple(sorted(r.city for r in rows)), sum(r.hours for r in rows))


def keep_major_cities(
    df: DataFrame, cities: DataFrame, scope: CityScope, min_rides: int = MAJOR_CITY_MIN_RIDES
) -> DataFrame:
    """Rows of the major cities. Few names become a predicate that reaches the scan; many
    are joined."""
    key = "city_key" if "city_key" in df.columns else "city"
    if scope.names is not None:
        return df.where(F.col(key).isin(list(scope.names)))
    major = cities.where(F.col("rides") >= min_rides).select(F.col("city").alias(key))
    return df.join(major, key, "left_semi")


def city_encoding(df: DataFrame) -> DataFrame:
    """Distinct cities numbered 0, 1, ... in text order."""
    cities = (
        df.where(F.col("city").isNotNull()).groupBy("city").agg(F.lit(1).cast("bigint").alias("one"))
    )
    return running_total(cities, ["city"], "one", "city_index").select("city", "city_index")


def encode_city(
    df: DataFrame, encoding: DataFrame, unseen: int = 0, scope: CityScope = UNKNOWN_SCOPE
) -> DataFrame:
    """Replace the city by its number. Unknown cities get ``unseen``; the parity value 0
    is also the number of the first city."""
    index = F.coalesce(F.col("city_index"), F.lit(unseen).cast("bigint"))
    return (
        df.join(scope.small(encoding, 1), "city", "left")
        .withColumn("city", index)
        .drop("city_index")
    )
