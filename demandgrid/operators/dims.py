"""First-non-null attribute tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandgrid.schema import (
    CALENDAR_COLUMNS,
    CELL_KEY,
    STATION_COLUMNS,
    STATION_KEY,
    WEATHER_COLUMNS,
    present,
)

# Aggregation buffers of these types can be updated in place, which keeps min_by in a
# hash aggregate. Text buffers cannot: Spark would sort the whole input instead.
_IN_PLACE = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)


def _first_by(value: str, order: Column | str) -> Column:
    """Value of the earliest row in which it is not null."""
    order = F.col(order) if isinstance(order, str) else order
    return F.min_by(value, F.when(F.col(value).isNotNull(), order))


def first_non_null(
    df: DataFrame, by: list[str], columns: list[str], order_col: str | None = "event_id"
) -> DataFrame:
    """One row per ``by`` key with the first non-null value of every column in row order.

    ``order_col`` must be unique within a key. A table without one falls back to the
    order in which its files are read, which is only repeatable for a fixed file layout.

    Text columns are turned into grouping keys of a first, hash-based step that shrinks
    the rides to one row per key and spelling; the few rows left are then combined.
    """
    if order_col is None or order_col not in df.columns:
        order_col = "_row_order"
        df = df.withColumn(order_col, F.monotonically_increasing_id())
    if not columns:
        return df.select(*by).distinct()
    types = {f.name: f.dataType for f in df.schema.fields}
    plain = [c for c in columns if isinstance(types[c], _IN_PLACE)]
    text = [c for c in columns if c not in plain]
    if not text:
        return df.groupBy(*by).agg(*[_first_by(c, order_col).alias(c) for c in plain])

    seen = {c: f"_seen_{i}" for i, c in enumerate(plain)}
    spellings = df.groupBy(*by, *text).agg(
        F.min(order_col).alias("_seen"),
        *[_first_by(c, order_col).alias(c) for c in plain],
        *[F.min(F.when(F.col(c).isNotNull(), F.col(order_col))).alias(s) for c, s in seen.items()],
    )
    firsts = {c: _first_by(c, seen.get(c, "_seen")).alias(c) for c in columns}
    return spellings.groupBy(*by).agg(*[firsts[c] for c in columns])


def station_dim(
    keyed: DataFrame,
    order_col: str | None = "event_id",
    station_col: str = "start_station_id",
    city_col: str = "city",
) -> DataFrame:
    """One row per city and station: raw city, first raw station spelling, attributes."""
    columns = present([station_col, *STATION_COLUMNS], keyed.columns)
    if city_col not in keyed.columns:
        return first_non_null(keyed, ["city_key", "station_key"], columns, order_col)
    # The raw city is the key itself unless all cities of the group are null, so a
    # marker number stands in for the text.
    marked = keyed.withColumn("_has_city", F.when(F.col(city_col).isNotNull(), F.lit(1)))
    out = first_non_null(marked, ["city_key", "station_key"], ["_has_city", *columns], order_col)
    city = F.when(F.col("_has_city").isNotNull(), F.col("city_key")).alias(city_col)
    return out.select("city_key", "station_key", city, *columns)


def city_hour_dim(keyed: DataFrame, order_col: str | None = "event_id") -> DataFrame:
    """One row per city and observed hour: weather and calendar attributes."""
    columns = present([*WEATHER_COLUMNS, *CALENDAR_COLUMNS], keyed.columns)
    return first_non_null(keyed, ["city_key", "target_hour_start"], columns, order_col)


def ride_attributes(
    have: list[str], station_col: str = "start_station_id", city_col: str = "city"
) -> tuple[list[str], list[str]]:
    """The attributes of stations and of city-hours that a table of rides has."""
    station = present([station_col, *STATION_COLUMNS], have)
    if city_col in have:
        station = ["_has_city", *station]
    return station, present([*WEATHER_COLUMNS, *CALENDAR_COLUMNS], have)


def cells_with_attributes(
    keyed: DataFrame,
    order_col: str | None = "event_id",
    station_col: str = "start_station_id",
    city_col: str = "city",
) -> DataFrame:
    """Attributed cells with all that ``station_dim`` and ``city_hour_dim`` have."""
    if city_col in keyed.columns:
        # The raw city is the key itself unless all cities of the group are null, so a
        # marker number stands in for the text.
        keyed = keyed.withColumn("_has_city", F.when(F.col(city_col).isNotNull(), F.lit(1)))
    station, hour = ride_attributes(keyed.columns, station_col, city_col)
    return attributed_cells(keyed, [*station, *hour], order_col)


def station_dim_of_cells(
    cells: DataFrame, station_col: str = "start_station_id", city_col: str = "city"
) -> DataFrame:
    """``station_dim`` from attributed cells."""
    columns = present(["_has_city", station_col, *STATION_COLUMNS], cells.columns)
    out = merged_firsts(cells, STATION_KEY, columns)
    if "_has_city" not in columns:
        return out
    city = F.when(F.col("_has_city").isNotNull(), F.col("city_key")).alias(city_col)
    return out.select(*STATION_KEY, city, *[c for c in columns if c != "_has_city"])


def city_hour_dim_of_cells(cells: DataFrame) -> DataFrame:
    """``city_hour_dim`` from attributed cells."""
    columns = present([*WEATHER_COLUMNS, *CALENDAR_COLUMNS], cells.columns)
    return merged_firsts(cells, ["city_key", "target_hour_start"], columns)


def _seen(column: str) -> str:
    return f"_at_{column}"


def attributed_cells(
    keyed: DataFrame, columns: list[str], order_col: str | None = "event_id"
) -> DataFrame:
    """Demand cells in one pass over the rides: ``demand``, the first non-null value of every
    column in row order, and in ``_at_<column>`` the place in that order where it was seen.

    What stations and city-hours need follows from the cells, by ``merged_firsts``. Partial
    sums run before the shuffle. Text is a grouping key of a first step, as a text buffer
    would sort the rides.
    """
    if order_col is None or order_col not in keyed.columns:
        order_col = "_row_order"
        keyed = keyed.withColumn(order_col, F.monotonically_increasing_id())
    order = F.col(order_col)
    seen = {_seen(c): F.when(F.col(c).isNotNull(), order) for c in columns}
    rows = keyed.select(*CELL_KEY, *[c for c in columns if c not in CELL_KEY], *(at.alias(n) for n, at in seen.items()))
    return _merged(rows.withColumn("demand", F.lit(1).cast("bigint")), CELL_KEY, columns, ["demand"], True)


def merged_firsts(cells: DataFrame, by: list[str], columns: list[str]) -> DataFrame:
    """First non-null values of attributed cells, merged up to coarser keys."""
    return _merged(cells, by, columns, [], False)


def merged_cells(parts: DataFrame, columns: list[str]) -> DataFrame:
    """Attributed cells of several tables of rides added up, still attributed."""
    return _merged(parts, CELL_KEY, columns, ["demand"], True)


def _merged(df: DataFrame, by: list[str], columns: list[str], sums: list[str], keep_places: bool) -> DataFrame:
    types = {f.name: f.dataType for f in df.schema.fields}
    text = [c for c in columns if not isinstance(types[c], _IN_PLACE)]

    def firsts(names: list[str]) -> list[Column]:
        return [F.min_by(c, _seen(c)).alias(c) for c in names]

    def places(names: list[str]) -> list[Column]:
        return [F.min(_seen(c)).alias(_seen(c)) for c in names]

    added = [F.sum(c).alias(c) for c in sums]
    plain = [c for c in columns if c not in text]
    if text:
        df = df.groupBy(*by, *text).agg(*added, *firsts(plain), *places(columns))
    return df.groupBy(*by).agg(*added, *firsts(columns), *(places(columns) if keep_places else []))


def first_row_per_city_hour(cells: DataFrame, columns: list[str]) -> DataFrame:
    """City-hour values taken from one row, that of the smallest station id, nulls kept.

    Each city and hour keeps one row per task before the shuffle.
    """
    return (
        cells.groupBy("city", "hour_ts")
        .agg(F.min_by(F.struct(*columns), "start_station_id").alias("_row"))
        .select("city", "hour_ts", "_row.*")
    )
