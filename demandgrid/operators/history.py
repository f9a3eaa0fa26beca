"""Demand history and exact-offset lags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from demandgrid.functions.features import weekly_mean
from demandgrid.schema import FEATURE_CELL, FEATURE_STATION, LAG_DAYS, WEEKLY_LAG_DAYS


def lag_name(days: int) -> str:
    return f"lag_{days}d_demand"


def demand_history(cells: DataFrame) -> DataFrame:
    """Observed demand per normalised key. Hours without rides have no row."""
    return cells.groupBy(*FEATURE_CELL).agg(F.sum("demand").cast("bigint").alias("demand"))


def demand_at_offsets(
    df: DataFrame, history: DataFrame, offsets: dict[str, int]
) -> DataFrame:
    """Add, per offset in days, the demand of the same station exactly that long ago.

    Rows and history are stacked and looked up with one range frame per offset over the
    same partitioning and order, so they are shuffled and sorted once for all offsets.
    Null where the history has no row.
    """
    past = history.select(*FEATURE_CELL, F.col("demand").cast("bigint").alias("_past"))
    both = df.withColumn("_row", F.lit(True)).unionByName(past, allowMissingColumns=True)

    def at(days: int) -> Column:
        return F.expr(
            f"sum(_past) OVER (PARTITION BY {', '.join(FEATURE_STATION)} ORDER BY hour_ts "
            f"RANGE BETWEEN INTERVAL '{days}' DAY PRECEDING AND INTERVAL '{days}' DAY PRECEDING)"
        )

    looked_up = both.withColumns({name: at(days) for name, days in offsets.items()})
    return looked_up.where("_row").drop("_row", "_past")


def with_lags(df: DataFrame, history: DataFrame) -> DataFrame:
    """The four lags and the weekly mean, zero where nothing was observed."""
    lags = {lag_name(d): d for d in LAG_DAYS}
    return zero_filled_lags(demand_at_offsets(df, history, lags))


def with_dense_lags(panel: DataFrame) -> DataFrame:
    """The same lags for a panel without gaps that holds its own history.

    Every hour of a station is present, so a lag is the row a fixed number of places
    earlier; a zero there means the history has no row. The panel keeps its partitioning.
    """
    station = W.partitionBy(*FEATURE_STATION).orderBy("hour_ts")

    def at(days: int) -> Column:
        return F.nullif(F.lag("demand", 24 * days).over(station), F.lit(0))

    return zero_filled_lags(panel.withColumns({lag_name(d): at(d) for d in LAG_DAYS}))


def zero_filled_lags(df: DataFrame) -> DataFrame:
    """Weekly mean over the observed lags first, zero fill after."""
    mean = weekly_mean([F.col(lag_name(d)) for d in WEEKLY_LAG_DAYS])
    out = df.withColumn("lag_rolling_mean", F.coalesce(mean, F.lit(0.0)))
    return out.withColumns(
        {lag_name(d): F.coalesce(F.col(lag_name(d)), F.lit(0)).cast("double") for d in LAG_DAYS}
    )
