"""Seeded samples: evaluated hours per city, and a fixed number of rows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from demandgrid.functions.keys import timestamp_text
from demandgrid.schema import EVAL_HOURS_SEED

# A selection up to this many city-hours is sent to every task; above it the targets
# are joined through a shuffle.
BROADCAST_HOURS = 500_000


def seeded_order(seed: int, *parts: Column) -> Column:
    """A pseudo-random but repeatable sort key."""
    return F.md5(F.concat_ws("|", *parts, F.lit(str(seed))))


def checked_caps(caps: Mapping[str, int]) -> dict[str, int]:
    invalid = {city: cap for city, cap in caps.items() if cap is None or int(cap) < 1}
    if invalid:
        told = ", ".join(f"{city}: {cap}" for city, cap in sorted(invalid.items()))
        raise ValueError(f"a city keeps at least one hour, but its cap is {told}")
    return {city: int(cap) for city, cap in caps.items()}


def small_if_capped(picked: DataFrame, caps: Mapping[str, int]) -> DataFrame:
    """Mark a picked-hours table for broadcast when the caps bound its size."""
    return F.broadcast(picked) if sum(caps.values()) <= BROADCAST_HOURS else picked


def pick_hours(
    city_hours: DataFrame, caps: Mapping[str, int], seed: int = EVAL_HOURS_SEED
) -> DataFrame:
    """At most ``caps[city]`` of the distinct hours of each listed city."""
    caps = checked_caps(caps)
    cap = F.create_map(*[F.lit(x) for item in caps.items() for x in item])[F.col("city_key")]
    order = seeded_order(seed, F.col("city_key"), timestamp_text(F.col("target_hour_start")))
    place = F.row_number().over(W.partitionBy("city_key").orderBy(order, "target_hour_start"))
    return (
        city_hours.where(F.col("city_key").isin(list(caps)))
        .withColumn("_place", place)
        .where(F.col("_place") <= cap)
        .select("city_key", "target_hour_start")
    )


def keep_picked_hours(rows: DataFrame, picked: DataFrame, caps: Mapping[str, int]) -> DataFrame:
    """Rows of unlisted cities, and rows of listed cities at their picked hours."""
    marked = small_if_capped(picked.withColumn("_picked", F.lit(True)), caps)
    return (
        rows.join(marked, ["city_key", "target_hour_start"], "left")
        .where(F.col("_picked") | ~F.col("city_key").isin(list(caps)))
        .drop("_picked")
    )


def cap_eval_hours_per_city(
    targets: DataFrame, caps: Mapping[str, int] | None = None, seed: int = EVAL_HOURS_SEED
) -> DataFrame:
    """Limit the distinct hours per listed city, keeping all stations at those hours."""
    if not caps:
        return targets
    missing = {"city_key", "target_hour_start"} - set(targets.columns)
    if missing:
        raise ValueError(f"hours can be picked by {' and '.join(sorted(missing))} only, which targets lack")
    caps = checked_caps(caps)
    city_hours = targets.select("city_key", "target_hour_start").distinct()
    return keep_picked_hours(targets, pick_hours(city_hours, caps, seed), caps)


def sample_rows(df: DataFrame, n: int, id_col: str = "id", seed: int = 42) -> DataFrame:
    """Exactly min(n, rows) rows, the same ones on every run."""
    return df.orderBy(seeded_order(seed, F.col(id_col).cast("string")), id_col).limit(n)
