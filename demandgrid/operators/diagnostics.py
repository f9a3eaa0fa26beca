"""Error diagnostics of scored rows, as small tables.

Input rows carry city, target_hour_start, demand, prediction, prediction_clipped,
abs_error, signed_error and squared_error (see ``functions.errors.with_errors``).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from demandgrid.functions import keys as K
from demandgrid.functions.errors import add_parts, metric_parts, part_mean
from demandgrid.operators.quantiles import exact_quantiles, quantiles_of_counts, value_counts
from demandgrid.operators.sampling import sample_rows
from demandgrid.schema import MISSING_CITY, OVERALL, SCATTER_SAMPLE_ROWS

# Bin edges, supports and segments must equal the benchmark's.
PREDICTION_BINS = 25
PREDICTION_BIN_SUPPORT = 50
TRUE_DEMAND_LIMIT = 30
TRUE_DEMAND_SUPPORT = 20
DEMAND_BUCKETS = [
    ("0", -1, 0),
    ("1", 0, 1),
    ("2", 1, 2),
    ("3", 2, 3),
    ("4-5", 3, 5),
    ("6-10", 5, 10),
    ("11-20", 10, 20),
    (">20", 20, 200),
]
HISTOGRAMS = [
    ("abs_error", 80, 0.0, 20.0),
    ("signed_error", 80, -10.0, 10.0),
    ("demand", 60, 0.0, 30.0),
    ("prediction_clipped", 60, 0.0, 30.0),
]
QUANTILES = 200
QUANTILE_RANGE = (0.001, 0.999)
NIGHT_HOURS = [0, 1, 2, 3, 4, 22, 23]
DAY_HOURS = list(range(6, 22))
LOW_DEMAND = 10
EXTREME_HOURS = 3


def with_hour(scored: DataFrame) -> DataFrame:
    ts = F.col("target_hour_start")
    return scored.withColumns({"hour": F.hour(ts), "weekday": K.weekday(ts)})


def _means(parts: DataFrame, *keys: Column | str) -> DataFrame:
    return parts.select(
        *keys,
        part_mean("sum_abs").alias("mae"),
        F.sqrt(part_mean("sum_sq")).alias("rmse"),
        part_mean("sum_signed").alias("mean_signed_error"),
        part_mean("sum_true").alias("mean_true"),
        part_mean("sum_pred").alias("mean_pred"),
        F.col("n_rows").alias("n"),
    )


def error_summary(scored: DataFrame) -> DataFrame:
    """Metrics, bias (prediction minus truth) and median absolute error per city and overall."""
    own = scored.withColumn("city", F.coalesce(F.col("city").cast("string"), F.lit(MISSING_CITY)))
    parts = metric_parts(own, ["city"])
    total = add_parts(parts, []).withColumn("city", F.lit(OVERALL))
    # The overall row is one more group of the same counts.
    each = F.explode(F.array("city", F.lit(OVERALL))).alias("city")
    counts = value_counts(own, "abs_error", ["city"]).select(each, "value", "n")
    counts = counts.groupBy("city", "value").agg(F.sum("n").alias("n"))
    medians = quantiles_of_counts(counts, [0.5], ["city"])
    return (
        _means(parts.unionByName(total), "city")
        .withColumn("bias", -F.col("mean_signed_error"))
        .drop("mean_signed_error")
        .join(medians.select("city", F.col("quantile").alias("median_abs_error")), "city")
    )


def by_hour(scored: DataFrame) -> DataFrame:
    parts = metric_parts(with_hour(scored), ["hour"])
    return _means(parts, "hour").drop("mean_signed_error")


def by_city(scored: DataFrame) -> DataFrame:
    """MAE, mean signed error (truth minus prediction) and means per city."""
    parts = metric_parts(scored, ["city"])
    return _means(parts, "city").select(
        "city", "mae", F.col("mean_signed_error").alias("bias"), "mean_true", "mean_pred"
    )


def by_weekday(scored: DataFrame) -> DataFrame:
    parts = metric_parts(with_hour(scored), ["weekday"])
    name = K.weekday_name(F.col("weekday")).alias("weekday_name")
    return (
        _means(parts, "weekday", name)
        .select("weekday", "weekday_name", "mae", "mean_true", "mean_pred", "n")
        .orderBy("weekday")
    )


def calibration_by_prediction(
    scored: DataFrame, bins: int = PREDICTION_BINS, support: int = PREDICTION_BIN_SUPPORT
) -> DataFrame:
    """Mean prediction and truth per unit-wide, right-closed prediction bin."""
    p = F.col("prediction_clipped")
    pred_bin = F.when(p == 0, F.lit(0)).when(
        (p > 0) & (p <= bins), F.ceil(p).cast("int") - 1
    )
    parts = metric_parts(scored.withColumn("pred_bin", pred_bin), ["pred_bin"])
    return (
        _means(parts, "pred_bin")
        .where(F.col("pred_bin").isNotNull() & (F.col("n") > support))
        .select("pred_bin", "mean_pred", "mean_true", F.col("n").alias("count"))
    )


def calibration_by_demand(
    scored: DataFrame, limit: int = TRUE_DEMAND_LIMIT, support: int = TRUE_DEMAND_SUPPORT
) -> DataFrame:
    """Mean and sample deviation of the predictions per true demand."""
    return (
        scored.where((F.col("demand") >= 0) & (F.col("demand") <= limit))
        .groupBy(F.col("demand").cast("int").alias("true_bin"))
        .agg(
            F.avg("prediction_clipped").alias("mean_pred"),
            F.stddev_samp("prediction_clipped").alias("std_pred"),
            F.count("*").alias("count"),
        )
        .where(F.col("count") > support)
    )


def demand_bucket(demand: Column) -> Column:
    """Position of the demand bucket; null outside all of them."""
    chosen = F.lit(None).cast("int")
    for i, (_, low, high) in reversed(list(enumerate(DEMAND_BUCKETS))):
        chosen = F.when((demand > low) & (demand <= high), F.lit(i)).otherwise(chosen)
    return chosen


def error_by_bucket(scored: DataFrame) -> DataFrame:
    bucket = demand_bucket(F.col("demand"))
    parts = metric_parts(scored.withColumn("bucket", bucket), ["bucket"])
    label = F.element_at(F.array(*[F.lit(b[0]) for b in DEMAND_BUCKETS]), F.col("bucket") + 1)
    return (
        _means(parts.where(F.col("bucket").isNotNull()), "bucket", label.alias("label"))
        .select("bucket", "label", "n", "mae", "mean_true", "mean_pred")
        .orderBy("bucket")
    )


def equal_width_bin(x: Column, bins: int, low: float, high: float) -> Column:
    """0-based bin; null outside the range. The last bin includes the upper end."""
    width = (high - low) / bins
    first = F.floor((x - low) / width)
    # Rounding in the division may miss by one bin next to an edge.
    step = (
        F.when(x < low + first * width, -1).when(x >= low + (first + 1) * width, 1).otherwise(0)
    )
    return F.when(
        (x >= low) & (x <= high), F.least(first + step, F.lit(bins - 1)).cast("int")
    )


def histograms(
    scored: DataFrame, specs: list[tuple[str, int, float, float]] | None = None
) -> DataFrame:
    """Counts of all histograms in one pass, empty bins included."""
    specs = specs or HISTOGRAMS
    spark = scored.sparkSession
    entries = [
        F.struct(
            F.lit(name).alias("histogram"),
            equal_width_bin(F.col(name).cast("double"), bins, low, high).alias("bin"),
        )
        for name, bins, low, high in specs
    ]
    counts = (
        scored.select(F.inline(F.array(*entries)))
        .where(F.col("bin").isNotNull())
        .groupBy("histogram", "bin")
        .agg(F.count("*").alias("n"))
    )
    frames = [
        spark.range(bins).select(
            F.lit(name).alias("histogram"),
            F.col("id").cast("int").alias("bin"),
            (F.lit(low) + F.col("id") * F.lit((high - low) / bins)).alias("bin_start"),
            (F.lit(low) + (F.col("id") + 1) * F.lit((high - low) / bins)).alias("bin_end"),
        )
        for name, bins, low, high in specs
    ]
    every = reduce(DataFrame.unionAll, frames)
    return every.join(counts, ["histogram", "bin"], "left").withColumn(
        "count", F.coalesce("n", F.lit(0).cast("bigint"))
    ).drop("n")


def quantile_points(n: int = QUANTILES, span: tuple[float, float] = QUANTILE_RANGE) -> list[float]:
    low, high = span
    return [low + i * (high - low) / (n - 1) for i in range(n)]


def qq_points(scored: DataFrame, probs: list[float] | None = None) -> DataFrame:
    """Quantiles of truth and prediction side by side."""
    probs = probs or quantile_points()
    series = F.array(
        F.struct(F.lit("true").alias("series"), F.col("demand").cast("double").alias("value")),
        F.struct(F.lit("pred").alias("series"), F.col("prediction_clipped").alias("value")),
    )
    stacked = scored.select(F.inline(series))
    found = exact_quantiles(stacked, "value", probs, ["series"])
    side = {
        f"{s}_quantile": F.max(F.when(F.col("series") == s, F.col("quantile")))
        for s in ("true", "pred")
    }
    return found.groupBy("q").agg(*[c.alias(n) for n, c in side.items()]).orderBy("q")


def zero_segments(scored: DataFrame) -> DataFrame:
    """One row: shares of zeros, and errors on rows without and with demand."""
    zero = F.col("demand") == 0
    pred = F.col("prediction_clipped")
    err = F.col("abs_error")
    return scored.agg(
        F.avg(zero.cast("double")).alias("zero_share_true"),
        F.avg((pred == 0).cast("double")).alias("zero_share_pred"),
        F.avg(F.when(zero, err)).alias("mae_zero"),
        F.avg(F.when(zero, pred)).alias("mean_pred_zero"),
        F.avg(F.when(zero, (pred == 0).cast("double"))).alias("zero_correct_share"),
        F.avg(F.when(~zero, err)).alias("mae_nonzero"),
        F.avg(F.when(~zero, pred)).alias("mean_pred_nonzero"),
    )


def night_day_errors(scored: DataFrame) -> DataFrame:
    """One row: MAE by night (22-4) and by day (6-21); hour 5 belongs to neither."""
    hour, err = F.hour("target_hour_start"), F.col("abs_error")
    return scored.agg(
        F.avg(F.when(hour.isin(NIGHT_HOURS), err)).alias("mae_night"),
        F.avg(F.when(hour.isin(DAY_HOURS), err)).alias("mae_day"),
    )


def prediction_summary(scored: DataFrame) -> DataFrame:
    """Range, mean and zero share of the predictions and MAE, per city and overall."""
    p, err = F.col("prediction"), F.abs(F.col("prediction") - F.col("demand"))
    sums = {
        "min_prediction": F.min(p),
        "max_prediction": F.max(p),
        "n": F.count("*"),
        "_p": F.sum(p),
        "_t": F.sum(F.col("demand").cast("double")),
        "_e": F.sum(err),
        "_z": F.count_if(p == 0),
    }
    cities = scored.groupBy(F.coalesce("city", F.lit(MISSING_CITY)).alias("city")).agg(
        *[c.alias(k) for k, c in sums.items()]
    )
    combine = {"min_prediction": F.min, "max_prediction": F.max}
    total = cities.agg(*[combine.get(k, F.sum)(k).alias(k) for k in sums]).na.fill(0, ["n"])
    both = cities.unionByName(total.withColumn("city", F.lit(OVERALL)))
    mean = F.try_divide
    return both.select(
        "city",
        "n",
        "min_prediction",
        "max_prediction",
        mean(F.col("_p"), F.col("n")).alias("mean_prediction"),
        mean(F.col("_t"), F.col("n")).alias("mean_true"),
        mean(F.col("_e"), F.col("n")).alias("mae"),
        mean(F.col("_z"), F.col("n")).alias("zero_share"),
    )


def extreme_hours(scored: DataFrame, k: int = EXTREME_HOURS) -> DataFrame:
    """The k hours of day with the lowest and the highest MAE (24 rows are compared)."""
    hours = by_hour(scored)
    ranks = hours.withColumns(
        {
            "_best": F.row_number().over(W.orderBy("mae", "hour")),
            "_worst": F.row_number().over(W.orderBy(F.desc("mae"), F.desc("hour"))),
        }
    )
    picks = F.array(
        F.struct(F.lit("best").alias("side"), F.col("_best").alias("place")),
        F.struct(F.lit("worst").alias("side"), F.col("_worst").alias("place")),
    )
    return (
        ranks.select("hour", "mae", "n", F.inline(picks))
        .where(F.col("place") <= k)
        .orderBy("side", "place")
    )


def low_demand_sample(
    scored: DataFrame, n: int = SCATTER_SAMPLE_ROWS, limit: int = LOW_DEMAND, seed: int = 42
) -> DataFrame:
    """Scatter points: a fixed-size sample, then its rows of low demand."""
    return (
        sample_rows(scored, n, "id", seed)
        .where(F.col("demand") <= limit)
        .select("id", "demand", "prediction_clipped")
    )


def ride_pattern(keyed: DataFrame) -> DataFrame:
    """Mean rides per city and hour of day, over the hours with at least one ride."""
    return (
        _city_hour_rides(keyed)
        .groupBy("city_key", F.hour("target_hour_start").alias("hour"))
        .agg(F.avg("n").alias("mean_rides"))
    )


def city_average(keyed: DataFrame) -> DataFrame:
    """Mean rides per city and hour, over the hours with at least one ride."""
    return _city_hour_rides(keyed).groupBy("city_key").agg(F.avg("n").alias("mean_rides"))


def _city_hour_rides(keyed: DataFrame) -> DataFrame:
    return keyed.groupBy("city_key", "target_hour_start").agg(F.count("*").alias("n"))


def dataset_profile(cells: DataFrame) -> DataFrame:
    """Rides, their share, stations and period per city."""
    stations = cells.groupBy("city_key", "station_key").agg(
        F.sum("demand").alias("rides"),
        F.min("target_hour_start").alias("first_hour"),
        F.max("target_hour_start").alias("last_hour"),
    )
    cities = stations.groupBy("city_key").agg(
        F.sum("rides").alias("rides"),
        F.count("*").alias("stations"),
        F.min("first_hour").alias("first_hour"),
        F.max("last_hour").alias("last_hour"),
    )
    total = cities.agg(F.sum("rides").alias("total"))
    return cities.withColumn("share", F.col("rides") / total.scalar())


def demand_profile(rows: DataFrame) -> DataFrame:
    """Rows, mean, median, maximum and zero share of the demand.

    Rows are first counted per demand value, which also bounds the median's buffer.
    """
    counts = rows.groupBy("demand").agg(F.count("*").alias("n"))
    n = F.sum("n")
    return counts.agg(
        F.coalesce(n, F.lit(0)).alias("n_rows"),
        (F.sum(F.col("demand") * F.col("n")) / n).alias("mean_demand"),
        F.expr("percentile(demand, 0.5, n)").alias("median_demand"),
        F.max("demand").alias("max_demand"),
        (F.sum(F.when(F.col("demand") == 0, F.col("n")).otherwise(0)) / n).alias("zero_share"),
    )
