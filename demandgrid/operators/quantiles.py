"""Quantiles of any column at any size: exact by selection, or from mergeable sketches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from demandgrid.operators.ordering import with_buckets

#: Size of a sketch, and the rank error that it keeps (as a share of the rows): twice the
#: published error of a single quantile for this size, for all of a list of them.
SKETCH_K = 800
SKETCH_ERROR = 0.008


def value_counts(df: DataFrame, value: str, by: list[str]) -> DataFrame:
    """Rows per group and distinct value; null and NaN are left out."""
    v = F.col(value).cast("double")
    return (
        df.select(*by, v.alias("value"))
        .where(F.col("value").isNotNull() & ~F.isnan("value"))
        .groupBy(*by, "value")
        .agg(F.count("*").alias("n"))
    )


def quantiles_of_counts(counts: DataFrame, probs: list[float], by: list[str]) -> DataFrame:
    """(by, q, quantile) with linear interpolation between neighbouring values.

    An aggregate that computes exact percentiles holds all distinct values of a group in one
    buffer. Here equal values are counted first and dealt to buckets in their order. The
    totals of the buckets tell which of them hold a wanted place; only the values of those
    buckets are sorted, two buckets per quantile and group at most. ``by`` must hold no nulls.
    """
    placed = with_buckets(counts, [*by, "value"], "n", "_bucket")
    totals = placed.groupBy(*by, "_bucket").agg(F.sum("n").alias("_in"))
    along = W.partitionBy(*by).orderBy("_bucket")
    totals = totals.select(
        *by,
        "_bucket",
        "_in",
        F.coalesce(F.sum("_in").over(along.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_start"),
        F.sum("_in").over(W.partitionBy(*by)).alias("_rows"),
    )

    def held(place: Column) -> Column:
        return (place >= F.col("_start")) & (place < F.col("_start") + F.col("_in"))

    wanted = F.filter(
        F.transform(
            F.array(*[F.lit(float(p)) for p in probs]),
            lambda p, i: F.struct(i.alias("i"), (p * (F.col("_rows") - 1)).alias("place")),
        ),
        lambda w: held(F.floor(w["place"])) | held(F.ceil(w["place"])),
    )
    chosen = totals.select(*by, "_bucket", "_start", wanted.alias("_wanted")).where(F.size("_wanted") > 0)
    joined = placed.join(chosen, [*by, "_bucket"])
    inside = W.partitionBy(*by, "_bucket").orderBy("value").rowsBetween(W.unboundedPreceding, -1)
    first = F.col("_start") + F.coalesce(F.sum("n").over(inside), F.lit(0))
    joined = joined.withColumn("_first", first)
    first, last = F.col("_first"), F.col("_first") + F.col("n") - 1

    def share(w: Column) -> Column:
        """How much of the quantile this value carries: its own place, or part of the gap."""
        low, high = F.floor(w["place"]), F.ceil(w["place"])
        part = w["place"] - low
        at_low = F.when((low >= first) & (low <= last), 1.0 - part).otherwise(F.lit(0.0))
        at_high = F.when((high >= first) & (high <= last), part).otherwise(F.lit(0.0))
        return at_low + at_high

    shares = F.filter(
        F.transform("_wanted", lambda w: F.struct(w["i"].alias("i"), share(w).alias("share"))),
        lambda s: s["share"] > 0,
    )
    labels = F.array(*[F.lit(float(p)) for p in probs])
    return (
        joined.select(*by, "value", F.inline(shares))
        .groupBy(*by, "i")
        .agg(F.sum(F.col("value") * F.col("share")).alias("quantile"))
        .select(*by, F.get(labels, F.col("i")).alias("q"), "quantile")
    )


def exact_quantiles(
    df: DataFrame, value: str, probs: list[float], by: list[str] | None = None
) -> DataFrame:
    by = by or []
    return quantiles_of_counts(value_counts(df, value, by), probs, by)


def sketches(df: DataFrame, value: str, by: list[str] | None = None, k: int = SKETCH_K) -> DataFrame:
    """(by, sketch, n): a quantile sketch of each group's values, of bounded size.

    Sketches are made before the shuffle and merged after it, so a group that holds a third
    of the rows sends one sketch per task. Stored, they can be merged further by
    ``merged_sketches``: days to weeks, cities to the whole. Null and NaN are left out.
    """
    by = by or []
    v = F.col(value).cast("double")
    kept = df.select(*by, v.alias("v")).where(F.col("v").isNotNull() & ~F.isnan("v"))
    found = kept.groupBy(*by).agg(F.kll_sketch_agg_double("v", k).alias("sketch"), F.count("*").alias("n"))
    return found.where("n > 0")


def merged_sketches(found: DataFrame, by: list[str] | None = None, k: int = SKETCH_K) -> DataFrame:
    """Sketches of coarser groups from those of finer ones."""
    return found.groupBy(*(by or [])).agg(
        F.kll_merge_agg_double("sketch", k).alias("sketch"), F.sum("n").alias("n")
    )


def sketched_quantiles(found: DataFrame, probs: list[float], by: list[str] | None = None) -> DataFrame:
    """(by, q, quantile) from sketches; the rank of each is off by ``SKETCH_ERROR`` at most."""
    points = F.array(*[F.lit(float(p)) for p in probs])
    values = F.kll_sketch_get_quantile_double("sketch", points)
    pairs = F.arrays_zip(points.alias("q"), values.alias("quantile"))
    return found.select(*(by or []), F.inline(pairs))
