"""Row errors and metric sums."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandgrid.functions.features import at_least


def with_errors(df: DataFrame) -> DataFrame:
    """Clipped prediction and its errors; ``signed_error`` is demand minus prediction."""
    clipped = at_least(F.col("prediction"), 0.0)
    signed = F.col("demand").cast("double") - F.col("prediction_clipped")
    return df.withColumn("prediction_clipped", clipped).withColumns(
        {
            "signed_error": signed,
            "abs_error": F.abs(signed),
            "squared_error": signed * signed,
        }
    )


# Sums that add up over any grouping, so totals come from the groups instead of the rows.
PARTS: dict[str, Column | str] = {
    "n_rows": "count(*)",
    "n_scored": "count(prediction)",
    "sum_abs": "sum(abs_error)",
    "sum_sq": "sum(squared_error)",
    "sum_signed": "sum(signed_error)",
    "sum_true": "sum(cast(demand AS double))",
    "sum_pred": "sum(prediction_clipped)",
    "n_negative": "count_if(prediction < 0)",
}


def metric_parts(df: DataFrame, by: list[str]) -> DataFrame:
    return df.groupBy(*by).agg(*[F.expr(e).alias(name) for name, e in PARTS.items()])


def add_parts(parts: DataFrame, by: list[str]) -> DataFrame:
    """Combine metric sums into coarser groups."""
    added = parts.groupBy(*by).agg(*[F.sum(name).alias(name) for name in PARTS])
    return added.na.fill(0, ["n_rows", "n_scored", "n_negative"])


def part_mean(name: str) -> Column:
    """Mean over all rows; null if a row has no prediction, and the sum so leaves it out."""
    whole = F.col("n_scored") == F.col("n_rows")
    return F.when(whole | F.lit(name == "sum_true"), F.try_divide(F.col(name), F.col("n_rows")))


