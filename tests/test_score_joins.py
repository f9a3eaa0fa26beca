"""Scoring joins rows that must not go through the driver."""

import pytest
from pyspark.sql import functions as F

from demandgrid.operators import scoring as SC


def stacked(spark, n, models):
    rows = spark.range(n).select("id", F.explode(F.array(*[F.lit(m) for m in models])).alias("model"))
    return rows.withColumn("prediction", F.col("id") % 7)


@pytest.mark.parametrize("whole", [True, False])
def test_rows_to_score_are_not_broadcast(spark, tmp_path, whole):
    # Written tables of ids are far smaller than their rows.
    spark.range(5000).select("id", F.lit("a").alias("city"), F.lit(1).alias("demand")).write.parquet(f"{tmp_path}/l")
    stacked(spark, 5000, ["m", "n"]).write.parquet(f"{tmp_path}/p")
    labels, made = spark.read.parquet(f"{tmp_path}/l"), spark.read.parquet(f"{tmp_path}/p")
    scored = SC.score_rows(labels, made, whole=whole)
    assert scored.count() == 10000
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
