"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the local cores. Each query is run once to warm
up the session on the small end of the work and then timed to the last row, without
collecting the rows.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from demandgrid.models.bundle import Bundle, train_bundle  # noqa: E402
from demandgrid.plans import features as P  # noqa: E402
from demandgrid.plans.catalog import BOOSTING, MODEL_SPEC, QUERIES, SPEC  # noqa: E402
from demandgrid.session import ensure_checkpoint_dir, local_session  # noqa: E402
from demandgrid.sources.rideviews import busy_rides, wide_rides  # noqa: E402

HEADLINE = [
    "station_hour_demand",
    "grid_full",
    "panel_keep_hours",
    "panel_targets",
    "train_panel",
    "stats_station_hod",
    "lag_features",
    "feature_matrix",
    "target_features",
    "leaderboard",
    "contract_report",
    "diag_summary",
    "hist_errors",
    "qq_points",
    "predict_gbt",
]
# Published rate of the reference: features and prediction for 346,907 rows in 142 s.
BASELINE_ROWS_PER_SECOND = 2443


def features_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training features with every user a station: the large panel."""
    train, _ = P.make_features_from_rides(wide_rides(spark, sf_dir), SPEC)
    return P.feature_matrix(train, ["start_station_id", "hour_ts", "demand"])


def trained(spark: SparkSession, sf_dir: str) -> Bundle:
    """Rides to a published bundle, loaded again."""
    path = f"{ensure_checkpoint_dir(spark)}/bench-bundle"
    train_bundle(busy_rides(spark, sf_dir), path, MODEL_SPEC, BOOSTING)
    return Bundle.load(spark, path)


def scored(bundle: Bundle) -> DataFrame:
    """Features and predictions for two weeks of targets: what the published rate covers."""
    return bundle.predict(bundle.future(24 * 14), ("city", "start_station_id", "hour_ts"))


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    queries = {**{name: QUERIES[name] for name in HEADLINE}, "features_wide": features_wide}
    run(queries["station_hour_demand"](spark, sf_dir))

    seconds: dict[str, float] = {}
    for name, query in queries.items():
        start = time.perf_counter()
        run(query(spark, sf_dir))
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name}: {seconds[name]}s", file=sys.stderr, flush=True)

    start = time.perf_counter()
    bundle = trained(spark, sf_dir)
    seconds["train_bundle"] = round(time.perf_counter() - start, 3)
    start = time.perf_counter()
    run(scored(bundle))
    seconds["features_and_predictions"] = round(time.perf_counter() - start, 3)
    rows, targets = features_wide(spark, sf_dir).count(), scored(bundle).count()
    spark.stop()
    rate = rows / seconds["features_wide"]
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
                "feature_rows": rows,
                "feature_rows_per_second": round(rate),
                "scored_rows": targets,
                "scored_rows_per_second": round(targets / seconds["features_and_predictions"]),
                "baseline_scored_rows_per_second": BASELINE_ROWS_PER_SECOND,
            }
        )
    )


if __name__ == "__main__":
    main()
