"""Every registered query against its SQL counterpart.

Panel queries are compared on the small tables, where they are quick; training, scoring and
diagnostics need the larger ones, because no small city reaches the ride threshold.
"""

import pytest

import __spark_entry__ as entry
from compare import connect, differences
from demandgrid.plans.catalog import QUERIES as CATALOG

SMALL, LARGE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
PANEL = {
    "station_id_normalize", "station_hour_demand", "station_activity", "grid_full",
    "grid_active_window", "grid_active_window_buffered", "grid_observed", "panel_keep_hours",
    "panel_cap_hours", "station_dim", "city_hour_dim", "panel_targets", "panel_labels",
    "incremental_panel", "unreadable_rides", "hidden_test_sample", "ride_pattern", "city_avg", "dataset_profile",
}
QUERIES = {k: q for k, q in entry.queries().items() if k in CATALOG}
ORACLE = {k: q for k, q in entry.oracle_sql().items() if k in CATALOG}
WITHOUT_SQL = {
    "predict_glm", "predict_gbt", "predict_future", "model_validation", "loss_curve", "feature_importance",
}


@pytest.fixture(scope="module")
def duck():
    return {d: connect(d) for d in (SMALL, LARGE)}


def test_only_models_lack_sql():
    assert set(QUERIES) - set(ORACLE) == WITHOUT_SQL
    assert set(ORACLE) <= set(QUERIES)


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["city_key", "station_key", "target_hour_start", "demand"]
    assert df.count() > 0


def test_every_event_is_in_the_panel(spark):
    from pyspark.sql import functions as F

    from demandgrid.operators import demand as D
    from demandgrid.operators import grid as G
    from demandgrid.sources.rideviews import busy_rides, sparse_rides

    for rides in (sparse_rides(spark, SMALL), busy_rides(spark, SMALL)):
        cells = D.demand_cells(D.keyed_rides(rides))
        panel = G.zero_filled(cells, G.active_windows(cells))
        assert panel.agg(F.sum("demand")).first()[0] == 1000


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, duck, name):
    where = SMALL if name in PANEL else LARGE
    assert differences(QUERIES[name](spark, where), duck[where], ORACLE[name]) == []


@pytest.mark.parametrize("name", sorted(WITHOUT_SQL))
def test_model_queries_return_rows(spark, name):
    assert QUERIES[name](spark, LARGE).count() > 0
