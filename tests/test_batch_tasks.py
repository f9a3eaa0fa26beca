"""A batch of one file is not one task's work."""

from demandgrid.plans.panel import PanelSpec
from demandgrid.session import shuffle_partitions
from demandgrid.streaming import incremental as INC


def test_rides_of_one_file_are_spread(spark, small_rides, tmp_path, monkeypatch):
    seen, plain = [], INC.cells_with_attributes

    def cells(keyed, *args):
        seen.append(keyed.rdd.getNumPartitions())
        return plain(keyed, *args)

    monkeypatch.setattr(INC, "cells_with_attributes", cells)
    rides = small_rides.where("city IS NOT NULL")
    rides.coalesce(1).write.parquet(f"{tmp_path}/rides")
    for order_col in ("event_id", None):
        to, spec = f"{tmp_path}/{order_col}", PanelSpec(keep_hours=None, order_col=order_col)
        INC.ingest(INC.read_rides(spark, f"{tmp_path}/rides", rides.schema), to, spec).awaitTermination()
        assert INC.cells(spark, to, spec).groupBy().sum("demand").first()[0] == rides.count()
    assert seen == [shuffle_partitions(spark), 1]
