"""Rides that come in pieces, digests of tables, sketches, and counts of bad rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from demandgrid.operators import digests as DG
from demandgrid.operators import quantiles as QT
from demandgrid.operators.ordering import running_total, with_buckets
from demandgrid.plans import panel as PN
from demandgrid.streaming import incremental as INC

SPEC = PN.PanelSpec(grid_mode="full", keep_hours=None)


def same(a, b):
    b = b.select(*a.columns)
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty() and not a.isEmpty()


def test_late_rides_end_in_the_batch_panel(spark, small_rides, tmp_path):
    folder, path = str(tmp_path / "rides"), str(tmp_path / "state")
    rides = small_rides.cache()

    def come(part):
        rides.where(F.col("event_id") % 3 == part).coalesce(1).write.mode("append").parquet(folder)

    def taken():
        stream = INC.read_rides(spark, folder, rides.schema, files_at_once=1)
        query = INC.ingest(stream, path, SPEC)
        query.awaitTermination()
        return query

    come(0)
    query = taken()
    assert "watermark" in str(query.lastProgress["eventTime"])
    first = rides.where("event_id % 3 = 0").coalesce(1)
    first.write.parquet(str(tmp_path / "first"))
    assert same(INC.panel(spark, path, SPEC), PN.station_hour_panel(spark.read.parquet(str(tmp_path / "first")), SPEC))
    assert INC.compact(spark, path, SPEC) == 0
    come(1)
    come(2)
    taken()
    rides.write.parquet(str(tmp_path / "all"))
    want = PN.station_hour_panel(spark.read.parquet(str(tmp_path / "all")), SPEC)
    assert same(INC.panel(spark, path, SPEC), want)  # the merged table and two later batches
    assert INC.compact(spark, path, SPEC) == 2
    taken()  # nothing new
    assert same(INC.panel(spark, path, SPEC), want)
    row = INC.settled_until(spark, path, 24).first()
    assert (row.last_hour - row.settled_until).days == 1
    with pytest.raises(FileNotFoundError):
        INC.cells(spark, str(tmp_path / "none"))


def test_bad_rides_are_counted_in_the_same_pass(small_rides):
    rides = small_rides.withColumn(
        "started_at", F.when(F.col("event_id") % 10 == 0, F.lit("soon")).otherwise(F.col("started_at").cast("string"))
    )
    counts = {}
    kept = PN.station_hour_panel(rides, PN.PanelSpec(grid_mode="full", keep_hours=None, on_bad="drop"), counts)
    assert counts == {"rides": 1502, "bad": 151}
    assert kept.agg(F.sum("demand")).first()[0] == 1502 - 151
    with pytest.raises(ValueError, match="151 of 1502 rides"):
        PN.station_hour_panel(rides, SPEC)
    with pytest.raises(ValueError, match="on_bad"):
        PN.station_hour_panel(rides, PN.PanelSpec(on_bad="ignore"))


def test_digests(spark):
    rng = np.random.default_rng(3)
    rows = [(int(i), float(rng.integers(9)), f"t{i % 5}") for i in rng.permutation(3000)]
    rows += [(7, 1.0, "again"), (None, 1.0, "none")]
    schema = "id bigint, x double, t string"
    first = spark.createDataFrame(rows, schema)
    second = spark.createDataFrame(list(reversed(rows)), schema).repartition(5)
    assert DG.same_rows(first, second) and DG.differing_rows(first, second).count() == 0
    assert not DG.same_rows(first, second.drop("t"))
    changed = [r if r[0] not in (5, 2999) else (r[0], -1.0, r[2]) for r in rows if r[0] != 1234]
    other = spark.createDataFrame([*changed, (10**12, 0.0, "far"), (-4, 0.0, "new")], schema)
    assert not DG.same_rows(first, other)
    got = {tuple(r) for r in DG.differing_rows(first, other).collect()}
    assert got == {(5, "changed"), (2999, "changed"), (1234, "only_first"), (10**12, "only_second"), (-4, "only_second")}
    # A row more of an id is a change, and so are two rows for one.
    twice = first.unionAll(first.where("id = 8"))
    assert [tuple(r) for r in DG.differing_rows(first, twice).collect()] == [(8, "changed")]
    none = first.limit(0)
    assert DG.same_rows(none, none) and DG.differing_rows(none, first).where("status <> 'only_second'").isEmpty()
    assert DG.table_digest(none).first().n == 0


def test_sketches_keep_their_rank_error(spark):
    n = 1_000_000
    values = spark.range(n, numPartitions=8).select(
        (F.xxhash64("id") % n).cast("double").alias("x"), F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 4)).alias("g")
    )
    probs = [0.001, 0.1, 0.5, 0.9, 0.999]
    found = QT.sketches(values, "x", ["g"]).cache()
    for sketched, by in ((found, ["g"]), (QT.merged_sketches(found), [])):
        each = QT.sketched_quantiles(sketched, probs, by).collect()
        for r in each:
            own = values.where(F.col("g") == r.g) if by else values
            rank = own.agg(F.avg((F.col("x") <= r.quantile).cast("double"))).first()[0]
            assert abs(rank - r.q) <= QT.SKETCH_ERROR
    assert found.agg(F.sum("n"), F.max(F.length("sketch"))).first()[1] < 50_000
    none = spark.createDataFrame([(None, "a"), (float("nan"), "a")], "x double, g string")
    assert QT.sketches(none, "x", ["g"]).count() == 0


def test_buckets_grow_with_the_rows_and_keep_the_order(spark):
    for n in (0, 1, 50, 2500):
        df = spark.range(n).select((F.col("id") * 7919 % 10007).alias("k"), F.lit(2).alias("w"))
        rows = with_buckets(df, ["k"], "w", "b").orderBy("k").collect()
        assert [r.b for r in rows] == sorted(r.b for r in rows)
        assert len({r.b for r in rows}) <= max(1, int(np.ceil(np.sqrt(n))))
        if n > 50:
            sizes = np.bincount([r.b for r in rows])
            assert len(sizes) > 40 and sizes.max() < n / 4
        totals = running_total(df, ["k"], "w", "t").orderBy("k").collect()
        assert [r.t for r in totals] == [2 * i for i in range(n)]
