"""The panel of a growing set of ride files, kept up to date by Structured Streaming.

Every micro-batch of new files is reduced to attributed demand cells (count, and the first
value of every attribute with its place in the order), which add up: merging the cells of all
batches gives those of all rides at once. So late rides need no special case, they are a few
more counts of an old cell, and a batch that is run again after a failure writes its own
folder again. A watermark on the ride's time tells which hours are settled; nothing is
dropped by it.

Small batches are merged into one table from time to time (``compact``), which is published
as a whole together with the number of the last batch in it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandgrid.operators.dims import cells_with_attributes, merged_cells, ride_attributes
from demandgrid.plans.panel import PanelSpec, panel_of_cells
from demandgrid.session import shuffle_partitions
from demandgrid.sources import publish
from demandgrid.sources.staging import path_exists

BATCHES = "batches"
EVENT_TIME = "_event_time"


def read_rides(
    spark: SparkSession, folder: str, schema: T.StructType, fmt: str = "parquet", files_at_once: int = 100
) -> DataFrame:
    """The rides of all files in a folder, and of those that will come."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_at_once)
    return reader.format(fmt).load(folder)


def _spread(batch: DataFrame, spec: PanelSpec) -> DataFrame:
    """The rides of a batch over all tasks: a file has few row groups, and a task that makes
    the cells of a whole one holds as much as the file grows to. Without an order column the
    order of the file counts, so they stay where they are."""
    if spec.order_col is None or spec.order_col not in batch.columns:
        return batch
    return batch.repartition(shuffle_partitions(batch.sparkSession), spec.order_col, spec.start_time_col)


def ingest(
    rides: DataFrame, path: str, spec: PanelSpec | None = None, delay: str = "2 days", until_empty: bool = True
):  # noqa: ANN201  a streaming query
    """Starts the query that turns new rides into cells under ``path``.

    ``until_empty`` works off what is there and ends, to be started again by a scheduler.
    """
    spec = spec or PanelSpec()

    def write(batch: DataFrame, number: int) -> None:
        keyed = spec.key(_spread(batch, spec).drop(EVENT_TIME))
        cells = cells_with_attributes(keyed, spec.order_col, spec.station_col, spec.city_col)
        cells.write.mode("overwrite").parquet(f"{path}/{BATCHES}/batch={number}")

    # Watermarks are kept on instants; what does not parse has none.
    at = F.col(spec.start_time_col).try_cast("timestamp")
    marked = rides.withColumn(EVENT_TIME, at).withWatermark(EVENT_TIME, delay)
    writer = marked.writeStream.foreachBatch(write).option("checkpointLocation", f"{path}/progress")
    return (writer.trigger(availableNow=True) if until_empty else writer).start()


def _parts(spark: SparkSession, path: str) -> tuple[DataFrame | None, int]:
    """The merged table and all batches after it, and the last batch."""
    found = publish.current(spark, f"{path}/merged")
    done = found.meta["batch"] if found else -1
    tables = [publish.read(spark, found)["cells"]] if found else []
    last = done
    if path_exists(spark, f"{path}/{BATCHES}"):
        later = spark.read.option("mergeSchema", "true").parquet(f"{path}/{BATCHES}")
        later = later.where(F.col("batch") > done)
        last = later.agg(F.max("batch")).first()[0]
        last = done if last is None else int(last)
        tables.append(later.drop("batch"))
    if not tables:
        return None, -1
    out = tables[0]
    for more in tables[1:]:
        out = out.unionByName(more, allowMissingColumns=True)
    return out, last


def cells(spark: SparkSession, path: str, spec: PanelSpec | None = None) -> DataFrame:
    """The attributed cells of all rides so far."""
    spec = spec or PanelSpec()
    parts, _ = _parts(spark, path)
    if parts is None:
        raise FileNotFoundError(f"no batch of rides has been taken in at {path}")
    station, hour = ride_attributes(parts.columns, spec.station_col, "_has_city")
    return merged_cells(parts, list(dict.fromkeys([*station, *hour])))


def compact(spark: SparkSession, path: str, spec: PanelSpec | None = None) -> int:
    """Merges all batches so far into one published table; returns the last batch in it."""
    _, last = _parts(spark, path)
    publish.publish(spark, f"{path}/merged", {"cells": cells(spark, path, spec)}, {"batch": last})
    publish.clean(spark, f"{path}/merged", keep=2)
    return last


def settled_until(spark: SparkSession, path: str, delay_hours: int = 48) -> DataFrame:
    """One row: the last hour seen, and the hour before which the watermark expects no rides."""
    parts, _ = _parts(spark, path)
    last = F.max("target_hour_start")
    return parts.agg(
        last.alias("last_hour"), (last - F.make_dt_interval(F.lit(0), F.lit(delay_hours))).alias("settled_until")
    )


def panel(spark: SparkSession, path: str, spec: PanelSpec | None = None) -> DataFrame:
    """The evaluation panel of all rides so far, as ``station_hour_panel`` gives it."""
    spec = spec or PanelSpec()
    return panel_of_cells(cells(spark, path, spec), spec)
