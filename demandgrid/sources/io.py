"""Readers and writers for rides, evaluation pairs, results and feature artifacts."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandgrid.functions.keys import as_ntz, with_text_times
from demandgrid.operators import contracts as Q
from demandgrid.operators.cities import UNKNOWN_SCOPE, CityScope
from demandgrid.plans.features import Artifacts
from demandgrid.plans.panel import PanelSpec, labels_of, station_hour_panel, targets_of
from demandgrid.schema import LABELS_SCHEMA, RIDES_SCHEMA
from demandgrid.sources.staging import staged

FORMATS = ("parquet", "csv")


def _checked(fmt: str) -> str:
    if fmt not in FORMATS:
        raise ValueError(f"format must be one of {FORMATS}, got {fmt!r}")
    return fmt


def _csv(spark: SparkSession, path: str, declared: T.StructType) -> DataFrame:
    """CSV with the declared type for every known column, in the order of the file.

    Only the header line is read up front, and every file must have the same one. Times and
    whole numbers are read as text and converted, so that a bad value becomes null in its own
    column instead of spoiling the row, and ``3.0`` is a whole number; ids stay text, because
    a numeric id column would lose its spelling.
    """
    header = spark.read.csv(path, header=True, enforceSchema=False).columns
    known = {f.name: f.dataType for f in declared.fields}
    times = [c for c in header if isinstance(known.get(c), T.TimestampNTZType)]
    whole = [c for c in header if isinstance(known.get(c), T.IntegralType)]
    as_text = {*times, *whole}
    fields = [
        T.StructField(c, T.StringType() if c in as_text else known.get(c, T.StringType()))
        for c in header
    ]
    df = spark.read.schema(T.StructType(fields)).csv(
        path, header=True, mode="PERMISSIVE", enforceSchema=False
    )
    return df.withColumns(
        {c: as_ntz(c) for c in times} | {c: _whole(c, known[c].simpleString()) for c in whole}
    )


def _whole(name: str, kind: str) -> Column:
    """A whole number in any spelling; what has a fraction or is no number becomes null."""
    text = F.trim(F.col(name))
    wide = text.try_cast("double")
    return F.coalesce(
        text.try_cast(kind), F.when(wide == F.floor(wide), wide).try_cast(kind)
    )


def read_rides(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Ride log. Optional columns may be missing from the files."""
    if _checked(fmt) == "csv":
        return _csv(spark, path, RIDES_SCHEMA)
    return spark.read.parquet(path)


def read_table(
    spark: SparkSession, path: str, fmt: str = "parquet", declared: T.StructType = RIDES_SCHEMA
) -> DataFrame:
    if _checked(fmt) == "csv":
        return _csv(spark, path, declared)
    return spark.read.parquet(path)


TARGETS_SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("target_hour_start", T.TimestampNTZType()),
        T.StructField("hour", T.IntegerType()),
        *[f for f in RIDES_SCHEMA.fields if f.name != "event_id"],
    ]
)


def load_eval_pair(
    spark: SparkSession,
    directory: str,
    targets_name: str = "public_test_targets",
    labels_name: str = "private_test_labels",
    fmt: str = "parquet",
) -> tuple[DataFrame, DataFrame]:
    """Targets and labels after their contract holds; raises with the broken rules."""
    targets = read_table(spark, f"{directory}/{targets_name}", fmt, TARGETS_SCHEMA)
    labels = read_table(spark, f"{directory}/{labels_name}", fmt, LABELS_SCHEMA)
    Q.assert_targets_are_safe(targets)
    Q.require_columns(labels, ["id", "city", "demand"], labels_name)
    Q.assert_ok(Q.id_report(targets, labels))
    return targets, labels.withColumn("city", F.col("city").cast("string"))


def write_by(df: DataFrame, path: str, key: str | None = None, fmt: str = "parquet") -> None:
    """Overwrite a table, one folder per key value.

    Rebalancing gathers the rows of a key into few files and splits a key that holds a
    large share of the rows over several tasks.
    """
    if _checked(fmt) == "csv":
        df = with_text_times(df)
    if key and key in df.columns:
        writer = df.hint("rebalance", key).write.partitionBy(key)
    else:
        writer = df.write
    writer.mode("overwrite").format(fmt).option("header", "true").save(path)


def write_eval_pair(
    rides: DataFrame,
    targets_path: str,
    labels_path: str,
    spec: PanelSpec | None = None,
    fmt: str = "parquet",
) -> tuple[DataFrame, DataFrame]:
    """Build the panel once, and write its targets and its labels, partitioned by city."""
    spec = spec or PanelSpec()
    panel = staged(station_hour_panel(rides, spec), "panel")
    targets, labels = targets_of(panel, spec), labels_of(panel, spec)
    for df, path in ((targets, targets_path), (labels, labels_path)):
        write_by(df, path, spec.city_col if fmt == "parquet" else None, fmt)
    return targets, labels


def write_leaderboard(board: DataFrame, path: str, fmt: str = "csv") -> None:
    """One small file: models times cities rows."""
    board.coalesce(1).write.mode("overwrite").format(_checked(fmt)).option("header", "true").save(
        path
    )


def write_scored_rows(scored: DataFrame, path: str, fmt: str = "parquet") -> None:
    write_by(scored, path, "model", fmt)


def save_artifacts(art: Artifacts, path: str) -> Artifacts:
    """Write every artifact table and return artifacts that read the written tables.

    Reading them back cuts the lineage to the rides, and gives later joins tables whose
    size is known from their files.
    """
    spark = art.demand_history.sparkSession
    for name in Artifacts.TABLES:
        table = getattr(art, name)
        if table is not None:
            table.write.mode("overwrite").parquet(f"{path}/{name}")
    names = list(art.scope.names) if art.scope.names is not None else None
    scope = [(names, art.scope.city_hours, art.station_hour_stats is not None)]
    spark.createDataFrame(
        scope, "names array<string>, city_hours bigint, by_hour boolean"
    ).coalesce(1).write.mode("overwrite").parquet(f"{path}/scope")
    return load_artifacts(spark, path)


def load_artifacts(spark: SparkSession, path: str) -> Artifacts:
    scope = spark.read.parquet(f"{path}/scope").first()
    names = Artifacts.TABLES if scope.by_hour else Artifacts.TABLES[:-1]
    tables = {name: spark.read.parquet(f"{path}/{name}") for name in names}
    known = UNKNOWN_SCOPE
    if scope.names is not None:
        known = CityScope(tuple(scope.names), scope.city_hours)
    return Artifacts(**tables, scope=known)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
