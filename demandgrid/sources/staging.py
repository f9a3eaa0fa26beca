"""Tables written between the steps of a job, and when they go."""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

from demandgrid.session import ensure_checkpoint_dir

#: Where each open job keeps its tables, innermost last.
_jobs: list[str] = []


def _root(spark: SparkSession) -> str:
    return _jobs[-1] if _jobs else f"{ensure_checkpoint_dir(spark)}/tables"


def staged(df: DataFrame, name: str, options: dict[str, str] | None = None) -> DataFrame:
    """Write the rows to the shared checkpoint folder and read them back.

    Steps that follow start from files instead of the rides: a lost executor costs the
    current step only, several readers do not repeat the work, each reads just the columns
    it needs, and the planner knows the size of the table. Within ``job`` the table goes
    with the job; otherwise it stays as long as the checkpoint folder, since results that
    are worked out later still read it. ``options`` are those of the writer.
    """
    spark = df.sparkSession
    path = f"{_root(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.options(**options or {}).parquet(path)
    table = spark.read.parquet(path)
    table._staged_at = path
    return table


def _delete(spark: SparkSession, path: str) -> None:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)


def discard(table: DataFrame) -> None:
    """Delete a table as ``staged`` returned it, when nothing reads it any more."""
    _delete(table.sparkSession, table._staged_at)


@contextlib.contextmanager
def job(spark: SparkSession) -> Iterator[str]:
    """Everything staged inside is deleted at the end, also after an error.

    For jobs that write their results: a table that is only returned would lose its files.
    """
    root = f"{ensure_checkpoint_dir(spark)}/tables/job-{uuid.uuid4().hex}"
    _jobs.append(root)
    try:
        yield root
    finally:
        _jobs.remove(root)
        _delete(spark, root)
