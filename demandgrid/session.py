"""Session settings that the operators rely on."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A local session for tests and the bench; a cluster supplies its own."""
    settings = {
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "12g",
        "spark.driver.bindAddress": "127.0.0.1",
        "spark.driver.host": "127.0.0.1",
        **conf,
    }
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("demandgrid")
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shuffle_partitions(spark: SparkSession) -> int:
    """Task count for stages whose output grows after the shuffle (grid expansion).

    Such stages name their partition count: sized by the few bytes they read,
    adaptive execution would merge them into too few tasks.
    """
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder the cluster names, or a private one for local runs."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = os.path.join(tempfile.mkdtemp(prefix="demandgrid-"), "checkpoint")
    sc.setCheckpointDir(named)
    return named
