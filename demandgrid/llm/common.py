"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space that separates words: blank and the controls 9 to 13.
SPACES = " \t\n\x0b\x0c\r"

#: One word, as a pattern.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables. Python workers are told where this package is."""
    root = str(Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *paths])
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def evened(text: Column) -> Column:
    """The text with every character of white space as a blank; a null text is empty."""
    text = F.coalesce(text, F.lit(""))
    for c in SPACES[1:]:
        text = F.replace(text, F.lit(c), F.lit(" "))
    return text


def words_of(even: Column) -> Column:
    """The words of an evened text, in order.

    Give it a column, not an expression: it looks at the text several times.
    """
    parts = F.split(even, " ")
    # Only texts with empty parts pay for another pass over them.
    gaps = F.contains(even, F.lit("  ")) | even.startswith(" ") | even.endswith(" ") | (even == "")
    return F.when(gaps, F.array_remove(parts, "")).otherwise(parts)


def by_order(df: DataFrame, *columns: str) -> list[Column]:
    """Ascending order with nulls first, named once so that all operators agree."""
    return [F.col(c).asc_nulls_first() for c in columns]
