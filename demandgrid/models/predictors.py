"""Predictors: anything that turns target rows into (id, prediction)."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import TYPE_CHECKING, Protocol

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandgrid.operators.scoring import prediction_sets

if TYPE_CHECKING:
    import pandas as pd

PREDICTION = "id bigint, prediction double"
#: Characters of an exception that are kept.
ERROR_LENGTH = 200
DUMMY_CONSTANT = 100.0


class Predictor(Protocol):
    """``predict`` returns one row per target: its id and a prediction. Predictors that are
    fitted have ``load(spark, path)`` too, as ``demandgrid.models.bundle.Bundle``."""

    def predict(self, targets: DataFrame) -> DataFrame: ...


@dataclass(frozen=True)
class ConstantPredictor:
    """The same value for every target."""

    value: float = DUMMY_CONSTANT

    def predict(self, targets: DataFrame) -> DataFrame:
        return targets.select("id", F.lit(float(self.value)).alias("prediction"))


@dataclass(frozen=True)
class PandasPredictor:
    """A Python model applied to Arrow batches of the columns it names.

    Predictions must not depend on which rows share a batch. An exception fails the job; of
    an ``isolate``d predictor it is written beside the rows of its batch, with predictions
    that are null, so that other predictors of the same job are not stopped.
    """

    function: Callable[[pd.DataFrame], object]
    columns: tuple[str, ...]
    isolate: bool = False

    def predict(self, targets: DataFrame) -> DataFrame:
        function, columns, isolate = self.function, list(self.columns), self.isolate

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            import numpy as np
            import pandas as pd

            for batch in batches:
                error = None
                try:
                    values = np.asarray(function(batch[columns]), dtype=float).reshape(-1)
                    if len(values) != len(batch):
                        raise ValueError(
                            f"predictor returned {len(values)} values for {len(batch)} rows"
                        )
                except Exception as raised:
                    if not isolate:
                        raise
                    values = np.full(len(batch), np.nan)
                    error = f"{type(raised).__name__}: {raised}"[:ERROR_LENGTH]
                out = pd.DataFrame({"id": batch["id"].to_numpy(), "prediction": values})
                if isolate:
                    out["error"] = error
                yield out

        return targets.select("id", *[c for c in columns if c != "id"]).mapInPandas(
            run, PREDICTION + (", error string" if isolate else "")
        )


def predicted_by_all(predictors: dict[str, Predictor], targets: DataFrame) -> DataFrame:
    """The stacked predictions of all predictors, those that fail on the way included.

    What a predictor raises before any row is read is one row without id, with the error.
    """
    spark, sets = targets.sparkSession, {}
    for name, predictor in predictors.items():
        try:
            sets[name] = predictor.predict(targets)
        except Exception as raised:  # noqa: BLE001  any model may be broken in any way
            told = f"{type(raised).__name__}: {raised}"[:ERROR_LENGTH]
            sets[name] = spark.range(1).select(
                F.lit(None).cast("bigint").alias("id"),
                F.lit(None).cast("double").alias("prediction"),
                F.lit(told).alias("error"),
            )
    return prediction_sets(sets)
