"""The linear Tweedie model of Spark ML, fitted in passes over blocks of numbers.

Spark's own fit makes objects of every row in every round. Here rows are coded once, a number
of one or two bytes for each value, and written as blocks. A round adds up the weighted moments
of features and working response by matrix products in the tasks, and one task adds up theirs.
The driver solves the least squares of the moments. First round, weights, working response,
penalties and end are those of Spark (``IterativelyReweightedLeastSquares``). A feature that
never varies has the coefficient zero, as there; Spark then looks for the others in steps, up to
a tolerance that shows in the second digit of some and keeps the rounds from ending, while they
are solved exactly here.

Memory: a reader holds ``HELD_BLOCKS`` blocks, a task one block and the moments; the driver one
matrix of moments, whatever the rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.common import _py2java
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.ml.regression import GeneralizedLinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandgrid.models.boosting import BLOCK_FILES, few_at_a_time
from demandgrid.sources.staging import discard, staged

BLOCK_ROWS = 32_768
#: Rows whose products are taken at a time, so that they stay in a core's cache.
CHUNK_ROWS = 2_048
BLOCK_DDL = "n int, label binary, sizes binary, codes binary, tables binary"
BLOCK = pa.schema([("n", pa.int32()), *((c, pa.binary()) for c in ("label", "sizes", "codes", "tables"))])
MOMENTS = pa.schema([("moments", pa.binary())])
#: Of a feature's mean square, what its variance must exceed; less is left over by rounding.
CONSTANT = 1e-14
#: What Spark takes for a demand of zero in the first round, and its bounds of a mean.
DELTA = 0.1
LEAST_LOG, MOST_LOG = np.log(1e-16), np.log(np.finfo(float).max)


def _coded(label: np.ndarray, x: np.ndarray) -> pa.RecordBatch:
    """A block of rows; the codes of a column are one byte, two, or the values themselves."""
    sizes, codes, tables = [], [], []
    for column in x.T:
        values, code = np.unique(column, return_inverse=True)
        few = len(values) <= max(256, len(column) // 8)
        sizes.append(len(values) if few else 0)
        codes.append((code.astype(np.uint8 if len(values) <= 256 else np.uint16) if few else column).tobytes())
        tables.append(values.tobytes() if few else b"")
    row = [len(label), label.tobytes(), np.array(sizes, np.int32).tobytes(), b"".join(codes), b"".join(tables)]
    return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, BLOCK.types, strict=True)], schema=BLOCK)


def _blocked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (label, features) to blocks."""
    labels, rows, size = [], [], 0
    for batch in batches:
        label = batch.column(0).to_numpy(zero_copy_only=False).astype(np.float64)
        lists = batch.column(1)
        if np.isnan(label).any():
            raise ValueError("labels must not be null or NaN")
        if (label < 0).any():
            raise ValueError("the response of a Tweedie model must not be negative")
        x = lists.flatten().to_numpy(zero_copy_only=False).reshape(len(label), -1)
        if lists.null_count or not np.isfinite(x).all():
            raise ValueError("features must not be null, NaN or infinite")
        for k in range(0, len(label), BLOCK_ROWS):
            labels.append(label[k : k + BLOCK_ROWS])
            rows.append(x[k : k + BLOCK_ROWS])
            size += len(labels[-1])
            if size >= BLOCK_ROWS:
                yield _coded(np.concatenate(labels), np.concatenate(rows))
                labels, rows, size = [], [], 0
    if size:
        yield _coded(np.concatenate(labels), np.concatenate(rows))


def _columns(row: dict) -> list[tuple[np.ndarray, np.ndarray | None]]:
    """Codes and table of every column; the table of plain values is None."""
    out, at, told = [], 0, 0
    tables = np.frombuffer(row["tables"], np.float64)
    for size in np.frombuffer(row["sizes"], np.int32).tolist():
        kind = np.float64 if not size else np.uint8 if size <= 256 else np.uint16
        codes = np.frombuffer(row["codes"], kind, row["n"], at)
        out.append((codes, tables[told : told + size] if size else None))
        at, told = at + codes.nbytes, told + size
    return out


def _moments(power: float, model: tuple[np.ndarray, float] | None):  # noqa: ANN202
    """Sums over a task's rows of weight x the products of (1, features, response)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, room = None, None
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                label, columns = np.frombuffer(row["label"], np.float64), _columns(row)
                if total is None:
                    total = np.zeros((len(columns) + 2,) * 2)
                    room = np.empty((len(columns) + 2, CHUNK_ROWS))
                for start in range(0, row["n"], CHUNK_ROWS):
                    y = label[start : start + CHUNK_ROWS]
                    rows = room[:, : len(y)]
                    rows[0] = 1
                    for into, (codes, table) in zip(rows[1:-1], columns, strict=True):
                        some = codes[start : start + CHUNK_ROWS]
                        into[:] = some if table is None else table[some]
                    if model is None:
                        rows[-1] = np.log(np.where(y == 0, DELTA, y))
                    else:
                        eta = model[0] @ rows[1:-1] + model[1]
                        bounded = np.clip(eta, LEAST_LOG, MOST_LOG)
                        rows[-1] = eta + y * np.exp(-bounded) - 1
                        rows *= np.exp((1 - power / 2) * bounded)
                    total += rows @ rows.T
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], schema=MOMENTS)

    return run


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = None
    for batch in batches:
        for raw in batch.column(0):
            part = np.frombuffer(raw.as_buffer(), np.float64)
            total = part if total is None else total + part
    if total is not None:
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], schema=MOMENTS)


def least_squares(moments: np.ndarray, intercept: bool, reg: float, first: bool) -> tuple[np.ndarray, float, list[float]]:
    """Coefficients, intercept and what Spark keeps of the inverse, of rows with these moments.

    The penalty counts for features in their own units; in the ``first`` round for features
    and response in units of their deviation.
    """
    total = moments[0, 0]
    mean, square = moments[0, 1:] / total, moments[1:, 1:] / total
    spread = square - np.outer(mean, mean)
    variance = np.where(np.diag(spread) > CONSTANT * np.diag(square), np.diag(spread), 0)
    varies = np.flatnonzero(variance[:-1])
    scale = np.sqrt(variance)
    products = spread if intercept else square
    ridge = np.full(len(varies), reg) if not first else reg * variance[varies] / (scale[-1] or abs(mean[-1]) or 1)
    unit = scale[varies]
    matrix = (products[np.ix_(varies, varies)] + np.diag(ridge)) / np.outer(unit, unit)
    lengths, axes = np.linalg.eigh(matrix)
    lengths = np.maximum(lengths, np.finfo(float).eps * len(matrix) * lengths.max(initial=0))
    found = axes @ ((axes.T @ (products[varies, -1] / unit)) / lengths) / unit
    coefficients = np.zeros(len(mean) - 1)
    coefficients[varies] = found
    at_zero = float(mean[-1] - mean[:-1] @ coefficients) if intercept else 0.0
    if len(varies) < len(coefficients):
        return coefficients, at_zero, [0.0]
    inverse = (axes**2 / lengths).sum(axis=1) / unit**2
    if intercept:
        away = axes.T @ (mean[:-1] / unit)
        inverse = np.append(inverse, 1 + (away**2 / lengths).sum())
    return coefficients, at_zero, (inverse / total).tolist()


class BlockwiseRegression(GeneralizedLinearRegression):
    """Spark's regression for a Tweedie power between 1 and 2 and a log link, without weights
    and offsets: the same parameters, the same model."""

    def _fit_java(self, dataset: DataFrame):  # noqa: ANN202
        spark, power = dataset.sparkSession, self.getVariancePower()
        rows = dataset.select(F.col(self.getLabelCol()).cast("double").alias("label"), vector_to_array(self.getFeaturesCol()).alias("features"))
        blocks = staged(rows.mapInArrow(_blocked, BLOCK_DDL), "blocks", BLOCK_FILES)

        def solved(model: tuple[np.ndarray, float] | None) -> tuple[np.ndarray, float, list[float]]:
            parts = blocks.mapInArrow(_moments(power, model), "moments binary").repartition(1)
            found = parts.mapInArrow(_added, "moments binary").collect()
            if not found:
                raise ValueError("a linear model needs training rows")
            moments = np.frombuffer(found[0].moments, np.float64)
            size = int(round(len(moments) ** 0.5))
            return least_squares(moments.reshape(size, size), self.getFitIntercept(), self.getRegParam(), model is None)

        with few_at_a_time(spark):
            coefficients, intercept, inverse = solved(None)
            rounds, moved = 0, np.inf
            while rounds < self.getMaxIter() and moved >= self.getTol():
                before = coefficients, intercept
                coefficients, intercept, inverse = solved(before)
                moved = max(np.abs(coefficients - before[0]).max(initial=0), abs(intercept - before[1]))
                rounds += 1
        discard(blocks)
        self._transfer_params_to_java()
        jvm, own = spark._jvm, self._java_obj
        vector = _py2java(spark.sparkContext, DenseVector(coefficients))
        java = jvm.org.apache.spark.ml.regression.GeneralizedLinearRegressionModel(own.uid(), vector, intercept)
        own.copyValues(java.setParent(own), jvm.org.apache.spark.ml.param.ParamMap.empty())
        java.createSummary(dataset._jdf, _py2java(spark.sparkContext, DenseVector(inverse)).toArray(), rounds)
        return java
