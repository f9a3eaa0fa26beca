"""Comparing tables by digests of id ranges.

A digest adds up a hash of every row, so it does not depend on order, file or partition. It
is taken for ranges of ids; equal ranges of both tables need no join. Ranges that differ are
cut finer, and only the rows of the last differing ranges meet, each with its partner.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandgrid.sources.staging import staged

#: Ranges that each differing range is cut into, and how often.
FAN = 256
LEVELS = 3


def _row_hash(columns: list[str]) -> Column:
    """Two hashes of a row side by side, as decimals: their sums over a table are exact."""
    first = F.xxhash64(*columns)
    second = F.xxhash64(F.lit("second"), *columns)
    return F.struct(*(h.cast("decimal(38,0)").alias(n) for n, h in (("a", first), ("b", second))))


def range_digests(df: DataFrame, range_: Column, columns: list[str]) -> DataFrame:
    """A row for each range: rows, and the sums of their hashes."""
    rows = df.select(range_.alias("range"), _row_hash(columns).alias("h"))
    return rows.groupBy("range").agg(
        F.count("*").alias("n"), F.sum("h.a").alias("a"), F.sum("h.b").alias("b")
    )


def table_digest(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row: the digest of the whole table, for storing beside it."""
    found = range_digests(df, F.lit(0), columns or df.columns)
    return found.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n", "a", "b")])


def _span(first: DataFrame, second: DataFrame, id_col: str) -> tuple[int, int]:
    ids = first.select(id_col).unionAll(second.select(id_col))
    low, high = ids.agg(F.min(id_col), F.max(id_col)).first()
    return (0, 0) if low is None else (int(low), int(high))


def differing_ranges(
    first: DataFrame, second: DataFrame, id_col: str, columns: list[str], levels: int = LEVELS
) -> tuple[DataFrame, Column] | None:
    """The finest ranges that differ, and the expression of a row's range; None if none does.

    Integer ids. A range that differs is cut into ``FAN`` finer ones at each level; what is
    equal is not looked at again.
    """
    low, high = _span(first, second, id_col)
    width = high - low + 1
    differing = None
    range_ = F.lit(0).cast("bigint")
    for _ in range(levels):
        width = max(1, -(-width // FAN))
        finer = F.floor((F.col(id_col) - F.lit(low)) / F.lit(width)).cast("bigint")
        sides = []
        for df in (first, second):
            df = df.where(F.col(id_col).isNotNull())
            if differing is not None:
                # Only the ranges that differed: FAN of them at most for each of the last level.
                df = df.withColumn("_range", range_).join(differing.withColumnRenamed("range", "_range"), "_range", "left_semi")
            sides.append(range_digests(df, finer, columns))
        found = sides[0].alias("x").join(sides[1].alias("y"), "range", "full")
        same = reduce(
            lambda a, b: a & b, [F.col(f"x.{c}").eqNullSafe(F.col(f"y.{c}")) for c in ("n", "a", "b")]
        )
        differing, range_ = staged(found.where(~same).select("range"), "ranges"), finer
        if not differing.take(1):
            return None
        if width == 1:
            break
    return differing, range_


def differing_rows(
    first: DataFrame, second: DataFrame, id_col: str = "id", columns: list[str] | None = None
) -> DataFrame:
    """(id, status) of the ids whose rows are not the same in both tables: changed, only_first
    or only_second. Rows without an id are left out. Repeated ids count as a set of rows."""
    columns = columns or [c for c in first.columns if c in second.columns]
    found = differing_ranges(first, second, id_col, columns)
    if found is None:
        return first.select(id_col, F.lit("").alias("status")).limit(0)
    differing, range_ = found
    sides = []
    for df in (first, second):
        rows = df.where(F.col(id_col).isNotNull()).withColumn("_range", range_)
        rows = rows.join(differing.withColumnRenamed("range", "_range"), "_range", "left_semi")
        sides.append(range_digests(rows, F.col(id_col), columns).withColumnRenamed("range", id_col))
    x, y = F.col("x.n"), F.col("y.n")
    same = reduce(lambda a, b: a & b, [F.col(f"x.{c}") == F.col(f"y.{c}") for c in ("n", "a", "b")])
    status = F.when(x.isNull(), "only_second").when(y.isNull(), "only_first").when(~same, "changed")
    joined = sides[0].alias("x").join(sides[1].alias("y"), id_col, "full")
    return joined.select(id_col, status.alias("status")).where(F.col("status").isNotNull())


def same_rows(first: DataFrame, second: DataFrame) -> bool:
    """Whether two tables hold the same rows, in any order; no row is moved or joined."""
    columns = sorted(first.columns)
    if columns != sorted(second.columns):
        return False
    a, b = (table_digest(df, columns).first() for df in (first, second))
    return tuple(a) == tuple(b)
