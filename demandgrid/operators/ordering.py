"""Buckets, running totals and dense ids over a global order, without a single-task sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

#: Most buckets of an order. With fewer rows than its square there are as many buckets as
#: rows in each: the root of their number.
MAX_BUCKETS = 1 << 16


def _buckets_up_to(cuts: Column, key: Column) -> Column:
    """How many of the sorted cuts are not above the key, by binary search."""
    none = F.lit(0)
    steps = F.ceil(F.log2(F.size(cuts) + 1)).cast("int")
    start = F.struct(none.alias("low"), F.size(cuts).alias("high"))

    def halved(s: Column, _: Column) -> Column:
        middle = F.floor((s["low"] + s["high"]) / 2).cast("int")
        open_ = s["low"] < s["high"]
        up = open_ & F.coalesce(F.get(cuts, middle)["key"] <= key, F.lit(False))
        return F.struct(
            F.when(up, middle + 1).otherwise(s["low"]).alias("low"),
            F.when(open_ & ~up, middle).otherwise(s["high"]).alias("high"),
        )

    found = F.aggregate(F.sequence(F.lit(1), F.greatest(steps, F.lit(1))), start, halved)
    return F.when(F.size(cuts) == 0, none).otherwise(found["low"])


def with_buckets(
    df: DataFrame, order: list[str], weight: str, out: str, buckets: int | None = None
) -> DataFrame:
    """Add ``out``: the bucket of the row, ascending in ``order``.

    ``order`` must identify a row and hold no nulls. The key range is cut at keys chosen by
    hash, so the cut depends on the data alone and stays the same when a lost task is run
    again; hashing distinct keys balances the buckets whatever the key distribution. Without
    ``buckets`` their number is the root of the number of rows.
    """
    most = buckets or MAX_BUCKETS
    key = F.struct(*order)
    # The cuts carry the weight only so that this branch reads the same columns as the
    # others and shares their shuffle.
    chosen = (
        df.select(F.xxhash64(*order).alias("h"), key.alias("key"), weight)
        .orderBy("h", "key")
        .limit(most - 1)
        .agg(F.sort_array(F.collect_list(F.struct("h", "key", weight))).alias("cuts"))
    )
    if buckets is None:
        rows = df.agg(F.sum(F.when(F.col(weight).isNotNull(), 1).otherwise(1)).alias("rows"))
        chosen = chosen.crossJoin(rows)  # one row each
        n = F.least(F.ceil(F.sqrt(F.coalesce("rows", F.lit(0)))).cast("int"), F.lit(most)) - 1
        chosen = chosen.withColumn("cuts", F.slice("cuts", F.lit(1), F.greatest(n, F.lit(0))))
    cuts = chosen.select(
        F.sort_array(F.transform("cuts", lambda c: F.struct(c["key"].alias("key")))).alias("cuts")
    )
    # Declared non-null: otherwise the join on the bucket adds a null test that travels
    # down to the scan of `df` and searches the cuts for every raw row.
    place = F.coalesce(_buckets_up_to(F.col("_rt_cuts"), key), F.lit(0))
    return df.withColumn("_rt_cuts", cuts.scalar()).withColumn(out, place).drop("_rt_cuts")


def running_total(
    df: DataFrame, order: list[str], weight: str, out: str, buckets: int | None = None
) -> DataFrame:
    """Add ``out``: the sum of ``weight`` over all rows before this one in ``order``.

    Totals per bucket are summed in one task (at most ``MAX_BUCKETS`` rows); the rows
    themselves are sorted per bucket.
    """
    cut_rows = with_buckets(df, order, weight, "_rt_bucket", buckets)
    before = W.orderBy("_rt_bucket").rowsBetween(W.unboundedPreceding, -1)
    totals = (
        cut_rows.groupBy("_rt_bucket")
        .agg(F.sum(weight).alias("_rt_total"))
        .select("_rt_bucket", F.coalesce(F.sum("_rt_total").over(before), F.lit(0)).alias("_rt_before"))
    )
    inside = W.partitionBy("_rt_bucket").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    return (
        cut_rows.join(F.broadcast(totals), "_rt_bucket")  # at most `MAX_BUCKETS` rows
        .withColumn(out, F.col("_rt_before") + F.coalesce(F.sum(weight).over(inside), F.lit(0)))
        .drop("_rt_bucket", "_rt_before")
    )


def dense_ids(rows: DataFrame, counts: DataFrame, group: list[str], order: str) -> DataFrame:
    """0-based ids without gaps in the order ``(*group, order)``.

    ``counts`` holds ``n_rows`` per group. Ids are a rank inside the group plus the number
    of rows in all groups before it, so only the group table is ordered globally.
    """
    offsets = running_total(counts, group, "n_rows", "_offset").select(*group, "_offset")
    rank = F.row_number().over(W.partitionBy(*group).orderBy(order)).cast("bigint")
    return (
        rows.withColumn("_rank", rank)
        .join(offsets, group, "left")  # the rows, often a grown grid, are never broadcast
        .withColumn("id", F.col("_offset") + F.col("_rank") - 1)
        .drop("_rank", "_offset")
    )
