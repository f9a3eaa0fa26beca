"""Connected components of a table of links, by alternating stars.

Every round replaces each node's links by links to the smallest node in its neighbourhood:
first for its larger neighbours, then for its smaller ones. Minima are taken before the
shuffle and joined back, so a node with very many links is never gathered in one task.
The links end as one star for each component. No links or nodes reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandgrid.session import ensure_checkpoint_dir

MAX_ROUNDS = 60


def _star(links: DataFrame) -> DataFrame:
    """Links (a, b) with a > b, each node's links moved to its least neighbour."""
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.first("a"), F.min("b")).alias("m"))
    # Larger neighbours of every node are linked to the least one around it.
    large = (
        both.filter("b > a")
        .join(least, "a")
        .select(F.col("b").alias("a"), F.col("m").alias("b"))
        .distinct()
    )
    # Then the smaller neighbours, and the node itself.
    low = large.groupBy("a").agg(F.min("b").alias("m"))
    small = (
        large.join(low, "a")
        .select(F.col("b").alias("a"), F.col("m").alias("b"))
        .filter("a <> b")
        .union(low.select("a", F.col("m").alias("b")))
    )
    return small.distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node that has a link; the root is the component's least node.

    ``links`` has two columns of one ordered type. Nulls and links of a node to itself are
    left out, repeated links count once, and without links there are no rows.
    """
    ensure_checkpoint_dir(links.sparkSession)
    a, b = (F.col(c) for c in links.columns[:2])
    current = (
        links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
        .filter((a.isNotNull()) & (b.isNotNull()) & (a != b))
        .distinct()
        .checkpoint()
    )
    seen = None
    for _ in range(MAX_ROUNDS):
        state = current.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if seen == state or not state[0]:
            break
        seen = state
        current = _star(current).checkpoint()
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
