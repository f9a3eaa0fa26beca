"""Sharding through fixed virtual slots.

A record is hashed, once and for all, into one of ``slots`` virtual slots. Bytes and rows are
added up per slot, and a small table says which shard holds which slot. Only that table
changes when shards are added or loads drift: every edit is a new version, and a record
moves only when its slot does.

Null ids and null texts are hashed like values of their own; a null text has no bytes. Equal
rows share a slot, so the finest unit that can be moved is one distinct record. Records are
hashed by id and text together, so that an id (or null) that many rows share is spread out. An
empty table gives a map in which every slot is empty, and no rows. Columns that are not named
pass through ``assign`` untouched; the columns it adds must not be among them.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from demandgrid.llm.common import by_order

SLOTS = 8192
#: Share of the mean by which shards may differ before an edit moves slots.
TOLERANCE = 0.02
#: Bytes that each record takes besides its text.
RECORD_OVERHEAD = 8
MAP_SCHEMA = (
    "version int, virtual_slot int, shard int, slot_rows bigint, slot_bytes bigint, "
    "first_row bigint"
)


def with_virtual_slots(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", slots: int = SLOTS
) -> DataFrame:
    """Adds size (bytes of the text and the overhead) and virtual_slot."""
    size = F.octet_length(F.coalesce(F.col(text_col), F.lit(""))) + F.lit(RECORD_OVERHEAD)
    key = F.xxhash64(F.col(id_col), F.col(text_col))
    return docs.withColumns(
        {"size": size.cast("long"), "virtual_slot": F.pmod(key, F.lit(slots)).cast("int")}
    )


def slot_loads(slotted: DataFrame) -> DataFrame:
    """Rows and bytes per occupied slot; added up before the shuffle."""
    return slotted.groupBy("virtual_slot").agg(
        F.count("*").alias("slot_rows"), F.sum("size").alias("slot_bytes")
    )


def _loads(loads: DataFrame, slots: int) -> list[tuple[int, int]]:
    """(bytes, rows) of every slot: as many rows as there are slots, whatever the input."""
    out = [(0, 0)] * slots
    for r in loads.collect():
        out[r["virtual_slot"]] = (r["slot_bytes"], r["slot_rows"])
    return out


def _as_table(
    spark: SparkSession, owner: list[int], loads: list[tuple[int, int]], version: int
) -> DataFrame:
    first: dict[int, int] = {}
    rows = []
    for slot, shard in enumerate(owner):
        size, n = loads[slot]
        rows.append((version, slot, shard, n, size, first.get(shard, 0)))
        first[shard] = first.get(shard, 0) + n
    return spark.createDataFrame(rows, MAP_SCHEMA)


def new_map(loads: DataFrame, shards: int, slots: int = SLOTS, version: int = 1) -> DataFrame:
    """The first map: heaviest slot first, each to the shard with the fewest bytes so far."""
    load = _loads(loads, slots)
    heap = [(0, 0, shard) for shard in range(shards)]
    owner = [0] * slots
    for slot in sorted(range(slots), key=lambda s: (-load[s][0], s)):
        size, held, shard = heapq.heappop(heap)
        owner[slot] = shard
        heapq.heappush(heap, (size + load[slot][0], held + 1, shard))
    return _as_table(loads.sparkSession, owner, load, version)


def rebalanced(
    current: DataFrame, loads: DataFrame, shards: int, tolerance: float = TOLERANCE
) -> DataFrame:
    """The next version of a map for the loads and the number of shards as they are now.

    Slots of shards that are gone, and then, one at a time, from the fullest shard to the
    emptiest the largest slot that fits into what the fullest has over the mean, until they differ by no more than ``tolerance`` of the
    mean or no slot fits. All other slots stay where they are.
    """
    rows = sorted(current.collect(), key=lambda r: r["virtual_slot"])
    load = _loads(loads, len(rows))
    owner = [r["shard"] for r in rows]
    held: list[list[int]] = [[] for _ in range(shards)]
    total = [0] * shards
    homeless = []
    for slot, shard in enumerate(owner):
        if shard < shards:
            held[shard].append(slot)
            total[shard] += load[slot][0]
        else:
            homeless.append(slot)

    def move(slot: int, to: int) -> None:
        owner[slot] = to
        held[to].append(slot)
        total[to] += load[slot][0]

    for slot in sorted(homeless, key=lambda s: (-load[s][0], s)):
        move(slot, min(range(shards), key=lambda s: (total[s], s)))
    for _ in range(len(owner)):
        full = max(range(shards), key=lambda s: (total[s], -s))
        bare = min(range(shards), key=lambda s: (total[s], s))
        gap = total[full] - total[bare]
        if gap <= tolerance * sum(total) / shards:
            break
        over = total[full] - sum(total) / shards
        fits = [s for s in held[full] if 0 < load[s][0] <= min(gap // 2, over)]
        if not fits:
            break
        slot = max(fits, key=lambda s: (load[s][0], -s))
        held[full].remove(slot)
        total[full] -= load[slot][0]
        move(slot, bare)
    return _as_table(current.sparkSession, owner, load, rows[0]["version"] + 1)


def store_map(shard_map: DataFrame, path: str) -> None:
    """Adds a version to the stored maps; earlier versions stay readable."""
    shard_map.coalesce(1).write.mode("append").partitionBy("version").parquet(path)


def stored_map(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """A stored version, the latest by default."""
    maps = spark.read.parquet(path)
    if version is None:
        version = maps.agg(F.max("version")).first()[0]
    names = [c.strip().split(" ")[0] for c in MAP_SCHEMA.split(",")]
    return maps.filter(F.col("version") == version).select(*names)


def assign(
    slotted: DataFrame, shard_map: DataFrame, order_by: tuple[str, ...] = ("doc_id",)
) -> DataFrame:
    """Adds shard, slot (the row's place in its shard, without gaps from 0) and map_version.

    The map has a fixed number of rows, so it is broadcast. Rows are numbered within their
    virtual slot, in ``order_by``, and start where the map says; no task sees a whole shard.
    """
    place = F.row_number().over(
        Window.partitionBy("virtual_slot").orderBy(*by_order(slotted, *order_by))
    )
    small = shard_map.select(
        "virtual_slot", "shard", "first_row", F.col("version").alias("map_version")
    )
    return (
        slotted.withColumn("slot", place.cast("long") - 1)
        .join(F.broadcast(small), "virtual_slot")
        .withColumn("slot", F.col("slot") + F.col("first_row"))
        .drop("first_row")
    )


def write_shards(assigned: DataFrame, path: str) -> None:
    """The records, one folder for each shard, one file or more for each task and shard."""
    assigned.write.partitionBy("shard").parquet(path)
