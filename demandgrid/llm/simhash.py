"""Near-duplicate documents by SimHash, linked through a Gray-order hierarchical index.

A fingerprint has a bit set if more than half of the text's shingle hashes have it.
Fingerprints are made distinct first, so a group of exact copies is one entry of the index.

The index is a tree of nodes (mask, bits): all entries below a node share ``bits`` where
``mask`` is set. Its top nodes are chosen so that fingerprints within k differing bits share
at least one of them: the 64 bits are cut into k + 1 blocks, and one block must agree. A
node with more than ``leaf`` entries is factored the same way over the bits that are left,
into k + 1 masks, as often as needed: entries are distinct, so at 11 free bits there are
2,048 at most, whatever the input. Nodes that remain are spread over the cluster. Inside
one, the entries stand in Gray order, where neighbours share most bits; runs of eight are
factored into what they share, runs of those again, up to the node. A search goes down from
the top, adds the differences on the bits that each node brings, and leaves out all entries
below as soon as the sum is over k. What a node finds is given as a forest, never as all
pairs; connected components join the forests.

Null and empty texts have fingerprint zero and are linked like others. Texts with fewer
words than a shingle hash the whole sequence. A null id is allowed: the row has a
fingerprint, and its component is the smallest id that is not null, if there is one.
Repeated ids and rows each give a row. An empty table gives none. Only the two named
columns are read, so further columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandgrid.llm.components import components
from demandgrid.sources.staging import staged

SEED = 42
#: Entries of an index node before it is factored further.
LEAF = 2048
#: Children of a node inside the tree of one task.
FAN = 8
#: Pairs of search and entry that a task looks at together.
CHUNK = 2_000_000
_SHINGLES_AT_ONCE = 65_536


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """The 64-bit SimHash of a text's word shingles, as an unsigned number."""
    found = (text or "").encode("utf-8").lower().split()  # bytes: only A-Z, only 9-13 and 32
    if not found:
        return 0
    flat = b" ".join(found)
    if len(found) <= shingle:
        return xxhash.xxh64_intdigest(flat, SEED)
    lengths = np.fromiter(map(len, found), np.int64, len(found))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: len(found) - shingle + 1].tolist()
    ends = ends[shingle - 1 :].tolist()
    digest, seed = xxhash.xxh64_intdigest, SEED
    counts = np.zeros(64, np.int64)
    for k in range(0, len(starts), _SHINGLES_AT_ONCE):
        part = slice(k, k + _SHINGLES_AT_ONCE)
        hashes = [digest(flat[s:e], seed) for s, e in zip(starts[part], ends[part], strict=True)]
        octets = np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8)
        bits = np.unpackbits(octets, axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.uint32)
    set_bits = 2 * counts > len(starts)
    return int.from_bytes(np.packbits(set_bits, bitorder="little").tobytes(), "little")


def fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3
) -> DataFrame:
    """(id, fp) of every row, fp as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.fromiter(
                (fingerprint(t, shingle) for t in batch.column(1).to_pylist()),
                np.uint64,
                batch.num_rows,
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(fps.view(np.int64))], names=[id_col, "fp"]
            )

    chosen = docs.select(id_col, text_col)
    return chosen.mapInArrow(run, f"`{id_col}` {chosen.schema[0].dataType.simpleString()}, fp bigint")


def hex_of(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def gray_rank(fp: Column) -> Column:
    """The place of a bit pattern in the order of the Gray code."""
    for step in (1, 2, 4, 8, 16, 32):
        fp = fp.bitwiseXOR(F.shiftrightunsigned(fp, step))
    return fp


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _cut(mask: int, parts: int) -> list[int]:
    """The mask extended by each of ``parts`` nearly equal runs of its free bits."""
    free = [b for b in range(64) if not mask >> b & 1]
    out = []
    for k in range(parts):
        run = free[len(free) * k // parts : len(free) * (k + 1) // parts]
        out.append(mask | sum(1 << b for b in run))
    return out


def index_entries(distinct_fps: DataFrame, max_bits: int, leaf: int = LEAF) -> DataFrame:
    """(mask, bits, fp): every fingerprint below each node of the index that holds it."""
    spark = distinct_fps.sparkSession
    masks, parts = [0], max_bits + 1
    entries = distinct_fps.select(F.lit(0).cast("long").alias("mask"), "fp")
    settled: list[DataFrame] = []
    while masks:
        # Masks are few: they depend on the number of levels, not on the data.
        children = {m: [c for c in _cut(m, parts) if c != m] for m in masks}
        rows = [(_signed(m), _signed(c)) for m, cs in children.items() for c in cs]
        if not rows:
            break
        below = spark.createDataFrame(rows, "mask bigint, child bigint")
        entries = (
            entries.join(F.broadcast(below), "mask")
            .select(F.col("child").alias("mask"), "fp")
            .withColumn("bits", F.col("mask").bitwiseAND(F.col("fp")))
        )
        level = sorted({c for cs in children.values() for c in cs})
        full = entries.groupBy("mask", "bits").count().filter(F.col("count") > leaf)
        large = [m for m in level if 64 - m.bit_count() > 11]
        hot = [r[0] % (1 << 64) for r in full.select("mask").distinct().collect()]
        masks = [m for m in hot if m in set(large)]
        if not masks:
            settled.append(entries.select("mask", "bits", "fp"))
            break
        full = staged(
            full.filter(F.col("mask").isin([_signed(m) for m in masks])).select("mask", "bits"),
            "full_nodes",
        )
        settled.append(entries.join(full, ["mask", "bits"], "left_anti").select("mask", "bits", "fp"))
        entries = entries.join(full, ["mask", "bits"], "left_semi").select("mask", "fp")
    out = settled[0]
    for more in settled[1:]:
        out = out.unionByName(more)
    return out


class _Tree:
    """Gray-ordered entries of many nodes, factored upwards in runs of ``FAN``.

    ``levels[0]`` has the entries themselves. A higher level has, for each run, the shared
    mask and bits, and the range of its members one level below.
    """

    def __init__(self, fps: np.ndarray, groups: np.ndarray) -> None:
        full = np.full(len(fps), ~np.uint64(0), np.uint64)
        self.levels = [(full, fps, np.empty(0, np.int64), np.empty(0, np.int64))]
        mask, bits, group = full, fps, groups
        while True:
            first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
            sizes = np.diff(np.r_[first, len(group)])
            if len(first) == len(group):
                break
            starts = np.concatenate([np.arange(f, f + n, FAN) for f, n in zip(first, sizes)])
            counts = np.diff(np.r_[starts, len(group)])
            lead = np.repeat(bits[starts], counts)
            differs = np.bitwise_or.reduceat(bits ^ lead, starts)
            shared = np.bitwise_and.reduceat(mask, starts) & ~differs
            mask, bits, group = shared, bits[starts] & shared, group[starts]
            self.levels.append((mask, bits, starts, counts))
        #: The top node of each group, in the order of the groups.
        self.group = group

    def search(self, wanted: np.ndarray, top: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
        """Places (in ``wanted``, among the entries) of all pairs within ``most`` bits."""
        who, node = np.arange(len(wanted)), top
        mask, bits, _, _ = self.levels[-1]
        known = mask[node]
        total = np.bitwise_count((wanted ^ bits[node]) & known).astype(np.int64)
        for level in range(len(self.levels) - 1, 0, -1):
            keep = total <= most
            who, node, known, total = who[keep], node[keep], known[keep], total[keep]
            _, _, starts, counts = self.levels[level]
            n = counts[node]
            offset = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            below = np.repeat(starts[node], n) + offset
            who, known, total = np.repeat(who, n), np.repeat(known, n), np.repeat(total, n)
            mask, bits, _, _ = self.levels[level - 1]
            own = mask[below]
            total = total + np.bitwise_count((wanted[who] ^ bits[below]) & own & ~known)
            node, known = below, own
        keep = total <= most
        return who[keep], node[keep]


def _joined(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels after joining the classes of a[i] and b[i]; a label is a class's least place."""
    while True:
        x, y = label[a], label[b]
        apart = x != y
        if not apart.any():
            return label
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while (label[label] != label).any():
            label = label[label]


def forest(fps: np.ndarray, groups: np.ndarray, most: int) -> np.ndarray:
    """For each entry the least place in its group that it is linked to, over any steps.

    Entries of a group are adjacent and in Gray order.
    """
    label = np.arange(len(fps))
    if not len(fps):
        return label
    tree = _Tree(fps, groups)
    top = np.searchsorted(tree.group, groups) if len(tree.levels) > 1 else np.arange(len(fps))
    first = np.flatnonzero(np.r_[True, groups[1:] != groups[:-1]])
    sizes = np.diff(np.r_[first, len(groups)])
    cost = np.cumsum(np.repeat(sizes, sizes))
    cuts = np.searchsorted(cost, np.arange(CHUNK, cost[-1] + CHUNK, CHUNK), side="right")
    start = 0
    for stop in [*cuts.tolist(), len(fps)]:
        stop = min(max(stop, start + 1), len(fps))
        if start >= len(fps):
            break
        who, found = tree.search(fps[start:stop], top[start:stop], most)
        who = who + start
        new = found > who
        label = _joined(label, who[new], found[new])
        start = stop
    return label


def _linked(most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = [np.empty(0, np.int64)] * 3

        def found(mask: np.ndarray, bits: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
            new = np.r_[True, (mask[1:] != mask[:-1]) | (bits[1:] != bits[:-1])]
            label = forest(fp.view(np.uint64), np.cumsum(new), most)
            child = label != np.arange(len(fp))
            return pa.RecordBatch.from_arrays(
                [pa.array(fp[child]), pa.array(fp[label[child]])], names=["a", "b"]
            )

        for batch in batches:
            cols = [
                np.concatenate([h, c.to_numpy(zero_copy_only=False)])
                for h, c in zip(held, batch.columns, strict=True)
            ]
            mask, bits, _ = cols
            # The last node may go on in the next batch.
            same = (mask == mask[-1]) & (bits == bits[-1])
            cut = len(mask) - int(same.sum())
            held = [c[cut:] for c in cols]
            if cut:
                yield found(*(np.ascontiguousarray(c[:cut]) for c in cols))
        if len(held[0]):
            yield found(*(np.ascontiguousarray(c) for c in held))

    return run


def links(distinct_fps: DataFrame, max_bits: int = 3, leaf: int = LEAF) -> DataFrame:
    """(a, b): links whose components are those of all pairs within ``max_bits``.

    Within a task a group has ``leaf`` entries at most, or the 2,048 that 11 free bits allow.
    """
    entries = index_entries(distinct_fps, max_bits, leaf)
    ordered = (
        entries.withColumn("rank", gray_rank(F.col("fp")))
        .repartition("mask", "bits")
        .sortWithinPartitions("mask", "bits", "rank")
        .select("mask", "bits", "fp")
    )
    return ordered.mapInArrow(_linked(max_bits), "a bigint, b bigint")


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 3,
    max_bits: int = 3,
) -> DataFrame:
    """(id, fingerprint, component_id): one row for each document."""
    marked = staged(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    distinct = staged(marked.groupBy("fp").agg(F.min(id_col).alias("least_id")), "distinct_fps")
    roots = components(links(distinct.select("fp"), max_bits))
    placed = distinct.join(
        roots.select(F.col("node").alias("fp"), "root"), "fp", "left"
    ).withColumn("root", F.coalesce("root", "fp"))
    smallest = placed.groupBy("root").agg(F.min("least_id").alias("component_id"))
    of_fp = placed.join(smallest, "root").select("fp", "component_id")
    return marked.join(of_fp, "fp").select(
        id_col, hex_of(F.col("fp")).alias("fingerprint"), "component_id"
    )


def representatives(docs: DataFrame, **parameters: object) -> DataFrame:
    """The documents without those that a near-duplicate with a smaller id stands for.

    A row without an id can't be named, so it stays; so do all rows of one id.
    """
    id_col = str(parameters.get("id_col", "doc_id"))
    found = near_duplicates(docs, **parameters)
    gone = found.filter(F.col(id_col) != F.col("component_id"))
    gone = gone.select(F.col(id_col).alias("__sh_id")).distinct()
    return docs.join(gone, docs[id_col] == F.col("__sh_id"), "left_anti")
