"""Prefix trie of conversations, built as a burst trie spread over the tasks.

Each turn becomes an id of 16 bytes (the head of a SHA-256 of role and text) and each
conversation the string of its ids; equal conversations become one row for every ``CHUNK``
of conversation ids, which lists them. These rows are suffixes in containers. At first one
container under the root holds all of them. A container with more than ``container`` rows
bursts: it becomes a head of the trie, its suffixes go to containers by their next turn id,
and those that end there stay with the head. No container or head reaches the driver, only
whether another round is due; after ``ROUNDS`` rounds the containers stay as they are.

Containers are dealt to the shards by a hash of their head, sorted there, and swept: the
suffixes of one container pass in order, open nodes lie on a stack, and a node whose last
suffix has passed gives a row. What a head has below it is summed up over the rows of its
containers, before the shuffle.

Memory: a sweep holds one path, and the finished nodes whose parent is still open, at most
one container's. One conversation's turn ids are held whole in one row (28 bytes a turn).

Null ids belong to no conversation: their rows are left out. Null roles and texts are empty.
Turns go by their number, null first; equal numbers by role and text, as compared by the
digest of the turn. Repeated turns are turns of their own. A table without conversations has
no nodes, not even the root. Columns other than the four named are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandgrid.llm.common import evened, words_of
from demandgrid.session import shuffle_partitions
from demandgrid.sources.staging import staged

WIDTH = 16
CONTAINER = 500
#: Equal conversations whose ids differ in the last twelve bits only share a row.
CHUNK_BITS = 12
ROUNDS = 32
ROWS_AT_ONCE = 10_000

NODE = [
    ("conv_id", pa.int64()),
    ("depth", pa.int64()),
    ("parent_conv_id", pa.int64()),
    ("n_convs", pa.int64()),
    ("n_children", pa.int64()),
    ("n_leaves", pa.int64()),
    ("saved_tokens", pa.int64()),
    ("ends_sha256", pa.string()),
]
NODE_COLUMNS = [name for name, _ in NODE]
NODE_DDL = (
    "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, "
    "n_leaves bigint, saved_tokens bigint, ends_sha256 string"
)


def turns_of(conversations: DataFrame) -> DataFrame:
    """conv_id and turns (turn, id, words) in order, a row for each conversation."""
    role = F.coalesce("role", F.lit(""))
    text = F.coalesce("text", F.lit(""))
    # The length of the role keeps role and text apart.
    told = F.concat_ws(":", F.length(role).cast("string"), F.concat(role, text))
    turns = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        F.unhex(F.substring(F.sha2(told, 256), 1, 2 * WIDTH)).alias("id"),
        evened(F.col("text")).alias("even"),
    )
    turns = turns.select("conv_id", "turn", "id", F.size(words_of(F.col("even"))).alias("words"))
    return (
        turns.groupBy("conv_id")
        .agg(F.sort_array(F.collect_list(F.struct("turn", "id", "words"))).alias("turns"))
    )


def with_shared_leads(turns: DataFrame, group: int = 20, most: int = 4) -> DataFrame:
    """Every conversation c rebuilt: the first h turns of conversation c - c mod ``group``, if
    there is one, and c's own after its first h; h is the checksum of c modulo ``most``."""
    base = F.col("conv_id") - F.col("conv_id") % group
    h = (F.crc32(F.col("conv_id").cast("string")) % most).cast("int")
    leads = turns.filter(base == F.col("conv_id")).select(
        F.col("conv_id").alias("base"), F.slice("turns", 1, most).alias("lead")
    )
    own = turns.withColumns({"base": base, "h": h})
    lead = F.slice(F.coalesce("lead", F.slice("turns", 1, 0)), F.lit(1), F.col("h"))
    rest = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns") - F.col("h"), F.lit(0)))
    return own.join(leads, "base", "left").select("conv_id", F.concat(lead, rest).alias("turns"))


def _suffixes(turns: DataFrame) -> DataFrame:
    """path (the ids strung together), words of each turn, and the sorted conversation ids."""
    joined = F.array_join(F.transform("turns", lambda t: F.hex(t["id"])), "")
    return (
        turns.select(
            F.unhex(joined).alias("path"),
            F.transform("turns", lambda t: t["words"]).alias("words"),
            "conv_id",
        )
        .groupBy("path", F.shiftright("conv_id", CHUNK_BITS).alias("chunk"))
        .agg(
            F.first("words").alias("words"),
            F.sort_array(F.collect_list("conv_id")).alias("ids"),
        )
    )


def _head(depth: int) -> Column:
    """The first turns of a path."""
    return F.substring("path", 1, WIDTH * depth)


class _Node:
    __slots__ = ("below", "children", "conv", "ends", "leaves", "n", "saved", "words")

    def __init__(self, words: int) -> None:
        self.words, self.n, self.children, self.leaves, self.saved = words, 0, 0, 0, 0
        self.conv: int | None = None
        self.ends = None
        self.below: list[tuple] = []


class _Sweep:
    """Takes sorted suffixes and leaves rows in ``rows``."""

    def __init__(self) -> None:
        self.rows: list[tuple] = []
        self.stack: list[_Node] = []
        self.top: tuple | None = None
        self.path = b""

    def add(self, head: bytes, burst: bool, parent: int | None, path: bytes, words: list[int], ids: list[int]) -> None:
        depth = len(head) // WIDTH
        if self.top is None or self.top[0] != head:
            self.close()
            self.top = (head, burst, parent)
            self.stack = [_Node(words[depth - 1] if depth else 0)]
            self.path = head
        shared, most = depth, min(len(path), len(self.path)) // WIDTH
        while shared < most and path[WIDTH * shared : WIDTH * (shared + 1)] == self.path[WIDTH * shared : WIDTH * (shared + 1)]:
            shared += 1
        self._close_to(shared - depth + 1)
        self.stack += map(_Node, words[shared:])
        self.path = path
        node = self.stack[-1]
        if node.ends is None:
            node.ends = hashlib.sha256()
        else:
            node.ends.update(b",")
        node.ends.update(",".join(map(str, ids)).encode())
        node.n += len(ids)
        node.conv = ids[0] if node.conv is None else min(node.conv, ids[0])

    def _closed(self, node: _Node, depth: int) -> tuple:
        """What the node gives, its parent aside; its children's rows are complete now."""
        self.rows += [(*row[:2], node.conv, *row[3:]) for row in node.below]
        leaves = node.leaves if node.children else 1
        saved = node.saved + (node.n - 1) * node.words
        ends = (node.ends or hashlib.sha256()).hexdigest()
        return (node.conv, depth, None, node.n, node.children, leaves, saved, ends, None, None)

    def _close_to(self, left: int) -> None:
        base = len(self.top[0]) // WIDTH
        while len(self.stack) > left:
            node = self.stack.pop()
            row = self._closed(node, base + len(self.stack))
            up = self.stack[-1]
            up.n += node.n
            up.conv = node.conv if up.conv is None else min(up.conv, node.conv)
            up.children += 1
            up.leaves += row[5]
            up.saved += row[6]
            up.below.append(row)

    def close(self) -> None:
        if self.top is None:
            return
        self._close_to(1)
        head, burst, parent = self.top
        row = self._closed(self.stack.pop(), len(head) // WIDTH)
        self.rows.append((*row[:2], parent, *row[3:8], head, burst))
        self.top = None


def _swept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sweep = _Sweep()
    kinds = [*(kind for _, kind in NODE), pa.binary(), pa.bool_()]
    names = [*NODE_COLUMNS, "head", "burst"]

    def given() -> pa.RecordBatch:
        columns = list(zip(*sweep.rows, strict=True))
        sweep.rows = []
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names
        )

    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            sweep.add(*row)
            if len(sweep.rows) >= ROWS_AT_ONCE:
                yield given()
    sweep.close()
    if sweep.rows:
        yield given()


def _burst(suffixes: DataFrame, container: int) -> tuple[DataFrame, DataFrame | None]:
    """The suffixes with the head of their container, and the heads that burst."""
    live = suffixes.withColumn("parent", F.lit(None).cast("long"))
    settled, heads = [], []
    for depth in range(ROUNDS):
        at_head = F.length("path") == WIDTH * depth
        large = live.groupBy(_head(depth).alias("head")).agg(
            F.min(F.col("ids")[0]).alias("conv_id"),
            F.sum(F.size("ids")).alias("n_convs"),
            F.first("parent").alias("parent_conv_id"),
            F.first(F.col("words")[depth - 1] if depth else F.lit(0)).alias("word"),
            F.count("*").alias("rows"),
            F.count_if(~at_head).alias("longer"),
        )
        large = staged(large.filter((F.col("rows") > container) & (F.col("longer") > 0)), "burst")
        if not large.take(1):
            break
        heads.append(large.select("head", "conv_id", "n_convs", "parent_conv_id", "word"))
        # No more heads than rows / container: small beside the suffixes.
        joined = live.withColumn("head", _head(depth)).join(
            large.select("head", F.col("conv_id").alias("up")), "head", "left"
        )
        burst = F.col("up").isNotNull()
        columns = ["path", "chunk", "words", "ids"]
        settled.append(
            joined.filter(~burst | at_head).select("head", burst.alias("burst"), "parent", *columns)
        )
        live = staged(
            joined.filter(burst & ~at_head).select(*columns, F.col("up").alias("parent")), "suffixes"
        )
    else:
        depth = ROUNDS
    last = live.select(_head(depth).alias("head"), F.lit(False).alias("burst"), "parent", "path", "chunk", "words", "ids")
    return reduce(DataFrame.union, [*settled, last]), reduce(DataFrame.union, heads) if heads else None


def _of_heads(tops: DataFrame, heads: DataFrame) -> DataFrame:
    """The nodes that burst, summed up from the tops of the containers below them."""
    none = F.lit(None)
    depth = (F.length("head") / WIDTH).cast("int")
    # A head's own row: what was known when it burst.
    own = heads.select(
        depth.alias("depth"), "head", "conv_id", "parent_conv_id", "n_convs",
        ((F.col("n_convs") - 1) * F.col("word")).alias("saved"), F.lit(0).alias("leaves"), none.cast("string").alias("ends"),
        F.lit(True).alias("is_head"),
    )
    under = tops.select(
        depth.alias("depth"), "head", none.cast("long").alias("conv_id"), none.cast("long").alias("parent_conv_id"),
        none.cast("long").alias("n_convs"),
        F.when(F.col("burst"), 0).otherwise(F.col("saved_tokens")).alias("saved"),
        F.when(F.col("burst"), 0).otherwise(F.col("n_leaves")).alias("leaves"),
        F.when(F.col("burst"), F.col("ends_sha256")).alias("ends"),
        F.col("burst").alias("is_head"),
    )
    rows = own.unionByName(under)
    # Every node counts for all heads above it, a head for itself too.
    last = F.col("depth") - F.when(F.col("is_head"), 0).otherwise(1)
    rows = rows.filter(last >= 0).withColumn("above", F.explode(F.sequence(F.lit(0), last)))
    at = F.substring("head", F.lit(1), (WIDTH * F.col("above")).cast("int"))
    self = F.col("above") == F.col("depth")
    # A burst container's leftover is not a child of its own: the head's row is.
    child = (F.col("above") == F.col("depth") - 1) & ~(F.col("is_head") & F.col("conv_id").isNull())
    found = rows.groupBy(at.alias("at")).agg(
        F.max(F.when(self, F.col("conv_id"))).alias("conv_id"),
        F.max("above").cast("long").alias("depth"),
        F.max(F.when(self, F.col("parent_conv_id"))).alias("parent_conv_id"),
        F.max(F.when(self, F.col("n_convs"))).alias("n_convs"),
        F.count_if(child).alias("n_children"),
        F.sum("leaves").alias("n_leaves"),
        F.sum("saved").alias("saved_tokens"),
        F.coalesce(F.max(F.when(self, F.col("ends"))), F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )
    return found.select(*NODE_COLUMNS)


def trie(turns: DataFrame, container: int = CONTAINER) -> DataFrame:
    """A row for each node of the trie of ``turns`` (conv_id, and turns as from ``turns_of``).

    conv_id: the smallest of the conversations that begin with the node's turns; depth; the
    parent's conv_id; n_convs, n_children, n_leaves (nodes without children, itself
    included); saved_tokens: words of the subtree's last turns that a shared prefix stores
    once instead of n_convs times; ends_sha256 of the conversations that end here.
    """
    spark = turns.sparkSession
    suffixes, heads = _burst(staged(_suffixes(turns), "suffixes"), container)
    dealt = (
        suffixes.repartition(shuffle_partitions(spark), "head")
        .sortWithinPartitions("head", "path", "chunk")
        .select("head", "burst", "parent", "path", "words", "ids")
    )
    swept = dealt.mapInArrow(_swept, f"{NODE_DDL}, head binary, burst boolean")
    if heads is None:
        return swept.select(*NODE_COLUMNS)
    swept = staged(swept, "trie")
    whole = swept.filter("burst IS NULL OR NOT burst").select(*NODE_COLUMNS)
    return whole.union(_of_heads(swept.filter("head IS NOT NULL"), heads))
