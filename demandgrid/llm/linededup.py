"""Lines that many documents share, found through two Bloom filters.

A line's key is the line without white space at its ends, with A-Z lower-cased. A key of at
least ``min_chars`` code points that at least ``min_docs`` rows hold loses its lines
everywhere but in the largest id that holds it; every other line stays in its place.

1. Hashes of keys, distinct in each row and batch, go to one of many segments. Each segment
   sets the bits of a hash in a filter of what was seen once; what is in there already goes
   into a second one, of what was seen twice.
2. All lines are tested against the second filter where they are read. Only suspected
   repeats, with their whole key, are shuffled. Their exact counts decide, and the largest id
   of each confirmed key is the one that keeps it. Counts are taken before the shuffle, and
   the lines of very common keys are not shuffled by key.
3. Each row gets the keys that it loses, and its text is put together again.

The filters are sized by the number of lines, up to ``MAX_BITS``. Only the second one is sent
to the tasks, so that is the bound of the broadcast. Beyond it the filter fills up: more lines
are shuffled to be confirmed, and the result stays the same.

Null and empty texts have one empty line and come out as an empty text. Each row counts as
a document. A null id is below all others; a key that only rows without an id hold stays in
all of them. Rows with the same largest id all keep the line. Equal rows are treated alike.
An empty table gives no rows. Further columns pass through; the columns added must not be
among them, and working columns start with ``__ld_``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandgrid.sources.staging import staged

MIN_CHARS = 20
MIN_DOCS = 3
#: Filter bits for each line, and the most bits of a filter (256 MiB).
BITS_PER_LINE = 12
MAX_BITS = 1 << 31
MIN_BITS = 1 << 20
SEGMENT_BITS = 1 << 18
PROBES = 4
#: A key with more than one in so many suspected lines is common.
HOT_SHARE = 1000


def line_key(line: bytes) -> bytes:
    return line.strip().lower()  # of bytes: white space 9-13 and 32, letters A-Z


def _long(key: bytes, least: int) -> bool:
    return len(key) >= least and (len(key) >= 4 * least or len(key.decode()) >= least)


def _keys(text: str | None, least: int) -> list[bytes]:
    """The distinct keys of a text that are long enough, in order."""
    lines = dict.fromkeys(map(bytes.strip, (text or "").encode().lower().split(b"\n")))
    return [k for k in lines if _long(k, least)]


def _probes(hashes: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """The segment of each hash, and its bits in there."""
    segment = (hashes % np.uint64(segments)).astype(np.int64)
    mixed = (hashes ^ (hashes >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    step = (mixed >> np.uint64(40)) | np.uint64(1)
    turns = np.arange(PROBES, dtype=np.uint64)
    bits = (mixed[:, None] + step[:, None] * turns) % np.uint64(SEGMENT_BITS)
    return segment, bits.astype(np.int64)


def _hashed(least: int, segments: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                xxhash.xxh64_intdigest(k)
                for t in batch.column(0).to_pylist()
                for k in _keys(t, least)
            ]
            hashes, times = np.unique(np.array(found, np.uint64), return_counts=True)
            segment = (hashes % np.uint64(segments)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(segment), pa.array(hashes.view(np.int64)), pa.array(times > 1)],
                names=["segment", "hash", "again"],
            )

    return run


def _twice(segments: int):
    """For every segment of a task, the filter of hashes that were seen twice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once: dict[int, np.ndarray] = {}
        twice: dict[int, np.ndarray] = {}
        for batch in batches:
            hashes = batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
            again = batch.column(2).to_numpy(zero_copy_only=False)
            segment, bits = _probes(hashes, segments)
            order = np.argsort(segment, kind="stable")
            cuts = np.flatnonzero(np.diff(segment[order])) + 1
            for rows in np.split(order, cuts) if len(order) else []:
                at = int(segment[rows[0]])
                seen = once.setdefault(at, np.zeros(SEGMENT_BITS, bool))
                more = twice.setdefault(at, np.zeros(SEGMENT_BITS, bool))
                # A hash can stand in a batch several times, once for each batch it is from.
                _, first, times = np.unique(
                    hashes[rows], return_index=True, return_counts=True
                )
                lead = bits[rows][first]
                repeat = seen[lead].all(axis=1) | (times > 1)
                more[lead[repeat].ravel()] = True
                more[bits[rows][again[rows]].ravel()] = True
                seen[lead.ravel()] = True
        for at, bitmap in twice.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([at], pa.int32()), pa.array([np.packbits(bitmap).tobytes()], pa.binary())],
                names=["segment", "bitmap"],
            )

    return run


def filter_segments(docs: DataFrame, text_col: str = "text") -> int:
    """Segments that hold ``BITS_PER_LINE`` for each line of the table, within the bounds."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    n = F.sum(F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1)
    lines = docs.agg(n).first()[0] or 0
    return min(max(lines * BITS_PER_LINE, MIN_BITS), MAX_BITS) // SEGMENT_BITS


def twice_seen(docs: DataFrame, text_col: str, least: int, segments: int) -> np.ndarray:
    """The filter of keys seen twice, packed, one row for each segment."""
    found = (
        docs.select(text_col)
        .mapInArrow(_hashed(least, segments), "segment int, hash bigint, again boolean")
        .repartition("segment")
        .mapInArrow(_twice(segments), "segment int, bitmap binary")
    )
    out = np.zeros((segments, SEGMENT_BITS // 8), np.uint8)
    for row in found.toLocalIterator():
        out[row["segment"]] = np.frombuffer(row["bitmap"], np.uint8)
    return out


def _suspects(least: int, bitmaps) -> object:  # noqa: ANN001  a broadcast
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed = bitmaps.value
        for batch in batches:
            keys: list[bytes] = []
            row: list[int] = []
            for i, text in enumerate(batch.column(2).to_pylist()):
                own = _keys(text, least)
                keys += own
                row += [i] * len(own)
            hashes = np.fromiter(map(xxhash.xxh64_intdigest, keys), np.uint64, len(keys))
            segment, bits = _probes(hashes, len(packed))
            octets = packed[segment[:, None], bits >> 3]
            held = (octets >> (7 - (bits & 7)).astype(np.uint8) & 1).all(axis=1)
            hit = np.flatnonzero(held)
            rows = pa.array(np.array(row, np.int64)[hit])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(rows),
                    batch.column(1).take(rows),
                    pa.array([keys[i].decode() for i in hit.tolist()], pa.string()),
                ],
                names=["id", "text_hash", "key"],
            )

    return run


def lost_keys(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = MIN_CHARS,
    min_docs: int = MIN_DOCS,
) -> DataFrame:
    """(id, text_hash, lost): the keys that each row loses; rows that lose none are not in it."""
    spark = docs.sparkSession
    bitmaps = twice_seen(docs, text_col, min_chars, filter_segments(docs, text_col))
    shared = spark.sparkContext.broadcast(bitmaps)
    id_type = docs.schema[id_col].dataType.simpleString()
    suspects = staged(
        docs.select(
            F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"), text_col
        ).mapInArrow(
            _suspects(min_chars, shared), f"id {id_type}, text_hash bigint, key string"
        ),
        "suspected_lines",
    )
    confirmed = staged(
        suspects.groupBy("key")
        .agg(F.count("*").alias("n"), F.max("id").alias("keeper"))
        .filter(F.col("n") >= min_docs)
        .filter("keeper IS NOT NULL")
        .select(F.sha2("key", 256).alias("digest"), "n", "keeper"),
        "confirmed_lines",
    )
    # Less than HOT_SHARE keys can have more than their share of all suspected lines. They go
    # to the tasks, and their lines stay where they are; the others meet by their digest.
    hot = F.col("n") * HOT_SHARE > suspects.count()
    common = F.broadcast(confirmed.filter(hot).select("digest", "keeper"))
    rest = confirmed.filter(~hot).select("digest", "keeper")
    suspects = suspects.withColumn("digest", F.sha2("key", 256))
    found = suspects.join(common, "digest").unionByName(
        suspects.join(common.select("digest"), "digest", "left_anti").join(rest, "digest")
    )
    return (
        found.filter(F.col("id").isNull() | (F.col("id") < F.col("keeper")))
        .groupBy("id", "text_hash")
        .agg(F.collect_set("key").alias("lost"))
    )


def _rebuilt(place: int, width: int, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts: list[str] = []
            before: list[int] = []
            dropped: list[int] = []
            gone_lists = batch.column(width).to_pylist()
            for text, lost in zip(batch.column(place).to_pylist(), gone_lists, strict=True):
                text = text or ""
                if not lost:
                    texts.append(text)
                    before.append(text.count("\n") + 1)
                    dropped.append(0)
                    continue
                lines = text.encode().split(b"\n")
                gone = {k.encode() for k in lost}
                kept = [x for x in lines if line_key(x) not in gone]
                texts.append(b"\n".join(kept).decode())
                before.append(len(lines))
                dropped.append(len(lines) - len(kept))
            columns = batch.columns[:width]
            columns[place] = pa.array(texts, pa.string())
            counts = [pa.array(before, pa.int64()), pa.array(dropped, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns + counts, names=names)

    return run


def without_repeated_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = MIN_CHARS,
    min_docs: int = MIN_DOCS,
) -> DataFrame:
    """The documents with the text that stays, n_lines (before) and n_dropped."""
    lost = lost_keys(docs, id_col, text_col, min_chars, min_docs).select(
        F.col("id").alias("__ld_id"), F.col("text_hash").alias("__ld_hash"), "lost"
    ).withColumnRenamed("lost", "__ld_lost")
    # The lists are the small side; hashing them spares sorting the texts.
    joined = docs.withColumn("__ld_text", F.xxhash64(text_col)).join(
        lost.hint("shuffle_hash"),
        F.col(id_col).eqNullSafe(F.col("__ld_id")) & (F.col("__ld_text") == F.col("__ld_hash")),
        "left",
    )
    schema = T.StructType([*docs.schema.fields]).add("n_lines", "long").add("n_dropped", "long")
    place, width = docs.columns.index(text_col), len(docs.columns)
    return joined.select(*[docs[c] for c in docs.columns], "__ld_lost").mapInArrow(
        _rebuilt(place, width, schema.names), schema
    )
