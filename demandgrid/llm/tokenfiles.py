"""Token files with directly addressable codes.

An id is cut into chunks of eight bits, the lowest first. Level 0 holds the first chunk of
every id; a continuation bitmap says which ids go on, and the next level holds the next chunk
of just those. A rank directory counts the continuing ids before every block of 512, so the
place of an id in the next level is one entry and a count within one block: any token is
read by touching one chunk, one directory entry and one block of bits at each level, without
decoding what stands before it.

File layout, all numbers little-endian: 8 bytes magic; int64 documents, tokens, levels;
int64 first token of each document and the end; int8 document keys present, int64 keys; per
level int64 chunks, the chunks, int64 bitmap bytes, the bitmap, int64 entries, the directory.

Documents are ordered by id over all files (nulls first, equal ids by a hash of the text).
Each task writes files of about ``FILE_TOKENS`` under a name of its own and renames them when
they are whole, so a repeated task replaces its files. A null text is an empty one and has
the end id alone. Repeated rows are repeated documents. An empty table gives no files and
no rows. Only the two named columns are read.
"""

from __future__ import annotations

import json
import os
import uuid
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from demandgrid.llm.lists import Lists, counted, often
from demandgrid.session import shuffle_partitions
from demandgrid.sources.staging import staged

MAGIC = b"DACTOK01"
CHUNK_BITS = 8
BLOCK = 512
FILE_TOKENS = 16_000_000
CACHE = 600_000
LONG = 200
SLICE_BYTES = 8_000_000
#: Marks that are cut off the end of a run; the others may belong to special tokens.
MARKS, MORE_MARKS = b".,;:!?", b"&*#$%|<>()[]{}\""


class Levels:
    """Ids as chunk levels, with random access."""

    def __init__(self, parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]], n: int) -> None:
        self.parts, self.n = parts, n

    @classmethod
    def of(cls, ids: np.ndarray) -> Levels:
        rest, parts = ids.astype(np.uint32, copy=False), []
        while True:
            chunk = rest.astype(np.uint8)  # the lowest bits
            more = rest >> CHUNK_BITS > 0
            bits = np.packbits(more, bitorder="little")
            # Bits beyond the last one are unset.
            ones = np.bitwise_count(np.pad(bits, (0, -len(bits) % (BLOCK // 8))))
            blocks = ones.reshape(-1, BLOCK // 8).sum(axis=1, dtype=np.int64)
            ranks = np.concatenate([[0], np.cumsum(blocks)]).astype(np.int64)
            parts.append((chunk, bits, ranks))
            rest = rest[more] >> CHUNK_BITS
            if not len(rest):
                return cls(parts, len(ids))

    def at(self, places: np.ndarray) -> np.ndarray:
        """The ids at any places, in their order."""
        places = np.asarray(places, np.int64)
        if len(places) and (places.min() < 0 or places.max() >= self.n):
            raise IndexError("no such token")
        out = np.zeros(len(places), np.uint64)
        open_, shift = np.arange(len(places)), 0
        for chunk, bits, ranks in self.parts:
            out[open_] |= chunk[places].astype(np.uint64) << np.uint64(shift)
            on = (bits[places >> 3] >> (places & 7).astype(np.uint8) & 1).astype(bool)
            open_, places = open_[on], places[on]
            if not len(places):
                break
            # Continuing ids before the block, and those before the place within its block.
            first = places // BLOCK * (BLOCK // 8)
            span = np.arange(BLOCK // 8)
            octets = bits[np.minimum(first[:, None] + span, len(bits) - 1)]
            keep = np.clip(places[:, None] % BLOCK - 8 * span, 0, 8)
            inside = np.bitwise_count(octets & ((1 << keep) - 1).astype(np.uint8)).sum(axis=1)
            places = ranks[places // BLOCK] + inside.astype(np.int64)
            shift += CHUNK_BITS
        return out.astype(np.uint32)

    def all(self) -> np.ndarray:
        """Every id in order; consecutive places need no directory."""
        out, open_ = np.empty(0, np.uint32), None
        for level, (chunk, bits, _) in enumerate(self.parts):
            on = np.flatnonzero(np.unpackbits(bits, count=len(chunk), bitorder="little"))
            if open_ is None:
                out, open_ = chunk.astype(np.uint32), on
            else:
                out[open_] |= chunk.astype(np.uint32) << np.uint32(level * CHUNK_BITS)
                open_ = open_[on]
        return out


def _packed(keys: list[int | None], ends: np.ndarray, ids: np.ndarray) -> bytes:
    levels = Levels.of(ids)
    out = [MAGIC, np.array([len(keys), len(ids), len(levels.parts)], "<i8").tobytes()]
    out.append(ends.astype("<i8").tobytes())
    out.append(np.array([k is not None for k in keys], np.int8).tobytes())
    out.append(np.array([k or 0 for k in keys], "<i8").tobytes())
    for level in levels.parts:
        for part, kind in zip(level, ("u1", "u1", "<i8"), strict=True):
            out += [np.array([len(part)], "<i8").tobytes(), part.astype(kind).tobytes()]
    return b"".join(out)


class TokenFile:
    """A file of documents: ``keys``, ``starts`` (with the end) and ``levels``."""

    def __init__(self, data: bytes) -> None:
        if data[:8] != MAGIC:
            raise ValueError("not a token file")
        at = 8

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            part = np.frombuffer(data, kind, n, at)
            at += part.nbytes
            return part

        docs, n, levels = take("<i8", 3).tolist()
        self.starts = take("<i8", docs + 1)
        present, keys = take("i1", docs), take("<i8", docs)
        self.keys = [int(k) if p else None for p, k in zip(present, keys, strict=True)]
        parts = [
            tuple(take(kind, int(take("<i8", 1)[0])) for kind in ("u1", "u1", "<i8"))
            for _ in range(levels)
        ]
        self.levels = Levels(parts, n)

    def token(self, document: int, place: int) -> int:
        start, end = self.starts[document], self.starts[document + 1]
        if not 0 <= place < end - start:
            raise IndexError("no such token")
        return int(self.levels.at([start + place])[0])


class StoredTokens:
    """A token file that stays where it is: any tokens are read by their offsets, a few bytes
    for each level, whatever the length of the file."""

    def __init__(self, file: pa.NativeFile) -> None:
        self.file = file
        if self._read(0, 8) != MAGIC:
            raise ValueError("not a token file")
        self.n_docs, self.n, levels = np.frombuffer(self._read(8, 24), "<i8").tolist()
        at = 32 + 8 * (self.n_docs + 1) + 9 * self.n_docs
        self.levels: list[list[int]] = []  # where chunks, bitmap and directory begin
        for _ in range(levels):
            places = []
            for width in (1, 1, 8):
                n = int(np.frombuffer(self._read(at, 8), "<i8")[0])
                places.append(at + 8)
                at += 8 + width * n
            self.levels.append(places)

    def _read(self, at: int, n: int) -> bytes:
        self.file.seek(at)
        return self.file.read(n)

    def span(self, document: int) -> tuple[int, int]:
        """Where a document's tokens begin and end."""
        if not 0 <= document < self.n_docs:
            raise IndexError("no such document")
        begin, end = np.frombuffer(self._read(32 + 8 * document, 16), "<i8").tolist()
        return begin, end

    def ids(self, begin: int, end: int) -> np.ndarray:
        """The tokens from one place to another."""
        if not 0 <= begin <= end <= self.n:
            raise IndexError("no such token")
        out = np.zeros(end - begin, np.uint32)
        open_ = np.arange(end - begin)
        for level, (chunks, bitmap, directory) in enumerate(self.levels):
            if begin == end:
                break
            own = np.frombuffer(self._read(chunks + begin, end - begin), np.uint8)
            out[open_] |= own.astype(np.uint32) << np.uint32(level * CHUNK_BITS)
            block = begin // BLOCK
            first = block * BLOCK
            octets = np.frombuffer(self._read(bitmap + first // 8, (end + 7) // 8 - first // 8), np.uint8)
            on = np.unpackbits(octets, bitorder="little")[: end - first].astype(bool)
            rank = int(np.frombuffer(self._read(directory + 8 * block, 8), "<i8")[0])
            open_ = open_[on[begin - first :]]
            begin = rank + int(on[: begin - first].sum())
            end = begin + len(open_)
        return out


class _Runs(dict):
    """Numbers runs in the order they come. Runs of ASCII that differ in case share one."""

    def __init__(self, fresh: list[bytes], lowers: bool) -> None:
        self.fresh, self.lowers, self.n = fresh, lowers, 0

    def __missing__(self, key: bytes) -> int:
        # Before the library has composed a letter and its marks, its case must stay.
        low = key.lower() if self.lowers and key.isascii() else key
        if low != key:
            self[key] = at = self[low]
            return at
        self[key] = at = self.n
        self.n += 1
        self.fresh.append(key)
        return at

    def renumber(self, places: list[int]) -> None:
        """New numbers by old ones; keys with a negative one, and long keys, are dropped."""
        kept = [(k, places[n]) for k, n in self.items() if places[n] >= 0 and len(k) <= LONG]
        self.clear()
        self.update(kept)


class WordTokenizer:
    """Texts to ids; every run between ASCII white space is looked up or encoded once.

    Holds for tokenizers that never match across white space and treat it all alike, and
    that take marks after a letter for a piece of their own. If the description lower-cases,
    runs of ASCII alone that differ in case are encoded once.
    """

    def __init__(self, description: str, special_as_text: bool = True) -> None:
        self.tokenizer = Tokenizer.from_str(description)
        self.tokenizer.encode_special_tokens = special_as_text
        added = json.loads(description).get("added_tokens") or []
        plain = special_as_text and all(t.get("special") for t in added)
        self.marks = MARKS + MORE_MARKS if plain else MARKS
        self.lowers = special_as_text and '"Lowercase"' in description
        self.clear()

    def clear(self) -> None:
        self.fresh: list[bytes] = []
        self.places = _Runs(self.fresh, self.lowers)
        self.runs, self.parts = Lists(np.uint32), Lists(np.uint32)
        self.known: dict[bytes, int] = {}  # places in parts
        self.run_uses, self.part_uses = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _forget(self) -> None:
        """Keeps the runs and parts met more than once, half of ``CACHE`` at most."""
        keep, at = often(self.run_uses, CACHE // 2)
        self.runs, self.run_uses = self.runs.only(keep), np.ones(len(keep), np.int64)
        self.places.renumber(at)
        self.places.n = len(keep)
        keep, at = often(self.part_uses, CACHE // 2)
        self.parts, self.part_uses = self.parts.only(keep), np.ones(len(keep), np.int64)
        self.known = {k: at[n] for k, n in self.known.items() if at[n] >= 0 and len(k) <= LONG}

    def _settle(self) -> None:
        """Works out the runs that came up since the last time."""
        if not self.fresh:
            return
        split: list[bytes] = []
        sizes = []
        for run in self.fresh:
            # Marks at the end are a piece of their own only right after a letter.
            if run[-1] in self.marks and (body := run.rstrip(self.marks))[-1:].isalpha():
                split += (body, run[len(body) :])
                sizes.append(2)
            else:
                split.append(run)
                sizes.append(1)
        new = [p for p in dict.fromkeys(split) if p not in self.known]
        found = [
            e.ids
            for e in self.tokenizer.encode_batch_fast(
                [p.decode() for p in new], add_special_tokens=False
            )
        ]
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        self.known.update(zip(new, range(self.parts.n, self.parts.n + len(new))))  # noqa: B905
        flat = np.fromiter(chain.from_iterable(found), np.uint32, int(lengths.sum()))
        self.parts.append(lengths, flat)
        at = np.fromiter(map(self.known.__getitem__, split), np.int64, len(split))
        self.part_uses = counted(self.part_uses, at, self.parts.n)
        ids, lengths = self.parts.take(at)
        ends = np.concatenate([[0], np.cumsum(lengths)])[np.cumsum([0, *sizes])]
        self.runs.append(np.diff(ends), ids)
        self.fresh.clear()

    def encode(self, texts: list[str | None], end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids with the end id after each text, and where each text begins."""
        if self.runs.n > CACHE or self.parts.n > CACHE:
            self._forget()
        at: list[np.ndarray] = [np.empty(0, np.int64)]
        for text in texts:
            # bytes.split cuts at blanks and the controls 9 to 13 alone.
            own = (text or "").encode().split()
            at.append(np.fromiter(map(self.places.__getitem__, own), np.int64, len(own)))
        self._settle()
        counts = np.cumsum([len(a) for a in at])
        every = np.concatenate(at)
        self.run_uses = counted(self.run_uses, every, self.runs.n)
        ids, lengths = self.runs.take(every)
        cuts = np.concatenate([[0], np.cumsum(lengths)])[counts]
        ids = np.insert(ids, cuts[1:], np.uint32(end_id))
        return ids, cuts + np.arange(len(cuts))


_tokenizers: dict[int, WordTokenizer] = {}


def _tokenizer(shared) -> WordTokenizer:  # noqa: ANN001  a broadcast
    """One for each Python worker, kept between tasks."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    description, special_as_text = shared.value
    key = hash((description, special_as_text))
    if key not in _tokenizers:
        _tokenizers.clear()
        _tokenizers[key] = WordTokenizer(description, special_as_text)
    return _tokenizers[key]


def _write(folder: str, name: str, data: bytes) -> None:
    """The whole file under its name, or none."""
    store, path = fs.FileSystem.from_uri(folder)
    part = f"{path}/.{name}.{uuid.uuid4().hex}"
    with store.open_output_stream(part) as out:
        out.write(data)
    store.move(part, f"{path}/{name}")


def _slices(texts: list[str | None]) -> Iterator[slice]:
    start = size = 0
    for k, text in enumerate(texts):
        size += len(text or "")
        if size >= SLICE_BYTES:
            yield slice(start, k + 1)
            start, size = k + 1, 0
    if start < len(texts):
        yield slice(start, len(texts))


def _written(shared, folder: str, end_id: int, file_tokens: int):  # noqa: ANN001
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, files = TaskContext.get().partitionId(), 0
        keys: list[int | None] = []
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def flush() -> pa.RecordBatch:
            nonlocal files, size
            name = f"{task:07d}-{files:05d}.dac"
            ids = np.concatenate([i for i, _ in held])
            ends = np.cumsum(np.concatenate([[0], *(np.diff(e) for _, e in held)]))
            _write(folder, name, _packed(keys, ends, ids))
            row = [[task], [files], [name], [len(keys)], [len(ids)]]
            kinds = (pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64())
            keys.clear()
            held.clear()
            files, size = files + 1, 0
            return pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip(row, kinds, strict=True)],
                names=["task", "file", "name", "n_docs", "n_tokens"],
            )

        for batch in batches:
            own, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for s in _slices(texts):
                ids, ends = _tokenizer(shared).encode(texts[s], end_id)
                keys += own[s]
                held.append((ids, ends))
                size += len(ids)
                if size >= file_tokens:
                    yield flush()
        if keys:
            yield flush()

    return run


def write_tokens(
    docs: DataFrame,
    folder: str,
    tokenizer: str,
    end_id: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    special_as_text: bool = True,
    file_tokens: int = FILE_TOKENS,
) -> DataFrame:
    """Writes the files into ``folder``, a URI that all executors reach, and returns the list
    of them: name, n_docs, n_tokens and first_token, the tokens of all files before it.

    ``tokenizer`` is the description itself, in JSON.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((tokenizer, special_as_text))
    store, path = fs.FileSystem.from_uri(folder)
    store.create_dir(path, recursive=True)
    chosen = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    tie = F.xxhash64("text")
    ordered = chosen.repartitionByRange(F.col("id").asc_nulls_first(), tie).sortWithinPartitions(
        F.col("id").asc_nulls_first(), tie
    )
    files = staged(
        ordered.mapInArrow(
            _written(shared, folder, end_id, file_tokens),
            "task int, file int, name string, n_docs bigint, n_tokens bigint",
        ),
        "token_files",
    )
    # One row a file, so a running sum in one task is small.
    before = Window.orderBy("task", "file").rowsBetween(Window.unboundedPreceding, -1)
    return files.select(
        "name",
        "n_docs",
        "n_tokens",
        F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("first_token"),
    )


def _read(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for name, first in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                with store.open_input_file(f"{path}/{name}") as file:
                    found = TokenFile(file.read())
                ids = found.levels.all().astype("<u4")
                ends = found.starts
                # First, middle and last token of each document, by the directories.
                sample = np.concatenate([ends[:-1], (ends[:-1] + ends[1:]) // 2, ends[1:] - 1])
                if (found.levels.at(sample) != ids[sample]).any():
                    raise ValueError(f"{name}: the directories and the codes disagree")
                raw, cuts = ids.tobytes(), (4 * ends).tolist()
                crc = [zlib.crc32(raw[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(found.keys, pa.int64()),
                        pa.array(ends[:-1] + first),
                        pa.array(np.diff(ends)),
                        pa.array(crc, pa.int64()),
                    ],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    return run


def read_tokens(spark: SparkSession, folder: str, files: DataFrame) -> DataFrame:
    """Reads the listed files: doc_id, start over all files, n_tokens and ids_crc32."""
    # A named number of tasks: by the few bytes of the list, adaptive execution would take one.
    listed = files.select("name", "first_token").repartition(shuffle_partitions(spark), "name")
    return listed.mapInArrow(
        _read(folder), "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
    )
