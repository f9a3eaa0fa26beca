"""Byte-level BPE: texts to token ids and back, with the merges run as recursive queries.

Every task keeps a DuckDB connection of its own with the vocabulary and its merge table
(each token as a pair of shorter ones). New words of a batch become rows of byte tokens; a
recursive query joins the positions of every word with the merge table and contracts the
leftmost pair of the least rank, until no pair is left. Decoding joins token positions with
the vocabulary and strings the bytes together by ordered aggregation. Pieces and words are
worked out once each and reused; a task holds about ``CACHE`` of each kind (200 bytes one, as
words longer than ``LONG`` are not kept) and forgets those it met once. Runs are decoded once
for each slice of ``SLICE`` characters.

A text is cut at blanks that stand between two other characters; the split pattern never
matches across those, so each piece can be looked up by itself. Texts with other blanks are
split as a whole. Special tokens are ordinary text.

Null and empty texts have no tokens; null ids decode to no bytes. Very long texts are taken
whole, and a batch is worked off in slices of ``SLICE`` characters. Repeated rows give a row
each, an empty table none. Further columns pass through; the columns added must not be among
them.
"""

from __future__ import annotations

import base64
import hashlib
import threading
from collections.abc import Iterable, Iterator
from itertools import chain

import duckdb
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from demandgrid.llm.lists import Lists, Places, counted, often

CACHE = 250_000
LONG = 200
SLICE = 4_000_000
#: Few enough for the merges' tables to stay in the processor's cache.
WORDS_AT_ONCE = 20_000
#: Seconds after which a worker without work lets its codec go.
IDLE = 15

MERGE = """
WITH RECURSIVE words(word, ids, live) AS (
  SELECT word, ids, true FROM fresh
  UNION ALL
  SELECT word,
         CASE WHEN best IS NULL THEN ids
              ELSE ids[:(best & 4294967295) - 1] || [(best >> 32)::INT]
                   || ids[(best & 4294967295) + 2:] END,
         best IS NOT NULL
  FROM words LEFT JOIN (
    SELECT word, min((merged::BIGINT << 32) | pos) AS best
    FROM (SELECT word, unnest(ids[:-2]) AS id, unnest(ids[2:]) AS next_id,
                 unnest(range(1, len(ids))) AS pos
          FROM words WHERE live) pairs
    JOIN merges ON id = head AND next_id = tail
    GROUP BY word) USING (word)
  WHERE live)
SELECT word, ids FROM words WHERE NOT live ORDER BY word
"""
#: Runs are strung together by place: the first ``PLACES`` tokens have a column each, which is
#: cheaper than sorting; what longer runs have beyond goes through an ordered aggregate.
PLACES = 6
DECODE = f"""
SELECT run, {" || ".join(f"coalesce(max(octets) FILTER (pos = {k}), '')" for k in range(PLACES))}
       || coalesce(string_agg(octets, '' ORDER BY pos) FILTER (pos >= {PLACES}), '') AS octets
FROM places JOIN vocabulary USING (id) GROUP BY run ORDER BY run
"""


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: one token in base 64 and its rank on each line."""
    with open(path, "rb") as file:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}


class Codec:
    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        self.ranks, self.pattern = ranks, regex.compile(pattern)
        self.bytes_of = np.array([ranks.get(bytes([b]), -1) for b in range(256)], np.int32)
        if (self.bytes_of < 0).any():
            raise ValueError("the vocabulary lacks single bytes")
        pairs = [
            (ranks[t[:k]], ranks[t[k:]], i)
            for t, i in ranks.items()
            for k in range(1, len(t))
            if t[:k] in ranks and t[k:] in ranks
        ]
        head, tail, merged = (pa.array(c, pa.int32()) for c in zip(*pairs or [()] * 3, strict=True))
        self.con = duckdb.connect(config={"threads": 1, "memory_limit": "200MB"})
        self._table("merge_rows", pa.table({"head": head, "tail": tail, "merged": merged}))
        self.con.execute("CREATE TABLE merges AS SELECT * FROM merge_rows")
        ids = pa.array(list(ranks.values()), pa.int32())
        self._table("token_rows", pa.table({"id": ids, "octets": [t.hex() for t in ranks]}))
        self.con.execute("CREATE TABLE vocabulary AS SELECT * FROM token_rows")
        self.blank = np.zeros(max(ranks.values(), default=0) + 1, bool)
        self.blank[[i for t, i in ranks.items() if t[:1] == b" "]] = True
        self.names = [str(i) for i in range(len(self.blank))]
        self._clear()

    def _table(self, name: str, rows: pa.Table) -> None:
        self.con.register(name, rows)

    def _clear(self) -> None:
        self.fresh: list[str] = []
        self.numbers = [0]
        self.first = Places(self.fresh, self.numbers, "")
        self.later = Places(self.fresh, self.numbers, " ")
        self.pieces, self.word_ids = Lists(), Lists()
        self.words: dict[str, int] = {}  # places in word_ids
        self.open: list[bool] = []  # pieces with white space at an end
        self.piece_uses, self.word_uses = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _forget(self) -> None:
        """Keeps the pieces and words met more than once, half of ``CACHE`` at most, the
        most used ones, and none that is long."""
        keep, at = often(self.piece_uses, CACHE // 2)
        self.pieces, self.piece_uses = self.pieces.only(keep), np.ones(len(keep), np.int64)
        self.open = [self.open[k] for k in keep.tolist()]
        self.numbers[0] = len(keep)
        # Places of long pieces stay; only their text is let go.
        self.first.renumber(at, LONG)
        self.later.renumber(at, LONG)
        keep, at = often(self.word_uses, CACHE // 2)
        self.word_ids, self.word_uses = self.word_ids.only(keep), np.ones(len(keep), np.int64)
        self.words = {w: at[n] for w, n in self.words.items() if at[n] >= 0 and len(w) <= LONG}

    def _learn(self, words: Iterable[str]) -> None:
        """Works out the ids of words that were not met yet."""
        whole, todo = [], []
        for w in dict.fromkeys(words):
            if w not in self.words:
                (whole if w.encode() in self.ranks else todo).append(w)
        ids = np.array([self.ranks[w.encode()] for w in whole], np.int32)
        self._keep(whole, np.ones(len(whole), np.int64), ids)
        for k in range(0, len(todo), WORDS_AT_ONCE):
            part = todo[k : k + WORDS_AT_ONCE]
            raw = [w.encode() for w in part]
            ends = np.cumsum([0, *map(len, raw)]).astype(np.int32)
            ids = self.bytes_of[np.frombuffer(b"".join(raw), np.uint8)]
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(ids))
            numbers = pa.array(np.arange(len(part), dtype=np.int32))
            self._table("fresh", pa.table({"word": numbers, "ids": lists}))
            found = self.con.execute(MERGE).to_arrow_table().column("ids").combine_chunks()
            self.con.unregister("fresh")
            sizes = found.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            self._keep(part, sizes, found.flatten().to_numpy(zero_copy_only=False))

    def _keep(self, words: list[str], sizes: np.ndarray, ids: np.ndarray) -> None:
        self.words.update(zip(words, range(self.word_ids.n, self.word_ids.n + len(words)), strict=True))
        self.word_ids.append(sizes, ids)

    def _ids_of(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        at = np.fromiter(map(self.words.__getitem__, words), np.int64, len(words))
        self.word_uses = counted(self.word_uses, at, self.word_ids.n)
        return self.word_ids.take(at)

    def _settle(self) -> None:
        """Works out the pieces that came up since the last time."""
        if not self.fresh:
            return
        split = [self.pattern.findall(p) for p in self.fresh]
        words = list(chain.from_iterable(split))
        self._learn(words)
        ids, lengths = self._ids_of(words)
        ends = np.concatenate([[0], np.cumsum(lengths)])[np.cumsum([0, *map(len, split)])]
        self.pieces.append(np.diff(ends), ids)
        self.fresh.clear()

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after the other, and where each text begins (and the last one ends)."""
        if self.pieces.n > CACHE or self.word_ids.n > CACHE:
            self._forget()
        pieces, whole = [], {}
        for text in texts:
            if not text:
                pieces.append(np.empty(0, np.int64))
                continue
            parts = text.split(" ")
            at = np.fromiter(map(self.later.__getitem__, parts[1:]), np.int64, len(parts) - 1)
            pieces.append(np.concatenate([[self.first[parts[0]]], at]))
        for p in self.fresh:
            # The blank in front is a cut only next to characters that aren't white space.
            body = p[1:] if p[:1] == " " else p
            self.open.append(not body or len(body.strip()) < len(body))
        open_ = np.array(self.open, bool)
        for k, at in enumerate(pieces):
            if len(at) > 1 and open_[at].any():
                whole[k] = self.pattern.findall(texts[k])
                pieces[k] = at[:0]
        self._settle()
        counts = np.array([len(p) for p in pieces], np.int64)
        every = np.concatenate([np.empty(0, np.int64), *pieces])
        self.piece_uses = counted(self.piece_uses, every, self.pieces.n)
        ids, lengths = self.pieces.take(every)
        ends = np.concatenate([[0], np.cumsum(lengths)])[np.concatenate([[0], np.cumsum(counts)])]
        if not whole:
            return ids, ends
        self._learn(chain.from_iterable(whole.values()))
        out = [ids[a:b] for a, b in zip(ends, ends[1:], strict=False)]
        ids, lengths = self._ids_of(list(chain.from_iterable(whole.values())))
        cuts = np.concatenate([[0], np.cumsum(lengths)])[np.cumsum([0, *map(len, whole.values())])]
        for k, a, b in zip(whole, cuts, cuts[1:], strict=False):
            out[k] = ids[a:b]
        return np.concatenate(out), np.cumsum([0, *map(len, out)])

    def runs(self, ids: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
        """Cuts ids before every token that begins with a blank, and at the ends of texts.

        Returns where the distinct runs begin, their lengths, which of them each run is, and
        how many runs begin before each text.
        """
        cut = self.blank[ids]
        cut[ends[:-1][ends[:-1] < len(ids)]] = True
        first = np.flatnonzero(cut)
        lengths = np.diff(np.r_[first, len(ids)])
        pos = np.arange(len(ids)) - np.repeat(first, lengths)
        mixed = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        mixed = (mixed ^ (mixed >> np.uint64(31))) * (2 * pos.astype(np.uint64) + np.uint64(0x632BE5AB))
        mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        sums = np.add.reduceat(mixed, first) if len(first) else mixed
        _, lead, which = np.unique(sums, return_index=True, return_inverse=True)
        like = np.repeat(first[lead][which], lengths) + pos
        if (lengths[lead][which] != lengths).any() or (ids[like] != ids).any():
            # Two different runs with one hash: tell them apart by their ids.
            keys = [ids[a : a + n].tobytes() for a, n in zip(first, lengths, strict=True)]
            places = {k: n for n, k in enumerate(dict.fromkeys(keys))}
            which = np.array([places[k] for k in keys])
            lead = np.unique(which, return_index=True)[1]
        return first[lead], lengths[lead], which, np.searchsorted(first, ends)

    @staticmethod
    def _at(ids: np.ndarray, begins: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        shift = begins - (np.cumsum(lengths) - lengths)
        return ids[np.repeat(shift, lengths) + np.arange(lengths.sum())]

    def decoded_runs(self, ids: np.ndarray, begins: np.ndarray, lengths: np.ndarray) -> list[bytes]:
        before = np.cumsum(lengths) - lengths
        rows = {
            "run": np.repeat(np.arange(len(lengths), dtype=np.int32), lengths),
            "pos": (np.arange(lengths.sum()) - np.repeat(before, lengths)).astype(np.int32),
            "id": self._at(ids, begins, lengths),
        }
        self._table("places", pa.table(rows))
        found = self.con.execute(DECODE).fetchall()
        self.con.unregister("places")
        return [bytes.fromhex(h) for _, h in found]

    def decode(self, ids: np.ndarray, ends: np.ndarray) -> tuple[list[bytes], list[str]]:
        """The bytes of each text, and its ids in decimal with commas between them."""
        if not len(ids):
            return [b""] * (len(ends) - 1), [""] * (len(ends) - 1)
        if ids.min() < 0 or ids.max() >= len(self.blank):
            raise ValueError("an id is not in the vocabulary")
        begins, lengths, which, cuts = self.runs(ids, ends)
        octets = self.decoded_runs(ids, begins, lengths)
        if len(octets) != len(begins):
            raise ValueError("an id is not in the vocabulary")
        names = list(map(self.names.__getitem__, ids.tolist()))
        texts = ends.tolist()
        which = which.tolist()
        spans = [which[a:b] for a, b in zip(cuts.tolist(), cuts[1:].tolist(), strict=False)]
        return (
            [b"".join(map(octets.__getitem__, s)) for s in spans],
            [",".join(names[a:b]) for a, b in zip(texts, texts[1:], strict=False)],
        )


_codecs: dict[str, Codec] = {}
_release: list[threading.Timer] = []


def _codec(shared) -> Codec:  # noqa: ANN001  a broadcast
    """One codec for each Python worker and vocabulary, kept between tasks."""
    while _release:
        _release.pop().cancel()
    key, ranks, pattern = shared.value
    if key not in _codecs:
        _codecs.clear()
        _codecs[key] = Codec(ranks, pattern)
    return _codecs[key]


def _rested() -> None:
    """Lets the codec go after ``IDLE`` seconds without work: workers outlive the stage, and
    what they hold would be missing to the stages that follow."""
    timer = threading.Timer(IDLE, _codecs.clear)
    timer.daemon = True
    _release.append(timer)
    timer.start()


def _slices(texts: list[str | None]) -> Iterator[slice]:
    start = size = 0
    for k, text in enumerate(texts):
        size += len(text or "")
        if size >= SLICE:
            yield slice(start, k + 1)
            start, size = k + 1, 0
    if start < len(texts) or not texts:
        yield slice(start, len(texts))


def _lists(parts: list[tuple[np.ndarray, np.ndarray]]) -> pa.Array:
    ids = np.concatenate([i for i, _ in parts]).astype(np.int32)
    sizes = np.concatenate([np.diff(e) for _, e in parts])
    ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(ids))


def _added(docs: DataFrame, new: list[tuple[str, T.DataType]], work, *columns: str) -> DataFrame:  # noqa: ANN001
    """Columns of ``work(values of the columns)`` after those of the table."""
    schema = T.StructType([*docs.schema.fields, *(T.StructField(*f) for f in new)])
    places = [docs.columns.index(c) for c in columns]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = work(*(batch.column(p) for p in places))
            _rested()
            yield pa.RecordBatch.from_arrays([*batch.columns, *found], names=schema.names)

    return docs.mapInArrow(run, schema)


def _shared(docs: DataFrame, ranks: dict[bytes, int], pattern: str):  # noqa: ANN202
    told = hashlib.sha256(pattern.encode())
    for token, rank in ranks.items():
        told.update(b"%d:%d:" % (rank, len(token)) + token)
    return docs.sparkSession.sparkContext.broadcast((told.hexdigest(), ranks, pattern))


def encoded(
    docs: DataFrame, ranks: dict[bytes, int], pattern: str, text_col: str = "text"
) -> DataFrame:
    """Adds ids, the tokens of the text."""
    shared = _shared(docs, ranks, pattern)

    def work(texts: pa.Array) -> list[pa.Array]:
        values, codec = texts.to_pylist(), _codec(shared)
        return [_lists([codec.encode(values[s]) for s in _slices(values)])]

    return _added(docs, [("ids", T.ArrayType(T.IntegerType()))], work, text_col)


def decoded(
    docs: DataFrame, ranks: dict[bytes, int], pattern: str, ids_col: str = "ids"
) -> DataFrame:
    """Adds octets, the bytes that the ids stand for."""
    shared = _shared(docs, ranks, pattern)

    def work(column: pa.Array) -> list[pa.Array]:
        lists = [np.array(x or [], np.int32) for x in column.to_pylist()]
        ends = np.cumsum([0, *map(len, lists)])
        ids = np.concatenate([np.empty(0, np.int32), *lists])
        return [pa.array(_codec(shared).decode(ids, ends)[0], pa.binary())]

    return _added(docs, [("octets", T.BinaryType())], work, ids_col)


def round_trip(
    docs: DataFrame, ranks: dict[bytes, int], pattern: str, text_col: str = "text"
) -> DataFrame:
    """Adds n_tokens, ids_sha256 (decimal ids with commas) and decoded_sha256.

    Encodes and decodes within a task, so that the ids need not leave it.
    """
    shared = _shared(docs, ranks, pattern)

    def work(texts: pa.Array) -> list[pa.Array]:
        values, codec = texts.to_pylist(), _codec(shared)
        sizes, names, octets = [], [], []
        for s in _slices(values):
            ids, ends = codec.encode(values[s])
            sizes += np.diff(ends).tolist()
            back, listed = codec.decode(ids, ends)
            names += [hashlib.sha256(x.encode()).hexdigest() for x in listed]
            octets += [hashlib.sha256(x).hexdigest() for x in back]
        return [pa.array(sizes, pa.int64()), pa.array(names), pa.array(octets)]

    new = [
        ("n_tokens", T.LongType()),
        ("ids_sha256", T.StringType()),
        ("decoded_sha256", T.StringType()),
    ]
    return _added(docs, new, work, text_col)
