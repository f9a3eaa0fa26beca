"""Web archives: pages written as WARC records, and a reader that splits archives anywhere.

Writer: a gzip member for each record, rolled into files of about ``FILE_BYTES``. Pages whose
payloads (UTF-8 bytes) are equal and long enough are stored once: the page with the smallest
id is a ``response``, the others are ``revisit`` records, which keep the HTTP headers, the
digest of the whole payload and a reference, but no payload. Pages are not shuffled unless
the table of repeated digests is too large for Spark to broadcast; digests with more than a
thousandth of all pages, a thousand at most, are always sent to the tasks.

Reader: files are cut into byte ranges. A task scans its range for the magic bytes of gzip and
takes a candidate only if the whole member decodes, checksum included, to a record whose
headers parse and whose length agrees. It owns the records that begin inside its range and
reads the last one to its end, past the range if need be. A payload may itself hold archive
members in plain sight of the scan; so a first pass notes where every range's records begin
and end, and a range whose first record begins before the last one of an earlier range has
ended is scanned again from there, until all ranges agree. What does not decode is passed
over up to the next record. Only counts reach the driver.

A file appears under its name when it is complete; lost tasks leave files that no list names.

Null html is empty. A null id is larger than all others, and comes back null; pages that share
the smallest id of a payload are all responses. Control characters in a URL are escaped by
percent signs, a null URL is left out. Repeated rows give a record each, an empty table no
file. Very long pages are records like others, held whole by the task that works on them.
Further columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from datetime import UTC, datetime

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from demandgrid.session import shuffle_partitions
from demandgrid.sources.staging import staged

LEAST_BYTES = 100
FILE_BYTES = 256 << 20
SPLIT_BYTES = 32 << 20
BATCH_BYTES = 16 << 20
WINDOW = 4 << 20
PIECE = 16 << 10
LEVEL = 6
HOT_SHARE = 1000

# Fixed values of the formats.
MAGIC = b"\x1f\x8b\x08"
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CONTROLS = re.compile(r"[\x00-\x1f\x7f]")

RECORD_DDL = (
    "file string, offset bigint, record_type string, record_id string, refers_to string, "
    "target_uri string, payload_bytes bigint, payload_digest string"
)


def _headed(headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = [f"{name}: {value}" for name, value in [*headers, ("Content-Length", str(len(block)))]]
    head = "\r\n".join(lines).encode("utf-8", "surrogatepass")
    return b"\r\n".join([VERSION, head, b"", block, b"", b""])


def _member(record: bytes, level: int) -> bytes:
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(record) + packer.flush()


def _page_record(
    page: int | None, url: str | None, payload: bytes, digest: str, first: int | None, date: str
) -> bytes:
    """``first``: the page that holds this payload, if this one is a revisit."""
    name = f"urn:page:{page}" if page is not None else f"urn:uuid:{uuid.uuid4()}"
    headers = [
        ("WARC-Type", "response" if first is None else "revisit"),
        ("WARC-Record-ID", f"<{name}>"),
        ("WARC-Date", date),
    ]
    if url is not None:
        headers.append(("WARC-Target-URI", CONTROLS.sub(lambda m: f"%{ord(m[0]):02X}", url)))
    headers.append(("WARC-Payload-Digest", f"sha256:{digest}"))
    if first is not None:
        headers += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<urn:page:{first}>")]
    headers.append(("Content-Type", "application/http;msgtype=response"))
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    return _headed(headers, http.encode() + (payload if first is None else b""))


def _written(folder: str, date: str, level: int, file_bytes: int):  # noqa: ANN202
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = fs.FileSystem.from_uri(folder)
        out, part, size, records = None, "", 0, 0

        def begin() -> None:
            nonlocal out, part, size, records
            part = f"{uuid.uuid4().hex}.warc.gz"
            out, records = store.open_output_stream(f"{path}/.{part}", compression=None), 0
            info = [
                ("WARC-Type", "warcinfo"),
                ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"),
                ("WARC-Date", date),
                ("WARC-Filename", part),
                ("Content-Type", "application/warc-fields"),
            ]
            lead = _member(_headed(info, b"format: WARC File Format 1.1\r\n"), level)
            out.write(lead)
            size = len(lead)

        def end() -> pa.RecordBatch:
            nonlocal out
            out.close()
            store.move(f"{path}/.{part}", f"{path}/{part}")
            out = None
            return pa.RecordBatch.from_pydict(
                {"name": [part], "n_bytes": [size], "n_records": [records]}
            )

        for batch in batches:
            pages, urls, htmls, digests, firsts = batch.columns
            for k in range(len(pages)):
                if out is None:
                    begin()
                payload = (htmls[k].as_py() or "").encode("utf-8", "surrogatepass")
                data = _member(
                    _page_record(pages[k].as_py(), urls[k].as_py(), payload, digests[k].as_py(), firsts[k].as_py(), date),
                    level,
                )
                out.write(data)
                size, records = size + len(data), records + 1
                if size >= file_bytes:
                    yield end()
        if out is not None:
            yield end()

    return run


def _with_first(pages: DataFrame, least_bytes: int) -> DataFrame:
    """Adds digest, and first: the page that holds the payload of a revisit, else null."""
    html = F.coalesce("html", F.lit(""))
    pages = pages.withColumn("digest", F.sha2(html, 256))
    repeated = staged(
        pages.filter(F.octet_length(html) >= least_bytes)
        .groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
        .filter((F.col("n") > 1) & F.col("first").isNotNull()),
        "payloads",
    )
    total = pages.count()
    hot = F.col("n") * HOT_SHARE > total
    # Less than HOT_SHARE digests can have more than their share of all pages.
    common = F.broadcast(repeated.filter(hot).select("digest", F.col("first").alias("common")))
    rest = repeated.filter(~hot).select(F.col("digest").alias("own"), "first")
    # Pages that are settled get keys of their own, so that none is hot in the join.
    key = F.when(F.col("common").isNull(), F.col("digest")).otherwise(F.concat(F.lit("page "), "page_id"))
    joined = pages.join(common, "digest", "left").withColumn("own", key).join(rest, "own", "left")
    first = F.coalesce("common", "first")
    return joined.select(
        "page_id",
        "url",
        "html",
        "digest",
        F.when(F.col("page_id").isNull() | (F.col("page_id") != first), first).alias("first"),
    )


def write_archives(
    pages: DataFrame,
    folder: str,
    least_bytes: int = LEAST_BYTES,
    level: int = LEVEL,
    file_bytes: int = FILE_BYTES,
) -> DataFrame:
    """Writes page_id, url and html of every row into archives in ``folder``, a URI that all
    executors reach, and returns the list of them: name, n_bytes, n_records."""
    store, path = fs.FileSystem.from_uri(folder)
    store.create_dir(path, recursive=True)
    date = datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
    chosen = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    return staged(
        _with_first(chosen, least_bytes).mapInArrow(
            _written(folder, date, level, file_bytes), "name string, n_bytes bigint, n_records bigint"
        ),
        "archives",
    )


class _Bytes:
    """A file's bytes by position, read in windows."""

    def __init__(self, file: pa.NativeFile) -> None:
        self.file, self.size = file, file.size()
        self.start, self.held = 0, memoryview(b"")

    def at(self, place: int, most: int) -> memoryview:
        """Up to ``most`` bytes from ``place`` on, none at the end of the file."""
        if not self.start <= place < self.start + len(self.held):
            self.file.seek(min(place, self.size))
            self.start, self.held = place, memoryview(self.file.read(WINDOW))
        k = place - self.start
        return self.held[k : k + most]


def _fields(lines: list[bytes]) -> dict[str, str]:
    pairs = (line.decode("utf-8", "replace").partition(":") for line in lines)
    return {name.strip().lower(): value.removeprefix(" ") for name, _, value in pairs}


def _record_at(data: _Bytes, place: int) -> tuple[int, dict[str, str], bytes] | None:
    """Where the member at ``place`` ends, its headers and its block, if it is a record."""
    if data.at(place, 1) != MAGIC[:1]:
        return None
    unpacker, parts, fed, piece, known = zlib.decompressobj(31), [], 0, PIECE, 0
    while not unpacker.eof:
        given = data.at(place + fed, piece)
        if not given:
            return None
        try:
            parts.append(unpacker.decompress(given))
        except zlib.error:
            return None
        fed += len(given)
        piece = min(2 * piece, WINDOW)
        if known < 5:
            lead = b"".join(parts)[:5]
            known = len(lead)
            if not b"WARC/".startswith(lead):
                return None
    head, found, block = b"".join(parts).partition(b"\r\n\r\n")
    first, *lines = head.split(b"\r\n")
    fields = _fields(lines)
    length = fields.get("content-length", "").strip()
    if not (found and first.startswith(b"WARC/") and length.isdecimal() and "warc-type" in fields):
        return None
    if len(block) != int(length) + 4 or not block.endswith(b"\r\n\r\n"):
        return None
    return place + fed - len(unpacker.unused_data), fields, block[:-4]


def _records(data: _Bytes, place: int, end: int) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """Begin, end, headers and block of the records that begin in a range."""
    while place < end:
        found = _record_at(data, place)
        if found:
            yield place, *found
            place = found[0]
            continue
        # Scan for the next magic bytes; they may lie across two windows.
        place += 1
        while place < end:
            held = bytes(data.at(place, WINDOW))
            if len(held) < len(MAGIC):
                held = bytes(data.at(place, len(MAGIC))) + bytes(data.at(place + len(held), len(MAGIC)))
                if len(held) < len(MAGIC):
                    return
            k = held.find(MAGIC)
            if k >= 0:
                place += k
                break
            place += max(len(held) - len(MAGIC) + 1, 1)


def _bounds(folder: str):  # noqa: ANN202
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = fs.FileSystem.from_uri(folder)
        for batch in batches:
            rows = batch.to_pylist()
            for row in rows:
                row["first"], row["until"] = None, row["begin"]
                with store.open_input_file(f"{path}/{row['name']}") as file:
                    for a, b, _, _ in _records(_Bytes(file), row["begin"], row["end"]):
                        row["first"] = a if row["first"] is None else row["first"]
                        row["until"] = b
            yield pa.RecordBatch.from_pylist(rows, schema=_RANGE)

    return run


_RANGE = pa.schema([("name", pa.string()), *((n, pa.int64()) for n in ("start", "end", "begin", "first", "until"))])
_RANGE_DDL = "name string, start bigint, end bigint, begin bigint, first bigint, until bigint"


def ranges_of(spark: SparkSession, folder: str, files: DataFrame, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Byte ranges of the listed files with the place where each range's records begin."""
    starts = F.sequence(F.lit(0).cast("long"), F.greatest(F.col("n_bytes") - 1, F.lit(0)), F.lit(split_bytes).cast("long"))
    cut = files.select("name", "n_bytes", F.explode(starts).alias("start")).select(
        "name",
        "start",
        F.least("n_bytes", F.col("start") + split_bytes).alias("end"),
        F.col("start").alias("begin"),
    )
    # A named number of tasks: by the few bytes of the list, adaptive execution would take one.
    tasks = shuffle_partitions(spark)
    known = staged(cut.repartition(tasks, "name", "start").mapInArrow(_bounds(folder), _RANGE_DDL), "ranges")
    before = Window.partitionBy("name").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    while True:
        # The scan has to begin where the records of earlier ranges end, if that is later.
        checked = known.withColumn("due", F.greatest("start", F.max("until").over(before)))
        wrong = (F.col("due") < F.col("begin")) | F.coalesce(F.col("first") < F.col("due"), F.lit(False))
        if not checked.filter(wrong).take(1):
            return known
        moved = F.when(wrong, F.col("due")).otherwise(F.col("begin"))
        again = checked.withColumn("begin", moved).select("name", "start", "end", "begin")
        known = staged(again.repartition(tasks, "name", "start").mapInArrow(_bounds(folder), _RANGE_DDL), "ranges")


def _payload(fields: dict[str, str], block: bytes) -> tuple[bytes | None, int | None, str | None]:
    """The payload (none for revisits), its length and its digest."""
    kind, told = fields["warc-type"].strip(), fields.get("warc-payload-digest", "").strip()
    digest = told.removeprefix("sha256:") if told.startswith("sha256:") else None
    if "application/http" not in fields.get("content-type", ""):
        return block, len(block), hashlib.sha256(block).hexdigest()
    head, _, payload = block.partition(b"\r\n\r\n")
    if kind == "revisit":
        length = _fields(head.split(b"\r\n")[1:]).get("content-length", "").strip()
        return None, int(length) if length.isdecimal() else None, digest
    own = hashlib.sha256(payload).hexdigest()
    if digest not in (None, own):
        raise ValueError(f"the payload of {fields.get('warc-record-id')} does not have its digest")
    return payload, len(payload), own


def _read(folder: str, with_payload: bool):  # noqa: ANN202
    names = ["file", "offset", "record_type", "record_id", "refers_to", "target_uri", "payload_bytes", "payload_digest"]
    kinds = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string()]
    if with_payload:
        names, kinds = [*names, "payload"], [*kinds, pa.binary()]

    def given(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = fs.FileSystem.from_uri(folder)
        rows: list[tuple] = []
        size = 0
        for batch in batches:
            for name, begin, end in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                with store.open_input_file(f"{path}/{name}") as file:
                    for at, _, fields, block in _records(_Bytes(file), begin, end):
                        kind = fields["warc-type"].strip()
                        if kind == "warcinfo":
                            continue
                        payload, length, digest = _payload(fields, block)
                        row = (name, at, kind, fields.get("warc-record-id"), fields.get("warc-refers-to"), fields.get("warc-target-uri"), length, digest)
                        rows.append((*row, payload) if with_payload else row)
                        size += 200 + (len(payload or b"") if with_payload else 0)
                        if size >= BATCH_BYTES:
                            yield given(rows)
                            rows, size = [], 0
        if rows:
            yield given(rows)

    return run


def read_archives(
    spark: SparkSession,
    folder: str,
    files: DataFrame,
    split_bytes: int = SPLIT_BYTES,
    with_payload: bool = True,
) -> DataFrame:
    """The records of the listed files (name and n_bytes), but for warcinfo: file, offset,
    record_type, record_id, refers_to, target_uri, payload_bytes and payload_digest (bare
    SHA-256) of the whole payload, and the payload, null for revisits."""
    ranges = ranges_of(spark, folder, files, split_bytes).filter("first IS NOT NULL")
    dealt = ranges.repartition(shuffle_partitions(spark), "name", "start").select("name", "first", "end")
    ddl = RECORD_DDL + (", payload binary" if with_payload else "")
    return dealt.mapInArrow(_read(folder, with_payload), ddl)


def listed(spark: SparkSession, folder: str) -> DataFrame:
    """The archives in a folder, as ``read_archives`` takes them, written by anyone."""
    store, path = fs.FileSystem.from_uri(folder)
    found = store.get_file_info(fs.FileSelector(path))
    rows = [(f.base_name, f.size) for f in found if f.is_file and f.base_name.endswith(".warc.gz") and f.base_name[0] != "."]
    return spark.createDataFrame(rows, "name string, n_bytes bigint")
