"""Web archives: round trips, ranges of any size, nested and damaged members."""

import gzip
import hashlib
import random
import zlib

import pytest

from demandgrid.llm import queries, warc

PAGES = "page_id bigint, url string, html string"


def digest(text):
    return hashlib.sha256((text or "").encode()).hexdigest()


def made(rng, n):
    copies = ["x" * 99, "y" * 100, "é" * 50, "z" * 5000]
    rows = []
    for k in range(n):
        words = "".join(rng.choice("abcdefgh <p>\n") for _ in range(rng.randrange(9000)))
        html = rng.choice([None, "", words, words, *copies])
        rows.append((k, rng.choice([None, "", f"http://h/{k}?a=%20", "http://h/\r\nX: 1"]), html))
    rng.shuffle(rows)
    return rows


def wanted(rows):
    first = {}
    for i, _, html in rows:
        if len((html or "").encode()) >= 100 and i is not None:
            first[html] = min(i, first.get(html, i))
    for i, _, html in rows:
        leader = first.get(html)
        revisit = leader is not None and leader != i
        yield (i, len((html or "").encode()), digest(html), "revisit" if revisit else "response", leader if revisit else None)


@pytest.mark.parametrize("split", [150, 4096, 1 << 20])
def test_round_trip(spark, tmp_path, split):
    rows = made(random.Random(split), 120)
    folder = f"file://{tmp_path}/warc"
    files = warc.write_archives(spark.createDataFrame(rows, PAGES).repartition(3), folder, file_bytes=60_000)
    assert files.agg({"n_records": "sum"}).first()[0] == len(rows)
    out = warc.read_archives(spark, folder, files, split).collect()
    page = {r.record_id: int(r.record_id[len("<urn:page:") : -1]) for r in out}
    got = [
        (page[r.record_id], r.payload_bytes, r.payload_digest, r.record_type, page.get(r.refers_to)) for r in out
    ]
    assert sorted(got) == sorted(wanted(rows))
    given = {i: (u, h) for i, u, h in rows}
    for r in out:
        url, html = given[page[r.record_id]]
        assert r.target_uri == (url and url.replace("\r", "%0D").replace("\n", "%0A"))
        assert r.payload == (None if r.record_type == "revisit" else (html or "").encode())


def test_null_and_repeated_ids(spark, tmp_path):
    rows = [(None, "u", "a" * 200), (5, "u", "a" * 200), (5, "u", "a" * 200), (7, None, "a" * 200), (None, None, "b" * 200)]
    folder = f"file://{tmp_path}/warc"
    files = warc.write_archives(spark.createDataFrame(rows, PAGES), folder)
    out = warc.read_archives(spark, folder, files).collect()
    assert sorted((r.record_type, r.refers_to or "", len(r.payload or b"")) for r in out) == [
        ("response", "", 200), ("response", "", 200), ("response", "", 200),
        ("revisit", "<urn:page:5>", 0), ("revisit", "<urn:page:5>", 0),
    ]


def test_empty_table_and_further_columns(spark, tmp_path):
    folder = f"file://{tmp_path}/warc"
    none = spark.createDataFrame([], PAGES + ", digest string, first int")
    files = warc.write_archives(none, folder)
    assert files.count() == 0 and warc.read_archives(spark, folder, files).count() == 0
    more = spark.createDataFrame([(1, "u", "text", "mine", 3)], PAGES + ", digest string, first int")
    assert warc.read_archives(spark, folder, warc.write_archives(more, folder)).first().payload == b"text"


def record(name, block, kind="resource"):
    return warc._headed([("WARC-Type", kind), ("WARC-Record-ID", f"<{name}>")], block)


@pytest.mark.parametrize("split", [40, 333, 5000])
def test_archives_within_payloads_are_not_records(spark, tmp_path, split):
    """A stored member shows the members of the archive it holds to any scan."""
    inner = b"".join(warc._member(record(f"inner {k}", b"n" * k), 6) for k in range(40))
    stored = warc._member(record("outer", inner), 0)
    data = stored + b"".join(warc._member(record(f"late {k}", b"q" * 30 * k), 6) for k in range(9)) + stored
    (tmp_path / "a.warc.gz").write_bytes(data)
    folder = f"file://{tmp_path}"
    out = warc.read_archives(spark, folder, warc.listed(spark, folder), split).collect()
    assert sorted(r.record_id for r in out) == sorted(["<outer>", *(f"<late {k}>" for k in range(9)), "<outer>"])
    assert {r.payload for r in out if r.record_id == "<outer>"} == {inner}


def test_damage_costs_the_damaged_records_only(spark, tmp_path):
    members = [bytearray(warc._member(record(f"r{k}", random.Random(k).randbytes(900)), 6)) for k in range(30)]
    members[7][300] ^= 255
    members[20] = members[20][:200]
    data = b"junk" + b"".join(members[:12]) + b"\0" * 777 + warc.MAGIC + b"".join(members[12:]) + bytes(members[0][:90])
    (tmp_path / "b.warc.gz").write_bytes(data)
    (tmp_path / "c.warc.gz").write_bytes(gzip.compress(b"not an archive") + zlib.compress(b"x"))
    folder = f"file://{tmp_path}"
    for split in (100, 2500, 1 << 20):
        out = warc.read_archives(spark, folder, warc.listed(spark, folder), split).collect()
        assert sorted(r.record_id for r in out) == sorted(f"<r{k}>" for k in range(30) if k not in (7, 20))


def test_a_false_digest_is_an_error(spark, tmp_path):
    block = b"HTTP/1.1 200 OK\r\nContent-Length: 1\r\n\r\nx"
    told = [("WARC-Type", "response"), ("WARC-Payload-Digest", "sha256:00"), ("Content-Type", "application/http;msgtype=response")]
    (tmp_path / "d.warc.gz").write_bytes(warc._member(warc._headed(told, block), 6))
    folder = f"file://{tmp_path}"
    with pytest.raises(Exception, match="digest"):
        warc.read_archives(spark, folder, warc.listed(spark, folder)).collect()


def test_hot_payloads_reach_few_rows_of_the_join(spark, tmp_path):
    """The common and the rare way of finding the page that holds a payload agree."""
    rows = [(k, "u", f"{k % 3000:0200d}" if k % 2 else "h" * 300) for k in range(6000)]
    folder = f"file://{tmp_path}/warc"
    files = warc.write_archives(spark.createDataFrame(rows, PAGES), folder)
    out = warc.read_archives(spark, folder, files, with_payload=False).collect()
    got = {(int(r.record_id[10:-1]), r.record_type, r.refers_to and int(r.refers_to[10:-1])) for r in out}
    assert got == {(i, kind, to) for i, _, _, kind, to in wanted(rows)}


def test_query(spark):
    small = "/root/testdata/sf0.001"
    pages = [tuple(r) for r in spark.read.parquet(f"{small}/pages.parquet").select("page_id", "url", "html").collect()]
    out = queries.op13_split_archives(spark, small).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )
    assert sorted(map(tuple, out.collect()), key=str) == sorted(wanted(pages), key=str)
