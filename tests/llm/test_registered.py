"""The registered queries and the pipeline over the small tables."""

import hashlib
import zlib

import public_tokenizers
import pytest
import tiktoken
from compare import connect, differences
from test_index_operators import plain_classes, plain_fingerprint
from test_text_operators import plain_base, plain_contaminated, plain_counts, plain_line_dedup
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from demandgrid.llm import bpe, queries

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    return dict(map(tuple, rows))


@pytest.fixture(scope="module")
def found(spark):
    return {name: query(spark, SMALL).collect() for name, query in queries.QUERIES.items()}


def test_all_are_registered():
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries())
    assert set(queries.ORACLE) <= set(entry.oracle_sql())
    assert {int(n[2:].split("_")[0]) for n in queries.QUERIES} == set(range(1, 14))


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_queries_equal_sql(spark, name):
    assert differences(queries.QUERIES[name](spark, SMALL), connect(SMALL), queries.ORACLE[name]) == []


def test_leaks(spark, found, texts):
    items = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    got = {(r.doc_id, r.item_id) for r in found["op1_spaced_seeds"]}
    assert got == plain_contaminated(texts.items(), items)
    assert {(i, j) for i, t in texts.items() for j, b in items if b in t} <= got


def test_components(found, texts):
    ids = sorted(texts)
    values = [plain_fingerprint(texts[i]) for i in ids]
    classes = plain_classes(values)
    want = {(i, f"{v:016x}", ids[c]) for i, v, c in zip(ids, values, classes, strict=True)}
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in found["op2_gray_index"]} == want


def test_token_files(found, texts):
    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer, start = Tokenizer.from_file(path), 0
    rows = {r.doc_id: r for r in found["op4_addressable_codes"]}
    for i in sorted(texts):
        ids = [*tokenizer.encode(texts[i], add_special_tokens=False).ids, 2]
        crc = zlib.crc32(b"".join(x.to_bytes(4, "little") for x in ids))
        assert (rows[i].start, rows[i].n_tokens, rows[i].ids_crc32) == (start, len(ids), crc)
        start += len(ids)


def test_shards(found, texts):
    rows = found["op6_virtual_slots"]
    shards = {}
    for r in rows:
        raw = texts[r.doc_id].encode()
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(raw) + 8, zlib.crc32(raw), "bytes", None)
        shards.setdefault(r.shard, []).append(r.slot)
    assert len(rows) == len(texts) and set(shards) <= set(range(24))
    assert all(sorted(s) == list(range(len(s))) for s in shards.values())


def test_secrets_and_quality(found, texts):
    for r in found["op8_character_network"]:
        base = plain_base(texts[r.doc_id])
        listed = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert r.base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(
            sum(k == kind for k, _, _ in base) for kind in ("assign", "access", "hex")
        )
        assert set(listed.split(",")) <= set(r.spans.split(","))
    for r in found["op9_likelihood_ratio"]:
        assert (
            r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed
        ) == plain_counts(texts[r.doc_id])
        assert not (r.base_failed and r.kept)


def test_every_stage_works_on_all_that_its_predecessor_kept(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    given = {r.doc_id: r.text for r in docs.collect()}
    out = []
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SMALL)
        rows = docs.collect()
        docs = spark.createDataFrame(rows, docs.schema)
        out.append(rows)
    good, lines, apart, clean, encoded = out
    assert good and all(given[r.doc_id] == r.text for r in good)
    assert not any(plain_counts(r.text)[-1] for r in good)
    want = plain_line_dedup([(r.doc_id, r.text) for r in good])
    assert {(r.doc_id, r.text) for r in lines} == {(i, t) for i, t, _, _ in want}
    assert all(r.n_chars == len(r.text) for r in lines)
    ordered = sorted(lines, key=lambda r: r.doc_id)
    classes = plain_classes([plain_fingerprint(r.text) for r in ordered])
    first = {ordered[c].doc_id for c in classes}
    assert {r.doc_id for r in apart} == first
    items = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    gone = {r.doc_id for r in apart} - {r.doc_id for r in clean}
    assert gone <= {i for i, _ in plain_contaminated([(r.doc_id, r.text) for r in apart], items)}
    assert not any(b in r.text for r in clean for _, b in items)
    ranks = bpe.read_ranks(public_tokenizers.path(corpus_pipeline.RANK_FILE))
    encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    kept = {r.doc_id: r.text for r in clean}
    assert len(encoded) == len(kept)
    for r in encoded:
        ids = encoding.encode_ordinary(kept[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.decoded_sha256 == hashlib.sha256(kept[r.doc_id].encode()).hexdigest()
