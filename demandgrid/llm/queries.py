"""The registered queries of the training-data operators, and their SQL counterparts."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from pathlib import Path

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from demandgrid.llm import (
    bpe,
    convtrie,
    decontaminate,
    htmlmodel,
    licences,
    linededup,
    periodic,
    quality,
    secrets,
    sharding,
    simhash,
    tokenfiles,
    warc,
)
from demandgrid.llm.common import table
from demandgrid.session import ensure_checkpoint_dir
from demandgrid.sources.staging import staged

SHARDS = 24
WORD_FILE = "word_bpe_49k.json"
END_ID = 2
RANK_FILE = "byte_bpe_multi_50k.tiktoken"


def op1_spaced_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that holds a benchmark passage, with the item and the best stretch."""
    docs, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontaminate.contaminated(docs, benchmark)


def op2_gray_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_bits=3)


def op3_recursive_merges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded again."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ranks = bpe.read_ranks(public_tokenizers.path(RANK_FILE))
    return bpe.round_trip(docs, ranks, public_tokenizers.PATTERN).drop("text")


def _listed(spans: Column) -> Column:
    """kind:start:end of every span, with commas between them."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


def op8_character_network(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The secrets of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secrets.findings(docs, secrets.train(docs)).drop("text")

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    # Spans in order of their start, then of their kind as listed.
    rank = F.create_map(*[F.lit(x) for n, k in enumerate(secrets.KINDS) for x in (k, n)])
    every = F.transform(
        F.sort_array(
            F.transform(
                F.concat("base", "added"),
                lambda s: F.struct(s["start"].alias("at"), rank[s["kind"]].alias("rank"), s.alias("s")),
            )
        ),
        lambda x: x["s"],
    )
    return found.select(
        "doc_id",
        *map(count, secrets.KINDS[:3]),
        F.sha2(_listed(F.col("base")), 256).alias("base_sha256"),
        _listed(every).alias("spans"),
    )


def op7_two_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that many share."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    left = linededup.without_repeated_lines(docs, min_chars=20, min_docs=3)
    return left.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op4_addressable_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document written to token files and read back."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    description = Path(public_tokenizers.path(WORD_FILE)).read_text(encoding="utf-8")
    folder = f"{ensure_checkpoint_dir(spark)}/tokens-{uuid.uuid4().hex}"
    files = tokenfiles.write_tokens(docs, folder, description, END_ID)
    return tokenfiles.read_tokens(spark, folder, files)


def op5_tree_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return htmlmodel.extracted(pages, htmlmodel.fit(htmlmodel.labelled_pages()))


def op6_virtual_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in one of 24 shards of nearly equal bytes."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    crc = F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32")
    slotted = staged(
        sharding.with_virtual_slots(docs).select("doc_id", "size", crc, "virtual_slot"), "slots"
    )
    shard_map = sharding.new_map(sharding.slot_loads(slotted), SHARDS)
    placed = sharding.assign(slotted, shard_map, ("doc_id", "text_crc32"))
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "virtual_slot",
        "map_version",
    )


def op9_likelihood_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.judged(docs, model).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "score",
    )


def op10_paragraph_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every paragraph that may state a licence, with the family."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return licences.scanned(docs, licences.fit(docs))


def op11_dyadic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The periodic runs of every document, a tenth of them made periodic."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = periodic.with_runs(periodic.with_planted_runs(docs)).drop("text")
    order = F.array_max(
        F.transform(
            "runs",
            lambda r: F.struct(
                r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period")
            ),
        )
    )
    listed = F.array_join(
        F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))),
        "",
    )
    most = found.withColumns({"most": order, "listed": listed})
    return most.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("most.start")).alias("start"),
        F.col("most.length").alias("length"),
        (-F.col("most.period")).alias("period"),
        F.expr("1000 * most.length div -most.period").alias("exponent_milli"),
        F.sha2("listed", 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_burst_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the trie of conversations, some of which share their first turns."""
    turns = convtrie.turns_of(table(spark, sf_dir, "conversations"))
    return convtrie.trie(convtrie.with_shared_leads(turns))


def op13_split_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to web archives and read back."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    folder = f"{ensure_checkpoint_dir(spark)}/warc-{uuid.uuid4().hex}"
    files = warc.write_archives(pages, folder)
    records = warc.read_archives(spark, folder, files, with_payload=False)

    def page(column: str) -> Column:
        return F.regexp_extract(column, "^<urn:page:(-?[0-9]+)>$", 1)

    return records.select(
        page("record_id").try_cast("bigint").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        page("refers_to").try_cast("bigint").alias("refers_to"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_spaced_seeds": op1_spaced_seeds,
    "op2_gray_index": op2_gray_index,
    "op3_recursive_merges": op3_recursive_merges,
    "op4_addressable_codes": op4_addressable_codes,
    "op5_tree_model": op5_tree_model,
    "op6_virtual_slots": op6_virtual_slots,
    "op7_two_filters": op7_two_filters,
    "op8_character_network": op8_character_network,
    "op9_likelihood_ratio": op9_likelihood_ratio,
    "op10_paragraph_classifier": op10_paragraph_classifier,
    "op11_dyadic_runs": op11_dyadic_runs,
    "op12_burst_trie": op12_burst_trie,
    "op13_split_archives": op13_split_archives,
}
#: Line dedup in SQL. The white space of the contract, and A-Z.
LINE_DEDUP = """
WITH lines AS (
  SELECT doc_id, place, line,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS place
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents))),
shared AS (
  SELECT key, max(doc_id) AS keeper FROM lines WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3)
SELECT l.doc_id, count(*) AS n_lines,
       count(*) FILTER (WHERE s.keeper <> l.doc_id) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place)
                       FILTER (WHERE s.keeper IS NULL OR s.keeper = l.doc_id), '')) AS kept_sha256
FROM lines l LEFT JOIN shared s USING (key)
GROUP BY l.doc_id
"""
#: The trie in SQL, on whole prefixes. CRC-32 is worked out bit by bit: 3988292384 is its
#: fixed polynomial.
TRIE = r"""
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
           sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS place
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
  SELECT DISTINCT conv_id, conv_id - conv_id % 20 AS base,
         xor(list_reduce([4294967295] || list_transform(range(1, length(conv_id::VARCHAR) + 1),
               lambda i: ascii((conv_id::VARCHAR)[i])::BIGINT),
               lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0],
                 lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) % 4 AS h
  FROM turns),
rebuilt AS (
  SELECT c.conv_id, place, role, text FROM convs c JOIN turns t ON t.conv_id = c.base AND place <= h
  UNION ALL
  SELECT c.conv_id, place + 1000000000, role, text FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND place > h),
numbered AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY place) AS depth,
         sha256(length(role) || ':' || role || text) AS turn,
         len(list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda w: w <> '')) AS words
  FROM rebuilt),
paths AS (
  SELECT conv_id, depth, words,
         string_agg(turn, '') OVER (PARTITION BY conv_id ORDER BY depth) AS path
  FROM numbered
  UNION ALL SELECT conv_id, 0, 0, '' FROM convs),
lengths AS (SELECT conv_id, max(depth) AS turns FROM paths GROUP BY conv_id),
nodes AS (
  SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
         (count(*) - 1) * any_value(words) AS saved,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE turns = depth), '')) AS ends
  FROM paths JOIN lengths USING (conv_id) GROUP BY path, depth),
linked AS (
  SELECT n.*, p.conv_id AS parent_conv_id, coalesce(k.children, 0) AS children
  FROM nodes n
  LEFT JOIN nodes p ON p.path = n.path[:length(n.path) - 64] AND n.depth > 0 AND p.depth = n.depth - 1
  LEFT JOIN (SELECT path[:length(path) - 64] AS path, count(*) AS children FROM nodes WHERE depth > 0 GROUP BY 1) k
    ON k.path = n.path),
above AS (
  SELECT path[:64 * up] AS path, count(*) FILTER (WHERE children = 0) AS n_leaves, sum(saved)::BIGINT AS saved_tokens
  FROM (SELECT path, children, saved, unnest(range(0, depth + 1)) AS up FROM linked) GROUP BY 1)
SELECT conv_id, depth, parent_conv_id, n_convs, children AS n_children, n_leaves, saved_tokens, ends AS ends_sha256
FROM linked JOIN above USING (path)
"""
#: Web archives in SQL: what a reader gives back.
ARCHIVES = """
WITH payloads AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
         sha256(coalesce(html, '')) AS payload_digest
  FROM pages),
firsts AS (
  SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) END AS first
  FROM payloads)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first IS NULL OR page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS NULL OR page_id <> first THEN first END AS refers_to
FROM firsts
"""
ORACLE: dict[str, str] = {
    "op7_two_filters": LINE_DEDUP,
    "op12_burst_trie": TRIE,
    "op13_split_archives": ARCHIVES,
}
