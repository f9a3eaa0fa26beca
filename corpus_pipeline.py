"""The corpus pipeline: documents in, encoded documents out, in stages.

Each stage works on the whole table that its predecessor kept, which is written as Parquet
and read again in between, so that a lost executor costs one stage.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandgrid.llm import bpe, decontaminate, linededup, quality, simhash
from demandgrid.llm.common import table
from demandgrid.sources.staging import staged

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
RANK_FILE = "byte_bpe_multi_50k.tiktoken"


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the rules reject goes."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.passed(docs, model).select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that three documents or more share stay in the largest id only."""
    left = linededup.without_repeated_lines(docs, min_chars=20, min_docs=3)
    return left.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates, the document with the smallest id stays."""
    return simhash.representatives(docs, shingle=3, max_bits=3).select(*COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a benchmark passage go."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark")).select(*COLUMNS)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and checksums of the ids and of the text decoded from them."""
    ranks = bpe.read_ranks(public_tokenizers.path(RANK_FILE))
    return bpe.round_trip(docs.select("doc_id", "text"), ranks, public_tokenizers.PATTERN).drop("text")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("near dedup", near_dedup),
    ("decontamination", decontamination),
    ("encoding", encoding),
]
#: Fitted weights, SimHash and BPE are beyond SQL; the stages are tested by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
