"""Corpus pipeline: documents in, token counts and digests of the mixed corpus out.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written and read back as the
next stage's documents. All but the last return the columns of the documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tapeline.llm.bpe import encode_documents
from tapeline.llm.common import stored
from tapeline.llm.jaccard import one_of_each_group
from tapeline.llm.line_dedup import dedup_lines
from tapeline.llm.mixing import mixed_documents
from tapeline.llm.queries import WORD_BPE
from tapeline.llm.toxicity import without_toxic

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted to be toxic go; the others stay as they are."""
    return without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated passages go from the texts; every document stays, if with less text."""
    return dedup_lines(docs, counts=False)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: five-word shingles, Jaccard 0.8 or more."""
    return one_of_each_group(docs, n=5, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded texts."""
    return encode_documents(docs, WORD_BPE, digests=True)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("jaccard_join", drop_near_duplicates),
    ("mixing", mix_sources),
    ("bpe", encode),
]

# Stages learn, hash and tokenise in ways that SQL cannot express; tests hold them against plain
# Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents in `sf_dir`."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
