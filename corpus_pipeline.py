"""The corpus pipeline: quality, exact copies, near copies, mixture, packing.

Each stage takes what its predecessor kept, written as Parquet in the shared folder and read again, so that a lost
executor costs one stage's partitions at most. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from rankflow.llm.exact_dedup import drop_copies
from rankflow.llm.mixing import repeat_mixed
from rankflow.llm.ngram_join import drop_similar
from rankflow.llm.packing import pack
from rankflow.llm.quality import keep_quality
from rankflow.sources.workspace import stored

TOKENIZER = "word_bpe_49k.json"


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; word vectors come from these documents, labels from the table."""
    return keep_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, the one with the largest id."""
    return drop_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by a Jaccard similarity of 0.8 or more, the one with the smallest id."""
    return drop_similar(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture of sources uses them: every one at least once."""
    return repeat_mixed(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of token ids, one for each piece of a document."""
    return pack(docs, public_tokenizers.path(TOKENIZER))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("exact_copies", exact_copies),
    ("near_copies", near_copies),
    ("mixture", mixture),
    ("packing", packing),
]

#: The classifier, the bands and the tokenizer are beyond SQL; tests/llm/test_pipeline.py has the brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
