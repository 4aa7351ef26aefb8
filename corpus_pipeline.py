"""The corpus pipeline: quality classifier, line dedup, n-gram Jaccard join, mixing, BPE encoding.

Each stage takes (spark, docs, sf_dir), works on all that the stage before it kept, and is written as Parquet.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from promolens.llm import bpe, jaccard, lines, mixing, quality
from promolens.llm.common import table, written


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return quality.kept(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of templates that an earlier document holds go; so do documents of which nothing else is left."""
    return lines.cleaned(docs)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays (five words, 0.8)."""
    return jaccard.distinct_documents(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole documents as often as the mix takes them, in its order."""
    return mixing.sequence(docs)


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document's ids, and the digests of the ids and of the text that they decode to."""
    return bpe.encoded(docs, ids=True)


STAGES = [
    ("quality classifier", quality_classifier),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", jaccard_join),
    ("mixing sources to target weights", source_mix),
    ("BPE encoding and decoding", bpe_encoding),
]

#: The classifier and the tokenizer are beyond SQL; tests/llm checks the stages on a small folder, line dedup by properties only.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
