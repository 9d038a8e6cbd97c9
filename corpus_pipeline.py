"""A corpus pipeline of the text operators: each stage takes the documents its predecessor kept, written and read again.

STAGES has (name, function) pairs; a function takes (spark, docs, sf_dir) and returns a frame. In every stage a null text counts as
empty, null ids come last where ids decide, repeated rows are rows like any other, columns beside id and text travel along whatever
their names, and an empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskloom.llm import content_sort, harmonic, quality_embed, secret_links, simhash_similar
from riskloom.llm.common import read
from riskloom.session import discard, shared_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go; without usable labels none does."""
    return quality_embed.accepted(docs, quality_embed.train(docs, read(spark, sf_dir, "labels")))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the smallest id stays; of rows that repeat id and text, one."""
    return content_sort.without_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts that share four fifths of their five-word shingles stays: the smallest id's. All texts
    without words are one group. SimHash fingerprints are joined in tries, the exact similarity confirms their links."""
    return simhash_similar.one_of_each(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are cut out of the texts; every document stays, a null text as it is."""
    return secret_links.redacted(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences; the last stage. A text without tokens is a piece of its end id."""
    return harmonic.packed(docs)


STAGES = [("quality", quality), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup), ("secrets", secrets), ("packing", packing)]

#: Tokens, fingerprints and learned weights are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs, older = read(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        path = shared_path(spark, f"pipeline-{name}")
        kept = stage(spark, docs, sf_dir)
        kept.write.parquet(path)
        docs = spark.read.schema(kept.schema).parquet(path)
        if older:
            discard(spark, older)  # the table before it is no longer read
        older = path
    return STAGES[-1][1](spark, docs, sf_dir)
