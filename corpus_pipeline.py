"""The corpus pipeline: cleaned, non-toxic, distinct documents packed into training sequences.

Each stage is (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame, which ``run`` writes as Parquet to the shared folder and
rereads as the next stage's docs.

Defined results: null, empty and short texts are rejected by the quality rules;
without labelled documents of both kinds no document is toxic; of copies and
repeated rows the smallest id stays (a null id comes last); a document with a
null id is kept like any other; empty tables give no rows; columns of documents
that stages use as names of their own pass untouched, but for the packing stage,
which returns its own columns only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from voltway.llm import common, dart_minhash, line_rules, packing, toxicity


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Failing lines go, then documents that are too short, repetitive or lost too much text."""
    return line_rules.cleaned(docs)


def nontoxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labelled ones among them, finds toxic go."""
    return toxicity.without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class stays: the one with the smallest id."""
    return dart_minhash.deduplicated(docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their places in sequences of at most 2048 tokens."""
    return packing.packed(docs)


STAGES = [("quality", quality), ("toxicity", nontoxic), ("near_dedup", distinct), ("packing", sequences)]

#: SQL can't express the stages (fitted models, signatures, tokenizers); tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    common.importable(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = common.written(stage(spark, docs, sf_dir), name)
    return docs
