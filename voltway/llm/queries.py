"""The queries ``opN_<name>``: each applies its operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from voltway.llm import common, dart_minhash, hilbert_codes, hmm_lm, host_trust, license_scan, line_rules, multiprobe, packing, prefix_trie, quality_ftrl, token_files, toxicity, trie_bpe


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    common.importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_hmm_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log10 probability of every text of documents under a hidden Markov model."""
    return hmm_lm.scored(table(spark, sf_dir, "documents"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity score of every text of documents."""
    return toxicity.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_dart_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate class of every document."""
    return dart_minhash.classified(table(spark, sf_dir, "documents"))


def op4_host_trust(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules, then host trust against distrust, for every url of pages."""
    return host_trust.filtered_urls(table(spark, sf_dir, "pages"))


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's token ids through files."""
    return token_files.round_trip(table(spark, sf_dir, "documents"))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and notices in every text of documents."""
    return license_scan.scanned(table(spark, sf_dir, "documents"))


def op7_trie_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text of documents encoded over a trie of its words, and decoded."""
    return trie_bpe.digests(table(spark, sf_dir, "documents"))


def op8_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line-first cleaning of every text of documents."""
    return line_rules.judged(table(spark, sf_dir, "documents"))


def op9_multiprobe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every twentieth vector, against all vectors of embeddings."""
    return multiprobe.nearest(table(spark, sf_dir, "embeddings"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in sequences of at most 2048 tokens."""
    return packing.packed(table(spark, sf_dir, "documents"))


def op11_quality_ftrl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality score of every text of documents."""
    return quality_ftrl.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prefix trie of all rebuilt conversations."""
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))


def op13_hilbert_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product codes of every vector of embeddings."""
    return hilbert_codes.compressed(table(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_hmm_lm, op2_toxicity, op3_dart_minhash, op4_host_trust, op5_token_files, op6_license_scan, op7_trie_bpe, op8_line_rules, op9_multiprobe, op10_packing, op11_quality_ftrl, op12_prefix_trie, op13_hilbert_codes)}


def oracle_sql() -> dict[str, str]:
    return {"op12_prefix_trie": prefix_trie.trie_sql(), "op13_hilbert_codes": hilbert_codes.compressed_sql()}
