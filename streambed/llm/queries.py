"""The registered queries of this subpackage: query N applies operator N to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from streambed.llm.chat import chat_digest
from streambed.llm.codes import codes_digest
from streambed.llm.decontaminate import decontamination_digest
from streambed.llm.fingerprints import fingerprint_edits
from streambed.llm.merkle import manifest_digest
from streambed.llm.mixing import mixing_digest
from streambed.llm.ngram_join import near_duplicates
from streambed.llm.oracles import ORACLES
from streambed.llm.packing import packing_digest
from streambed.llm.quality import quality_digest
from streambed.llm.shared import table
from streambed.llm.sharding import sharding_digest
from streambed.llm.suffix_dedup import repeats_digest
from streambed.llm.toxicity import toxicity_digest
from streambed.llm.warc import warc_digest


def tokenizer_path(name: str = "byte_bpe_50k.tiktoken") -> str:
    """The installed vocabulary file, the same on every executor; its ids are those of byte_bpe_50k.json."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats_digest(table(spark, sf_dir, "documents"))


def op4_minhash_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_edits(table(spark, sf_dir, "documents"))


def op5_packing(spark: SparkSession, sf_dir: str, tokenizer: str = "") -> DataFrame:
    return packing_digest(table(spark, sf_dir, "documents"), tokenizer or tokenizer_path())


def op6_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_digest(table(spark, sf_dir, "pages"))


def op7_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_digest(table(spark, sf_dir, "conversations"))


def op8_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination_digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_kd_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding_digest(table(spark, sf_dir, "documents"))


def op11_cover_tree_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes_digest(table(spark, sf_dir, "embeddings"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest_digest(table(spark, sf_dir, "documents"))


def op13_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing_digest(table(spark, sf_dir, "documents"))


__all__ = ["ORACLES", "QUERIES", "tokenizer_path"]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_quality": op2_quality,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_minhash_fingerprints": op4_minhash_fingerprints,
    "op5_packing": op5_packing,
    "op6_warc_index": op6_warc_index,
    "op7_chat_formatting": op7_chat_formatting,
    "op8_ngram_jaccard_join": op8_ngram_jaccard_join,
    "op9_benchmark_decontamination": op9_benchmark_decontamination,
    "op10_kd_sharding": op10_kd_sharding,
    "op11_cover_tree_codes": op11_cover_tree_codes,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_source_mixing": op13_source_mixing,
}
