"""The queries of this subpackage, by name, with their SQL where there is any."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ._jobs import read, scratch
from .chat_rotation import perspectives
from .decontaminate import contamination
from .language_id import identify
from .line_dedup import FUZZY_CHARS, THRESHOLD, line_classes
from .minhash_dedup import near_duplicates
from .packing import pack
from .quality_rules import quality
from .sql import ORACLE
from .token_files import checksums, read_tokens, write_tokens
from .toxicity import toxicity
from .url_filter import judged


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The links of the SQL; the operator's own limits, which grow with the length, are those of the pipeline."""
    return line_classes(read(spark, sf_dir, "documents"), threshold=THRESHOLD, fuzzy_chars=FUZZY_CHARS, by_bytes=True).drop("h")


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark)
    write_tokens(read(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"), path)
    return checksums(read_tokens(spark, path))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))


def op4_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(read(spark, sf_dir, "documents"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(read(spark, sf_dir, "documents"))


def op8_chat_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return perspectives(read(spark, sf_dir, "conversations"))


def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(read(spark, sf_dir, "pages"))


def queries() -> dict:
    every = (op1_line_dedup, op2_token_files, op3_packing, op4_minhash_dedup, op5_toxicity, op6_quality_rules, op7_language_id, op8_chat_rotation, op9_benchmark_decontamination, op10_url_filter)
    return {f.__name__: f for f in every}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
