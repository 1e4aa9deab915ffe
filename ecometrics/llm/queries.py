"""The operators applied to the whole ``documents`` table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ecometrics.llm import (
    bpe, language, lm, mixing, order_minhash, privacy, quality, repeats, secrets, simhash, spelling, token_counts, vector_codes,
)
from ecometrics.llm.common import documents, prepared
from ecometrics.session import input_bytes, tune


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(documents(spark, folder))


def op2_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.encode(documents(spark, folder), tokenizer_path("word_bpe_49k.json"))


def op3_repeats(spark: SparkSession, folder: str) -> DataFrame:
    return repeats.remove_repeats(documents(spark, folder))


def op4_language(spark: SparkSession, folder: str) -> DataFrame:
    return language.identify(documents(spark, folder))


def op5_order_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return order_minhash.fingerprint(documents(spark, folder))


def op6_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.judge(documents(spark, folder))


def op7_privacy(spark: SparkSession, folder: str) -> DataFrame:
    return privacy.find(documents(spark, folder))


def op8_lm(spark: SparkSession, folder: str) -> DataFrame:
    return lm.score(documents(spark, folder))


def op9_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, folder))


def op10_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.count_tokens(documents(spark, folder), tokenizer_path("byte_bpe_50k.json"))


def op11_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    path = f"{folder}/embeddings.parquet"
    tune(prepared(spark), input_bytes(spark, path))
    return vector_codes.compress(spark.read.parquet(path))


def op12_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.scan(documents(spark, folder))


def op13_spelling(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.group_variants(documents(spark, folder))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mixing": op1_mixing,
    "op2_bpe": op2_bpe,
    "op3_repeats": op3_repeats,
    "op4_language": op4_language,
    "op5_order_minhash": op5_order_minhash,
    "op6_quality": op6_quality,
    "op7_privacy": op7_privacy,
    "op8_lm": op8_lm,
    "op9_simhash": op9_simhash,
    "op10_token_counts": op10_token_counts,
    "op11_vector_codes": op11_vector_codes,
    "op12_secrets": op12_secrets,
    "op13_spelling": op13_spelling,
}

SQL: dict[str, str] = {"op1_mixing": mixing.SQL, "op11_vector_codes": vector_codes.SQL}
