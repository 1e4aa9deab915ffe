"""From raw documents to encoded training text: language, near-duplicates, personal data, mix, encoding.

Every stage takes (spark, docs, sf_dir) and works on all its predecessor kept; all but the last return the
columns of ``documents``.  A stage's result is written as Parquet and read again by the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ecometrics.llm import bpe, language, mixing, privacy, simhash
from ecometrics.llm.common import documents
from ecometrics.llm.queries import tokenizer_path
from ecometrics.session import settle


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without letters, and texts unlike every learned language, go."""
    return language.reject(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: SimHash fingerprints of four-word shingles at most four bits apart connect documents."""
    return simhash.keep_first(docs)


def remove_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and what discloses it give way to the name of their kind."""
    return privacy.sanitise(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A document appears as often as its source's target takes it."""
    return mixing.take(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.encode(docs, tokenizer_path("word_bpe_49k.json"))


STAGES = [
    ("language ID", identify_language),
    ("near-duplicates", drop_near_duplicates),
    ("personal data", remove_personal_data),
    ("mix", mix_sources),
    ("encoding", encode),
]

#: Groups of near copies and merges can't be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = settle(docs, name.replace(" ", "-"))
    return docs
