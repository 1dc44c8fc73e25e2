"""Corpus preparation: five stages over ``documents``, each one of the training-data operators.

1. language: documents whose language cannot be told go.
2. near_duplicates: of every group of near copies one document stays.
3. personal_data: identifiers and the terms that disclose them are replaced in the texts.
4. mixture: sources are brought to their target weights; a document appears once per epoch that takes it.
5. packing: documents become token pieces placed in sequences of 4,096 tokens.

Every stage works on all that its predecessor kept, and all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerproof.llm import langid, mixing, packing, pii, simhash
from ledgerproof.llm.common import table
from ledgerproof.session import materialize_at, remove_path


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.identified(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_each(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.sanitised(docs, everywhere=True)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.digest(docs)


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("mixture", mixture),
    ("packing", pack),
]

#: Hashing, language models and tokenizers have no SQL; tests compare the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table, each written as Parquet and read again by the next.

    The last stage has read its input when it returns (it writes its pieces first), so the stages' tables can go."""
    docs, made = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES[:-1]:
        docs, path = materialize_at(stage(spark, docs, sf_dir), f"llm-stage-{name}")
        made.append(path)
    packed = STAGES[-1][1](spark, docs, sf_dir)
    for path in made:
        remove_path(spark, path)
    return packed
