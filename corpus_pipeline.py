"""The corpus pipeline: documents through five stages, each written and read again."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tickerlark.llm import bpe, langid, minhash, mixing, pii
from tickerlark.llm.queries import MIX, PII_KEY, WEIGHTS, domains
from tickerlark.llm.scratch import stored, table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can't be told (no text, no letter, hardly any confidence) go."""
    return langid.keep_identified(docs, langid.train(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, 0.8) stays."""
    return minhash.drop_near_duplicates(docs, minhash.NearDup())


def replace_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in texts is replaced; no document goes."""
    return pii.replace_pii(docs, pii.Pii(PII_KEY)).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are kept at rates that bring the domains' tokens to their weights."""
    return mixing.mixed_documents(docs, domains(table(spark, sf_dir, "labels")), WEIGHTS, MIX)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of each text."""
    return bpe.encode_documents(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("pii", replace_pii),
    ("mixing", mix_sources),
    ("encoding", encode),
]
#: No SQL for the trained models and the merges; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; the rows of the last."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
