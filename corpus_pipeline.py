"""The training-data pipeline: stages over ``documents``, each written as Parquet and reread.

Defined results, by stage.  Quality rules: null and empty texts, and texts of fewer than 20 words, go; rows
without an id, repeated rows and very long texts are judged like any other, by their whole text.  Near
duplicates: of each group one row stays, the one with the smallest id (rows without an id last, then by
text), so of repeated rows one; texts without words are linked with nothing.  Decontamination and secrets:
null and empty texts stay as they are; repeated rows are judged one by one.  Encoding: null text is empty.
All columns but the text (and n_chars where a secret was masked) are carried along unread, whatever their
names; an empty table gives an empty result at every stage.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from lexitrend.llm import bpe_codec, decontaminate, near_dup, quality_rules, secret_scan
from lexitrend.llm.common import remove, scratch
from lexitrend.session import checkpoint_path
from lexitrend.sources.tables import table


def rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.quality_filter(docs, table(spark, sf_dir, "labels"))


def near_dup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return near_dup.one_of_each(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, every secret in their texts masked."""
    return secret_scan.redact(docs, secret_scan.fit(docs))


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, the number of tokens, and digests of the ids and of the text decoded from them."""
    return bpe_codec.encode_decode(docs, ("n_tokens", "ids_sha256", "decoded_sha256"))


STAGES = [
    ("quality_rules", rules_stage),
    ("near_dup", near_dup_stage),
    ("decontaminate", decontamination_stage),
    ("secret_scan", secret_stage),
    ("bpe_codec", bpe_stage),
]

#: Fitted models and sketches can't be expressed in SQL; tests/llm holds run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's rows are written and reread as the next one's docs.  What a stage
    wrote on its way, and its input, are removed once its rows are written."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        path = checkpoint_path(spark, f"pipeline-{name}-{uuid.uuid4().hex}")
        with scratch(spark):
            out = stage(spark, docs, sf_dir)
            out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
        if before:
            remove(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
