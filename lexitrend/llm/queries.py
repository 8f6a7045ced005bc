"""The registered queries of this subpackage and their DuckDB SQL, where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (bpe_codec, chat_format, decontaminate, importance_resampling, license_scan, merkle_manifest, near_dup,
               packing, quality_classifier, quality_rules, secret_scan, substring_dup, warc_bundle)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_chat_format": chat_format.op1,
    "op2_secret_scan": secret_scan.op2,
    "op3_decontaminate": decontaminate.op3,
    "op4_warc_bundle": warc_bundle.op4,
    "op5_quality_rules": quality_rules.op5,
    "op6_quality_classifier": quality_classifier.op6,
    "op7_substring_dup": substring_dup.op7,
    "op8_near_dup": near_dup.op8,
    "op9_license_scan": license_scan.op9,
    "op10_bpe_codec": bpe_codec.op10,
    "op11_packing": packing.op11,
    "op12_merkle_manifest": merkle_manifest.op12,
    "op13_importance_resampling": importance_resampling.op13,
}

ORACLE: dict[str, str] = {
    "op1_chat_format": chat_format.ORACLE,
    "op4_warc_bundle": warc_bundle.ORACLE,
    "op12_merkle_manifest": merkle_manifest.ORACLE,
    "op13_importance_resampling": importance_resampling.ORACLE,
}
