"""The registered queries: each applies its operator, with production
parameters, to the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import oracles
from .alignment import alignment
from .byte_bpe import ByteBpe
from .common import table
from .divergence import source_divergence
from .host_quality import host_quality
from .packing import pack, packed_digest
from .secret_scan import find_secrets
from .simhash import simhash_groups
from .token_counts import token_counts
from .token_files import ids_digest, token_files
from .toxicity import toxicity
from .url_alias import judge_urls
from .warc import archives
from .winnow import contamination


def op1_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return contamination(docs, items).drop("digest")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_digest(pack(table(spark, sf_dir, "documents")))


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ids_digest(token_files(table(spark, sf_dir, "documents")))


def op4_url_aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"))


def op5_host_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return host_quality(table(spark, sf_dir, "documents"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(table(spark, sf_dir, "documents"), width=4, distance=4)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))


def op9_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_secrets(table(spark, sf_dir, "documents"))


def op10_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archives(table(spark, sf_dir, "pages"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment(table(spark, sf_dir, "documents"))


def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ByteBpe(spark).round_trip(table(spark, sf_dir, "documents"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_benchmark_decontamination": op1_benchmark_decontamination,
    "op2_packing": op2_packing,
    "op3_token_files": op3_token_files,
    "op4_url_aliases": op4_url_aliases,
    "op5_host_quality": op5_host_quality,
    "op6_simhash": op6_simhash,
    "op7_toxicity": op7_toxicity,
    "op8_token_counts": op8_token_counts,
    "op9_secret_scans": op9_secret_scans,
    "op10_warc_revisits": op10_warc_revisits,
    "op11_token_alignment": op11_token_alignment,
    "op12_byte_bpe": op12_byte_bpe,
    "op13_source_divergence": op13_source_divergence,
}

ORACLES: dict[str, str] = {
    "op1_benchmark_decontamination": oracles.CONTAMINATION,
    "op4_url_aliases": oracles.URL_VERDICTS,
    "op5_host_quality": oracles.HOST_QUALITY,
    "op10_warc_revisits": oracles.WARC_RECORDS,
    "op13_source_divergence": oracles.DIVERGENCE,
}
