"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

import functools
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidelog.llm import alignment, decontaminate, language_id, license_scan, media, mixing, periodic_runs, secret_scan, sharding, simhash, token_ids, url_filter, warc
from tidelog.llm.common import bound_batches, table


def op1_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.url_report(table(spark, sf_dir, "pages"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.warc_round_trip(spark, table(spark, sf_dir, "pages"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_report(table(spark, sf_dir, "documents"))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_report(table(spark, sf_dir, "documents"))


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secret_digest(table(spark, sf_dir, "documents"))


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.language_report(table(spark, sf_dir, "documents"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(table(spark, sf_dir, "documents"))


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = media.encode_media(table(spark, sf_dir, "documents"))
    return media.decode_media(stored).drop("clips")


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_report(table(spark, sf_dir, "documents"))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.alignment_report(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


def op12_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_ids.token_report(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), vocabulary=49_408, end_id=2)


def op13_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.run_report(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {
        "op1_urls": op1_urls,
        "op2_warc": op2_warc,
        "op3_simhash": op3_simhash,
        "op4_sharding": op4_sharding,
        "op5_secrets": op5_secrets,
        "op6_language": op6_language,
        "op7_mixing": op7_mixing,
        "op8_decontaminate": op8_decontaminate,
        "op9_media": op9_media,
        "op10_licenses": op10_licenses,
        "op11_alignment": op11_alignment,
        "op12_token_ids": op12_token_ids,
        "op13_runs": op13_runs,
    }
    return {name: bounded(make) for name, make in found.items()}


def bounded(make: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """The query, in a session that sends texts to Python a few megabytes at a time."""

    @functools.wraps(make)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        bound_batches(spark)
        return make(spark, sf_dir)

    return run


def oracle_sql() -> dict[str, str]:
    return {"op2_warc": warc.oracle(), "op4_sharding": sharding.oracle(), "op10_licenses": license_scan.oracle()}
