"""The registered queries opN_<name> and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cueforge.llm import fingerprint, jaccard_join, media, mixing, packing, pitman_yor, quality, repair, spans, url_filter


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pitman_yor.scored(spark, _documents(spark, sf_dir))


def op2_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    return spans.deduplicated(spark, docs)


def op3_scaled_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.compared(spark, _documents(spark, sf_dir))


def op4_quality_qda(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classified(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_classes(spark, _documents(spark, sf_dir))


def op6_water_filling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(spark, _documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


def op7_url_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judged(spark, spark.read.parquet(f"{sf_dir}/pages.parquet"))


def _vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op8_repair_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.encoded(spark, _documents(spark, sf_dir), _vocabulary(), end_id=1)


def op9_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(spark, _documents(spark, sf_dir), _vocabulary(), end_id=2)


def op10_iso_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.stored(_documents(spark, sf_dir))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_pitman_yor": op1_pitman_yor,
        "op2_sentence_spans": op2_sentence_spans,
        "op3_scaled_sketch": op3_scaled_sketch,
        "op4_quality_qda": op4_quality_qda,
        "op5_jaccard_join": op5_jaccard_join,
        "op6_water_filling": op6_water_filling,
        "op7_url_cascade": op7_url_cascade,
        "op8_repair_ids": op8_repair_ids,
        "op9_harmonic_packing": op9_harmonic_packing,
        "op10_iso_media": op10_iso_media,
    }


def oracle_sql() -> dict[str, str]:
    return {"op7_url_cascade": url_filter.ORACLE}
