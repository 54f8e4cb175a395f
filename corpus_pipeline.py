"""From raw documents to packed sequences: each stage works on all rows that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cueforge.llm import jaccard_join, mixing, packing, quality, spans
from cueforge.llm.store import Store, fields, whole_row

#: SQL can't express the stages (numeric learning, hashing, tokenizers); tests/llm compares them with brute force.
ORACLE_SQL = None


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go; null texts are judged as empty ones, repeated rows alike."""
    return quality.accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies one row stays: the one with the smallest doc_id (null after all others), then text hash.

    Rows alike in doc_id and text are one document, of which one row stays, blank ones too.
    """
    key = F.xxhash64(F.col("doc_id").isNull(), "doc_id", F.col("text").isNull(), "text")
    classes = jaccard_join.jaccard_classes(spark, docs.select(key.alias("doc_id"), "text"))
    classes = classes.groupBy(F.col("doc_id").alias("_key")).agg(F.min("component_id").alias("class"))
    rank = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("th"), key.alias("_key"))
    ranks = docs.select(key.alias("_key"), rank.alias("rank")).groupBy("_key").agg(F.min("rank").alias("rank"))
    keep = classes.join(ranks, "_key").groupBy("class").agg(F.min("rank").alias("rank")).select("rank._key")
    rows = docs.select(key.alias("_key"), whole_row(docs).alias("row")).join(keep, "_key", "left_semi").dropDuplicates(["_key"])
    return rows.select(*fields("row", docs.columns))


def span_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated passages are cut out; a document that nothing is left of goes, one that was null or blank stays.

    n_chars follows the text where docs has it. Rows alike in doc_id and text stay or go together.
    """
    rest = docs.drop("doc_id", "text")
    clean = spans.deduplicated(spark, docs.select("doc_id", "text", whole_row(rest).alias("rest")) if rest.columns else docs)
    clean = clean.where((F.col("n_removed") == 0) | (F.trim("text") != ""))
    new = {c: F.col(c) for c in ("doc_id", "text")}
    if "n_chars" in docs.columns:
        length = F.length(F.coalesce("text", F.lit(""))).cast(docs.schema["n_chars"].dataType)
        new["n_chars"] = F.when(F.col("n_removed") > 0, length).otherwise(F.col("rest.n_chars"))
    return clean.select(*fields("rest", docs.columns, **new))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources are repeated or thinned to their target weights; null and blank texts have no words to take and go."""
    return mixing.repeated(docs, mixing.mixed(spark, docs))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in sequences of 4,096; a null text is one end id, repeated rows are packed each."""
    import public_tokenizers

    return packing.packed(spark, docs, public_tokenizers.path("word_bpe_49k.json"), end_id=2)


STAGES = [
    ("quality classifier", quality_stage),
    ("n-gram Jaccard join", near_duplicate_stage),
    ("substring dedup", span_stage),
    ("mixing sources to target weights", mixing_stage),
    ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each is written and read again, but for the last."""
    store, docs = Store(spark, "pipeline"), spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = store.save(docs, f"stage{i}")
    return docs
