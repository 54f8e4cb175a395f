"""Mixing sources to target weights by capped water-filling.

A source's target is its weight's share of the total, at most `epochs` times its size; what a cap cuts off is shared
again by weight among the others, until none is above its cap. Sources whose cap is a smaller multiple of their weight
fill first, so the fixed point is found in one ordered pass: with sources by cap / weight, those before the
first whose share of the rest fits under its cap are the capped ones.

A source then takes each document floor(target / size) whole times, and a fractional repetition for what is left:
documents in an order drawn from the seed are taken once more until the words suffice, the last of them in part.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cueforge.llm.store import Store, fields, whole_row

BUCKET_ROWS = 2000


def n_words(text: Column) -> Column:
    """The number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def water_fill(sources: DataFrame, epochs: float, weights: tuple[float, ...] = (5, 2, 1)) -> DataFrame:
    """(source, source_size, target) from (source, source_size): weights by code point of the source, null last.

    Both windows run over one row for each source. Targets add up to all sizes unless every source is at its cap.
    """
    by_name = Window.orderBy(F.col("source").cast("binary").asc_nulls_last())
    w = F.element_at(F.array(*(F.lit(float(x)) for x in weights)), ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    df = sources.withColumn("weight", w).withColumn("cap", F.col("source_size") * F.lit(float(epochs)))
    by_fill = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").cast("binary").asc_nulls_last())
    before = by_fill.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    df = df.withColumn("rest", F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
    df = df.withColumn("open", F.sum("weight").over(by_fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
    df = df.withColumn("level", F.col("rest") / F.col("open"))
    fits = F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct(F.row_number().over(by_fill).alias("turn"), "level"))
    df = df.withColumn("level", F.min(fits).over(everything)["level"])
    return df.select("source", "source_size", F.least("cap", F.coalesce(F.col("level") * F.col("weight"), F.col("cap"))).alias("target"))


def _which(docs: DataFrame) -> Column:
    """128 bits that tell a row from all rows that aren't wholly alike."""
    row = [x for c in docs.columns for x in (F.col(f"`{c}`").isNull(), F.col(f"`{c}`"))]
    return F.struct(F.xxhash64(*row).alias("a"), F.xxhash64(F.lit(1), *row).alias("b"))


def mixed(spark: SparkSession, docs: DataFrame, epochs: float = 3, weights: tuple[float, ...] = (5, 2, 1), seed: int = 20) -> DataFrame:
    """docs (doc_id, text, source and any others), with size, source_size, target and taken.

    taken: the words that the mix takes of the row, repeats counted, at most `epochs` times its size. Each source's
    taken words add up to its target, rounded. The order within a source is a hash of doc_id and seed: sums over hash buckets,
    then running sums inside one bucket, so a source of any size is spread over all tasks. A null source is a source of
    its own; empty texts take nothing; rows that share a doc_id are drawn together, but count one by one. The result also has
    which, a hash of the whole row, by which repeated() finds it. Extra columns are ignored, but for that hash.
    """
    store = Store(spark, "mixing")
    sized = docs.select("doc_id", "source", n_words(F.col("text")).alias("size"), F.xxhash64(F.col("doc_id").cast("string"), F.lit(seed)).alias("draw"), _which(docs).alias("which"))
    sized = store.save(sized, "sized")
    buckets = 1 << max(0, math.ceil(math.log2(max(1, sized.count()) / BUCKET_ROWS)))
    sized = sized.withColumn("bucket", F.shiftright(F.col("draw"), 40).bitwiseAND(buckets - 1))
    sums = store.save(sized.groupBy("source", "bucket").agg(F.sum("size").alias("words")), "sums")
    targets = water_fill(sums.groupBy("source").agg(F.sum("words").alias("source_size")), epochs, weights)
    targets = store.save(targets, "targets")
    before = F.sum("words").over(Window.partitionBy("source").orderBy("bucket")) - F.col("words")
    sums = sums.withColumn("before", before).alias("b").join(targets.alias("t"), F.col("b.source").eqNullSafe(F.col("t.source")))
    sums = sums.select(F.col("b.source").alias("s"), F.col("bucket").alias("k"), "before", "source_size", "target")
    whole = F.when(F.col("source_size") > 0, F.floor(F.round("target") / F.col("source_size"))).otherwise(F.lit(0))
    rows = sized.join(sums, F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("k")))
    inside = Window.partitionBy("s", "bucket").orderBy("draw", "doc_id", "which").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("earlier", F.col("before") + F.coalesce(F.sum("size").over(inside), F.lit(0)))
    left = F.round("target") - whole * F.col("source_size") - F.col("earlier")
    part = F.greatest(F.lit(0), F.least(F.col("size"), left))
    return rows.select("doc_id", "source", "which", "size", "source_size", "target", (whole * F.col("size") + part).cast("long").alias("taken"))


def repeated(docs: DataFrame, mix: DataFrame) -> DataFrame:
    """docs, each row as often as the mix takes it: whole repetitions, then the first words of a fractional one.

    mix is mixed() of the same docs. Rows that are alike in every column can't be told apart: they go on as one row that is
    repeated as often as all of them together, so the words taken stay exact. Null texts give no rows.
    """
    one = mix.groupBy(F.col("which").alias("of")).agg(F.max("size").alias("size"), F.sum("taken").alias("taken")).where("taken > 0")
    rows = docs.select(_which(docs).alias("which"), whole_row(docs).alias("row")).dropDuplicates(["which"])
    both = rows.join(one, F.col("which") == F.col("of"))
    text, over = F.col("row.text"), (F.col("taken") % F.col("size")).cast("int")
    lead = text.rlike(r"^[\x20\x09-\x0D]").cast("int")
    cut = F.call_function("split", text, F.lit(r"[\x20\x09-\x0D]+"), over + 1 + lead)
    both = both.select("row", F.floor(F.col("taken") / F.col("size")).cast("int").alias("whole"), F.when(over > 0, cut).alias("cut"))
    piece = F.expr("substring(row.text, 1, length(row.text) - length(element_at(cut, -1)))")
    turns = F.col("whole") + F.col("cut").isNotNull().cast("int")
    out = both.select("row", "whole", piece.alias("part"), F.explode(F.sequence(F.lit(1), turns)).alias("turn"))
    out = out.select("row", F.when(F.col("turn") > F.col("whole"), F.col("part")).otherwise(F.col("row.text")).alias("piece"))
    new = {"text": F.col("piece")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.length("piece").cast(docs.schema["n_chars"].dataType)
    return out.select(*fields("row", docs.columns, **new))
