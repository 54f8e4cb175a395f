"""Threshold-scaled document sketches in DataFrame functions only.

A text's shingles are its runs of five words (lower-cased; a shorter text is one run). The sketch keeps every shingle
hash in the lowest 1 / SCALE of the hash range, so its size follows the document's and sketches of very unequal documents
stay comparable: they merge by union, and the share of one that the other has estimates containment.

A sketch is struct(n, total, kept): the set's size, the exclusive or of all its hashes, and the kept hashes, sorted. Where two
sketches keep nothing, n and total still tell equal sets from others. Null and blank texts have an empty set.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SCALE_BITS, WIDTH, BOUNDS = 2, 5, 4000


def sketch(text: Column, width: int = WIDTH, scale_bits: int = SCALE_BITS) -> Column:
    """The sketch of a text column."""
    words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    hashes = F.transform(words, lambda w: F.xxhash64(w))
    runs = F.transform(
        F.filter(F.array(hashes), lambda h: F.size(h) > 0),
        lambda h: F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.size(h) - (width - 1))), lambda i: F.xxhash64(F.slice(h, i, width)))),
    )
    every = F.coalesce(F.get(runs, F.lit(0)), F.array().cast("array<bigint>"))
    made = F.transform(
        F.array(every),
        lambda r: F.struct(
            F.size(r).alias("n"),
            F.aggregate(r, F.lit(0).cast("long"), lambda a, x: a.bitwiseXOR(x)).alias("total"),
            F.array_sort(F.filter(r, lambda x: F.shiftrightunsigned(x, 64 - scale_bits) == 0)).alias("kept"),
        ),
    )
    return F.get(made, F.lit(0))


def as_text(s: Column) -> Column:
    """A sketch as a string: size, total and kept hashes in hexadecimal."""
    kept = F.transform(s["kept"], lambda x: F.lpad(F.hex(x), 16, "0"))
    return F.concat_ws("-", s["n"].cast("string"), F.lpad(F.hex(s["total"]), 16, "0"), F.array_join(kept, ""))


def _same(a: Column, b: Column) -> Column:
    return F.coalesce((a["n"] == b["n"]) & (a["total"] == b["total"]), F.lit(False))


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity, 0 to 1; 1 for equal sets."""
    both = F.size(F.array_intersect(a["kept"], b["kept"]))
    either = F.size(a["kept"]) + F.size(b["kept"]) - both
    return F.when(_same(a, b), 1.0).when(either > 0, both / either).otherwise(0.0)


def containment(a: Column, b: Column) -> Column:
    """Estimated share of a's shingles that b has, 0 to 1; 1 for equal sets and for an empty a."""
    both = F.size(F.array_intersect(a["kept"], b["kept"]))
    return F.when(_same(a, b) | (a["n"] == 0), 1.0).when(F.size(a["kept"]) > 0, both / F.size(a["kept"])).otherwise(0.0)


def merge(a: Column, b: Column, scale_bits: int = SCALE_BITS) -> Column:
    """The sketch of both documents together: what either keeps. Its n is estimated from that, and it has no total."""
    kept = F.array_sort(F.array_union(a["kept"], b["kept"]))
    n = F.greatest(a["n"], b["n"], F.size(kept) * (1 << scale_bits))
    return F.struct(n.alias("n"), F.lit(None).cast("long").alias("total"), kept.alias("kept"))


def _nested(bounds: list[int], key: Column) -> Column:
    """How many of the ascending bounds lie below key, looked up in two steps."""
    if not bounds:
        return F.lit(0)
    side = math.isqrt(len(bounds)) + 1
    rows = [bounds[i : i + side] for i in range(0, len(bounds), side)]
    text = lambda xs: f"cast(split('{','.join(map(str, xs))}', ',') as array<bigint>)"
    heads = F.expr(text([r[0] for r in rows]))
    row = F.greatest(F.lit(0), F.size(F.filter(heads, lambda b: b < key)) - 1)
    parts = F.expr(f"transform(split('{';'.join(','.join(map(str, r)) for r in rows)}', ';'), x -> cast(split(x, ',') as array<bigint>))")
    return row * side + F.size(F.filter(F.get(parts, row), lambda b: b < key))


def with_next(spark: SparkSession, docs: DataFrame, *carried: str) -> DataFrame:
    """docs (doc_id, text, n_chars and carried columns) with next_text and next_<carried>: the next row's in descending doc_id.

    After the last row comes the first. Rows are cut into ranges of doc_id at approximate quantiles, each ordered alone;
    the first row of each range also goes to the end of the range before, so no range needs another. Rows that
    share a doc_id are ordered by text, and null doc_ids go last.
    """
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)))
    ids = docs.select(key.alias("k"))
    n = min(BOUNDS, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    shares = ", ".join(f"{i / n:.6f}D" for i in range(1, n))
    found = ids.agg(F.expr(f"approx_percentile(k, array({shares}), 100000)").alias("q")).first()["q"]
    bounds = sorted(set(found or []))
    place = _nested(bounds, F.col("k"))
    firsts = sorted(ids.select("k", place.alias("b")).groupBy("b").agg(F.max("k").alias("k")).collect(), reverse=True)  # one row a range
    to = {r["k"]: firsts[i - 1]["b"] for i, r in enumerate(firsts)}  # the range before; the first's goes after the last
    extra = F.create_map(*(F.lit(x) for kv in to.items() for x in kv))[F.col("k")] if to else F.lit(None).cast("int")
    rows = docs.withColumn("k", key).withColumn("b", place.cast("int"))
    goes = F.when(extra.isNull(), F.array(F.struct(F.col("b").alias("b"), F.lit(0).alias("copy")))).otherwise(F.array(F.struct(F.col("b").alias("b"), F.lit(0).alias("copy")), F.struct(extra.cast("int").alias("b"), F.lit(1).alias("copy"))))
    rows = rows.withColumn("go", F.explode(goes)).withColumn("b", F.col("go.b")).withColumn("copy", F.col("go.copy")).drop("go")
    order = Window.partitionBy("b").orderBy("copy", F.col("k").desc(), F.xxhash64("text"))
    for c in ("text", *carried):
        rows = rows.withColumn(f"next_{c}", F.lead(c).over(order))
    return rows.where("copy = 0").drop("k", "b", "copy")


def compared(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Fingerprints of docs (doc_id, text) and of their edited texts, and how alike they are.

    The edited text has the last floor(n_chars / 3) characters replaced by the first as many, or all, of the next document.
    Returns doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next (Jaccard estimates), and
    contained_edited, contained_next: the estimated share of the document's shingles that the other text has.
    Null texts count as empty; rows that share a doc_id follow each other by a hash of the text, rows without one come last; repeated
    rows get rows of their own; an empty table gives no rows; extra columns are ignored.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    texts = texts.withColumn("own", sketch(F.col("text")))
    rows = with_next(spark, texts, "own")
    n = F.length("text")
    rows = rows.withColumn("edited", F.expr("concat(substring(text, 1, length(text) - cast(floor(length(text) / 3) as int)), substring(next_text, 1, cast(floor(length(text) / 3) as int)))"))
    rows = rows.select("doc_id", n.cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"), "own", "next_own", sketch(F.col("edited")).alias("changed"))
    own, changed, following = F.col("own"), F.col("changed"), F.col("next_own")
    return rows.select(
        "doc_id", "n_chars", "edited_sha256", as_text(own).alias("fingerprint"), as_text(changed).alias("edited_fingerprint"),
        likeness(own, changed).alias("near_edited"), likeness(own, following).alias("near_next"),
        containment(own, changed).alias("contained_edited"), containment(own, following).alias("contained_next"),
    )
