"""Harmonic packing of documents' token ids into sequences of fixed capacity.

Class k holds pieces of at most capacity // k ids, and each of its sequences holds exactly k pieces. A document is
cut into whole sequences first, then into up to `cuts` pieces that are exactly as long as a class allows; what is left
goes to the class that it fits, so hardly a place stays empty.

Workers cut and classify independently. A piece's number in its class is its number in its worker's share plus the
counts of earlier workers' shares (a table of workers times classes), so classes fill their sequences without moving
or sorting pieces. The pieces that would start an incomplete sequence, fewer than k of each class and so a bounded
number at any input size, are packed best-fit into shared sequences by one task.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cueforge.llm import tokens
from cueforge.llm.memory import lean
from cueforge.llm.store import Store

CAPACITY, CUTS = 4096, 2


def cut(n: int, capacity: int = CAPACITY, cuts: int = CUTS) -> list[tuple[int, int]]:
    """(length, class) of each piece of a document of n ids."""
    out = [(capacity, 1)] * (n // capacity)
    n %= capacity
    while n and cuts:
        k = -(-capacity // n)  # the least k with capacity // k <= n, or one less than it
        if capacity // k > n:
            k += 1
        out.append((capacity // k, k))
        n -= capacity // k
        cuts -= 1
    if n:
        out.append((n, capacity // n))
    return out


def _pieces(path: str, end_id: int, capacity: int, cuts: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, counts = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        known: dict[int, list[tuple[int, int]]] = {}
        for batch in batches:
            rows = []
            for doc, x in zip(batch.column(0).to_pylist(), tokens.encode(batch.column(1), path), strict=True):
                n, at = len(x) + 1, 0
                data = memoryview(np.append(x, np.uint32(end_id)).astype("<u4").tobytes())
                for size, k in known.get(n) or known.setdefault(n, cut(n, capacity, cuts)):
                    rows.append((part, k, int(counts[k]), doc, at, size, zlib.crc32(data[4 * at : 4 * (at + size)]), n))
                    counts[k] += 1
                    at += size
            yield pa.record_batch([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)] if rows else [pa.array([], pa.int64())] * 8, names=_NAMES)

    return scan


_NAMES = ["part", "class", "nth", "doc_id", "start", "length", "ids_crc32", "doc_tokens"]


def _rest(capacity: int):
    def pack(table: pa.Table) -> pa.Table:
        """The incomplete sequences' pieces, longest first, each into the fullest sequence with room."""
        size, first = table["length"].to_numpy(), table["first_id"][0].as_py() if len(table) else 0
        order = np.lexsort((table["start"].to_numpy(), table["doc_id"].to_numpy(zero_copy_only=False), -size))
        room, seq, offset = np.zeros(0, np.int64), np.zeros(len(size), np.int64), np.zeros(len(size), np.int64)
        used = 0
        for i in order:
            fits = np.where(room[:used] >= size[i], room[:used], capacity + 1)
            j = int(np.argmin(fits)) if used else 0
            if not used or fits[j] > capacity:
                if used == len(room):
                    room = np.r_[room, np.full(max(64, used), capacity)]
                j, used = used, used + 1
            seq[i], offset[i] = first + j, capacity - room[j]
            room[j] -= size[i]
        return table.drop_columns(["first_id"]).append_column("sequence_id", pa.array(seq)).append_column("offset", pa.array(offset))

    return pack


def packed(spark: SparkSession, docs: DataFrame, path: str, end_id: int = 2, capacity: int = CAPACITY, cuts: int = CUTS) -> DataFrame:
    """One row for each piece of docs (doc_id, text).

    doc_id, start (ids of its document before it), length, ids_crc32, doc_tokens (with the end id), sequence_id,
    offset (in the sequence), class, and padded_length: the sequence's length with padding, which is the capacity, or
    what it holds where that is a power of two. Null texts are only an end id; rows that share a doc_id, or have none,
    are packed as documents of their own; an empty table gives no rows.
    """
    store = Store(spark, "packing")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    pieces = store.save(texts.mapInArrow(lean(_pieces(path, end_id, capacity, cuts)), "part long, class long, nth long, doc_id long, start long, length long, ids_crc32 long, doc_tokens long"), "pieces")
    shares = pieces.groupBy("part", "class").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("class").orderBy("part")) - F.col("n")
    total = F.sum("n").over(Window.partitionBy("class"))
    shares = store.save(shares.select("part", "class", before.alias("before"), total.alias("total")), "shares")
    # at most `capacity` classes, so this window is over a bounded table
    full = shares.groupBy("class").agg(F.floor(F.first("total") / F.col("class")).cast("long").alias("full"))
    full = full.select("class", "full", (F.sum("full").over(Window.orderBy("class")) - F.col("full")).alias("first_id"), F.sum("full").over(Window.partitionBy()).alias("all_full"))
    placed = pieces.join(shares.select("part", "class", "before"), ["part", "class"]).join(F.broadcast(full), "class")
    placed = placed.withColumn("number", F.col("before") + F.col("nth")).withColumn("bin", F.floor(F.col("number") / F.col("class")))
    placed = store.save(placed.drop("part", "nth", "before"), "placed")
    keep = [c for c in _NAMES if c not in ("part", "nth")]
    whole = placed.where("bin < full").withColumn("sequence_id", F.col("first_id") + F.col("bin"))
    order = Window.partitionBy("sequence_id").orderBy("number")
    whole = whole.select(*keep, "sequence_id", (F.sum("length").over(order) - F.col("length")).alias("offset"))
    rest = placed.where("bin >= full").select(*keep, F.col("all_full").alias("first_id"))
    kinds = ", ".join(f"{c} long" for c in [*keep, "sequence_id", "offset"])
    rest = rest.groupBy().applyInArrow(_rest(capacity), kinds)
    held = F.sum("length").over(Window.partitionBy("sequence_id"))
    out = whole.unionByName(rest).withColumn("held", held)
    power = F.col("held").bitwiseAND(F.col("held") - 1) == 0
    return out.withColumn("padded_length", F.when(power, F.col("held")).otherwise(F.lit(capacity))).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "class", "padded_length")
