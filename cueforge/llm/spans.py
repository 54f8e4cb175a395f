"""Substring dedup over sliding sentence spans.

Texts are cut into sentences (after `.`, `!`, `?` and white space, and after line ends), and sentences of more than `LONG` words
into pieces: before each word whose hash is the smallest (the last of equal ones) of some `WINDOW` consecutive words of the
sentence, so that places of cuts depend on few words around them and no piece has more than `WINDOW` words. Two kinds of spans
are hashed, lower-cased and without regard to white space: from each piece on, pieces until there are `span_words` words; and
every run of `run` consecutive sentences with at least `least_words` words. The hashes are joined over all documents, and a
piece goes if a span that covers it is not the first of its kind, by doc_id, then place. What stays is joined as it stood.

Any two passages of 51 words or more that are alike share a span, wherever they stand in their sentences. Up to LONG words of
the first and of the last sentence may be cut in one text and not in the other; 51 - 2 LONG = span_words are left for the span. In
long sentences cuts are the same but for WINDOW - 1 words at either end: LONG + span_words + 2 WINDOW - 1 is no more than 51.

Finding repeated hashes is a grouped count with partial aggregation, so a passage in a third of all documents is no hot group;
finding their spans is a join on the hash, whose repeated side is a written table of one row for each hash and whose other side
adaptive execution can split. Texts are shuffled once, to meet their marks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cueforge.llm.memory import lean, release
from cueforge.llm.store import ROWS, Store, fields, rows_at_once, whole_row
from cueforge.llm.words import _power, buffers, mix, pieces, word_spans

RUN, LEAST_WORDS, SPAN_WORDS, LONG, WINDOW = 3, 15, 19, 16, 8
PIECE = 1 << 20
_END = np.zeros(256, bool)
_END[[33, 46, 63]] = True
_LINE = np.zeros(256, bool)
_LINE[[10, 13]] = True
_CUT = "struct<text: string, n_sentences: int, removed: array<int>>"


def _cuts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the words of lower-cased texts, the texts' offsets in them, the first words of sentences and of pieces."""
    h, first, last, at = word_spans(data, offsets)
    n = len(h)
    new = np.zeros(n, bool)
    if n:
        new[1:] = _END[data[last[:-1] - 1]] | _LINE[data[first[1:] - 1]]
        new[at[:-1][np.diff(at) > 0]] = True
    starts = np.flatnonzero(new)
    sizes = np.diff(np.r_[starts, n])
    left = np.repeat(starts + sizes, sizes) - np.arange(n)  # words to the sentence's end
    lo = np.flatnonzero(np.repeat(sizes > LONG, sizes) & (left >= WINDOW))
    if len(lo):
        low, place = h[lo + WINDOW - 1], lo + WINDOW - 1
        for k in range(WINDOW - 2, -1, -1):
            other = h[lo + k]
            less = other < low
            low, place = np.where(less, other, low), np.where(less, lo + k, place)
        new[place] = True
    return h, at, starts, np.flatnonzero(new)


def _spans(data: np.ndarray, offsets: np.ndarray, run: int, least_words: int, span_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text, first word in it, number of words and hash of each span."""
    h, at, starts, parts = _cuts(data, offsets)
    n = len(h)
    doc = np.repeat(np.arange(len(at) - 1), np.diff(at))
    bounds = np.r_[parts, n]
    lo = parts[parts + span_words <= at[doc[parts] + 1]] if n else parts
    hi = bounds[np.searchsorted(bounds, lo + span_words)]
    grown = np.full(n + 1, -1, np.int64)
    grown[lo] = hi
    ends = np.r_[starts, n]
    a, b = starts[: max(0, len(starts) + 1 - run)], ends[run:]
    keep = (b <= at[doc[a] + 1]) & (b - a >= least_words) & (grown[a] != b)
    lo, hi = np.r_[lo, a[keep]], np.r_[hi, b[keep]]
    up, down = _power(n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(h * up[:n], out=total[1:])
    return doc[lo], lo - at[doc[lo]], hi - lo, mix((total[hi] - total[lo]) * down[lo] + (hi - lo).astype(np.uint64))


def _scan(run: int, least_words: int, span_words: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, _, _ in pieces(batch.column(2), PIECE):
                data, offsets = buffers(pc.utf8_lower(batch.column(2).slice(first, end - first)))
                doc, start, size, h = _spans(data, offsets, run, least_words, span_words)
                for k in range(0, len(doc), 1 << 15):
                    own = slice(k, k + (1 << 15))
                    ids = batch.slice(first, end - first).select([0, 1]).take(pa.array(doc[own]))
                    place = start[own] << 31 | size[own]
                    yield pa.record_batch([*ids.columns, pa.array(place), pa.array(h[own].view(np.int64))], names=["id", "th", "place", "hash"])

    return scan


def _without(text: pa.Array, marks: pa.Array) -> pa.Array:
    """What stays of texts without the spans marked, the number of pieces, and the places of those that went."""
    out = []
    for first, end, own, where in pieces(text, PIECE):
        _, at, _, parts = _cuts(*buffers(pc.utf8_lower(text.slice(first, end - first))))
        _, begin, _, same = word_spans(own, where)
        assert np.array_equal(at, same)
        cut = np.searchsorted(parts, at)
        for d, found in enumerate(marks.slice(first, end - first)):
            mine = parts[cut[d] : cut[d + 1]] - at[d]
            if not found.is_valid:
                out.append((None, max(1, len(mine)), []))
                continue
            place = np.asarray(found.values, np.int64)
            start, size = place >> 31, place & (1 << 31) - 1
            depth = np.zeros(at[d + 1] - at[d] + 1, np.int64)
            np.add.at(depth, start, 1)
            np.add.at(depth, start + size, -1)
            gone = np.cumsum(depth)[mine] > 0
            edges = np.r_[where[d], begin[at[d] + mine[1:]], where[d + 1]]
            stays = b"".join(own[edges[j] : edges[j + 1]].tobytes() for j in np.flatnonzero(~gone))
            out.append((stays.decode(), len(mine), np.flatnonzero(gone).tolist()))
    kept, number, removed = zip(*out, strict=True) if out else ((), (), ())
    fields = [pa.array(kept, pa.string()), pa.array(number, pa.int32()), pa.array(removed, pa.list_(pa.int32()))]
    if len(text) > 1000:
        release()
    return pa.StructArray.from_arrays(fields, ["text", "n_sentences", "removed"])


def deduplicated(spark: SparkSession, docs: DataFrame, run: int = RUN, least_words: int = LEAST_WORDS, span_words: int = SPAN_WORDS) -> DataFrame:
    """docs (doc_id, text, any others) with repeated passages cut out of text, and n_sentences, n_removed, removed.

    n_sentences counts the pieces, which are sentences but for long ones; removed: the places (from 0) of the pieces that
    went. A text that nothing is cut from stays as it is, a null one null. Rows alike in doc_id and text are one document
    to this operator: none is a repetition of another. Null doc_ids come before all others. Columns of docs with the
    names of the results are replaced.
    """
    docs = docs.drop("n_sentences", "n_removed", "removed")
    store = Store(spark, "spans")
    rows = docs.select(F.col("doc_id").alias("id"), F.xxhash64("text").alias("th"), F.coalesce("text", F.lit("")).alias("text"), whole_row(docs).alias("row"))
    schema = T.StructType([T.StructField("id", docs.schema["doc_id"].dataType), *(T.StructField(c, T.LongType()) for c in ("th", "place", "hash"))])
    with rows_at_once(spark, ROWS):
        spans = store.save(rows.select("id", "th", "text").mapInArrow(lean(_scan(run, least_words, span_words)), schema), "spans")
    often = store.save(spans.groupBy("hash").agg(F.count("*").alias("k")).where("k > 1").select("hash"), "often")
    repeated = store.save(spans.join(often, "hash"), "repeated")
    first = store.save(repeated.groupBy("hash").agg(F.min(F.struct("id", "th", "place")).alias("first")), "first")
    again = repeated.join(first, "hash").where(~F.struct("id", "th", "place").eqNullSafe(F.col("first")))
    marks = again.groupBy(F.col("id").alias("marked"), F.col("th").alias("marked_th")).agg(F.collect_set("place").alias("marks"))
    marks = store.save(marks, "marks")
    store.drop("spans", "often", "repeated", "first")
    kept = rows.join(marks, F.col("marked").eqNullSafe(F.col("id")) & (F.col("marked_th") == F.col("th")), "left")
    cutter = F.arrow_udf(_without, _CUT).asNondeterministic()  # so that a filter on its result doesn't make Spark call it twice
    kept = kept.select("row", "marks", cutter("text", "marks").alias("cut"))
    text = F.when(F.col("marks").isNotNull(), F.col("cut.text")).otherwise(F.col("row.text"))
    return kept.select(*fields("row", docs.columns, text=text), F.col("cut.n_sentences").alias("n_sentences"), F.size("cut.removed").alias("n_removed"), F.col("cut.removed").alias("removed"))
