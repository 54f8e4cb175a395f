"""Token-id files compressed by a pair grammar (Re-Pair), one grammar for each shard.

A shard holds whole documents, about SHARD_IDS ids of them. Each round counts all adjacent pairs of symbols (occurrences that overlap count
once), ranks those that occur twice or more by frequency, and replaces each occurrence that no better pair overlaps; a pair that would be
replaced only once waits. Rounds go on until no pair occurs twice: the best one is replaced wherever it stands, so each round makes progress,
and there is no limit on rounds, rules or symbols. Pairs never cross a document's end, so every document is a run of symbols of its own.
The first rounds leave rare pairs alone (see FLOORS), so that frequent ones shape the grammar. A shard's file is, in little-endian numbers:

    magic `CFR2`, then uint32: documents, rules, symbols, base (the first nonterminal), bytes of a symbol, bytes of a length
    int64 doc_id, uint32 ids, uint32 symbols       one of each for every document
    symbol pairs of the rules; length of each rule's expansion; symbols of all documents

A document is decoded alone from its symbols and the rules, and a slice of it without expanding the rest, by the lengths. A shard is one
binary value of a Parquet table, so that the files lie wherever Spark writes and survive lost executors.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cueforge.llm import tokens
from cueforge.llm.memory import lean
from cueforge.llm.store import Store

MAGIC, SHARD_IDS, PART_BYTES = b"CFR2", 1_000_000, 128 << 20
#: The least count of a pair that is replaced, by round; the last goes for all rounds after.
FLOORS = (64, 8, 2)


def _runs(key: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct keys, where each begins in the sorted order, and the places in that order."""
    bits = max(1, int(place[-1]).bit_length()) if len(place) else 1
    if int(key.max(initial=0)).bit_length() + bits <= 63:  # one sort of both together
        both = np.sort(key << np.int64(bits) | place)
        key, place = both >> np.int64(bits), both & np.int64((1 << bits) - 1)
    else:
        order = np.argsort(key, kind="stable")
        key, place = key[order], place[order]
    begin = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
    return key[begin], begin, place


def _chosen(seq: np.ndarray, live: np.ndarray, floor: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of the pairs to replace, the rule (from 0) at each, and the rules. Places whose pair occurs once are no longer live."""
    none = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, 2), np.int64)
    place = np.flatnonzero(live)
    if not len(place):
        return none
    top = np.int64(int(seq.max()) + 1)
    key = seq[place] * top + seq[place + 1]
    same = np.flatnonzero((key[1:] == key[:-1]) & (place[1:] == place[:-1] + 1))  # a pair of one symbol, overlapping itself
    if len(same):
        run = np.flatnonzero(np.r_[True, np.diff(same) > 1])
        odd = (np.arange(len(same)) - np.repeat(run, np.diff(np.r_[run, len(same)]))) % 2 == 0
        free = np.ones(len(place), bool)
        free[same[odd] + 1] = False
        key, place = key[free], place[free]
    keys, begin, place = _runs(key, place)
    count = np.diff(np.r_[begin, len(place)])
    live[place[begin[count == 1]]] = False
    often = np.flatnonzero(count >= floor)
    if not len(often):
        return none
    often = often[np.argsort(-count[often], kind="stable")]
    size = count[often]
    to = np.repeat(begin[often] - np.r_[0, np.cumsum(size)[:-1]], size) + np.arange(size.sum())
    rank = np.full(len(seq) + 2, len(often), np.int32)
    place, turn = place[to], np.repeat(np.arange(len(often), dtype=np.int32), size)
    rank[place + 1] = turn
    best = (turn < rank[place]) & (turn < rank[place + 2])
    used = np.bincount(turn[best], minlength=len(often))
    best &= used[turn] > 1
    number = np.cumsum(used > 1) - 1
    pairs = keys[often[used > 1]]
    return place[best], number[turn[best]], np.stack([pairs // top, pairs % top], 1)


def compress(ids: np.ndarray, ends: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols, their documents' ends among them, and the rules (pairs of symbols; rule r is symbol base + r).

    ids: all documents' ids; ends: each document's end among them, in order. A pair that occurs once never occurs twice
    later, unless one of its symbols is new: only places that may still repeat are live, and only these are sorted.
    """
    seq, rules, made, turn = ids.astype(np.int64), [np.zeros((0, 2), np.int64)], 0, 0
    open_, live = np.ones(len(seq) + 1, bool), np.ones(len(seq), bool)  # whether a pair may begin before, and at, a place
    open_[ends], open_[-1] = False, False
    live &= open_[1:]
    while True:
        floor = FLOORS[min(turn, len(FLOORS) - 1)]
        at, rule, new = _chosen(seq, live, floor)
        turn += 1
        if not len(at):
            if floor == FLOORS[-1]:
                break
            continue
        seq[at] = base + made + rule
        rules.append(new)
        made += len(new)
        keep = np.ones(len(seq), bool)
        keep[at + 1] = False
        live[at] = True
        live[at[at > 0] - 1] = True
        stay = np.flatnonzero(keep)
        ends = np.searchsorted(stay, ends)
        seq, live, open_ = seq[stay], live[stay], np.r_[open_[stay], False]
        live &= open_[1:]
    return seq, ends, np.concatenate(rules)


def expand(symbols: np.ndarray, rules: np.ndarray, base: int) -> np.ndarray:
    """The ids that symbols stand for."""
    seq = symbols.astype(np.int64)
    while len(at := np.flatnonzero(seq >= base)):
        size = np.ones(len(seq), np.int64)
        size[at] = 2
        place = np.cumsum(size) - size
        out = np.repeat(seq, size)
        pair = rules[seq[at] - base]
        out[place[at]], out[place[at] + 1] = pair[:, 0], pair[:, 1]
        seq = out
    return seq.astype(np.uint32)


def _levels(rules: np.ndarray, base: int) -> Iterator[tuple[int, int]]:
    """Ranges of rules that use only rules before the range."""
    most, done = rules.max(1) if len(rules) else np.zeros(0, np.int64), 0
    while done < len(rules):
        uses = np.flatnonzero(most[done:] >= base + done)
        stop = done + int(uses[0]) if len(uses) else len(rules)
        yield done, stop
        done = stop


def _lengths(rules: np.ndarray, base: int) -> np.ndarray:
    """Each rule's expanded length; a rule only uses earlier rules."""
    size = np.ones(base + len(rules), np.int64)
    for a, b in _levels(rules, base):
        size[base + a : base + b] = size[rules[a:b]].sum(1)
    return size[base:]


def _gather(table: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Runs of a table, one after the other."""
    end = np.cumsum(size)
    return table[np.repeat(start - (end - size), size) + np.arange(end[-1] if len(end) else 0)]


def _width(x: np.ndarray) -> int:
    """The fewest bytes that hold all of these numbers, 1 to 8."""
    return max(1, (int(x.max(initial=0)).bit_length() + 7) // 8)


def _packed(x: np.ndarray, width: int) -> bytes:
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]).tobytes()


def _unpacked(data: memoryview, width: int) -> np.ndarray:
    out = np.zeros((len(data) // width, 8), np.uint8)
    out[:, :width] = np.frombuffer(data, np.uint8).reshape(-1, width)
    return out.view("<i8").ravel()


def write_shard(doc_ids: list[int], docs: list[np.ndarray], base: int) -> bytes:
    """The file of a shard."""
    sizes = np.array([len(x) for x in docs], np.int64)
    ends = np.cumsum(sizes)
    symbols, cuts, rules = compress(np.concatenate([np.zeros(0, np.uint32), *docs]), ends, base)
    lengths = _lengths(rules, base)
    wide, long = max(_width(rules), _width(symbols)), _width(lengths)
    head = MAGIC + struct.pack("<6I", len(docs), len(rules), len(symbols), base, wide, long)
    return head + b"".join((np.array(doc_ids, "<i8").tobytes(), sizes.astype("<u4").tobytes(), np.diff(cuts, prepend=0).astype("<u4").tobytes(), _packed(rules.ravel(), wide), _packed(lengths, long), _packed(symbols, wide)))


class Shard:
    """A shard's file, opened: document i is decoded alone by ids(i)."""

    def __init__(self, data: bytes | memoryview):
        if bytes(data[:4]) != MAGIC:
            raise ValueError("not a token shard")
        n, r, m, self.base, wide, long = struct.unpack("<6I", data[4:28])
        self.doc_ids, self.sizes, runs = np.frombuffer(data, "<i8", n, 28), np.frombuffer(data, "<u4", n, 28 + 8 * n), np.frombuffer(data, "<u4", n, 28 + 12 * n)
        view, at = memoryview(data), 28 + 16 * n
        parts = []
        for count, width in ((2 * r, wide), (r, long), (m, wide)):
            parts.append(_unpacked(view[at : at + count * width], width))
            at += count * width
        self.rules, self.lengths, self.symbols = parts[0].reshape(r, 2), parts[1], parts[2]
        self.cuts = np.r_[0, np.cumsum(runs, dtype=np.int64)]

    def ids(self, i: int) -> np.ndarray:
        return expand(self.symbols[self.cuts[i] : self.cuts[i + 1]], self.rules, self.base)

    def all_ids(self) -> np.ndarray:
        """Every document's ids: rules are expanded once each, then copied to where they stand."""
        size = np.r_[np.ones(self.base, np.int64), self.lengths]
        start = np.r_[np.arange(self.base), self.base + np.cumsum(self.lengths) - self.lengths]
        table = np.zeros(self.base + self.lengths.sum(), np.uint32)
        table[: self.base] = np.arange(self.base)
        for a, b in _levels(self.rules, self.base):
            pair = self.rules[a:b].ravel()
            own = _gather(table, start[pair], size[pair])
            table[start[self.base + a] : start[self.base + a] + len(own)] = own
        return _gather(table, start[self.symbols], size[self.symbols])

    def slice(self, i: int, start: int, stop: int) -> np.ndarray:
        """Ids start to stop of document i; expands only the symbols that these reach into."""
        run = self.symbols[self.cuts[i] : self.cuts[i + 1]].astype(np.int64)
        size = np.ones(len(run), np.int64)
        size[run >= self.base] = self.lengths[run[run >= self.base] - self.base]
        end = np.cumsum(size)
        lo, hi = np.searchsorted(end, start, "right"), np.searchsorted(end, stop, "left") + 1
        skip = start - (end[lo - 1] if lo else 0)
        return expand(run[lo:hi], self.rules, self.base)[skip : skip + max(0, stop - start)]


def _writer(path: str, end_id: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, shard, base = TaskContext.get().partitionId(), 0, max(tokens.vocabulary(path), end_id + 1)
        doc_ids, docs, held = [], [], 0

        def flush() -> pa.RecordBatch:
            row = {"part": [part], "shard": [shard], "first_doc": [doc_ids[0]], "docs": [len(docs)], "ids": [held], "data": [write_shard(doc_ids, docs, base)]}
            return pa.RecordBatch.from_pydict(row, pa.schema([*((c, pa.int64()) for c in list(row)[:-1]), ("data", pa.binary())]))

        for batch in batches:
            for doc, x in zip(batch.column(0).to_pylist(), tokens.encode(batch.column(1), path), strict=True):
                doc_ids.append(doc)
                docs.append(np.append(x, np.uint32(end_id)))
                held += len(x) + 1
                if held >= SHARD_IDS:
                    yield flush()
                    doc_ids, docs, held, shard = [], [], 0, shard + 1
        if docs:
            yield flush()

    return write


def write_ids(docs: DataFrame, path: str, end_id: int, parts: int) -> DataFrame:
    """(part, shard, first_doc, docs, ids, data): the shards' files of docs (doc_id, text), in ascending doc_id.

    Range partitions keep the order across shards. Null texts are only an end id; rows of the same doc_id (also a
    null one, which goes first and is stored as the least number) are all kept, ordered by text.
    """
    texts = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    ordered = texts.repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "text")
    return ordered.mapInArrow(lean(_writer(path, end_id)), "part long, shard long, first_doc long, docs long, ids long, data binary")


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, number, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
            shard = Shard(data.as_buffer())
            ids = memoryview(shard.all_ids().astype("<u4").tobytes())
            end = np.cumsum(shard.sizes, dtype=np.int64)
            start = end - shard.sizes
            crc = [zlib.crc32(ids[4 * a : 4 * b]) for a, b in zip(start.tolist(), end.tolist(), strict=True)]
            n = len(end)
            yield pa.record_batch([pa.array(x, pa.int64()) for x in (np.full(n, part), np.full(n, number), shard.doc_ids, start, shard.sizes, crc)], names=["part", "shard", "doc_id", "inside", "n_tokens", "ids_crc32"])


def read_ids(shards: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, part, shard) of each document in the files of write_ids().

    A shard's place is a running sum over the shards of its part, and over the parts: one number for each part.
    """
    sizes = shards.select("part", "shard", "ids")
    totals = sizes.groupBy("part").agg(F.sum("ids").alias("n"))
    before = totals.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    inside = F.sum("ids").over(Window.partitionBy("part").orderBy("shard")) - F.col("ids")
    places = sizes.withColumn("earlier", inside).join(before, "part").select("part", "shard", (F.col("earlier") + F.col("before")).alias("place"))
    rows = shards.select("part", "shard", "data").mapInArrow(lean(_read), "part long, shard long, doc_id long, inside long, n_tokens long, ids_crc32 long")
    return rows.join(places, ["part", "shard"]).select("doc_id", (F.col("place") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32", "part", "shard")


def encoded(spark: SparkSession, docs: DataFrame, path: str, end_id: int = 1) -> DataFrame:
    """Write docs (doc_id, text) as compressed id files and read them back; see write_ids() and read_ids()."""
    store = Store(spark, "token-ids")
    size = int(str(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))  # an estimate; only tasks follow it
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(100_000, -(-size // PART_BYTES)))
    return read_ids(store.save(write_ids(docs, path, end_id, parts), "shards"))
