"""N-gram Jaccard join with adaptive multi-match prefixes.

Two documents link when the Jaccard similarity of their word-shingle sets is at least `threshold` per cent.

Global token order: rarer shingles first (by document frequency, then hash). A document of n shingles whose prefix
has n - ceil(t n) + l shingles shares at least l of them with every similar document. Each document picks the l
that makes its estimated cost least, up to ceil(t n): the postings that its prefix reads, plus verifications, which
are at most those postings over l. A pair is verified if it shares at least min(l, l') prefix shingles.

Flow, all in blocks of bounded size:

1.  A scan packs each block's (shingle, document) postings into one binary row for each hash range: whole 64-bit hashes,
    stored as differences. Equal sets inside a block are one entry.
2.  Each hash range finds the shingles with two or more postings and returns only those to their blocks. A shingle
    held by one document can match nothing; it only counts as a prefix place. Most documents end here: their
    prefix has no shared shingle.
3.  The rest, one row for each distinct set, are joined into groups by shared prefix shingles (graph.components;
    each shingle gives a star, not all pairs), and groups are cut into tiles of about `tile` sets or TILE_BYTES at most.
4.  Each pair of tiles of a group is one task: it counts shared prefix shingles, verifies candidates that aren't
    connected yet against whole sets, and returns the links found; components of these are the result.

Equal texts are never expanded into pairs. Links between already connected sets of a task are not repeated, so the
links kept span the components. Null or blank texts have no set and link with nothing; extra columns are ignored;
a doc_id that occurs twice is two rows; a null doc_id keeps its row, and its class is that of its
partners, or null; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cueforge.llm.graph import components
from cueforge.llm.memory import lean, lean_group
from cueforge.llm.store import ROWS, Store, rows_at_once
from cueforge.llm.words import mix, pieces, shingles, word_spans

_U = np.uint64
BLOCK_POSTINGS, BLOCK_DOCS, RANGE_POSTINGS, CHARS_PER_WORD, PIECE = 1_500_000, 1 << 16, 1_500_000, 6, 8 << 20
COST_OF_CHECK, NO_ID, TILE_BYTES = 8, -(1 << 63), 16 << 20


def least_shared(n, threshold: int):
    """How many of its n shingles a set shares with any similar one at least: ceil(threshold n / 100)."""
    return -(-threshold * n // 100)


def prefix_places(n, threshold: int):
    """Prefix length for one shared shingle: n - ceil(threshold n / 100) + 1."""
    return n - least_shared(n, threshold) + 1


def _postings(width: int, ranges: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, block = TaskContext.get().partitionId(), 0
        for batch in batches:
            ids = batch.column(0).fill_null(NO_ID).to_numpy()
            for first, end, data, offsets in pieces(batch.column(1), PIECE):
                h, _, _, words = word_spans(data, offsets)
                runs, at = shingles(h, words, width)
                own, lo = ids[first:end], 0
                while lo < len(own):
                    hi = int(np.searchsorted(at, at[lo] + BLOCK_POSTINGS, "right")) - 1
                    hi = min(max(hi, lo + 1), len(own), lo + BLOCK_DOCS)
                    yield _block(part << 32 | block, own[lo:hi], runs, at[lo : hi + 1], ranges)
                    lo, block = hi, block + 1

    return scan


def _packed(keys: np.ndarray, *others: np.ndarray) -> bytes:
    """Ascending 64-bit hashes as differences, byte plane by byte plane (the highest are zeros, which compress), and other arrays."""
    planes = np.diff(keys, prepend=_U(0)).view(np.uint8).reshape(-1, 8).T
    return planes.tobytes() + b"".join(x.tobytes() for x in others)


def _opened(data: pa.Buffer, *kinds: str) -> list[np.ndarray]:
    """What _packed() made, with the kinds of the other arrays."""
    n = len(data) // (8 + sum(np.dtype(k).itemsize for k in kinds))
    keys = np.cumsum(np.ascontiguousarray(np.frombuffer(data, np.uint8, 8 * n).reshape(8, n).T).view(_U).ravel(), dtype=_U)
    out, at = [keys], 8 * n
    for kind in kinds:
        out.append(np.frombuffer(data, kind, n, at))
        at += out[-1].nbytes
    return out


def _block(block: int, ids: np.ndarray, runs: np.ndarray, at: np.ndarray, ranges: int) -> pa.RecordBatch:
    """Rows (block, rng, data): the block's documents under a range below 0, its postings by hash range."""
    m = len(ids)
    head = np.zeros((m, 3), np.int64)  # doc_id, signature of the set, size of the set
    head[:, 0] = ids
    seen, parts, owner = set(), [np.zeros(0, _U)], [np.zeros(0, np.uint16)]
    for d in range(m):
        own = np.unique(runs[at[d] : at[d + 1]])
        if not len(own):
            continue
        sign = int(mix(own + _U(7)).sum(dtype=_U) ^ _U(len(own)))
        head[d, 1:] = np.array([sign], _U).view(np.int64)[0], len(own)
        if sign not in seen:
            seen.add(sign)
            parts.append(own)
            owner.append(np.full(len(own), d, np.uint16))
    keys, owner = np.concatenate(parts), np.concatenate(owner)
    order = np.argsort(keys, kind="stable")
    keys, owner = keys[order], owner[order]
    rng = ((keys >> _U(32)) * _U(ranges)) >> _U(32)
    cut = np.searchsorted(rng, np.arange(ranges + 1, dtype=_U))
    full = np.flatnonzero(np.diff(cut))
    data = [head.tobytes(), *(_packed(keys[cut[r] : cut[r + 1]], owner[cut[r] : cut[r + 1]]) for r in full)]
    spread = -1 - block % 65_521
    return pa.record_batch([pa.array([block] * len(data), pa.int64()), pa.array([spread, *full.tolist()], pa.int64()), pa.array(data, pa.binary())], names=["block", "rng", "data"])


def _shared(table: pa.Table) -> pa.Table:
    """One hash range: to each block its postings of shingles with two or more, each with that number."""
    if len(table) and table["rng"][0].as_py() < 0:
        return table.select(["block", "rng", "data"])
    blocks, parts = table["block"].to_pylist(), [_opened(x.as_buffer(), "<u2") for x in table["data"]]
    keys, doc = (np.concatenate([p[k] for p in parts]) for k in (0, 1))
    owner = np.repeat(np.arange(len(parts), dtype=np.int32), [len(p[0]) for p in parts])
    del parts
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    df = np.diff(np.r_[first, len(keys)])
    keep = np.repeat(df > 1, df)
    keys, order, df = keys[keep], order[keep], np.repeat(df, df)[keep]
    by = np.argsort(owner[order], kind="stable")  # hashes stay in order in each block
    keys, doc, owner, df = keys[by], doc[order[by]], owner[order[by]], np.minimum(df[by], 0xFFFFFFFF).astype("<u4")
    cut = np.searchsorted(owner, np.arange(len(blocks) + 1))
    full = np.flatnonzero(np.diff(cut))
    data = [_packed(keys[cut[i] : cut[i + 1]], doc[cut[i] : cut[i + 1]], df[cut[i] : cut[i + 1]]) for i in full]
    return pa.table([pa.array([blocks[i] for i in full], pa.int64()), pa.array([0] * len(full), pa.int64()), pa.array(data, pa.binary())], names=["block", "rng", "data"])


def _gathered(threshold: int):
    def gather(table: pa.Table) -> pa.Table:
        """One block: a row for each document, with its shared shingles in global order if its prefix has any."""
        head, parts = np.zeros((0, 3), np.int64), []
        for rng, x in zip(table["rng"].to_pylist(), table["data"], strict=True):
            if rng < 0:
                head = np.frombuffer(x.as_buffer(), np.int64).reshape(-1, 3)
            else:
                parts.append(_opened(x.as_buffer(), "<u2", "<u4"))
        parts.append([np.zeros(0, _U), np.zeros(0, np.uint16), np.zeros(0, np.uint32)])
        keys, doc, df = (np.concatenate([p[k] for p in parts]) for k in range(3))
        order = np.lexsort((keys, df, doc))
        keys, df, doc = keys[order], df[order], doc[order]
        cut = np.searchsorted(doc, np.arange(len(head) + 1))
        sets, freq = [], []
        for d, n in enumerate(head[:, 2]):
            own = cut[d + 1] - cut[d]
            alive = own > 0 and n - own < prefix_places(int(n), threshold)
            sets.append(keys[cut[d] : cut[d + 1]].tobytes() if alive else None)
            freq.append(df[cut[d] : cut[d + 1]].tobytes() if alive else None)
        return pa.table([pa.array(head[:, 0], mask=head[:, 0] == NO_ID), pa.array(head[:, 1]), pa.array(head[:, 2]), pa.array(sets, pa.binary()), pa.array(freq, pa.binary())], names=["doc_id", "sig", "n", "shared", "df"])

    return gather


def best_match(df: np.ndarray, places: int, most: int) -> int:
    """The number of shared prefix shingles to ask for: where the estimated cost is least.

    df: frequencies of the shared shingles in global order; places: how many of them the shortest prefix holds.
    """
    reach = np.cumsum(df[: places + most - 1].astype(np.float64))
    tries = np.arange(1, most + 1)
    read = reach[np.minimum(places + tries - 1, len(reach)) - 1]
    return int(np.argmin(read + COST_OF_CHECK * read / tries)) + 1


def _stars(threshold: int):
    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sig, n = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            sets = [np.frombuffer(x.as_buffer(), _U) for x in batch.column(2)]
            for lo in range(0, len(sig), 2000):
                part = [s[: prefix_places(int(m), threshold) - (int(m) - len(s))] for s, m in zip(sets[lo : lo + 2000], n[lo : lo + 2000], strict=True)]
                key = np.concatenate(part) if part else np.zeros(0, _U)
                yield pa.record_batch([pa.array(key.astype(np.int64)), pa.array(np.repeat(sig[lo : lo + 2000], [len(p) for p in part]))], names=["key", "sig"])

    return explode


def _verified(threshold: int, most: int):
    def verify(table: pa.Table) -> pa.Table:
        """One pair of tiles: links between sets that no other link of this task connects yet."""
        order = np.argsort(table["sig"].to_numpy(), kind="stable")
        sig, n, tile = (table[c].to_numpy()[order] for c in ("sig", "n", "tile"))
        blobs, freqs = table["shared"].combine_chunks(), table["df"].combine_chunks()
        sets = [np.frombuffer(blobs[int(i)].as_buffer(), _U) for i in order]
        df = [np.frombuffer(freqs[int(i)].as_buffer(), np.uint32) for i in order]
        m = len(sets)
        places = [prefix_places(int(n[i]), threshold) - (int(n[i]) - len(sets[i])) for i in range(m)]
        need = np.array([best_match(df[i], places[i], min(most, least_shared(int(n[i]), threshold))) for i in range(m)])
        _, token = np.unique(np.concatenate(sets), return_inverse=True)
        cut = np.r_[0, np.cumsum([len(s) for s in sets])]

        def index(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
            tokens = np.concatenate(parts)
            holder = np.repeat(np.arange(m), [len(p) for p in parts])
            by = np.argsort(tokens, kind="stable")
            return np.searchsorted(tokens[by], np.arange(token.max() + 2)), holder[by]

        def counts(tokens: np.ndarray, at: np.ndarray, holder: np.ndarray) -> np.ndarray:
            lo, size = at[tokens], at[tokens + 1] - at[tokens]
            step = np.repeat(lo - np.r_[0, np.cumsum(size)[:-1]], size) + np.arange(size.sum())
            return np.bincount(holder[step], minlength=m)

        whole = [token[cut[i] : cut[i + 1]] for i in range(m)]
        front = [w[: places[i] + need[i] - 1] for i, w in enumerate(whole)]
        in_front, in_whole = index(front), index(whole)
        top = np.arange(m)
        a, b = [], []
        cross = len(set(tile.tolist())) > 1
        for i in range(m):
            near = counts(front[i], *in_front) >= np.minimum(need, need[i])
            near &= top != top[i]
            if cross:
                near &= tile != tile[i]
            if not near.any():
                continue
            common = counts(whole[i], *in_whole)
            linked = near & (100 * common >= threshold * (n + n[i] - common))
            for j in np.flatnonzero(linked):
                if top[j] != top[i]:
                    top[top == top[j]] = top[i]
                    a.append(sig[i])
                    b.append(sig[j])
        return pa.table([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return verify


def jaccard_classes(spark: SparkSession, docs: DataFrame, threshold: int = 80, width: int = 5, most: int = 8, tile: int = 8192) -> DataFrame:
    """(doc_id, n_shingles, component_id) for each row of docs (doc_id, text).

    n_shingles is the size of the document's set; component_id is the smallest doc_id that links reach.
    threshold: per cent; width: words in a shingle; most: the largest number of shared prefix shingles asked for.
    """
    store = Store(spark, "jaccard")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    chars = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = max(parts, math.ceil(chars / CHARS_PER_WORD / RANGE_POSTINGS))
    rows = "block long, rng long, data binary"
    posted = texts.mapInArrow(lean(_postings(width, ranges)), rows)
    shared = posted.groupBy("rng").applyInArrow(lean_group(_shared), rows)
    members = shared.groupBy("block").applyInArrow(lean_group(_gathered(threshold)), "doc_id long, sig long, n long, shared binary, df binary")
    with rows_at_once(spark, ROWS):
        members = store.save(members, "members")
    alive = members.where("shared is not null").groupBy("sig").agg(F.first("n").alias("n"), F.first("shared").alias("shared"), F.first("df").alias("df"))
    alive = store.save(alive, "alive")
    stars = alive.select("sig", "n", "shared").mapInArrow(lean(_stars(threshold)), "key long, sig long")
    stars = store.save(stars, "stars")
    hubs = stars.groupBy("key").agg(F.min("sig").alias("hub"), F.count("*").alias("k")).where("k > 1")
    edges = stars.join(hubs, "key").where("sig > hub").select(F.col("sig").alias("a"), F.col("hub").alias("b"))
    groups = store.save(components(edges, store, "group"), "groups")
    sizes = groups.join(alive.select(F.col("sig").alias("node"), F.octet_length("shared").alias("bytes")), "node").groupBy("label").agg(F.count("*").alias("m"), F.sum("bytes").alias("bytes"))
    sizes = sizes.select("label", F.greatest(F.ceil(F.col("m") / tile), F.ceil(F.col("bytes") / TILE_BYTES)).cast("int").alias("tiles"))
    tiled = groups.join(sizes, "label").withColumn("tile", F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))
    tiled = tiled.select("label", F.col("node").alias("sig"), "tile", other.alias("other"))
    tiled = tiled.select("label", "sig", "tile", F.least("tile", "other").alias("x"), F.greatest("tile", "other").alias("y"))
    checked = tiled.join(alive, "sig").groupBy("label", "x", "y").applyInArrow(lean_group(_verified(threshold, most)), "a long, b long")
    linked = components(store.save(checked, "links"), store, "linked")
    named = members.select("doc_id", "sig", "n").join(linked, F.col("sig") == F.col("node"), "left")
    named = named.select("doc_id", "n", F.when(F.col("n") > 0, F.coalesce("label", "sig")).alias("class"))
    named = store.save(named, "named")
    least = named.where("n > 0").groupBy("class").agg(F.min("doc_id").alias("component_id"))
    result = named.join(least, "class", "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))
    result = store.save(result, "classes")
    store.drop("members", "alive", "stars", "groups", "links", "named")
    return result
