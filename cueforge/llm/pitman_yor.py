"""Hierarchical Pitman-Yor language model, trained and applied over blocks of documents.

A word's context is the word before it. Each word of the training texts, and a text's start, has a restaurant of its own; they share the
parent of their class (the word's last two letters, hashed to CLASSES classes); all classes share the root, whose base is uniform over the
known words and one unknown. A word that training lacks has an empty restaurant, which predicts what its class does. No process holds all
restaurants: a context is named by its key, and each range of words knows only those that it seats somebody in. `frequent` bounds the restaurants to
that many most frequent words, and the words that follow rarer ones then sit at their class directly: another, coarser model.

Seating: dishes are dealt to ranges by hash, so all restaurants' seats of one dish lie together. A Gibbs sweep works by blocks: all customers
of a dish leave their restaurant (their tables leave the parent's count too) and sit down again in turn, at a new table or at one that is there, given
the seating of all others at the end of the sweep before; contexts first, then classes, then the root. The numbers of customers between
two new tables are drawn at once from their exact distribution (see seat()), so one law holds for a dish of two customers as of billions. (The
block is drawn forward and isn't reweighted, as a removal of single customers would do; and blocks of one sweep see each other's last seats.)
Ranges send their customers and tables by context to parts of the contexts, which add them up and answer each range with the totals of its own
contexts; only the sums of classes and root and the likelihoods of strengths reach the driver. A range's state after a sweep is its numbers of tables.
A draw depends on the seed, the word, the context and the sweep, not on how the work is divided. After each sweep, discounts come from the
numbers of dishes with one and two customers, and strengths are the likeliest for the totals. Predictive probabilities are
averaged over the sweeps after `burn_in`.

Flow: a scan cuts the corpus into blocks, each of which asks every hash range for its distinct (word, context) pairs and says how often it saw them in
training; ranges merge, sample, and answer each block with one probability a pair; blocks add up their documents.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cueforge.llm.memory import lean, lean_group
from cueforge.llm.store import ROWS, Store, rows_at_once
from cueforge.llm.words import buffers, mix, seeds, word_spans

_U = np.uint64
CLASSES, BLOCK_TOKENS, RANGE_TOKENS, PIECE, FEW, SINGLY = 64, 800_000, 600_000, 2 << 20, 48, 16
END, START = (int(k) & ~63 for k in seeds(2, 3000))  # a text's end as a word, its start as a context; a context below 64 is a class itself
#: Kinds of rows: a block's documents; a range's pairs, which of them blocks asked for, its tables; its sums by
#: context, and all others; how likely strengths are; the totals of its contexts (where several sweeps meet: TOTALS + sweep).
HEAD, SEATS, ASKED, STATE, SUMS, TAIL, FITS, TOTALS = range(8)
GRID = np.array([10 ** (x / 4) for x in range(-4, 33)])
_FOLD = np.arange(256, dtype=np.int64)
_FOLD[65:91] += 32


def _pieces(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(doc ids, token keys, offsets) of some of the documents at a time; each text has its end as last token.

    A key is a word's hash with its class in the lowest bits.
    """
    data, offsets = buffers(batch.column(1))
    ids, lo = batch.column(0).to_pylist(), 0
    while lo < len(ids):
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + PIECE, "right")) - 1)
        part = data[offsets[lo] : offsets[hi]]
        h, s, e, at = word_spans(part, offsets[lo : hi + 1] - offsets[lo])
        if len(h):
            tail = _FOLD[part[e - 1]] << 8 | np.where(e - s > 1, _FOLD[part[e - 2]], 0)
            h = (h & ~_U(63)) | (mix(tail.astype(_U)) & _U(63))
        cuts = at + np.arange(len(at))
        keys = np.full(len(h) + hi - lo, END, _U)
        inner = np.ones(len(keys), bool)
        inner[cuts[1:] - 1] = False
        keys[inner] = h
        yield ids[lo:hi], keys, cuts
        lo = hi


def held(doc_id: int | None, folds: int, out: int) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % folds == out


def _range_of(keys: np.ndarray, ranges: int) -> np.ndarray:
    return ((keys >> _U(32)) * _U(ranges)) >> _U(32)


def _rows(kind: list[int], block: list[int], rng: list[int], data: list[bytes]) -> pa.RecordBatch:
    return pa.record_batch([pa.array(kind, pa.int32()), pa.array(block, pa.int64()), pa.array(rng, pa.int64()), pa.array(data, pa.binary())], names=["kind", "block", "rng", "data"])


def _table(*rows: tuple[int, int, int, bytes]) -> pa.Table:
    return pa.Table.from_batches([_rows(*map(list, zip(*rows, strict=True)))])


_SCHEMA = "kind int, block long, rng long, data binary"


def _pack(*parts: np.ndarray) -> bytes:
    """Arrays of whole numbers, each in as many bytes as its largest takes, their lowest bytes first, compressed."""
    head, body = [len(parts)], []
    for x in parts:
        x = np.ascontiguousarray(x).astype(_U, copy=False)
        width = (int(x.max(initial=0)).bit_length() + 7) // 8
        head += [len(x), width]
        body.append(x.view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes())
    raw = np.array(head, "<i8").tobytes() + b"".join(body)
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _unpack(data: pa.Buffer | bytes) -> list[np.ndarray]:
    view = memoryview(data)
    raw = pa.decompress(view[8:], decompressed_size=int.from_bytes(view[:8], "little"), codec="zstd")
    sizes = np.frombuffer(raw, "<i8", 2 * int(np.frombuffer(raw, "<i8", 1)[0]), 8).reshape(-1, 2).tolist()
    found, at = [], 8 + 16 * len(sizes)
    for n, width in sizes:
        x = np.zeros((n, 8), np.uint8)
        x[:, :width] = np.frombuffer(raw, np.uint8, n * width, at).reshape(width, n).T
        found.append(x.view(_U).ravel())
        at += n * width
    return found


def _deltas(x: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Differences within runs that begin at `starts`; a run's first number stays."""
    d = np.diff(x, prepend=x.dtype.type(0))
    d[starts] = x[starts]
    return d


def _counting(folds: int, out: int, ranges: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, size = [], 0

        def flush() -> pa.RecordBatch:
            keys, n = np.unique(np.concatenate(waiting), return_counts=True)
            cut = np.searchsorted(_range_of(keys, ranges), np.arange(ranges + 1, dtype=_U))
            full = np.flatnonzero(np.diff(cut))
            return _rows([SUMS] * len(full), [0] * len(full), full.tolist(), [_pack(keys[cut[r] : cut[r + 1]], n[cut[r] : cut[r + 1]]) for r in full])

        for batch in batches:
            for ids, keys, cuts in _pieces(batch):
                train = np.array([not held(d, folds, out) for d in ids])
                waiting.append(keys[np.repeat(train, np.diff(cuts))])
                size += len(waiting[-1])
                if size > BLOCK_TOKENS:
                    yield flush()
                    waiting, size = [], 0
        if size:
            yield flush()

    return count


def _counted(frequent: int):
    def total(table: pa.Table) -> pa.Table:
        """One range: its most frequent words."""
        parts = [_unpack(x.as_buffer()) for x in table["data"]]
        keys, where = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
        n = np.bincount(where, weights=np.concatenate([p[1] for p in parts])).astype(np.int64)
        top = np.lexsort((keys, -n))[:frequent]
        return pa.table({"top": pa.array([keys[top].tobytes() + n[top].tobytes()], pa.binary())})

    return total


def _best(frequent: int):
    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The most frequent words of all rows of a task, in one row."""
        both = np.zeros((2, 0), np.int64)
        for batch in batches:
            both = np.concatenate([both, *(np.frombuffer(x.as_buffer(), np.int64).reshape(2, -1) for x in batch.column(0))], axis=1)
            both = both[:, np.lexsort((both[0].view(_U), -both[1]))[:frequent]]
        yield pa.record_batch([pa.array([both.tobytes()], pa.binary())], names=["top"])

    return merge


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sum of all rows' numbers, in one row."""
    total = sum(np.frombuffer(x.as_buffer(), "<f8") for batch in batches for x in batch.column("data"))
    if not isinstance(total, int):
        yield _rows([TAIL], [0], [0], [total.tobytes()])


def _planes(x: np.ndarray) -> bytes:
    """uint32 numbers, their lowest bytes first, so that they compress well."""
    return x.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _unplanes(data: memoryview | bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view("<u4").ravel()


def _blocking(folds: int, out: int, ranges: int, frequent: np.ndarray | None):
    def block_rows(number: int, docs: list, keys: np.ndarray, cuts: np.ndarray) -> pa.RecordBatch:
        context = np.r_[_U(0), keys[:-1]]
        if frequent is not None:
            at = np.minimum(np.searchsorted(frequent, context), max(0, len(frequent) - 1))
            context = np.where(frequent[at] == context if len(frequent) else False, context, context & _U(63))
        context[cuts[:-1]] = START
        _, at, which = np.unique(mix(keys + mix(context)), return_index=True, return_inverse=True)
        train = np.repeat(np.array([not held(d, folds, out) for d in docs]), np.diff(cuts))
        n = np.bincount(which, weights=train, minlength=len(at)).astype(_U)
        word, context = keys[at], context[at]
        order = np.lexsort((context, word))
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        word, context, n = word[order], context[order], n[order]
        rng, all_ranges = _range_of(word, ranges).astype(np.int64), np.arange(ranges + 1)
        cut = np.searchsorted(rng, all_ranges)
        full = np.flatnonzero(np.diff(cut))
        # words and contexts of each range in order, as differences, and pairs by their places there
        first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
        pairs, cut_words = np.diff(np.r_[first, len(word)]), np.searchsorted(rng[first], all_ranges)
        words = _deltas(word[first], cut_words[full])
        order = np.lexsort((context, rng))
        other = context[order]
        new = np.r_[True, (other[1:] != other[:-1]) | (np.diff(rng[order]) > 0)]
        cut_contexts = np.searchsorted(rng[order[new]], all_ranges)
        place = np.empty(len(order), np.int64)
        place[order] = np.cumsum(new) - 1
        place -= cut_contexts[rng]
        contexts = _deltas(other[new], cut_contexts[full])
        data = []
        for r in full.tolist():
            own, w, c = slice(cut[r], cut[r + 1]), slice(cut_words[r], cut_words[r + 1]), slice(cut_contexts[r], cut_contexts[r + 1])
            data.append(_pack(words[w], pairs[w], contexts[c], place[own], n[own]))
        # a document's pairs in order: only their sum counts
        sizes, low = np.diff(cuts), (1 << 32) - 1
        places = np.sort(np.repeat(np.arange(len(docs)), sizes) << 32 | rank[which]) & low
        head = _pack(np.array([-1 << 62 if d is None else d for d in docs], np.int64), sizes, _deltas(places, cuts[:-1]))
        return _rows([HEAD] + [SEATS] * len(full), [number] * (len(full) + 1), [-1 - number % 65_521, *full.tolist()], [head, *data])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        docs, waiting, size = [], [], 0
        sizes: list[np.ndarray] = []
        for batch in batches:
            for ids, keys, cuts in _pieces(batch):
                docs += ids
                waiting.append(keys)
                sizes.append(np.diff(cuts))
                size += len(keys)
                if size >= BLOCK_TOKENS:
                    yield block_rows(number, docs, np.concatenate(waiting), np.r_[0, np.cumsum(np.concatenate(sizes))])
                    docs, waiting, sizes, size, number = [], [], [], 0, number + 1
        if docs:
            yield block_rows(number, docs, np.concatenate(waiting), np.r_[0, np.cumsum(np.concatenate(sizes))])

    return scan


def _request(word: np.ndarray, leaf: np.ndarray, n: np.ndarray) -> bytes:
    """Distinct words, how many pairs each has, and the pairs' contexts and counts (of 32 bits, then what is above)."""
    start = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
    return np.array([len(start), len(word)], "<i8").tobytes() + word[start].tobytes() + _planes(np.diff(np.r_[start, len(word)])) + _planes(leaf) + _planes(n & 0xFFFFFFFF) + (_planes(n >> 32) if n.dtype == np.int64 and (n >> 32).any() else b"")


def _open_request(data: pa.Buffer) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    w, m = np.frombuffer(data, "<i8", 2).tolist()
    view, at = memoryview(data), 16 + 8 * w
    leaf = at + 4 * w
    count = leaf + 4 * m
    n = _unplanes(view[count : count + 4 * m]).astype(np.int64)
    if len(data) > count + 4 * m:
        n |= _unplanes(view[count + 4 * m :]).astype(np.int64) << 32
    return np.frombuffer(data, _U, w, 16), _unplanes(view[at:leaf]), _unplanes(view[leaf:count]), n


def _merged(table: pa.Table) -> pa.Table:
    """One range: all pairs once with their counts, which of them each block asked for, and its training words, tokens and pairs seen once and twice."""
    if table["rng"][0].as_py() < 0:
        return table
    rng, blocks = table["rng"][0].as_py(), table["block"].to_pylist()
    parts = [_unpack(x.as_buffer()) for x in table["data"]]
    words, word = np.unique(np.concatenate([np.cumsum(p[0], dtype=_U) for p in parts]), return_inverse=True)
    contexts, context = np.unique(np.concatenate([np.cumsum(p[2], dtype=_U) for p in parts]), return_inverse=True)
    classes = int(np.searchsorted(contexts, _U(64)))  # those that are no words lie first
    leaf = np.r_[len(contexts) - classes + 1 + contexts[:classes].astype(np.int64), np.arange(len(contexts) - classes)][context]
    base = np.cumsum([0] + [len(p[2]) for p in parts[:-1]])
    leaf = leaf[np.concatenate([p[3].astype(np.int64) + b for p, b in zip(parts, base.tolist(), strict=True)])]
    pair = np.repeat(word, np.concatenate([p[1].astype(np.int64) for p in parts])) << 32 | leaf
    del leaf, word, context
    pairs, which = np.unique(pair, return_inverse=True)
    n = np.bincount(which, weights=np.concatenate([p[4] for p in parts])).astype(np.int64)
    own = contexts[classes:]
    data = [_pack(np.diff(own, prepend=_U(0)))]
    data.append(_request(words[pairs >> 32], (pairs & 0xFFFFFFFF).astype(np.uint32), n))
    raw = np.array([len(x) for x in data], "<i8").tobytes() + b"".join(data)
    seats = len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)
    cuts = np.cumsum([0] + [len(p[3]) for p in parts])
    asked = _pack(np.array(blocks), np.diff(cuts), _deltas(which, cuts[:-1]))
    seen, leafs = np.bincount(pairs >> 32, weights=n), n[(pairs & 0xFFFFFFFF) < len(own)]
    tail = np.array([np.count_nonzero(seen), seen.sum(), np.count_nonzero(leafs == 1), np.count_nonzero(leafs == 2)], "<f8").tobytes()
    return _table((SEATS, -1, rng, seats), (ASKED, -1, rng, asked), (TAIL, -1, rng, tail))


@dataclass
class Totals:
    """What a sweep leaves for all ranges: customers and tables of each restaurant, discounts and strengths by level (contexts, classes, root)."""

    customers: tuple[np.ndarray, np.ndarray, np.ndarray]
    tables: tuple[np.ndarray, np.ndarray, np.ndarray]
    discount: tuple[float, float, float]
    strength: tuple[float, float, float]

    def within(self, customers: np.ndarray, tables: np.ndarray) -> Totals:
        """The same with other contexts: those of one range, and one without customers."""
        return Totals((np.r_[customers, 0], *self.customers[1:]), (np.r_[tables, 0], *self.tables[1:]), self.discount, self.strength)


def _discount(one: float, two: float) -> float:
    return min(0.95, max(0.05, one / max(1.0, one + 2 * two)))


def totals(sums: np.ndarray, contexts: int, fits: np.ndarray | None = None) -> Totals:
    """From the sums over all ranges (see _Range.sums). fits: how likely the strengths of GRID are for contexts that are elsewhere."""
    sizes = (contexts, contexts, CLASSES, CLASSES, 1, 1)
    c1, t1, c2, t2, c3, t3, ones = np.split(sums, np.cumsum(sizes))
    discount = tuple(_discount(a, b) for a, b in ones.reshape(3, 2))
    levels = [_fits(c, t, d) for c, t, d in zip((c1, c2, c3), (t1, t2, t3), discount, strict=True)]
    if fits is not None:
        levels[0] = fits
    return Totals((c1, c2, c3), (t1, t2, t3), discount, tuple(float(GRID[np.argmax(x)]) for x in levels))


def _fits(customers: np.ndarray, tables: np.ndarray, d: float) -> np.ndarray:
    """How likely each strength of GRID is, if these restaurants share it."""
    alike, times = np.unique(customers[customers > 0] + 1j * tables[customers > 0], return_counts=True)  # most restaurants are small and alike
    c, t = alike.real, alike.imag
    g = lgamma

    def fit(s: float) -> float:
        one = np.full(1, s)
        return float((times * ((t - 1) * math.log(d) + g(s / d + t) - g(one / d + 1) - g(s + c) + g(one + 1))).sum())

    return np.array([fit(s) for s in GRID.tolist()])


def lgamma(x: np.ndarray) -> np.ndarray:
    """The logarithm of the gamma function, for x > 0."""
    low = x * (x + 1) * (x + 2) * (x + 3) * (x + 4) * (x + 5)
    z = x + 6
    r = 1 / (z * z)
    series = (1 / 12 - r * (1 / 360 - r * (1 / 1260 - r / 1680))) / z
    return (z - 0.5) * np.log(z) - z + 0.9189385332046727 + series - np.log(low)


def _uniform(key: np.ndarray, turn: int) -> np.ndarray:
    """A number between 0 and 1 for each key."""
    return ((mix(key + seeds(1, turn if turn >= 0 else (1 << 40) - turn)[0]) >> _U(11)).astype(np.float64) + 0.5) / (1 << 53)


def seat(customers: np.ndarray, fresh: np.ndarray, each: np.ndarray, d: float, key: np.ndarray) -> np.ndarray:
    """Tables of each dish, all of its customers sitting down in turn.

    With i customers at t tables the next one takes a new table with odds fresh + each * t against i - d * t. The first SINGLY are
    drawn so, one after the other. The others need only the places of new tables: none opens while the number there grows from i to
    m with probability G(m - dt) G(i - dt + a) / (G(i - dt) G(m - dt + a)), a = fresh + each * t, G the gamma function: so one draw
    gives the number at which the next table opens. key: what a dish's draws depend on.
    """
    t = (customers > 0).astype(np.float64)
    own = np.flatnonzero(customers > 1)
    own = own[np.argsort(-customers[own], kind="stable")]
    c, a0, a1, keys = customers[own].astype(np.float64), fresh[own], each[own], key[own]
    tables = np.ones(len(own))
    for i in range(1, SINGLY):  # the first ones one by one: cheaper than their waiting times
        live = int(np.searchsorted(-c, -i))  # those with more than i customers
        a = a0[:live] + a1[:live] * tables[:live]
        tables[:live] += _uniform(keys[:live], -i) * (a + i - d * tables[:live]) < a
    t[own] = tables
    live = int(np.searchsorted(-c, -SINGLY))
    own, c, tables, at, turn = own[:live], c[:live], tables[:live], np.full(live, float(SINGLY)), 0
    while len(own) > FEW:
        a, back, u = fresh[own] + each[own] * tables, d * tables, _uniform(key[own], turn)
        there = at - back
        limit = np.log(u) + lgamma(there) - lgamma(there + a)
        opens = lgamma(c - back) - lgamma(c - back + a) <= limit
        t[own[~opens]] = tables[~opens]
        own, c, tables, at, a, back, u, there, limit = (x[opens] for x in (own, c, tables, at, a, back, u, there, limit))
        lo, hi = at.copy(), c.copy()  # the first number with a lower probability lies above lo, up to hi
        with np.errstate(over="ignore"):  # G(x) / G(x + a) is about (x + (a - 1) / 2) ** -a
            near = back - (a - 1) / 2 + np.maximum(there + (a - 1) / 2, 0.01) * np.exp(np.minimum(-np.log(u) / a, 700))
        near = np.floor(np.clip(near, lo + 1, hi))
        for mid in (near, near - 1, near + 1):
            inside = (mid > lo) & (mid < hi)
            down = inside & (lgamma(mid - back) - lgamma(mid - back + a) <= limit)
            hi, lo = np.where(down, mid, hi), np.where(inside & ~down, mid, lo)
        wide = np.flatnonzero(hi - lo > 1)
        while len(wide):
            mid = np.floor((lo[wide] + hi[wide]) / 2)
            down = lgamma(mid - back[wide]) - lgamma(mid - back[wide] + a[wide]) <= limit[wide]
            hi[wide[down]], lo[wide[~down]] = mid[down], mid[~down]
            wide = wide[hi[wide] - lo[wide] > 1]
        at, tables, turn = hi, tables + 1, turn + 1
        t[own] = tables
        more = at < c
        own, c, tables, at = own[more], c[more], tables[more], at[more]
    for i, *state in zip(own.tolist(), c.tolist(), at.tolist(), tables.tolist(), fresh[own].tolist(), each[own].tolist(), strict=True):
        t[i] = _seat_one(*state, d, key[i : i + 1], turn)
    return t


def _seat_one(c: float, at: float, t: float, fresh: float, each: float, d: float, key: np.ndarray, turn: int) -> float:
    """seat() for a single dish from a state on: dishes with very many tables, of which a range has few."""
    lg = math.lgamma
    while True:
        draws = ((mix(key + seeds(256, turn)) >> _U(11)).astype(np.float64) + 0.5) / (1 << 53)
        turn += 256
        for u in draws.tolist():
            a, back = fresh + each * t, d * t
            there, h = at - back, (a - 1) / 2
            limit = math.log(u) + lg(there) - lg(there + a)
            if lg(c - back) - lg(c - back + a) > limit:
                return t
            lo, hi = at, c
            mid = math.floor(min(max(back - h + max(there + h, 0.01) * math.exp(min(-math.log(u) / a, 700)), lo + 1), hi))
            step = 1.0
            while hi - lo > 1:  # outwards from the guess, then by halves
                if not lo < mid < hi:
                    mid = math.floor((lo + hi) / 2)
                if lg(mid - back) - lg(mid - back + a) <= limit:
                    hi, mid = mid, mid - step
                else:
                    lo, mid = mid, mid + step
                step *= 2
            t, at = t + 1, hi
            if at >= c:
                return t


class _Range:
    """The seats of one range's words."""

    def __init__(self, data: pa.Buffer, frequent: np.ndarray, words: int, seed: int):
        at, size = np.frombuffer(data, "<i8", 2).tolist()  # the request comes after the contexts' keys
        self.words, pairs, leaf, n = _open_request(data.slice(16 + at, size))
        self.leaf, self.n = leaf.astype(np.int64), n.astype(np.int64)
        self.word = np.repeat(np.arange(len(self.words)), pairs)
        self.frequent, self.contexts = frequent, len(frequent) + 1
        classes = np.r_[(frequent & 63).astype(np.uint8), np.uint8(0)]
        self.own = self.leaf < self.contexts
        cls = np.where(self.own, classes[np.minimum(self.leaf, self.contexts - 1)].astype(np.int64), self.leaf - self.contexts)
        seats, self.up = np.unique(self.word * CLASSES + cls, return_inverse=True)
        self.word2, self.cls2 = seats // CLASSES, seats % CLASSES
        self.base, self.seed = 1.0 / (words + 1), seed
        self.leaf1 = np.where(self.own, self.leaf, 0)
        context = np.r_[frequent, _U(START), np.arange(CLASSES, dtype=_U)][self.leaf]
        self.keys = (mix(self.words[self.word] + mix(context + _U(1 << 20))), mix(self.words[self.word2] + mix(self.cls2.astype(_U) + _U(1 << 21))), mix(self.words))

    @classmethod
    def of(cls, data: pa.Buffer, words: int, seed: int) -> _Range:
        view = memoryview(data)
        raw = pa.decompress(view[8:], decompressed_size=int.from_bytes(view[:8], "little"), codec="zstd")
        frequent = np.cumsum(_unpack(raw.slice(16, int(np.frombuffer(raw, "<i8", 1)[0])))[0], dtype=_U)
        return cls(raw, frequent, words, seed)

    def _fill(self) -> None:
        self.c2 = np.bincount(self.up, weights=np.where(self.own, self.t1, self.n), minlength=len(self.word2))

    def start(self) -> None:
        """One table for each dish."""
        self.t1 = (self.own & (self.n > 0)).astype(np.float64)
        self._fill()
        self.t2 = (self.c2 > 0).astype(np.float64)
        self.c3 = np.bincount(self.word2, weights=self.t2, minlength=len(self.words))
        self.t3 = (self.c3 > 0).astype(np.float64)

    def state(self) -> bytes:
        return _pack(self.t1, self.t2, self.t3)

    def restore(self, data: pa.Buffer) -> None:
        """Go on from a state."""
        self.t1, self.t2, self.t3 = (x.astype(np.float64) for x in _unpack(data))
        self._fill()
        self.c3 = np.bincount(self.word2, weights=self.t2, minlength=len(self.words))

    def parents(self, g: Totals) -> tuple[np.ndarray, np.ndarray]:
        """Probabilities of the words at the root, and of the classes' dishes."""
        (_, d2, d3), (_, s2, s3) = g.discount, g.strength
        root = (self.c3 - d3 * self.t3 + (s3 + d3 * g.tables[2][0]) * self.base) / (s3 + g.customers[2][0])
        fresh = (s2 + d2 * g.tables[1])[self.cls2] * root[self.word2]
        return root, (self.c2 - d2 * self.t2 + fresh) / (s2 + g.customers[1])[self.cls2]

    def sweep(self, g: Totals, turn: int) -> None:
        """Every dish's customers leave and sit down again: tables of the dish itself don't count in what they meet."""
        (d1, d2, d3), (s1, s2, s3) = g.discount, g.strength
        draw = [k + seeds(1, self.seed * 1000 + turn)[0] for k in self.keys]
        root, _ = self.parents(g)
        rest = self.c2[self.up] - self.t1  # the class's customers of the dish without this restaurant's tables
        back = np.minimum(self.t2[self.up], rest)
        cls = self.cls2[self.up]
        up = (rest - d2 * back + (s2 + d2 * g.tables[1])[cls] * root[self.word]) / (s2 + np.maximum(g.customers[1][cls] - self.t1, 0))
        others = np.maximum(g.tables[0][self.leaf1] - self.t1, 0)
        self.t1 = seat(np.where(self.own, self.n, 0), (s1 + d1 * others) * up, d1 * up, d1, draw[0])
        rest = self.c3[self.word2] - self.t2
        back = np.minimum(self.t3[self.word2], rest)
        up = (rest - d3 * back + (s3 + d3 * g.tables[2][0]) * self.base) / (s3 + np.maximum(g.customers[2][0] - self.t2, 0))
        others = np.maximum(g.tables[1][self.cls2] - self.t2, 0)
        self._fill()
        self.t2 = seat(self.c2, (s2 + d2 * others) * up, d2 * up, d2, draw[1])
        others = np.maximum(g.tables[2][0] - self.t3, 0)
        self.c3 = np.bincount(self.word2, weights=self.t2, minlength=len(self.words))
        self.t3 = seat(self.c3, (s3 + d3 * others) * self.base, np.full(len(self.words), d3 * self.base), d3, draw[2])

    def sums(self) -> np.ndarray:
        """Customers and tables by context, and by class and at the root, and how many dishes have one and two customers at each level."""
        n1 = np.where(self.own, self.n, 0)
        ones = [np.count_nonzero(x == k) for x in (n1, self.c2, self.c3) for k in (1, 2)]
        at, by = (lambda x: np.bincount(self.leaf1, weights=x, minlength=self.contexts)), (lambda x: np.bincount(self.cls2, weights=x, minlength=CLASSES))
        return np.concatenate([at(n1), at(self.t1), by(self.c2), by(self.t2), [self.c3.sum(), self.t3.sum()], ones])

    def rows(self, rng: int, parts: int) -> list[tuple[int, int, int, bytes]]:
        """The sums as rows for the parts of the contexts, and the rest."""
        c, t, rest = np.split(self.sums(), (self.contexts, 2 * self.contexts))
        cut = np.searchsorted(_range_of(self.frequent, parts), np.arange(parts + 1, dtype=_U))
        found = [(TAIL, -1, rng, rest.tobytes())]
        for q in np.flatnonzero(np.diff(cut)).tolist():
            own = slice(cut[q], cut[q + 1])
            found.append((SUMS, rng, q, _pack(np.diff(self.frequent[own], prepend=_U(0)), c[own], t[own])))
        return found

    def predict(self, g: Totals) -> np.ndarray:
        """Each pair's predictive probability."""
        _, cls = self.parents(g)
        d1, s1 = g.discount[0], g.strength[0]
        up = cls[self.up]
        at_leaf = (self.n - d1 * self.t1 + (s1 + d1 * g.tables[0])[self.leaf1] * up) / (s1 + g.customers[0])[self.leaf1]
        return np.where(self.own, at_leaf, up)

    def answers(self, p: np.ndarray, asked: pa.Buffer) -> Iterator[tuple[int, bytes]]:
        """For each block: log10 of the pairs it asked for, and how often training saw each of its words."""
        logs = np.log10(p).astype("<f4")
        seen = np.bincount(self.word, weights=self.n, minlength=len(self.words)).astype("<i8")
        blocks, sizes, which = (x.view(np.int64) for x in _unpack(asked))
        ends = np.cumsum(sizes)
        for block, lo, hi in zip(blocks.tolist(), (ends - sizes).tolist(), ends.tolist(), strict=True):
            own = np.cumsum(which[lo:hi])
            word = self.word[own]
            start = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            yield block, np.array([len(own)], "<i8").tobytes() + logs[own].tobytes() + seen[word[start]].tobytes() + np.diff(np.r_[start, len(own)]).astype("<u4").tobytes()


def _kinds(table: pa.Table) -> dict[int, list[tuple[int, pa.Buffer]]]:
    """A group's (block, data) by kind, in order."""
    found: dict[int, list[tuple[int, pa.Buffer]]] = {}
    for kind, block, data in zip(table["kind"].to_pylist(), table["block"].to_pylist(), table["data"], strict=True):
        found.setdefault(kind, []).append((block, data.as_buffer()))
    return {k: sorted(rows, key=lambda r: r[0]) for k, rows in found.items()}


def _placed(rows: dict[int, list[tuple[int, pa.Buffer]]], words: int, seed: int) -> _Range:
    own = _Range.of(rows[SEATS][0][1], words, seed)
    if STATE in rows:
        own.restore(rows[STATE][0][1])
    else:
        own.start()
    return own


def _within(g: Totals, rows: list[tuple[int, pa.Buffer]]) -> Totals:
    parts = [_unpack(data) for _, data in rows]
    c, t = (np.concatenate([p[i] for p in parts]).astype(np.float64) if parts else np.zeros(0) for i in (0, 1))
    return g.within(c, t)


def _started(parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rng, data in zip(batch.column("rng").to_pylist(), batch.column("data"), strict=True):
                own = _Range.of(data.as_buffer(), 0, 0)
                own.start()
                yield from _table(*own.rows(rng, parts)).to_batches()

    return run


def _totalled(d: float):
    def run(table: pa.Table) -> pa.Table:
        """One part of the contexts: customers and tables of each, sent to the ranges that know it, and how likely strengths are."""
        ranges, parts = table["block"].to_pylist(), [_unpack(x.as_buffer()) for x in table["data"]]
        _, where = np.unique(np.concatenate([np.cumsum(p[0], dtype=_U) for p in parts]), return_inverse=True)
        c, t = (np.bincount(where, weights=np.concatenate([p[i] for p in parts])) for i in (1, 2))
        part, lo, rows = table["rng"][0].as_py(), 0, []
        rows.append((FITS, part, -1, _fits(c, t, d).tobytes()))
        for rng, p in zip(ranges, parts, strict=True):
            own = where[lo : lo + len(p[0])]
            rows.append((TOTALS, part, rng, _pack(c[own], t[own])))
            lo += len(p[0])
        return _table(*rows)

    return run


def _swept(g: Totals, words: int, seed: int, turn: int, parts: int):
    def run(table: pa.Table) -> pa.Table:
        rows, rng = _kinds(table), table["rng"][0].as_py()
        own = _placed(rows, words, seed)
        own.sweep(_within(g, rows.get(TOTALS, [])), turn)
        return _table((STATE, -1, rng, own.state()), *own.rows(rng, parts))

    return run


def _answered(past: dict[int, Totals], words: int, seed: int):
    def run(table: pa.Table) -> pa.Table:
        """The mean of the predictions after each sweep of `past`, from the state after the first of them on."""
        rows, rng, p = _kinds(table), table["rng"][0].as_py(), 0.0
        own = _placed(rows, words, seed)
        for turn, whole in past.items():
            g = _within(whole, rows.get(TOTALS + turn, []))
            p = p + own.predict(g)
            if turn + 1 in past:
                own.sweep(g, turn)
        return _table(*((SEATS, block, rng, data) for block, data in own.answers(p / len(past), rows[ASKED][0][1])))

    return run


def _scored(folds: int, out: int, tokens: int, words: int):
    def score(table: pa.Table) -> pa.Table:
        """One block: each document's sums."""
        logs, seen, head = [], [], None
        for i in np.argsort(table["rng"].to_numpy(), kind="stable").tolist():
            data = table["data"][i].as_buffer()
            if table["rng"][i].as_py() < 0:
                head = data
                continue
            m = int(np.frombuffer(data, "<i8", 1)[0])
            w = (len(data) - 8 - 4 * m) // 12
            logs.append(np.frombuffer(data, "<f4", m, 8))
            seen.append(np.repeat(np.frombuffer(data, "<i8", w, 8 + 4 * m), np.frombuffer(data, "<u4", w, 8 + 4 * m + 8 * w)))
        ids, sizes, which = (x.view(np.int64) for x in _unpack(head))
        start, docs = np.cumsum(sizes) - sizes, len(ids)
        which = np.cumsum(which)
        which -= np.repeat(np.r_[0, which[start[1:] - 1]], sizes)
        seen = np.concatenate(seen)[which].astype(np.float64)
        add = lambda x: np.add.reduceat(x, start)
        base = add(np.log10((seen + 1) / (tokens + words + 1)))
        model = add(np.concatenate(logs)[which].astype(np.float64))
        out_ = [held(d, folds, out) for d in ids.tolist()]
        names = pa.array(ids, mask=ids == -1 << 62)
        return pa.table([names, pa.array(out_), pa.array(sizes), pa.array(add((seen > 0).astype(np.int64))), pa.array(np.full(docs, tokens)), pa.array(base), pa.array(model)], names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return score


def _most_frequent(store: Store, texts: DataFrame, folds: int, out: int, ranges: int, frequent: int) -> np.ndarray:
    """The keys of the most frequent training words, sorted."""
    with rows_at_once(store.spark, ROWS):
        counts = texts.mapInArrow(lean(_counting(folds, out, ranges)), _SCHEMA).groupBy("rng").applyInArrow(lean_group(_counted(frequent)), "top binary")
        best = counts.mapInArrow(_best(frequent), "top binary").repartition(1).mapInArrow(_best(frequent), "top binary").collect()  # one row
    return np.sort(np.frombuffer(best[0]["top"], _U).reshape(2, -1)[0]) if best else np.zeros(0, _U)


def scored(spark: SparkSession, docs: DataFrame, folds: int = 7, out: int = 2, frequent: int | None = None, sweeps: int = 2, burn_in: int = 0, seed: int = 11) -> DataFrame:
    """Scores of docs (doc_id, text) by a model of those whose crc32(doc_id as text) mod folds isn't `out`.

    Returns doc_id, held_out, n_tokens (words and one end), n_known (tokens that training has), train_tokens, base_score (log10 by
    add-one word counts), score (log10 by the model), perplexity (10 ** (-score / n_tokens)). Null texts count as empty, a
    null doc_id is never held out; repeated rows count each; an empty table gives no rows; extra columns are ignored. frequent: how
    many words have a context restaurant of their own, if not all of the training texts; all others share those of their classes.
    """
    if frequent is not None and frequent < 0:
        raise ValueError("frequent must be 0 or more, or None for all words")
    store = Store(spark, "pitman-yor")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    chars = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(chars / 6 / RANGE_TOKENS))
    parts = math.ceil(ranges / 4)  # of the contexts
    keys = None if frequent is None else _most_frequent(store, texts, folds, out, ranges, frequent)
    merged = texts.mapInArrow(lean(_blocking(folds, out, ranges, keys)), _SCHEMA).groupBy("rng").applyInArrow(lean_group(_merged), _SCHEMA)
    with rows_at_once(spark, ROWS):
        merged = store.save(merged, "merged", by="kind")
    store.release()

    def of(table: DataFrame, kind: int, name: int | None = None) -> DataFrame:
        return table.where(F.col("kind") == kind).select(F.lit(kind if name is None else name).alias("kind"), "block", "rng", "data")

    def added(table: DataFrame, n: int) -> np.ndarray:
        return sum((np.frombuffer(r["data"], "<f8") for r in of(table, TAIL).mapInArrow(_added, _SCHEMA).collect()), np.zeros(n))

    known = added(merged, 4)
    words, tokens, d = int(known[0]), int(known[1]), _discount(known[2], known[3])
    seats, past, first = of(merged, SEATS), {}, min(burn_in + 1, sweeps)
    with rows_at_once(spark, 1):
        state = store.save(seats.mapInArrow(lean(_started(parts)), _SCHEMA), "turn-0", by="kind")
    with rows_at_once(spark, 64):
        for turn in range(sweeps + 1):
            whole = store.save(of(state, SUMS).groupBy("rng").applyInArrow(lean_group(_totalled(d)), _SCHEMA), f"totals-{turn}", by="kind")
            fits = sum((np.frombuffer(r["data"], "<f8") for r in of(whole, FITS).orderBy("block").collect()), np.zeros(len(GRID)))
            g = totals(added(state, 2 * CLASSES + 8), 0, fits)
            if turn >= first:
                past[turn] = g, whole
            if turn == first:
                placed = seats.union(of(state, STATE)) if turn else seats
            if turn < sweeps:
                rows = seats.union(of(whole, TOTALS))
                rows = rows.union(of(state, STATE)) if turn else rows
                state = store.save(rows.groupBy("rng").applyInArrow(lean_group(_swept(g, words, seed, turn, parts)), _SCHEMA), f"turn-{turn + 1}", by="kind")
                del rows
            store.drop(*([f"totals-{turn}"] if turn < first else []), f"turn-{turn}/kind={SUMS}" if turn == first else f"turn-{turn}")
        rows = placed.union(of(merged, ASKED))
        for turn, (_, whole) in past.items():
            rows = rows.union(of(whole, TOTALS, TOTALS + turn))
        answers = rows.groupBy("rng").applyInArrow(lean_group(_answered({turn: g for turn, (g, _) in past.items()}, words, seed)), _SCHEMA)
        answers = answers.union(of(merged, HEAD))
        schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
        result = store.save(answers.groupBy("block").applyInArrow(lean_group(_scored(folds, out, tokens, words)), schema), "scores")
    store.drop("merged", f"turn-{first}", *(f"totals-{turn}" for turn in past))
    return result.withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))
