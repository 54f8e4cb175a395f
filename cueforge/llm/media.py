"""Media columns in ISO base media containers.

mux() stores a payload as samples of one audio track: `ftyp`, `mdat` with the samples, and `moov` with the track's
boxes and sample tables (stsd, stts, stsc, stsz, stco or co64, stss). probe() walks nested boxes, decodes the sample tables and
tells codec, duration and the byte ranges of key samples without decoding payloads; demux() reads the payload back
by these ranges.
"""

from __future__ import annotations

import hashlib
import json
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cueforge.llm.memory import lean

UNIT, RATE, CHUNK_UNITS, KEY_EVERY, CODEC = 192, 8000, 64, 16, b"raw "
#: Boxes of the format that hold other boxes.
CONTAINERS = {b"moov", b"trak", b"mdia", b"minf", b"stbl", b"dinf", b"edts", b"udta", b"mvex", b"moof", b"traf"}
_MATRIX = struct.pack(">9I", 0x10000, 0, 0, 0, 0x10000, 0, 0, 0, 0x40000000)


def _box(kind: bytes, *parts: bytes) -> bytes:
    body = b"".join(parts)
    if len(body) + 8 < 1 << 32:
        return struct.pack(">I", len(body) + 8) + kind + body
    return struct.pack(">I", 1) + kind + struct.pack(">Q", len(body) + 16) + body


def _full(kind: bytes, *parts: bytes, version: int = 0, flags: int = 0) -> bytes:
    return _box(kind, struct.pack(">I", version << 24 | flags), *parts)


def mux(payload: bytes) -> bytes:
    """A container whose samples are the payload's units of UNIT bytes, one byte for each 8-bit audio sample."""
    units = len(payload) // UNIT
    if units * UNIT != len(payload) or not units:
        raise ValueError("the payload isn't a positive multiple of the unit")
    head = _box(b"ftyp", b"isom", struct.pack(">I", 512), b"isom", b"mp42")
    data = _box(b"mdat", payload)
    first = len(head) + len(data) - len(payload)
    chunks, tail = -(-units // CHUNK_UNITS), units % CHUNK_UNITS
    offsets = first + np.arange(chunks, dtype=np.int64) * CHUNK_UNITS * UNIT
    wide = bool(offsets[-1] >> 32)
    runs = [(1, min(units, CHUNK_UNITS), 1)] + ([(chunks, tail, 1)] if tail and chunks > 1 else [])
    keys = np.arange(1, units + 1, KEY_EVERY)
    entry = _box(CODEC, b"\0" * 6, struct.pack(">H", 1), struct.pack(">IIHHHHI", 0, 0, 1, 8, 0, 0, RATE << 16))
    table = _box(
        b"stbl",
        _full(b"stsd", struct.pack(">I", 1), entry),
        _full(b"stts", struct.pack(">III", 1, units, UNIT)),
        _full(b"stss", struct.pack(">I", len(keys)), keys.astype(">u4").tobytes()),
        _full(b"stsc", struct.pack(">I", len(runs)), b"".join(struct.pack(">III", *r) for r in runs)),
        _full(b"stsz", struct.pack(">II", UNIT, units)),
        _full(b"co64" if wide else b"stco", struct.pack(">I", chunks), offsets.astype(">u8" if wide else ">u4").tobytes()),
    )
    span = len(payload)
    long = bool(span >> 32)
    times = struct.pack(">QQIQ" if long else ">IIII", 0, 0, RATE, span)
    track = struct.pack(">QQIIQ" if long else ">IIIII", 0, 0, 1, 0, span)
    refs = _box(b"dinf", _full(b"dref", struct.pack(">I", 1), _full(b"url ", flags=1)))
    media = _box(
        b"mdia",
        _full(b"mdhd", times, struct.pack(">HH", 0x55C4, 0), version=int(long)),
        _full(b"hdlr", struct.pack(">I4s12x", 0, b"soun"), b"samples\0"),
        _box(b"minf", _full(b"smhd", struct.pack(">I", 0)), refs, table),
    )
    header = _full(b"mvhd", times, struct.pack(">IH10x", 0x10000, 0x100), _MATRIX, b"\0" * 24, struct.pack(">I", 2), version=int(long))
    moov = _box(b"moov", header, _box(b"trak", _full(b"tkhd", track, struct.pack(">8xhhHH", 0, 0, 0x100, 0), _MATRIX, struct.pack(">II", 0, 0), version=int(long), flags=7), media))
    return head + data + moov


def boxes(data: bytes | memoryview, start: int = 0, stop: int | None = None, path: str = "") -> Iterator[tuple[str, int, int]]:
    """(path, first byte of the body, end) of every box, containers before what they hold. Stops at a broken box."""
    stop = len(data) if stop is None else stop
    while start + 8 <= stop:
        size, kind, body = int.from_bytes(data[start : start + 4], "big"), bytes(data[start + 4 : start + 8]), start + 8
        if size == 1 and start + 16 <= stop:
            size, body = int.from_bytes(data[start + 8 : start + 16], "big"), start + 16
        elif size == 0:
            size = stop - start
        end = start + size
        if size < body - start or end > stop:
            return
        name = f"{path}/{kind.decode('latin-1')}"
        yield name, body, end
        if kind in CONTAINERS:
            yield from boxes(data, body, end, name)
        start = end


def probe(data: bytes | memoryview) -> list[dict]:
    """Each track's codec, timescale, duration, samples (count and bytes), and key samples' byte ranges (start, end).

    Reads boxes and sample tables only. Broken or foreign bytes give no tracks.
    """
    tracks: list[dict[str, tuple[int, int]]] = []
    for name, lo, hi in boxes(data):
        if name == "/moov/trak":
            tracks.append({})
        elif name.startswith("/moov/trak/") and tracks:
            tracks[-1][name.rpartition("/")[2]] = (lo, hi)
    whole = [t for t in tracks if {"stsd", "stts", "stsc", "stsz", "mdhd"} <= set(t) and ("stco" in t or "co64" in t)]
    found = []
    for t in whole:
        try:
            found.append(_track(data, t))
        except (ValueError, IndexError, OverflowError, MemoryError):  # tables that contradict each other or the file
            continue
    return found


def _numbers(data: bytes | memoryview, at: int, count: int, wide: int = 4) -> np.ndarray:
    if count < 0 or at + count * wide > len(data):
        raise ValueError("a table that is longer than the file")
    return np.frombuffer(data, f">u{wide}", count, at).astype(np.int64)


def _track(data: bytes | memoryview, t: dict[str, tuple[int, int]]) -> dict:
    count = lambda box, skip=4: int(_numbers(data, t[box][0] + skip, 1)[0])
    codec = bytes(data[t["stsd"][0] + 12 : t["stsd"][0] + 16]).decode("latin-1")
    at, long = t["mdhd"][0], data[t["mdhd"][0]] == 1
    scale = int(_numbers(data, at + (20 if long else 12), 1)[0])
    duration = int(_numbers(data, at + (24 if long else 16), 1, 8 if long else 4)[0])
    same, n = _numbers(data, t["stsz"][0] + 4, 2)
    if same and int(n) * int(same) > len(data):
        raise ValueError("more samples than bytes")
    sizes = np.full(n, same) if same else _numbers(data, t["stsz"][0] + 12, int(n))
    where = "co64" if "co64" in t else "stco"
    chunks = _numbers(data, t[where][0] + 8, count(where), 8 if where == "co64" else 4)
    runs = _numbers(data, t["stsc"][0] + 8, 3 * count("stsc")).reshape(-1, 3)
    per_chunk = np.repeat(runs[:, 1], np.diff(np.r_[runs[:, 0], len(chunks) + 1]))
    if (np.diff(np.r_[0, runs[:, 0], len(chunks) + 1]) < (np.arange(len(runs) + 1) < len(runs))).any() or per_chunk.sum() < n or per_chunk.sum() > n + per_chunk.max(initial=0):
        raise ValueError("chunks that don't hold the samples")
    owner = np.repeat(np.arange(len(chunks)), per_chunk)[:n]
    end = np.cumsum(sizes)
    first = np.searchsorted(owner, owner)  # the first sample of the same chunk
    starts = chunks[owner] + (end - sizes) - (end - sizes)[first]
    times = _numbers(data, t["stts"][0] + 8, 2 * count("stts")).reshape(-1, 2)
    keys = _numbers(data, t["stss"][0] + 8, count("stss")) - 1 if "stss" in t else np.arange(n)
    if len(starts) and (starts.min() < 0 or (starts + sizes).max() > len(data)) or len(keys) and (keys.min() < 0 or keys.max() >= n):
        raise ValueError("samples that lie outside of the file")
    return {"codec": codec, "timescale": scale, "duration": duration, "decoded": int((times[:, 0] * times[:, 1]).sum()), "starts": starts, "sizes": sizes, "keys": np.stack([starts[keys], starts[keys] + sizes[keys]], 1)}


def demux(data: bytes | memoryview, track: dict) -> bytes:
    """The track's samples, in order; neighbouring samples are read as one range."""
    starts, ends = track["starts"], track["starts"] + track["sizes"]
    if not len(starts):
        return b""
    breaks = np.flatnonzero(starts[1:] != ends[:-1])
    return b"".join(bytes(data[a:b]) for a, b in zip(starts[np.r_[0, breaks + 1]].tolist(), ends[np.r_[breaks, len(ends) - 1]].tolist(), strict=True))


def pad(raw: bytes) -> bytes:
    """raw and spaces, up to a positive multiple of UNIT."""
    return raw + b" " * (max(UNIT, -(-len(raw) // UNIT) * UNIT) - len(raw))


_FIELDS = [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("payload_bytes", pa.int64()), ("payload_sha256", pa.string()), ("tail_crc32", pa.int64()), ("media_bytes", pa.int64()), ("media_sha256", pa.string()), ("feature", pa.string()), ("codec", pa.string()), ("duration_s", pa.float64()), ("keyframes", pa.int64()), ("media", pa.binary())]


def _stored(media: bool):
    fields = _FIELDS if media else _FIELDS[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, len(batch), 1000):
                rows = [_row(doc, text, media) for doc, text in zip(batch.column(0)[lo : lo + 1000].to_pylist(), batch.column(1)[lo : lo + 1000].to_pylist(), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(c, f[1]) for c, f in zip(zip(*rows, strict=True), fields, strict=True)], names=[f[0] for f in fields])

    return run


def _row(doc: int | None, text: str | None, media: bool) -> tuple:
    raw = (text or "").encode()
    file = mux(pad(raw))
    track = probe(file)[0]
    payload = demux(file, track)
    ranges = hashlib.sha256(track["keys"].astype("<i8").tobytes()).hexdigest()[:16]
    feature = json.dumps({"codec": track["codec"].strip(), "timescale": track["timescale"], "duration": track["duration"], "samples": len(track["sizes"]), "keyframes": len(track["keys"]), "first_key": track["keys"][0].tolist(), "last_key": track["keys"][-1].tolist(), "key_ranges": ranges})
    row = (doc, len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]), len(file), hashlib.sha256(file).hexdigest(), feature, track["codec"].strip(), track["duration"] / track["timescale"], len(track["keys"]))
    return (*row, file) if media else row


def stored(docs: DataFrame, media: bool = False) -> DataFrame:
    """docs (doc_id, text) stored as containers and read back: digests, codec, duration, key samples and a feature string.

    media: also return the files. The feature tells codec, timescale, duration, counts, the first and last key
    sample's byte range and a digest of all ranges. A null or empty text is one unit of spaces. Each row stands alone:
    equal texts give equal values, whatever their doc_id.
    """
    fields = _FIELDS if media else _FIELDS[:-1]
    kinds = {pa.int64(): "long", pa.string(): "string", pa.float64(): "double", pa.binary(): "binary"}
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(lean(_stored(media)), ", ".join(f"{n} {kinds[k]}" for n, k in fields))
