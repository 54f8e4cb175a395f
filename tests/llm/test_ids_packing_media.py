import hashlib
import random
import zlib

import numpy as np
import pytest

from cueforge.llm import media, packing, repair, tokens
from helpers import awkward, corpus

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("word_bpe_49k.json")


def ids_of(text, end):
    from tokenizers import Tokenizer

    return np.array(Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids + [end], "<u4")


@pytest.mark.parametrize("base", [49_408, 70_000])
def test_shard_round_trip(base):
    random.seed(2)
    docs = [np.array([random.choice([1, 1, 1, 5, 7, 49_407]) for _ in range(random.choice([0, 1, 2, 50, 3000]))] + [1], np.uint32) for _ in range(60)]
    docs.append(np.full(5000, 7, np.uint32))
    data = repair.write_shard(list(range(len(docs))), docs, base)
    shard = repair.Shard(data)
    assert (shard.all_ids() == np.concatenate(docs)).all() and len(data) < 2 * sum(map(len, docs))
    for i, d in enumerate(docs):
        assert shard.ids(i).tolist() == d.tolist()
        a, b = sorted((random.randrange(len(d) + 1), random.randrange(len(d) + 1)))
        assert shard.slice(i, a, b).tolist() == d[a:b].tolist()
    # every rule expands to its stored length
    for r, n in enumerate(shard.lengths.tolist()):
        assert len(repair.expand(np.array([base + r]), shard.rules, base)) == n


def test_no_ids():
    shard = repair.Shard(repair.write_shard([1], [np.zeros(0, np.uint32)], 10))
    assert shard.all_ids().tolist() == [] and shard.ids(0).tolist() == []
    with pytest.raises(ValueError, match="shard"):
        repair.Shard(b"nope")


def test_id_files(spark, monkeypatch):
    rows = awkward(10)
    got = repair.encoded(spark, corpus(spark, rows), PATH).orderBy("start").collect()
    start = 0
    for r, (i, t, _) in zip(got, sorted(rows, key=lambda r: (r[0], r[1] or "")), strict=True):
        ids = ids_of(t, 1)
        assert (r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) == (i, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert repair.encoded(spark, corpus(spark, []), PATH).count() == 0


def test_cuts():
    for n in range(9000):
        parts = packing.cut(n)
        assert sum(a for a, _ in parts) == n and all(1 <= a * k <= 4096 and a > 0 for a, k in parts)


def test_packing(spark):
    rows = [(i, t, s) for i, (_, t, s) in enumerate(awkward(40))]
    got = packing.packed(spark, corpus(spark, rows), PATH).collect()
    by_doc, by_seq = {}, {}
    for r in got:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_seq.setdefault(r["sequence_id"], []).append(r)
    for i, t, _ in rows:
        ids, at = ids_of(t, 2), 0
        for r in sorted(by_doc[i], key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids) and r["ids_crc32"] == zlib.crc32(ids[at : at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)
    for parts in by_seq.values():
        at = 0
        for r in sorted(parts, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 4096 and parts[0]["padded_length"] in (4096, at)
    total = sum(p[0]["padded_length"] for p in by_seq.values())
    assert sum(r["length"] for r in got) > 0.85 * total
    assert packing.packed(spark, corpus(spark, []), PATH).count() == 0


def test_repeated_rows_are_packed_each(spark):
    got = packing.packed(spark, corpus(spark, [(1, "a b", "s"), (1, "a b", "s"), (None, None, None)]), PATH).collect()
    n = len(ids_of("a b", 2))
    assert sum(r["length"] for r in got) == 2 * n + 1


@pytest.mark.parametrize("units", [1, 63, 64, 65, 200])
def test_container(units):
    payload = random.Random(units).randbytes(units * media.UNIT)
    file = media.mux(payload)
    (track,) = media.probe(file)
    assert media.demux(file, track) == payload
    assert (track["codec"], track["timescale"], track["duration"], track["decoded"], len(track["sizes"])) == ("raw ", 8000, len(payload), len(payload), units)
    for k, (a, b) in enumerate(track["keys"].tolist()):
        lo = k * media.KEY_EVERY * media.UNIT
        assert file[a:b] == payload[lo : lo + media.UNIT]
    names = [n for n, _, _ in media.boxes(file)]
    assert names[:2] == ["/ftyp", "/mdat"] and "/moov/trak/mdia/minf/stbl/stsz" in names


def test_foreign_bytes():
    file = media.mux(b" " * media.UNIT)
    assert media.probe(b"") == [] and media.probe(b"junk" * 9) == [] and media.probe(file[:-10]) == []
    with pytest.raises(ValueError, match="unit"):
        media.mux(b"x")


def container(wide, version, sizes, runs, gaps):
    """A file with a size for each sample, several runs of chunks with bytes between them, and 64-bit fields where asked."""
    import struct

    samples = [bytes([65 + i % 26]) * n for i, n in enumerate(sizes)]
    per_chunk = [k for k, times in runs for _ in range(times)]
    body, offsets, at = b"", [], 0
    for c, k in enumerate(per_chunk):
        body += b"\0" * gaps[c % len(gaps)]
        offsets.append(len(body))
        body += b"".join(samples[at : at + k])
        at += k
    box, full = media._box, media._full
    head = box(b"ftyp", b"isom", b"\0\0\2\0", b"isom")
    data = struct.pack(">I", 1) + b"mdat" + struct.pack(">Q", len(body) + 16) + body if wide else box(b"mdat", body)
    offsets = [len(head) + (16 if wide else 8) + o for o in offsets]
    first, table = 1, b""
    for k, times in runs:
        table += struct.pack(">III", first, k, 1)
        first += times
    times = struct.pack(">QQIQ" if version else ">IIII", 0, 0, 1000, 40 * len(sizes))
    stbl = box(
        b"stbl", full(b"stsd", struct.pack(">I", 1), box(b"avc1", b"\0" * 78)), full(b"stts", struct.pack(">5I", 2, 1, 10, len(sizes) - 1, 40)),
        full(b"stsc", struct.pack(">I", len(runs)), table), full(b"stsz", struct.pack(">II", 0, len(sizes)), struct.pack(f">{len(sizes)}I", *sizes)),
        full(b"co64" if wide else b"stco", struct.pack(">I", len(offsets)), struct.pack(f">{len(offsets)}{'Q' if wide else 'I'}", *offsets)),
        full(b"stss", struct.pack(">III", 2, 1, 4)),
    )
    return head + data + box(b"moov", box(b"trak", box(b"mdia", full(b"mdhd", times, b"\0" * 4, version=version), box(b"minf", stbl)))), samples


@pytest.mark.parametrize(("wide", "version"), [(False, 0), (True, 1)])
def test_variable_sizes_and_chunks(wide, version):
    """A table with a size for each sample, runs of chunks that aren't neighbours, 32 and 64-bit offsets, boxes and times."""
    file, samples = container(wide, version, [5, 1, 30, 2, 9, 4, 7, 11], [(2, 1), (1, 2), (3, 1), (1, 1)], [3, 0, 8])
    (track,) = media.probe(file)
    assert [file[a : a + n] for a, n in zip(track["starts"].tolist(), track["sizes"].tolist(), strict=True)] == samples
    assert (track["codec"], track["timescale"], track["duration"], track["decoded"]) == ("avc1", 1000, 320, 10 + 7 * 40)
    assert [file[a:b] for a, b in track["keys"].tolist()] == [samples[0], samples[3]] and media.demux(file, track) == b"".join(samples)


def test_damaged_tables_give_no_track():
    good, _ = container(False, 0, [5, 1, 30, 2, 9, 4, 7, 11], [(2, 1), (1, 2), (3, 1), (1, 1)], [3, 0, 8])
    spans = [(name, lo, hi) for name, lo, hi in media.boxes(good) if name.rpartition("/")[2] in ("stsc", "stsz", "stco", "stts", "stss")]
    assert len(spans) == 5
    for name, lo, hi in spans:
        for at in range(lo + 4, hi):
            for value in (0, 1, 127, 255):
                file = bytearray(good)
                file[at] = value
                for track in media.probe(bytes(file)):  # never raises; what it gives lies in the file
                    assert (track["starts"] + track["sizes"] <= len(file)).all()
        broken = bytearray(good)
        broken[lo + (8 if name.endswith("stsz") else 4)] = 255
        assert media.probe(bytes(broken)) == [], name


def test_stored(spark):
    rows = awkward(10)
    got = media.stored(corpus(spark, rows), media=True).collect()
    assert len(got) == len(rows)
    texts = {i: t for i, t, _ in rows}
    for r in got:
        raw = (texts[r["doc_id"]] or "").encode()
        payload = media.pad(raw)
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"]) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest())
        assert (r["media_bytes"], r["media_sha256"], r["tail_crc32"]) == (len(r["media"]), hashlib.sha256(r["media"]).hexdigest(), zlib.crc32(payload[-16:]))
        assert media.demux(r["media"], media.probe(r["media"])[0]) == payload
    assert media.stored(corpus(spark, [])).count() == 0


def test_vocabulary():
    assert tokens.vocabulary(PATH) == 49_408


def _pairs(symbols, ends):
    """How often each pair of neighbours occurs without overlaps, document by document."""
    seen, starts = {}, [0, *ends[:-1]]
    for a, b in zip(starts, ends, strict=True):
        before = None
        for k in range(a, b - 1):
            pair = (symbols[k], symbols[k + 1])
            if before == (k - 1, pair):
                before = None
                continue
            seen[pair], before = seen.get(pair, 0) + 1, (k, pair)
    return seen


@pytest.mark.parametrize("alphabet", [2, 7, 300])
def test_no_pair_is_left_twice(alphabet):
    rng = np.random.default_rng(alphabet)
    docs = [rng.integers(0, alphabet, n).astype(np.uint32) for n in (0, 1, 2, 900, 0, 3000)]
    docs += [docs[3], docs[5][100:2000], np.full(777, 1, np.uint32)]
    ends = np.cumsum([len(d) for d in docs])
    symbols, cuts, rules = repair.compress(np.concatenate(docs), ends, alphabet)
    assert max(_pairs(symbols.tolist(), cuts.tolist()).values(), default=0) <= 1
    assert repair.expand(symbols, rules, alphabet).tolist() == np.concatenate(docs).tolist()


def test_a_repeated_block_is_stored_once():
    block = np.random.default_rng(1).integers(5, 49_000, 20_000).astype(np.uint32)
    symbols, _, rules = repair.compress(np.tile(block, 5), np.array([100_000]), 49_408)
    assert len(symbols) <= 5 and len(rules) < 1.01 * len(block)


def test_long_runs_take_few_rules():
    symbols, _, rules = repair.compress(np.full(100_000, 7, np.uint32), np.array([100_000]), 10)
    assert len(symbols) + len(rules) < 60
