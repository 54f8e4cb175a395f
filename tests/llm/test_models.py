import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from cueforge.llm import pitman_yor, quality
from helpers import awkward, corpus, sentence
from test_words_tokens import plain_words


def test_scores(spark):
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(x for _ in range(20) for x in (lambda k: (vocabulary[k], vocabulary[(k + 1) % 60]))(min(59, int(rng.expovariate(0.1))))), "s") for i in range(200)]
    rows += [(500 + i, t, s) for i, (_, t, s) in enumerate(awkward(5))]
    got = {r["doc_id"]: r for r in pitman_yor.scored(spark, corpus(spark, rows), frequent=20).collect()}
    texts = {i: plain_words(t) + [None] for i, t, _ in rows}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in texts}
    counts = Counter(w for i, _, _ in rows for w in texts[i] if not held[i])
    n, v = sum(counts.values()), len(counts)
    for i, r in got.items():
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in texts[i])
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held[i], len(texts[i]), sum(counts[w] > 0 for w in texts[i]), n)
        assert r["base_score"] == pytest.approx(base) and r["score"] < 0
    out = [r for i, r in got.items() if r["held_out"] and i < 200]
    assert sum(r["score"] for r in out) > sum(r["base_score"] for r in out)
    again = {r["doc_id"]: r["score"] for r in pitman_yor.scored(spark, corpus(spark, rows), frequent=20).collect()}
    assert all(again[i] == pytest.approx(r["score"]) for i, r in got.items())


def test_every_word_has_a_restaurant(spark):
    """Words that differ in their followers alone, more of them than 16 bits count."""
    n = 36_000
    rows = [(i, " ".join(f"a{k} b{k}" for k in range(i % 360, n, 360)), "s") for i in range(1080)]
    whole, bounded = (sum(r["score"] for r in pitman_yor.scored(spark, corpus(spark, rows), **kw).select("score").collect()) for kw in ({}, {"frequent": 65_470}))
    assert whole > bounded + 5000


def test_contexts_stay_off_the_driver(spark, monkeypatch):
    """What is collected doesn't grow with the words that have restaurants."""
    n, kind, got = 20_000, type(spark.range(0)), []
    plain = kind.collect

    def collect(self):
        rows = plain(self)
        got.append(sum(len(x) for r in rows for x in r if isinstance(x, (bytes, bytearray))))
        return rows

    monkeypatch.setattr(kind, "collect", collect)
    pitman_yor.scored(spark, corpus(spark, [(i, " ".join(f"a{k} b{k}" for k in range(i, n, 400)), "s") for i in range(400)]))
    assert 0 < sum(got) < n


def test_no_texts(spark):
    assert pitman_yor.scored(spark, corpus(spark, [])).count() == 0
    assert pitman_yor.scored(spark, corpus(spark, [(0, None, None), (None, "", None)])).count() == 2


def seated_one_by_one(c, fresh, each, d, rng):
    """Tables of one dish, customer by customer."""
    t = min(c, 1)
    for i in range(1, c):
        a = fresh + each * t
        t += rng.random() < a / (a + i - d * t)
    return t


@pytest.mark.parametrize(("c", "fresh", "each", "d"), [(2, 1.0, 0.5, 0.5), (3, 0.02, 0.01, 0.9), (40, 2.5, 0.3, 0.7), (400, 0.4, 0.2, 0.3), (33, 30.0, 0.9, 0.95)])
def test_seating_is_that_of_customers_one_by_one(c, fresh, each, d):
    rng, n = random.Random(c), 4000
    key = pitman_yor.seeds(n, 900 + c)
    got = pitman_yor.seat(np.full(n, c), np.full(n, fresh), np.full(n, each), d, key)
    plain = np.array([seated_one_by_one(c, fresh, each, d, rng) for _ in range(n)])
    error = np.hypot(got.std(), plain.std()) / math.sqrt(n)
    assert abs(got.mean() - plain.mean()) < 5 * error + 1e-9 and abs(got.std() - plain.std()) < 0.1 * plain.std() + 0.02
    few = slice(0, pitman_yor.FEW)  # the same draws one dish at a time
    assert (got[few] == pitman_yor.seat(np.full(n, c)[few], np.full(n, fresh)[few], np.full(n, each)[few], d, key[few])).all()


def test_seating_of_any_number():
    c = np.array([0, 1, 2, 50, 5000, 10**7, 6 * 10**9])
    t = pitman_yor.seat(c, np.full(7, 1.0), np.full(7, 0.1), 0.5, pitman_yor.seeds(7))
    assert t[:2].tolist() == [0, 1] and (t[1:] >= 1).all() and (t <= c).all() and t[5] > t[3]
    x = np.array([0.05, 0.5, 1, 2.5, 9, 400.25, 1e6])
    assert pitman_yor.lgamma(x) == pytest.approx([math.lgamma(v) for v in x], rel=1e-9, abs=1e-9)


def test_counts_above_32_bits():
    import pyarrow as pa

    n = np.array([5_000_000_000, 3], np.int64)
    data = pitman_yor._request(np.array([64, 128], np.uint64), np.array([0, 1], np.uint16), n)
    assert pitman_yor._open_request(pa.py_buffer(data))[3].tolist() == n.tolist()


def test_scores_do_not_depend_on_the_partitions(spark):
    rows = [(i, t, s) for i, (_, t, s) in enumerate(awkward(30))]
    key, got = "spark.sql.shuffle.partitions", []
    old = spark.conf.get(key)
    try:
        for n in ("4", "40"):
            spark.conf.set(key, n)
            got.append({r["doc_id"]: r["score"] for r in pitman_yor.scored(spark, corpus(spark, rows), frequent=30).collect()})
    finally:
        spark.conf.set(key, old)
    assert got[0].keys() == got[1].keys() and all(got[1][i] == pytest.approx(x, rel=1e-9) for i, x in got[0].items())


def test_probabilities_sum_to_one():
    """Over all known words and one unknown, in every context."""
    words = np.sort(pitman_yor.seeds(50, 77) & ~np.uint64(63) | np.arange(50, dtype=np.uint64))
    frequent = words[:5].copy()
    rng = np.random.default_rng(3)
    contexts = len(frequent) + 1 + 64
    n = rng.poisson(0.4, (51, contexts))
    n[50] = 0  # asked for, but never seen
    all_words = np.sort(np.append(words, np.uint64((1 << 64) - 64)))
    pairs = [(w, c) for w in range(51) for c in range(contexts)]
    request = pitman_yor._request(all_words[[w for w, _ in pairs]], np.array([c for _, c in pairs], np.uint16), np.array([n[w, c] for w, c in pairs], np.uint32))
    head = np.array([0, len(request)], "<i8").tobytes() + request
    import pyarrow as pa

    own = pitman_yor._Range(pa.py_buffer(head), frequent, 50, 1)
    own.start()
    past = [pitman_yor.totals(own.sums(), len(frequent) + 1)]
    for turn in range(3):
        own.sweep(past[-1], turn)
        past.append(pitman_yor.totals(own.sums(), len(frequent) + 1))
    assert own.predict(past[-1]).reshape(51, contexts).sum(0) == pytest.approx(np.ones(contexts))


def test_ranges_go_on_from_a_state():
    """Also from what is packed in few bytes, numbers above 32 bits included."""
    import pyarrow as pa

    words, contexts = np.sort(pitman_yor.seeds(30, 5)), np.sort(pitman_yor.seeds(4, 6))
    n = np.random.default_rng(1).poisson(3, 120)
    n[7] = 5_000_000_000
    request = pitman_yor._request(np.repeat(words, 4), np.tile(np.arange(4, dtype=np.uint32), 30), n)
    data = pa.py_buffer(np.array([0, len(request)], "<i8").tobytes() + request)
    one, two = (pitman_yor._Range(data, contexts, 30, 1) for _ in range(2))
    one.start()
    for turn in range(2):
        g = pitman_yor.totals(one.sums(), 5)
        two.restore(pa.py_buffer(one.state()))
        one.sweep(g, turn)
        two.sweep(g, turn)
    g = pitman_yor.totals(one.sums(), 5)
    assert (one.sums() == two.sums()).all() and (one.predict(g) == two.predict(g)).all()


def junk(rng):
    return " ".join(f"{w.upper()}!!" for w in sentence(rng, 30).split())


def test_quality(spark):
    rng = random.Random(9)
    rows = [(i, " ".join(sentence(rng, 12) for _ in range(5)) if i % 3 else junk(rng), "s") for i in range(300)] + [(900, None, None), (901, "", "s"), (902, "x" * 5000, "s")]
    docs = corpus(spark, rows)
    labels = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(300)] + [(1, None, 0), (7777, 1, 1), (None, 1, 0)], "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r for r in quality.classified(docs, labels).collect()}
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got.values())
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())
    out = [(r["predicted"], int(i % 3 > 0)) for i, r in got.items() if r["held_out"] and i < 300]
    assert sum(a == b for a, b in out) > 0.95 * len(out)
    kept = quality.accepted(docs, labels)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {i for i, r in got.items() if r["predicted"]}


def test_quality_of_one_class(spark):
    docs = corpus(spark, [(1, "a b", "s"), (2, None, "s")])
    one = spark.createDataFrame([(2, 0)], "doc_id long, quality int")
    assert {r["score"] for r in quality.classified(docs, one).collect()} == {0.0}
    assert {r["score"] for r in quality.classified(docs, one.where("false")).collect()} == {1.0}
    assert quality.classified(docs.where("false"), one).count() == 0


def test_scores_follow_the_densities():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(500, len(quality.FEATURES)))
    x[:250] = 3 + 2 * x[:250]
    sums = np.stack([np.r_[len(p), p.sum(0), (p.T @ p).ravel()] for p in (x[:250], x[250:])])
    model = quality.fit(sums, to_diagonal=0, to_pooled=0)
    means = [x[:250].mean(0), x[250:].mean(0)]
    covs = [np.cov(p.T, bias=True) + 1e-4 * np.eye(len(quality.FEATURES)) for p in (x[:250], x[250:])]
    density = [-0.5 * np.linalg.slogdet(covs[c])[1] - 0.5 * np.einsum("ij,jk,ik->i", x - means[c], np.linalg.inv(covs[c]), x - means[c]) for c in (0, 1)]
    assert model.score(x) == pytest.approx(1 / (1 + np.exp(np.clip(density[0] - density[1], -700, 700))), abs=1e-6)
