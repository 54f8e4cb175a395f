import hashlib
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from cueforge.llm import fingerprint, mixing, queries, spans, url_filter
from cueforge.llm.store import Store
from helpers import awkward, corpus, sentence
from test_words_tokens import plain_words


def shingles(text):
    w = [x for x in re.split(r"[ \t-\r]+", (text or "").lower()) if x]
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def test_fingerprints(spark):
    rows = [(3 * i, t, s) for i, (_, t, s) in enumerate(awkward(30))]
    got = {r["doc_id"]: r for r in fingerprint.compared(spark, corpus(spark, rows)).collect()}
    ordered, same = sorted(rows, key=lambda r: -r[0]), {}
    errors = []
    for (i, t, _), (_, u, _) in zip(ordered, ordered[1:] + ordered[:1], strict=True):
        t, u, r = t or "", u or "", got[i]
        edited = t[: len(t) - len(t) // 3] + u[: len(t) // 3]
        assert (r["n_chars"], r["edited_sha256"]) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert same.setdefault(t, r["fingerprint"]) == r["fingerprint"]
        for other, key in ((edited, "near_edited"), (u, "near_next")):
            a, b = shingles(t), shingles(other)
            assert 0 <= r[key] <= 1
            if len(a | b) > 100:
                errors.append(abs(r[key] - len(a & b) / len(a | b)))
            if a == b:
                assert r[key] == 1
    assert sum(errors) / len(errors) < 0.06
    assert fingerprint.compared(spark, corpus(spark, [])).count() == 0


def test_next_of_repeated_and_null_ids(spark):
    rows = [(5, "five", "s"), (5, "five again", "s"), (None, "none", "s"), (1, "one", "s")]
    got = fingerprint.with_next(spark, corpus(spark, rows).select("doc_id", "text")).collect()
    follow = {r["text"]: r["next_text"] for r in got}
    assert len(got) == 4 and follow["one"] == "none" and follow["none"] in ("five", "five again") and sorted(follow.values()) == sorted(t for _, t, _ in rows)


def test_sketches_merge(value):
    a, b = " ".join(f"a{i}" for i in range(400)), " ".join(f"b{i}" for i in range(2000))
    both = F.lit(f"{a} {b}")
    assert value(fingerprint.containment(fingerprint.sketch(F.lit(a)), fingerprint.sketch(both))) == 1
    assert value(fingerprint.containment(fingerprint.sketch(both), fingerprint.sketch(F.lit(a)))) == pytest.approx(396 / 2396, abs=0.05)
    merged = fingerprint.merge(fingerprint.sketch(F.lit(a)), fingerprint.sketch(F.lit(b)))
    assert set(value(merged["kept"])) <= set(value(fingerprint.sketch(both)["kept"]))
    assert value(fingerprint.containment(fingerprint.sketch(F.lit(a)), merged)) == 1
    assert value(fingerprint.containment(merged, fingerprint.sketch(F.lit(b)))) == pytest.approx(1996 / 2392, abs=0.05)
    assert value(fingerprint.likeness(fingerprint.merge(merged, merged), fingerprint.sketch(both))) > 0.98


def spans_by_hand(rows, run=3, least=15):
    """What stays of each distinct document."""
    cut = re.compile(r"(?<=[.!?])([ \t-\r]+)|(?<=[\n\r])([ \t-\r]*)(?=[^ \t-\r])")
    pieces, seen = {}, {}
    for i, t, _ in rows:
        text, at, out = t or "", 0, []
        for m in cut.finditer(text):
            if m.end() > at and m.end() < len(text):
                out.append(text[at : m.end()])
                at = m.end()
        pieces[(i, t)] = [*out, text[at:]]
    order = sorted(pieces, key=lambda k: k[0])
    gone = {k: set() for k in pieces}
    for k in order:
        plain = [" ".join(plain_words(p)) for p in pieces[k]]
        for s in range(len(plain) - run + 1):
            own = tuple(plain[s : s + run])
            if sum(len(p.split()) or 1 for p in own) < least:
                continue
            if seen.setdefault(own, (k, s)) != (k, s):
                gone[k] |= set(range(s, s + run))
    return {k: "".join(p for j, p in enumerate(pieces[k]) if j not in gone[k]) if gone[k] else k[1] for k in pieces}


def test_spans(spark):
    import random

    rng = random.Random(3)
    passage = " ".join(sentence(rng, 10) for _ in range(6))
    rows = [(i, " ".join(sentence(rng, 9) for _ in range(3)) + (f" {passage} " if i % 3 == 0 else "\n") + sentence(rng, 9), "s") for i in range(12)]
    rows += [(100 + i, t, s) for i, (_, t, s) in enumerate(awkward(10)[:-3])] + [(200, f"{passage}\n{passage}", "s"), rows[5]]
    got = spans.deduplicated(spark, corpus(spark, rows)).collect()
    expected = spans_by_hand(rows)
    assert len(got) == len(rows)
    texts = {i: t for i, t, _ in rows}
    for r in got:
        assert r["text"] == expected[(r["doc_id"], texts[r["doc_id"]])], r["doc_id"]
    assert sum(passage in (r["text"] or "") for r in got) == 1
    assert spans.deduplicated(spark, corpus(spark, [])).count() == 0


def test_water_filling(spark):
    s = spark.createDataFrame([("b", 100), ("a", 10), ("c", 1000), (None, 500)], "source string, source_size long")
    got = {r["source"]: r["target"] for r in mixing.water_fill(s, 3).collect()}
    # weights a 5, b 2, c 1, null 5 of 1610: a stops at 30, b at 300, null at 1500, so c takes no more than its share
    assert got["a"] == 30 and sum(got.values()) == pytest.approx(1610) and got[None] == pytest.approx(1280 * 5 / 6) and got["c"] == pytest.approx(1280 / 6) and got["b"] == 300


def test_mixture(spark):
    rows = awkward(40)
    docs = corpus(spark, rows)
    mix = mixing.mixed(spark, docs).collect()
    assert len(mix) == len(rows)
    size = lambda t: len(plain_words(t))
    texts = {i: t for i, t, _ in rows}
    assert all(r["size"] == size(texts[r["doc_id"]]) and 0 <= r["taken"] <= 3 * r["size"] for r in mix)
    for source in {r["source"] for r in mix}:
        own = [r for r in mix if r["source"] == source]
        assert own[0]["source_size"] == sum(r["size"] for r in own) and abs(sum(r["taken"] for r in own) - own[0]["target"]) <= 0.5
    again = mixing.mixed(spark, docs).collect()
    assert sorted((r["doc_id"], r["taken"]) for r in mix) == sorted((r["doc_id"], r["taken"]) for r in again)
    assert mixing.mixed(spark, corpus(spark, [])).count() == 0


def test_repetitions(spark):
    rows = [(i, t, s) for i, (_, t, s) in enumerate(awkward(20))]
    docs = corpus(spark, rows)
    mix = mixing.mixed(spark, docs)
    out = mixing.repeated(docs, mix)
    assert out.columns == docs.columns
    words, texts = {}, {i: t for i, t, _ in rows}
    for r in out.collect():
        words[r["doc_id"]] = words.get(r["doc_id"], 0) + len(plain_words(r["text"]))
        assert texts[r["doc_id"]].startswith(r["text"]) and r["n_chars"] == len(r["text"])
    assert words == {r["doc_id"]: r["taken"] for r in mix.collect() if r["taken"]}


URLS = [None, "", "no scheme", "http://", "http://net", "http://NET/", "https://a.b.example.net/en/x?q#f", "https://example.net/en", "http://xexample.net/en/", "http://example.com/de/1", "http://a.org/fr/", "http://a.org/", "ftp://b.org/fr/#x", "http://c.net?x/y", "http://example.com/de", "x://y.example.com/de/?"]


def test_urls(spark):
    pages = spark.createDataFrame(list(enumerate(URLS)) + [(3, URLS[3])], "page_id long, url string").withColumn("host", F.lit("clash"))
    got = sorted(tuple(r) for r in url_filter.judged(spark, pages).collect())
    c = duckdb.connect()
    c.sql("create table pages (page_id bigint, url varchar)")
    c.executemany("insert into pages values (?, ?)", [*enumerate(URLS), (3, URLS[3])])
    key = lambda rows: sorted(tuple("" if x is None else x for x in r) for r in rows)
    assert key(got) == key(c.sql(url_filter.ORACLE).fetchall())
    assert url_filter.judged(spark, pages.where("false")).count() == 0
    assert {r["verdict"] for r in url_filter.judged(spark, pages, rules=[]).collect()} == {"allow"}


def test_cascade_is_exact(spark):
    universe = spark.range(5000).select(F.concat(F.lit("k"), "id").alias("key"))
    listed = universe.where("xxhash64(key) % 17 = 0").union(spark.createDataFrame([("not in the corpus",)], "key string"))
    levels = url_filter.cascade(universe, listed, Store(spark, "t"), "c")
    wrong = universe.withColumn("says", F.expr(url_filter.listed_by(levels, "key"))).where("says <> (xxhash64(key) % 17 = 0)")
    assert len(levels) > 1 and wrong.count() == 0


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_oracles(spark, name):
    d = "/root/testdata/sf0.001"
    c = duckdb.connect()
    c.sql(f"create view pages as select * from '{d}/pages.parquet'")
    c.sql(f"create view documents as select * from '{d}/documents.parquet'")
    got = queries.queries()[name](spark, d)
    expected = c.sql(queries.oracle_sql()[name])
    order = sorted(got.columns)
    key = lambda rows: sorted(tuple("" if x is None else str(x) for x in r) for r in rows)
    assert key(got.select(*order).collect()) == key(expected.select(*order).fetchall())


def _distinct_words(rng, n):
    return ["".join(rng.choice("klmnopqrst") for _ in range(7)) for _ in range(n)]


@pytest.mark.parametrize(("sentence_words", "stop"), [((1000,), ""), ((60,), "."), ((24,), "."), ((9, 30, 17), "."), ((16,), ".")])
def test_spans_passages_over_fifty_words_inside_sentences(spark, sentence_words, stop):
    import random

    rng = random.Random(5)
    words, k = _distinct_words(rng, 51), 0
    for n in sentence_words * 51:
        k += n
        if k <= len(words):
            words[k - 1] += stop
    passage, rows = " ".join(words), []
    for i in range(40):
        before, after = (" ".join(_distinct_words(rng, rng.randint(1, 20))) for _ in range(2))
        rows.append((i, f"{before} {passage} {after}", "s"))
    got = {r["doc_id"]: r["text"] for r in spans.deduplicated(spark, corpus(spark, rows)).collect()}
    assert got[0] == rows[0][1]
    for i, t, _ in rows[1:]:
        assert got[i] != t and passage not in got[i], i


@pytest.mark.parametrize(("line_words", "lines"), [(1, 60), (4, 15), (4, 500)])
def test_spans_passages_of_short_lines(spark, line_words, lines):
    import random

    rng = random.Random(9)
    passage = "\n".join(" ".join(_distinct_words(rng, line_words)) for _ in range(lines))
    rows = [(i, f"{sentence(rng, 12)}\n{passage}\n{sentence(rng, 12)}", "s") for i in range(4)]
    got = {r["doc_id"]: r["text"] for r in spans.deduplicated(spark, corpus(spark, rows)).collect()}
    assert got == {i: t if i == 0 else t.replace(f"{passage}\n", "") for i, t, _ in rows}
