import pytest

from cueforge.llm import graph, jaccard_join
from cueforge.llm.store import Store
from helpers import awkward, corpus
from test_words_tokens import plain_words


def brute(rows):
    sets, links = {}, {i: i for i, _, _ in rows}
    for i, t, _ in rows:
        w = plain_words(t)
        sets[i] = frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])

    def top(x):
        while links[x] != x:
            x = links[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((top(a), top(b)))
                links[y] = x
    return {i: (len(sets[i]), top(i)) for i in ids}


@pytest.mark.parametrize(("most", "tile"), [(8, 8192), (1, 3), (4, 2)])
def test_classes(spark, most, tile):
    rows = awkward()
    got = jaccard_join.jaccard_classes(spark, corpus(spark, rows), most=most, tile=tile).collect()
    assert len(got) == len(rows)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == brute(rows)


def test_many_near_copies(spark):
    words = [f"w{i}" for i in range(100)]
    rows = []
    for i in range(60):
        w = list(words)
        for k in range(i % 4):
            w[(7 * i + 31 * k) % 100] = f"x{i}"
        rows.append((i, " ".join(w), "s"))
    got = jaccard_join.jaccard_classes(spark, corpus(spark, rows), tile=16)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got.collect()} == brute(rows)


def test_null_id(spark):
    rows = [(None, "a b c d e f", "s"), (4, "A B C D E F", "s"), (None, "x", None)]
    got = jaccard_join.jaccard_classes(spark, corpus(spark, rows)).collect()
    assert sorted((r["doc_id"] or -1, r["n_shingles"], r["component_id"] or -1) for r in got) == [(-1, 1, -1), (-1, 2, 4), (4, 2, 4)]


def test_empty_table(spark):
    assert jaccard_join.jaccard_classes(spark, corpus(spark, [])).count() == 0


def test_best_match_prefers_longer_prefixes_where_postings_are_cheap():
    import numpy as np

    assert jaccard_join.best_match(np.full(40, 50, np.uint32), 20, 4) == 4
    assert jaccard_join.best_match(np.array([2, 9000, 9000], np.uint32), 1, 3) == 1


def test_components(spark):
    edges = spark.createDataFrame([(i + 1, i) for i in range(40)] + [(100, 101), (101, 100), (7, 7), (None, 1)], "a long, b long")
    got = {r["node"]: r["label"] for r in graph.components(edges, Store(spark, "t"), "c").collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}


def test_short_texts_extended_by_one_word(spark):
    rows = []
    for n in range(8, 13):
        for copies in (1, 2, 3):
            words = [f"w{n}x{copies}x{k}" for k in range(n + 1)]
            rows += [(len(rows) + k, " ".join(words[: n + k % 2]), "s") for k in range(2 * copies)]
            # others that hold the same shingles, so that all of them are shared
            rows += [(len(rows) + k, " ".join([*words, *(f"y{len(rows)}z{k}z{j}" for j in range(30))]), "s") for k in range(copies)]
    got = jaccard_join.jaccard_classes(spark, corpus(spark, rows)).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == brute(rows)
