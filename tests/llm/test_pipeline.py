import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cueforge.llm import mixing, quality, spans
from cueforge.llm.store import Store
from helpers import corpus
from test_jaccard import brute

DIR = "/root/testdata/sf0.001"


def test_stages(spark):
    store, docs = Store(spark, "t"), spark.read.parquet(f"{DIR}/documents.parquet")
    columns, steps = docs.columns, dict(corpus_pipeline.STAGES)
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality classifier", "n-gram Jaccard join", "substring dedup", "mixing sources to target weights", "packing"]
    ids = lambda df: sorted(r["doc_id"] for r in df.select("doc_id").collect())
    out = store.save(steps[names[0]](spark, docs, DIR), "a")
    known = quality.classified(docs, spark.read.parquet(f"{DIR}/labels.parquet"))
    assert out.columns == columns and ids(out) == ids(known.where("predicted = 1"))
    unique = store.save(steps[names[1]](spark, out, DIR), "b")
    expected = brute([(r["doc_id"], r["text"], None) for r in out.collect()])
    assert unique.columns == columns and ids(unique) == sorted(i for i, (_, top) in expected.items() if i == top)
    clean = store.save(steps[names[2]](spark, unique, DIR), "c")
    whole = spans.deduplicated(spark, unique)
    assert clean.columns == columns and ids(clean) == ids(whole.where((F.col("n_removed") == 0) | (F.trim("text") != "")))
    assert clean.where(F.length("text") != F.col("n_chars")).count() == 0
    mixed = store.save(steps[names[3]](spark, clean, DIR), "d")
    words = mixed.select(F.sum(mixing.n_words(F.col("text")))).first()[0]
    assert mixed.columns == columns and words == mixing.mixed(spark, clean).agg(F.sum("taken")).first()[0]
    packed = steps[names[4]](spark, mixed, DIR)
    whole_docs = packed.where("start = 0").count()
    assert whole_docs == mixed.count()


def test_registered():
    import __spark_entry__

    names = set(__spark_entry__.queries())
    assert "pipeline" in names and all(sum(n.startswith(f"op{i}_") for n in names) == 1 for i in range(1, 11))


def test_one_row_of_each_group_stays(spark):
    a, b = " ".join(f"a{k}" for k in range(40)), " ".join(f"b{k}" for k in range(40))
    rows = [(1, a, "s"), (1, a, "s"), (1, a + " more", "s"), (2, a, "s"), (1, b, "s"), (3, b, "s"), (None, b, "s"), (3, "c d e", "s"), (None, "x y z", "s"), (None, "x y z", "s")]
    kept = corpus_pipeline.near_duplicate_stage(spark, corpus(spark, rows), DIR).collect()
    got = sorted((r["doc_id"] or -1, r["text"][0]) for r in kept)
    assert got == [(-1, "x"), (1, "a"), (1, "b"), (3, "c")]


CLASH = "id long, th long, row string, text2 string, marks string, cut string, size long, taken long, which string, whole long, piece string, turn long, x string, label string, sig long, `key` string, _key string, rank string, class string, draw long, bucket long, hash long, place long, n_sentences int"


def clashing(spark, rows):
    """Documents with a column for each internal name, distinct in every row."""
    names = [c.strip().split(" ")[0].strip("`") for c in CLASH.split(",")]
    kinds = [c.strip().split(" ")[1] for c in CLASH.split(",")]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + CLASH
    full = [(i, t, "en", s, len(t or ""), *(None if (k + j) % 5 == 0 else f"v{k}" if kind == "string" else k for j, kind in enumerate(kinds))) for k, (i, t, s) in enumerate(rows)]
    assert len(full[0] if full else names) >= len(names)
    return spark.createDataFrame(full, schema)


ROWS = [(1, "One two three four five six seven eight nine ten. " * 4, "a"), (1, "One two three four five six seven eight nine ten. " * 4, "a"), (None, "One two three four five six seven eight nine ten. " * 4, None), (None, None, None), (2, "", "a"), (2, " \n", "b"), (3, "word " * 30_000, "b"), (4, None, "b"), (4, "alpha beta gamma", None)]


def _by_row(df):
    return sorted((str(r.asDict()) for r in df.collect()))


@pytest.mark.parametrize("stage", range(4))
def test_stages_on_clashing_names_repeated_and_null_ids(spark, stage):
    docs = clashing(spark, ROWS)
    out = corpus_pipeline.STAGES[stage][1](spark, docs, DIR)
    assert out.columns == docs.columns and out.schema.simpleString() == docs.schema.simpleString()
    got, names = out.collect(), docs.columns[5:]
    extra = {tuple(r[c] for c in names): (r["doc_id"], r["source"]) for r in docs.collect()}
    assert all(extra[tuple(r[c] for c in names)] == (r["doc_id"], r["source"]) for r in got)  # other columns stay with their rows
    if stage == 1:
        assert len({(r["doc_id"], r["text"]) for r in got}) == len(got)
    else:
        assert _by_row(corpus_pipeline.STAGES[stage][1](spark, docs, DIR)) == sorted(str(r.asDict()) for r in got)


@pytest.mark.parametrize("stage", range(5))
def test_stages_on_an_empty_table(spark, stage):
    assert corpus_pipeline.STAGES[stage][1](spark, clashing(spark, []), DIR).count() == 0


def test_mixing_counts_wholly_equal_rows_each(spark):
    from cueforge.llm import mixing

    rows = [(k % 3, "a b c d e f g", f"s{k % 2}") for k in range(40)] + [(9, "x y z", "s0"), (9, None, "s1")]
    docs = corpus(spark, rows)
    mix = Store(spark, "t").save(mixing.mixed(spark, docs), "m")
    out = mixing.repeated(docs, mix)
    assert out.agg(F.sum(mixing.n_words(F.col("text")))).first()[0] == mix.agg(F.sum("taken")).first()[0]
