import random

from pyspark.sql import functions as F

from cueforge.operators import consolidate, sequence, topics


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_rollup(spark):
    cues = spark.createDataFrame([("a", 0, "Este é um teste"), ("a", 1, "Este é um teste de legenda"), ("a", 2, "Este é um teste de legenda"), ("a", 3, "Início diferente"), ("b", 0, None), ("b", 1, "x")], "doc string, seq int, text string")
    assert rows(sequence.strip_rollup(cues, "doc", "seq"), "doc", "seq") == [("a", 0, "Este é um teste"), ("a", 1, "de legenda"), ("a", 3, "Início diferente"), ("b", 1, "x")]


def test_rollup_forms_agree_without_drops(spark):
    random.seed(3)
    cues = spark.createDataFrame([(d, i, f"u{i} " + " ".join(random.choice("xy") for _ in range(4))) for d in range(5) for i in range(20)], "doc int, seq int, text string")
    fold = rows(sequence.strip_rollup(cues, "doc", "seq"), "doc", "seq")
    assert fold == rows(sequence.rollup_by_lag(cues, "doc", "seq").select("doc", "seq", "kept"), "doc", "seq")


def test_line_dedup_start():
    assert sequence.dedup_start(["Hello", "World"], ["World", "New"]) == 1
    assert sequence.dedup_start(["A", "B"], ["A", "B", "C"]) == 2
    assert sequence.dedup_start(["A", "B"], ["X", "Y"]) == 0


def test_line_dedup(spark):
    blocks = spark.createDataFrame([("d", 0, ["Olá", "tudo"]), ("d", 1, ["Olá", "tudo", "bem"])], "doc string, seq int, lines array<string>")
    assert rows(sequence.line_dedup(blocks, "doc", "seq"), "seq") == [("d", 0, 0, ["Olá", "tudo"]), ("d", 1, 2, ["bem"])]


def test_fold_lines():
    assert sequence.fold_lines(["cat", "category", " dogs"]) == ["cat", "category", " dogs"]
    assert sequence.fold_lines(["Ola pessoal", "Ola pessoal bem vindos"]) == ["Ola pessoal bem vindos"]
    assert sequence.fold_lines(["igual.", "Igual"]) == ["igual."]


def test_pauses_and_windows(spark):
    cues = spark.createDataFrame([("d", 1, 1000, 5000), ("d", 2, 10_000, 15_000), ("d", 3, 40_000, 45_900)], "doc string, seq int, start_ms long, end_ms long")
    assert rows(sequence.pauses(cues, "doc", "seq").select("seq", "pause_s", "is_last"), "seq") == [(1, 5.0, False), (2, 25.0, False), (3, 0.0, True)]
    sized = cues.withColumn("size", F.lit(30))
    assert [r[2] for r in rows(sequence.elapsed_windows(sized, "doc", "seq", "size"), "seq")] == [0, 0, 0]
    more = sized.union(spark.createDataFrame([("d", 4, 50_000, 51_000, 30)], sized.schema))
    assert [r[2] for r in rows(sequence.elapsed_windows(more, "doc", "seq", "size"), "seq")] == [0, 0, 0, 1]
    wide = cues.withColumn("size", F.lit(60)).withColumn("end_ms", F.col("end_ms") + 100_000)
    assert {r[2] for r in rows(sequence.elapsed_windows(wide, "doc", "seq", "size"), "seq")} == {0}  # the seconds place never passes 59
    assert [r[2] for r in rows(sequence.elapsed_windows(wide, "doc", "seq", "size", elapsed="total"), "seq")] == [0, 1, 2]


def test_paragraphs(spark):
    cues = spark.createDataFrame([("d", i, i * 30_000, i * 30_000 + 29_000, t) for i, t in enumerate(["a", "b", "c.", "d", None])], "doc string, seq int, start_ms long, end_ms long, text string")
    assert rows(sequence.paragraphs(cues, ["doc"], "seq", elapsed="total"), "para") == [("d", 0, 0, "a b c."), ("d", 1, 90_000, "d")]


def test_known_run(spark):
    known = [False, True, True, False, True, True, True, False]
    e = spark.createDataFrame([("c", i, k) for i, k in enumerate(known)], "channel string, pos int, known boolean")
    assert [r[1] for r in rows(sequence.known_run_cutoff(e, "channel", "pos", "known", run=3), "pos")] == [0, 1, 2, 3, 4, 5]


def test_topics(spark):
    texts = ["gato gato preto", "gato preto lindo", "carro novo azul", "carro azul veloz", "lua cheia brilha"]
    w = spark.createDataFrame([("d", i, t) for i, t in enumerate(texts)], "doc_id string, window_id int, text string")
    weights = topics.tfidf(w)
    norms = weights.groupBy("window_id").agg(F.sum(F.col("weight") * F.col("weight")).alias("n")).collect()
    assert all(abs(r["n"] - 1) < 1e-9 for r in norms)
    sims = topics.neighbour_similarity(weights, w)
    got = {r["window_id"]: r["sim"] for r in sims.collect()}
    assert got[2] == 0 and got[4] == 0 and got[1] > 0.4 and got[3] > 0.4
    breaks = topics.topic_breaks(sims, 0.1)
    assert [r[1] for r in rows(breaks, "window_id")] == [2, 4]
    placed = topics.segments(w.select("doc_id", "window_id"), breaks)
    labels = {r["seg_no"]: r["label"] for r in topics.keywords(weights, placed, ["novo"]).collect()}
    assert labels[1] == "Introdução" and labels[2].startswith("azul · carro")


def test_breaks_are_filled_up(spark):
    sims = spark.createDataFrame([("d", i, s) for i, s in enumerate([0.9, 0.3, 0.2, 0.8, 0.4], 1)], "doc_id string, window_id int, sim double")
    assert [r[1] for r in rows(topics.topic_breaks(sims, 0.1, least=3), "window_id")] == [3, 5]
    assert "então" in topics.stop_words("pt_BR") and "the" in topics.stop_words("en")


def test_no_terms(spark):
    w = spark.createDataFrame([("d", 0, "a"), ("d", 1, None)], "doc_id string, window_id int, text string")
    assert topics.tfidf(w).count() == 0
    assert rows(topics.neighbour_similarity(topics.tfidf(w), w), "window_id") == [("d", 1, 0.0)]


def test_fold_keeps_keys_whole_after_a_join_on_them(spark):
    """Joins of large tables are planned by sorting and turn into broadcasts once Spark sees that one side is small."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "10MB", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        blocks = spark.range(0, 600, 1, 6).selectExpr("cast(id % 2 as string) as channel", "id as path", "id % 7 + 1 as n_chars")
        state = spark.createDataFrame([("0", 7, 1000), ("1", 3, 95)], "channel string, last_volume int, last_volume_size long")
        got = rows(consolidate.pack(blocks, max_chars=2000, header=5, state=state).select("channel", "path", "volume_no", "offset"), "channel", "path")
    finally:
        for k in settings:
            spark.conf.unset(k)
    expected = []
    for channel, volume, used in (("0", 7, 1000), ("1", 3, 95)):
        for path in range(int(channel), 600, 2):
            n = path % 7 + 1
            if used + n > 2000:
                volume, used = volume + 1, 5
            expected.append((channel, path, volume, used))
            used += n
    assert got == expected
