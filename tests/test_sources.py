from pyspark.sql import functions as F

from cueforge.operators import consolidate
from cueforge.sources import records, sinks, subtitles
from cueforge.streaming import incremental

SRT = "1\r\n00:00:01,000 --> 00:00:03,000\r\nHello\r\n\r\n2\r\n00:00:03,000 --> 00:00:05,500\r\nWorld\r\n\r\n3\r\n00:00:06,000 --> 00:00:07,000\r\n\r\n"
VTT = "WEBVTT\nKind: captions\n\nid-1\n00:01.500 --> 00:03.000 align:start\nOlá\ntudo\n\nNOTE x\n\n01:00:03.000 --> 01:00:04.000\nbem\n"


def cues(df):
    return [tuple(r)[1:] for r in df.orderBy("path", "start_ms").collect()]


def test_srt(spark, tmp_path):
    (tmp_path / "a.srt").write_bytes(SRT.encode())
    (tmp_path / "empty.srt").write_text("")
    got = subtitles.srt_cues(subtitles.texts(spark, str(tmp_path), "srt"))
    assert [c[1:] for c in cues(got)] == [(1000, 3000, "Hello"), (3000, 5500, "World")]
    assert subtitles.fluent_text(got).first()["value"] == "Hello World"
    subtitles.register(spark)
    assert [c[1:] for c in cues(spark.read.format("srt").load(str(tmp_path)))] == [(1000, 3000, "Hello"), (3000, 5500, "World")]


def test_vtt(spark, tmp_path):
    (tmp_path / "a.vtt").write_text(VTT)
    expected = [(1, 1500, 3000, "Olá\ntudo"), (2, 3_603_000, 3_604_000, "bem")]
    got = subtitles.vtt_cues(subtitles.texts(spark, str(tmp_path), "vtt"))
    assert cues(got) == expected
    subtitles.register(spark)
    assert cues(spark.read.format("vtt").load(str(tmp_path))) == expected
    assert subtitles.srt_text(got).first()["value"].startswith("1\n00:00:01,500 --> 00:00:03,000\nOlá\ntudo\n\n2\n01:00:03,000")


def test_databases(spark):
    texts = [("m", '{"folder_repository": "x", "videos": [{"video_id": "abcdefghij1", "title": "T", "consolidated": true}], "channel": "@c"}'), ("l", '[{"id": "abcdefghij2", "title": "U"}, {"id": "bad"}]'), ("c", "{broken")]
    docs = records.channel_documents(spark.createDataFrame(texts, "path string, value string"))
    got = {r["video_id"]: r["consolidated"] for r in records.videos(docs).collect()}
    assert got == {"abcdefghij1": True, "abcdefghij2": False}
    assert records.videos(docs, validate_ids=False).count() == 3
    assert {r["path"]: r["doc"]["youtube_channel"] for r in records.migrated(docs).where("path = 'm'").collect()} == {"m": "@c"}


def test_infos(spark):
    texts = [("d/x-abcdefghij1.info.json", '{"upload_date": "20240115", "fulltitle": "F", "duration": 9}'), ("b.info.json", "[1]")]
    infos = records.info_records(spark.createDataFrame(texts, "path string, value string"))
    r = infos.first()
    assert (infos.count(), r["video_id"], r["title"], r["publish_date"], r["info_downloaded"]) == (1, "abcdefghij1", "F", "2024-01-15", True)
    v = spark.createDataFrame([("abcdefghij1", "N/A", "", None, None, None)], "video_id string, title string, publish_date string, duration_s long, channel string, view_count long")
    h = records.harvest(v, infos).first()
    assert (h["title"], h["publish_date"], h["duration_s"]) == ("F", "2024-01-15", 9)


def test_rules_and_lists(spark):
    lines = spark.createDataFrame([(0, 1, "A = B"), (0, 2, "# x"), (0, 3, "C,D = E"), (0, 4, ""), (1, 1, "A,Z")], "scope int, line_no int, value string")
    assert records.rule_dictionary(records.rules(lines)) == {"A": "Z", "C": "D = E"}
    text = spark.createDataFrame([("youtube abc",), ("x https://y/watch?v=1&watch?v=q2",), ("ARQUIVO: a.txt",), ("ID: abcdefghij1",), ("video_id: \"short\"",)], "value string")
    assert [r[0] for r in records.legacy_ids(text).collect()] == ["abc"]
    assert [r[0] for r in records.legacy_without(text).collect()] == ["q2"]
    assert {tuple(r) for r in records.manifest(text).collect()} == {("file", "a.txt"), ("id", "abcdefghij1")}


def test_files(spark):
    f = spark.createDataFrame([("r/meucanal--ABC12345678.txt",), ("r/archive/meucanal--XYZ12345678.md",), ("r/aleatorio.txt",), ("r/meucanal-v001.txt",)], "path string")
    assert [r[0] for r in records.eligible(f, "meucanal").collect()] == ["r/archive/meucanal--XYZ12345678.md", "r/meucanal--ABC12345678.txt"]
    assert [r[0] for r in records.eligible(f, "meucanal", archives=False).collect()] == ["r/meucanal--ABC12345678.txt"]
    names = spark.range(1).select(records.sidecar_candidates(F.lit("Channel--ID.pt-br.txt"))).first()[0]
    assert names[0] == "Channel--ID.pt-br.info.json" and "Channel--ID.info.json" in names
    side = spark.createDataFrame([("r/meucanal--ABC12345678.info.json", "T")], "path string, title string")
    assert {r["path"]: r["sidecar"] for r in records.with_sidecars(f, side).collect()}["r/meucanal--ABC12345678.txt"]["title"] == "T"
    paths = spark.createDataFrame([("a/b/db_x.json",), ("a/c/archive/y.txt",), ("a/.git/db_z.json",)], "path string")
    assert [r[0] for r in records.channel_folders(paths, "db").collect()] == ["a/b", "a/c"]


def test_cookies(spark):
    lines = [".youtube.com\tTRUE", "google.com\tTRUE", ".evil.com\tT", "#HttpOnly_.google.com\tT", ".notgoogle.com\tT", "#HttpOnly_.evil.com\tT", "# comment"]
    kept = [r[0] for r in records.cookies(spark.createDataFrame([(x,) for x in lines], "value string"), ["google.com", "youtube.com"]).collect()]
    assert kept == [lines[0], lines[1], lines[3], lines[6]]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("x/a.txt", "olá"), ("b.txt", "b")], "file_name string, content string")
    assert sinks.write_texts(df, str(tmp_path), bom=True).agg(F.sum("n_chars")).first()[0] == 4
    assert (tmp_path / "x/a.txt").read_text(encoding="utf-8-sig") == "olá"
    s = sinks.Snapshots(spark, str(tmp_path / "state"))
    assert s.read() is None
    s.write(spark.range(3))
    s.write(s.read().where("id > 0"))
    assert s.read().count() == 2
    s.reset()
    assert s.read() is None


def blocks(spark, part):
    return spark.createDataFrame([("c", f"{i:03d}", f"v{i}", 40) for i in part], "channel string, path string, video_id string, n_chars int")


def test_consolidation_restarts(spark, tmp_path):
    landing = str(tmp_path / "in")
    c = incremental.Consolidation(spark, str(tmp_path / "out"), max_chars=100)
    for part in (range(3), range(2, 6)):  # item 2 comes twice
        blocks(spark, part).write.mode("append").parquet(landing)
        stream = spark.readStream.schema(blocks(spark, []).schema).parquet(landing)
        q = incremental.Consolidation(spark, str(tmp_path / "out"), max_chars=100).start(stream, str(tmp_path / "cp"))
        q.awaitTermination()
    got = [(r["video_id"], r["volume_no"], r["offset"]) for r in c.placed().orderBy("path").collect()]
    assert got == [("v0", 1, 0), ("v1", 1, 40), ("v2", 2, 0), ("v3", 2, 40), ("v4", 3, 0), ("v5", 3, 40)]
    c.batch(blocks(spark, [9]), 0)  # an old batch again
    assert c.placed().count() == 6
    assert incremental.rebuilt_state(c.placed()).first()["last_volume"] == 3


def test_state_against_volumes(spark):
    state = spark.createDataFrame([("a", 2, 10), ("b", 3, 20)], "channel string, last_volume int, last_volume_size long")
    there = spark.createDataFrame([("a", 2, 99), ("b", 1, 5), ("c", 4, 7)], "channel string, last_volume int, last_volume_size long")
    got = {tuple(r) for r in consolidate.reconciled(state, there).collect()}
    assert got == {("a", 2, 99), ("b", 3, 20), ("c", 4, 7)}
    assert consolidate.reconciled(state, there.limit(0)).count() == 2


def test_blocks_without_ids_are_known_by_path(spark, tmp_path):
    c = incremental.Consolidation(spark, str(tmp_path / "out"), max_chars=100)
    rows = lambda *paths: spark.createDataFrame([("c", p, None, 40) for p in paths], "channel string, path string, video_id string, n_chars int")
    c.batch(rows("a", "b"), c.next_batch())
    c.batch(rows("a", "b", "d"), c.next_batch())
    assert [r["path"] for r in c.placed().orderBy("path").collect()] == ["a", "b", "d"]
    assert c.state.read().first()["last_volume"] == 2 and c.next_batch() == 2


def test_file_report_and_vtt_names(spark):
    files = spark.createDataFrame([("a", None), ("b", " "), ("c", "\ufffd\ufffd"), ("d", "text"), ("e", "1\n00:00:00,000 --> 00:00:01,000\nx\n")], "path string, value string")
    got = {r["path"]: (r["n_cues"], r["problem"]) for r in subtitles.file_report(files).collect()}
    assert got == {"a": (0, "missing"), "b": (0, "empty"), "c": (0, "undecodable"), "d": (0, "no cues"), "e": (1, None)}
    names = spark.createDataFrame([("x/a.b-1.pt.vtt",), ("x/a.b-1.srt",), ("x/a title.vtt",), ("x/a-title.vtt",)], "path string")
    assert [r["path"] for r in records.vtt_files(names, "a.b", "1").collect()] == ["x/a.b-1.pt.vtt"]
    assert [r["path"] for r in records.vtt_files(names, "a.b", "2").collect()] == ["x/a title.vtt"]


def test_early_stop_stream(spark, tmp_path):
    rows = [("c", i, f"v{i}", i in (2, 3, 4)) for i in range(7)]
    spark.createDataFrame(rows, "channel string, pos int, video_id string, known boolean").coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("channel string, pos int, video_id string, known boolean").parquet(str(tmp_path / "in"))
    q = incremental.early_stop(stream, run=3).writeStream.format("memory").queryName("stop").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted(r[1] for r in spark.table("stop").collect()) == ["v0", "v1", "v2", "v3"]


def test_names_listings_and_state(spark, value):
    item, lit = F.lit("abcdefghij1"), F.lit
    assert value(records.standard_srt_name(lit("c-abcdefghij1.pt-BR.srt"), "c", item)) == "c-abcdefghij1-pt-BR.srt"
    assert value(records.standard_srt_name(lit("c-abcdefghij1-pt.srt"), "c", item)) == "c-abcdefghij1-pt.srt"
    listing = spark.createDataFrame([("a", "A", "20240101", None, None), ("b", "B", None, "", None), ("c", "C", None, None, None)], "video_id string, title string, upload_date string, publish_date string, date string")
    known = spark.createDataFrame([("b", "2023-01-01")], "video_id string, publish_date string")
    assert {r["video_id"]: r["publish_date"] for r in records.listing_records(listing, known).collect()} == {"a": "2024-01-01", "b": "2023-01-01", "c": "Desconhecida"}
    new, old = spark.createDataFrame([("c", 2)], "channel string, last_volume int"), spark.createDataFrame([("c", 1), ("d", 4)], "channel string, last_volume int")
    assert {tuple(r) for r in records.adopt_old_state(new, old).collect()} == {("c", 2), ("d", 4)}
    files = spark.createDataFrame([("x/b.srt",), ("x/archive/z.srt",), ("x/a.srt",), ("x/n.md",)], "path string")
    assert [r["path"] for r in records.subtitle_listing(files).collect()] == ["x/archive/z.srt", "x/a.srt", "x/b.srt"]
    assert records.archived(files, files.where("path like '%a.srt'")).where("archived").count() == 1
