from pyspark.sql import functions as F

from cueforge import cli
from cueforge.functions import markdown as M
from cueforge.operators import document, topics
from cueforge.sources import records


def test_cues_to_markdown(spark):
    texts = ["vamos falar de gatos", "vamos falar de gatos pretos", "gatos pretos dormem muito", "agora carros novos", "carros novos e velozes", None, "Eclesia <i>antiga</i>"]
    cues = spark.createDataFrame([("abc12345678", i, i * 10_000, i * 10_000 + 9_000, t) for i, t in enumerate(texts)] + [("blank", 0, 0, 1000, " ")], "doc_id string, seq int, start_ms long, end_ms long, text string")
    meta = spark.createDataFrame([("abc12345678", 'O "T"', "20240101")], "doc_id string, title string, date string")
    got = document.to_markdown(cues, meta, rules={"Eclesia": "Igreja"}, elapsed="total")
    rows = got.collect()
    assert len(rows) == 1
    md = rows[0]["md"]
    assert md.startswith('---\ntitle: "O \\"T\\""\nvideo_id: "abc12345678"\nurl: "https://youtube.com/watch?v=abc12345678"\ndate: "2024-01-01"\nduration: "01:09"')
    assert "## Sumário e Tópicos (Timestamps)\n* `[00:00]` **Introdução**\n" in md and "### [00:00:00] - Tópico: Introdução\n[00:00] Vamos falar de gatos" in md
    assert "Igreja antiga." in md and "<i>" not in md and "Agora carros novos" in md
    assert {r["status"]: r["n"] for r in document.converted_counts(cues, got).collect()} == {"converted": 1, "skipped": 1}


def test_clean_cues_pause_counts_dropped_cues(spark):
    cues = spark.createDataFrame([("d", 0, 0, 1000, "um dois"), ("d", 1, 1000, 2000, "um dois"), ("d", 2, 9000, 9500, "um dois três")], "doc_id string, seq int, start_ms long, end_ms long, text string")
    assert [r["clean"] for r in document.clean_cues(cues).orderBy("seq").collect()] == ["Um dois", None, "Três."]


def test_lookups(spark):
    h = spark.createDataFrame([("v1", "U", "c", "u", ["P"]), ("v2", "W", "d", "w", None)], "video_id string, uploader string, channel_id string, uploader_id string, playlists array<string>")
    assert document.origin_of_item(h, "v2").first()["uploader"] == "W"
    assert document.origin_of_playlist(h, "P").first()["uploader"] == "U"
    files = spark.createDataFrame([("v1", "a.srt"), ("v1", "a.md"), ("v2", "b.SRT")], "video_id string, path string")
    assert [r["video_id"] for r in document.pending_markdown(h, files).collect()] == ["v2"]
    docs = records.channel_documents(spark.createDataFrame([("x/db_abc.json", "{}"), ("y.json", '{"youtube_channels": ["@k"]}')], "path string, value string"))
    assert {r["path"]: r["handle"] for r in document.channel_of_document(docs).collect()} == {"x/db_abc.json": "@abc", "y.json": "@k"}
    orphans = spark.createDataFrame([("d/title.pt.srt",), ("d/other.srt",)], "path string")
    infos = spark.createDataFrame([("d/title.info.json", "abcdefghij1")], "path string, video_id string")
    assert [tuple(r) for r in document.recovered_names(orphans, infos).collect()] == [("d/title.pt.srt", "d/title-abcdefghij1.pt.srt")]
    assert document.numbered(files, "video_id", "path").where(F.col("nth") == 2).count() == 1


def test_front_end(spark, tmp_path, capsys):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/c-abcdefghij1.srt").write_text("1\n00:00:01,000 --> 00:00:03,000\nOlá mundo\n\n2\n00:00:04,000 --> 00:00:05,000\nbem vindo\n")
    (tmp_path / "in/db_c.json").write_text('{"videos": [{"video_id": "abcdefghij1", "subtitle_downloaded": true}]}')
    assert cli.main(["status", str(tmp_path / "in")]) == 0
    assert '"total":1,"downloaded":1' in capsys.readouterr().out
    assert cli.main(["markdown", str(tmp_path / "in"), str(tmp_path / "md")]) == 0
    text = (tmp_path / "md/c-abcdefghij1.md").read_text(encoding="utf-8-sig")
    assert "Olá mundo. Bem vindo." in text and 'video_id: "abcdefghij1"' in text
    assert cli.main(["consolidate", str(tmp_path / "md"), str(tmp_path / "out"), "c"]) == 0
    volume = (tmp_path / "out/c-v001.txt").read_text(encoding="utf-8-sig")
    assert "CANAL: c" in volume and '<article class="video-entry">' in volume and "(ID: abcdefghij1)" in volume


def test_consolidation_goes_on(spark, tmp_path, capsys):
    (tmp_path / "in").mkdir()
    run = lambda *more: cli.main(["consolidate", str(tmp_path / "in"), str(tmp_path / "out"), "c", "--max-chars", "700", *more])
    put = lambda n, words: (tmp_path / f"in/c-abcdefghij{n}.md").write_text(f"# **T{n}**\n\n{words}\n")
    volume = lambda n: (tmp_path / f"out/c-v00{n}.txt").read_text(encoding="utf-8-sig")
    put(3, "first " * 20)
    run()
    put(1, "second " * 20)
    put(2, "third " * 20)
    run()
    one = volume(1)
    assert one.count("<article") == 2 and one.index("first") < one.index("second")  # the first volume is filled on, in the order of arrival
    assert volume(2).count("<article") == 1 and "third" in volume(2)
    capsys.readouterr()
    run()
    assert "0 volumes" in capsys.readouterr().out and volume(1) == one
    run("--reset")
    assert "third" in volume(1) and "first" in volume(2)  # all anew, by path


def test_least_topics_and_titles(spark):
    sims = spark.createDataFrame([(d, w, 0.5 + w / 100, n) for d, n in ((1, 3), (2, 5)) for w in range(1, 12)], "doc_id int, window_id int, sim double, least int")
    got = topics.topic_breaks(sims, 0.1, least="least").groupBy("doc_id").count().collect()
    assert {tuple(r) for r in got} == {(1, 2), (2, 4)}
    files = spark.createDataFrame([("x/a.b.srt", "1"), ("x/c.srt", None)], "path string, video_id string")
    lookup = spark.createDataFrame([("1", "", "20240102")], "video_id string, title string, publish_date string")
    assert {(r["title"], r["publish_date"]) for r in document.titled(files, lookup).collect()} == {("a.b", "2024-01-02"), ("c", "Desconhecida")}


def test_records_of_volumes(value):
    front = '<article class="video-entry">\n---\ndate: "2024-01-02"\nvideo_id: "v1"\ntitle: "A "quoted": one"\n---\n\n# A\n\ntitle: "no"\ndate: spoken of\n</article>\n'
    old = "text\nID: v2\nDATA: 2020-01-01\nTITULO: Old\n" + "-" * 60 + "\nmore text\n"
    read = lambda text: [tuple(r) for r in value(M.volume_records(F.lit(text)))]
    assert read(front + front.replace("v1", "v3")) == [('A "quoted": one', "v1", "2024-01-02"), ('A "quoted": one', "v3", "2024-01-02")]
    assert read(front + old) == read(front) and read(old + old) == [("Old", "v2", "2020-01-01")] * 2
    assert read("nothing\n---\nhere") == [] and read("") == []


def test_heads_of_documents(value):
    read = lambda text: tuple(value(M.metadata(F.lit(text))))
    assert read("---\nTitulo: 'One'\r\ndate:\npublish_date: 20240203\nid: x\n---\nbody") == ("One", "2024-02-03", "x")
    assert read("text\n # **Head _line_**\n> **Data:** 2024-03-01 | **Date:** 2020-01-01") == ("Head line", "2024-03-01", None)
    assert read("# T\nData 12, later Date: 20240305") == ("T", "2024-03-05", None)
    assert read("no head") == (None, None, None)


def test_files_without_an_id_stay_apart(spark, tmp_path):
    for name, word in (("one", "Alpha"), ("two", "Beta"), ("x/one", "Gamma")):
        (tmp_path / "in" / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "in" / f"{name}.srt").write_text(f"1\n00:00:01,000 --> 00:00:03,000\n{word} speaks\n")
    assert cli.main(["markdown", str(tmp_path / "in"), str(tmp_path / "md")]) == 0
    texts = {f.name: f.read_text(encoding="utf-8-sig") for f in (tmp_path / "md").iterdir()}
    assert sorted(texts) == ["one-2.md", "one.md", "two.md"]
    assert all(sum(w in t for w in ("Alpha", "Beta", "Gamma")) == 1 for t in texts.values()) and "Beta speaks." in texts["two.md"]


def test_channel_argument():
    assert cli.channel_argument(["https://youtube.com/", "@x"]) == "https://youtube.com/@x"
    assert cli.channel_argument(["My", "Channel"]) == "My Channel" and cli.channel_argument([]) == ""
