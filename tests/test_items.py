import pytest
from pyspark.sql import functions as F

from cueforge.operators import consolidate, merge, select, status


def test_merge_records(spark):
    r = spark.createDataFrame([
        ("a", 0, "N/A", "Desconhecida", False, None, ["PL001"]), ("a", 1, "Real", "2024-01-01", True, "@c", ["PL001", "PL002"]),
        ("a", 2, "Outro", "2025-01-01", False, "@d", None), ("b", 3, "Avulso", "N/A", None, "", None), ("", 4, "x", "y", True, "@", None),
    ], "video_id string, pos int, title string, publish_date string, subtitle_downloaded boolean, source_channel string, playlists array<string>")
    got = {x["video_id"]: x for x in merge.merge_records(r).collect()}
    a, b = got["a"], got["b"]
    assert (a["title"], a["publish_date"], a["subtitle_downloaded"], a["source_channel"], a["playlists"]) == ("Real", "2024-01-01", True, "@c", ["PL001", "PL002"])
    assert (b["title"], b["publish_date"], b["subtitle_downloaded"], b["source_channel"], set(got)) == ("Avulso", "N/A", False, None, {"a", "b"})


def test_upsert(spark):
    s = spark.createDataFrame([("a", "T", "2024-01-01", "@ch", ["P"], True), ("b", "N/A", "N/A", None, None, None)], "video_id string, title string, publish_date string, source_channel string, playlists array<string>, subtitle_downloaded boolean")
    n = spark.createDataFrame([("a", "N/A", "Desconhecida"), ("b", "B", "2024-02-02"), ("c", "C", "N/A")], "video_id string, title string, publish_date string")
    got = {r["video_id"]: r for r in merge.upsert_listing(s, n, tag="@Channel", playlist="Q").collect()}
    assert (got["a"]["title"], got["a"]["publish_date"], got["a"]["source_channel"], got["a"]["playlists"], got["a"]["is_new"]) == ("T", "2024-01-01", "@Channel", ["P", "Q"], False)
    assert (got["b"]["title"], got["b"]["publish_date"], got["c"]["is_new"], got["c"]["publish_date"]) == ("B", "2024-02-02", True, "N/A")
    parity = {r["video_id"]: r["publish_date"] for r in merge.upsert_listing(s, n, parity_dates=True).collect()}
    assert parity["a"] == "Desconhecida"


def test_channels(spark):
    c = spark.createDataFrame([("@a", 0), ("@a", 1), ("https://www.youtube.com/@a", 2), ("@b", 3)], "item string, pos int")
    assert [r["item"] for r in merge.dedup_channels(c).orderBy("pos").collect()] == ["@a", "@b"]
    one = merge.dedup_channels(c)
    assert merge.register_channel(one.select("item", "pos"), "B").count() == 2
    more = merge.register_channel(one.select("item", "pos"), "new").orderBy("pos").collect()
    assert [r["item"] for r in more] == ["@a", "@b", "@new"]


def test_filters(spark):
    v = spark.createDataFrame([("a", "2024-06-01", "@x.official"), ("b", "2022-01-01", "@y"), ("c", "N/A", None)], "video_id string, publish_date string, source_channel string")
    ids = lambda df: sorted(r["video_id"] for r in df.collect())
    assert ids(select.since(v, "20240101")) == ["a"]
    assert ids(select.since(v, "")) == ["a", "b", "c"]
    assert ids(select.of_channel(v, "X")) == ["a"]
    assert ids(select.of_channel(v, "@x", first=True)) == ["a", "c"]
    assert select.single_item(v, "zz").first()["publish_date"] == "N/A"
    assert ids(select.working_items(v, item="b", limit="20240101")) == ["b"]
    with pytest.raises(ValueError):
        select.since(v, "2024")


def test_language_mode(spark):
    s = spark.createDataFrame([(i, x) for i, x in enumerate(["NA", "none", "NA", "pt-BR", "en", "EN", "PT-br"])], "pos int, lang string")
    assert select.language_mode(s).first()["lang"] == "pt"


def test_skip_and_status(spark):
    v = spark.createDataFrame([("a", True, None), ("b", None, True), ("c", None, None), ("d", False, False)], "video_id string, subtitle_downloaded boolean, has_no_subtitle boolean")
    disk = spark.createDataFrame([("c",), ("c",)], "video_id string")
    p = merge.skip_partition(v, disk)
    assert {r["video_id"]: r["to_download"] for r in p.collect()} == {"a": False, "b": False, "c": False, "d": True}
    assert merge.skip_partition(v, disk, retry_without=True).where("to_download").count() == 2
    assert tuple(status.partition_summary(p).first()) == (4, 1, 3, 1)
    assert tuple(status.channel_status(v.withColumn("channel", F.lit("x"))).first()) == ("x", 4, 1, 1, 2)


def placed(spark, sizes, **kw):
    b = spark.createDataFrame([("c", i, n) for i, n in enumerate(sizes)], "channel string, path int, n_chars int")
    return [(r["volume_no"], r["offset"]) for r in consolidate.pack(b, **kw).orderBy("path").collect()]


def test_packing_boundaries(spark):
    assert placed(spark, [50, 40, 10, 1], max_chars=100) == [(1, 0), (1, 50), (1, 90), (2, 0)]
    assert placed(spark, [50, 40, 10], max_chars=100, header=10) == [(1, 10), (1, 60), (2, 10)]
    assert placed(spark, [5, 500, 5], max_chars=100) == [(1, 0), (2, 0), (3, 0)]


def test_packing_resumes(spark):
    state = spark.createDataFrame([("c", 3, 90)], "channel string, last_volume int, last_volume_size long")
    assert placed(spark, [10, 1], max_chars=100, state=state) == [(3, 90), (4, 0)]
    full = spark.createDataFrame([("c", 3, 100)], "channel string, last_volume int, last_volume_size long")
    assert placed(spark, [10], max_chars=100, state=full) == [(4, 0)]  # a full volume isn't written over


def test_volumes(spark):
    b = spark.createDataFrame([("c", "a.md", "v1", "T1", "2024-01-01", "A"), ("c", "b.md", "v1", "T1", "2024-01-01", "B"), ("c", "c.md", None, None, None, "C")], "channel string, path string, video_id string, title string, date string, block string")
    v = consolidate.volumes(consolidate.pack(b.withColumn("n_chars", F.length("block")), max_chars=100), F.lit("now")).first()
    assert v["file_name"] == "c-v001.txt" and v["video_ids"] == ["v1"] and "ABC" in v["content"] and v["content"].count("(ID: v1)") == 1


def test_best_files(spark):
    f = spark.createDataFrame([("v", "x.srt"), ("v", "x.txt"), ("v", "x.md"), (None, "d/y.txt"), ("Sem ID", "z.jpg")], "video_id string, path string")
    assert {r["video_id"]: r["path"] for r in consolidate.best_files(f).collect()} == {"v": "x.md", "FILE_y.txt": "d/y.txt", "FILE_z.jpg": "z.jpg"}


def test_two_steps_of_packing_as_in_one_where_joins_turn_into_broadcasts(spark):
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "10MB", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        part = lambda lo, hi: spark.range(lo, hi, 1, 6).selectExpr("cast(id % 2 as string) as channel", "id as path", "id % 7 + 1 as n_chars")
        pack = lambda blocks, **kw: consolidate.pack(blocks, max_chars=200, header=5, **kw).select("channel", "path", "volume_no", "offset")
        first = pack(part(0, 300))
        state = consolidate.last_volumes(first.join(part(0, 300), ["channel", "path"]))
        both = first.union(pack(part(300, 600), state=spark.createDataFrame(state.collect(), state.schema)))
        assert sorted(map(tuple, both.collect())) == sorted(map(tuple, pack(part(0, 600)).collect()))
    finally:
        for k in settings:
            spark.conf.unset(k)


def test_two_steps_of_packing_keep_repeated_blocks_and_null_channels(spark):
    first = [("c", 1, 30), ("c", 1, 30), ("c", 2, 50), (None, 1, 60)]
    second = [("c", 3, 20), ("c", 3, 40), (None, 2, 30), (None, 3, 30)]
    frame = lambda rows: spark.createDataFrame(rows, "channel string, path int, n_chars int")
    one = consolidate.pack(frame(first), max_chars=100)
    both = one.union(consolidate.pack(frame(second), max_chars=100, state=consolidate.last_volumes(one)))
    assert both.columns == ["channel", "path", "n_chars", "volume_no", "offset"]
    got = sorted(map(tuple, both.collect()), key=lambda r: (r[0] or "", r[3], r[4]))
    assert [r for r in got if r[0]] == [("c", 1, 30, 1, 0), ("c", 1, 30, 1, 30), ("c", 2, 50, 2, 0), ("c", 3, 20, 2, 50), ("c", 3, 40, 3, 0)]
    assert [r for r in got if not r[0]] == [(None, 1, 60, 1, 0), (None, 2, 30, 1, 60), (None, 3, 30, 2, 0)]


def test_volumes_above_999_have_names_of_their_own(spark):
    placed = spark.createDataFrame([("c", n, "p", "v", "t", "d", "b") for n in (7, 100, 1000, 1001)], "channel string, volume_no int, path string, video_id string, title string, date string, block string")
    names = [r["file_name"] for r in consolidate.volumes(placed, F.lit("now")).orderBy("volume_no").collect()]
    assert names == ["c-v007.txt", "c-v100.txt", "c-v1000.txt", "c-v1001.txt"]
