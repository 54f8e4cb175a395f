"""Queries about landed files: item databases, sidecars, rules, manifests, names and saved state, made of the driver tables' rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cueforge.functions import text as T
from cueforge.operators import consolidate, document, merge, select, status
from cueforge.plans.item_queries import _SIZES
from cueforge.plans.registry import query
from cueforge.session import table
from cueforge.sources import records, subtitles


def _s(c: str) -> Column:
    return F.col(c).cast("string")


def _cat(*parts: Column | str) -> Column:
    """Strings as literals and columns, joined."""
    return F.concat(*(F.lit(p) if isinstance(p, str) else p for p in parts))


@query("vtt_cues", """
with t as (select conv_id, turn, regexp_replace(regexp_replace(text, '\\n\\s*', chr(10), 'g'), '^\\s+|\\s+$', '', 'g') as t from conversations)
select cast(conv_id as varchar) as path, cast(row_number() over (partition by conv_id order by turn) as integer) as seq, turn * 5000 + 250 as start_ms, turn * 5000 + 4750 as end_ms, md5(t) as text from t""")
def vtt_cues(spark: SparkSession, d: str) -> DataFrame:
    """Every conversation as one WebVTT file with a header block, cue ids and settings."""
    time = lambda ms: F.format_string("%02d:%02d.%03d", F.floor(ms / 60000), F.floor(ms / 1000) % 60, ms % 1000)
    at = F.col("turn") * 5000
    text = T.strip(F.regexp_replace("text", r"\n\s*", "\n"))
    block = _cat("id", _s("turn"), "\n", time(at + 250), " --> ", time(at + 4750), " align:start\n", text)
    listed = F.array_sort(F.collect_list(F.struct("turn", block.alias("b"))))
    files = table(spark, d, "conversations").groupBy(_s("conv_id").alias("path")).agg(_cat("WEBVTT\r\nKind: captions\r\n\r\n", F.array_join(F.transform(listed, lambda x: x["b"]), "\n\n")).alias("value"))
    return subtitles.vtt_cues(files).select("path", "seq", "start_ms", "end_ms", F.md5(F.col("text").cast("binary")).alias("text"))


@query("subtitle_file_report", """
with v as (select conv_id, min(regexp_replace(text, '^\\s+|\\s+$', '', 'g')) filter (turn = 0) as t, conv_id % 4 as k from conversations group by conv_id)
select 'f' || conv_id as path, cast(case when k = 0 and t <> '' then 1 else 0 end as bigint) as n_cues, case when k = 0 and t <> '' then null when k = 1 then 'missing' when k = 2 then 'empty' else 'no cues' end as problem from v""")
def subtitle_file_report(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("conv_id") % 4
    text = _cat("1\n00:00:00,000 --> 00:00:02,000\n", T.strip(F.col("text")), "\n")
    value = F.when(k == 0, text).when(k == 2, " \n").when(k == 3, T.strip(F.col("text")))
    return subtitles.file_report(table(spark, d, "conversations").where("turn = 0").select(_cat("f", _s("conv_id")).alias("path"), value.alias("value")))


def _infos(spark: SparkSession, d: str) -> DataFrame:
    """A sidecar for each document, in four forms by id; the last is no object."""
    i, k = _s("doc_id"), F.col("doc_id") % 4
    value = (
        F.when(k == 0, _cat('{"id": "v', i, '", "title": "T', i, '", "upload_date": "20240105", "duration": ', i, ', "uploader": "', F.col("source"), '"}'))
        .when(k == 1, _cat('{"display_id": "v', i, '", "fulltitle": "F', i, '", "title": "", "publish_date": "2024-01-06", "channel": "', F.col("lang"), '"}'))
        .when(k == 2, '{"title": null, "view_count": 7}').otherwise("[1, 2]")
    )
    path = F.when(k == 2, _cat("/x/c-", F.lpad(i, 11, "w"), ".info.json")).otherwise(_cat("/x/c", i, ".info.json"))
    return records.info_records(table(spark, d, "documents").select(path.alias("path"), value.alias("value")))


_INFOS = """i as (select doc_id, case when doc_id % 4 = 2 then lpad(cast(doc_id as varchar), 11, 'w') else 'v' || doc_id end as video_id, case doc_id % 4 when 0 then 'T' || doc_id when 1 then 'F' || doc_id else 'Avulso' end as title,
  case doc_id % 4 when 0 then '2024-01-05' when 1 then '2024-01-06' else 'Desconhecida' end as publish_date, doc_id % 4 <> 2 as info_downloaded, case when doc_id % 4 = 0 then source when doc_id % 4 = 1 then lang end as channel,
  case when doc_id % 4 = 0 then doc_id end as duration_s, case when doc_id % 4 = 2 then cast(7 as bigint) end as view_count from documents where doc_id % 4 <> 3)"""


@query("info_records", f"with {_INFOS} select video_id, title, publish_date, info_downloaded, channel, channel as uploader, coalesce(duration_s, -1) as duration_s, coalesce(view_count, -1) as view_count from i")
def info_records(spark: SparkSession, d: str) -> DataFrame:
    return _infos(spark, d).select("video_id", "title", "publish_date", "info_downloaded", "channel", "uploader", F.coalesce("duration_s", F.lit(-1)).alias("duration_s"), F.coalesce("view_count", F.lit(-1)).alias("view_count"))


@query("harvest_infos", f"""with {_INFOS}, v as (select 'v' || doc_id as video_id, case when doc_id % 3 = 0 then 'N/A' else 'own' end as title, case when doc_id % 2 = 0 then 'Desconhecida' else '2020-01-01' end as publish_date, case when doc_id % 8 = 0 then 0 else 5 end as duration_s, '' as channel from documents)
select v.video_id, case when v.title = 'N/A' and i.title <> 'Avulso' then i.title else v.title end as title, case when v.publish_date = 'Desconhecida' then coalesce(i.publish_date, v.publish_date) else v.publish_date end as publish_date,
  cast(case when v.duration_s = 0 then coalesce(i.duration_s, 0) else v.duration_s end as bigint) as duration_s, coalesce(i.channel, v.channel) as channel, coalesce(i.view_count, 0) as view_count from v left join i using (video_id)""")
def harvest_infos(spark: SparkSession, d: str) -> DataFrame:
    n = F.col("doc_id")
    items = table(spark, d, "documents").select(
        _cat("v", _s("doc_id")).alias("video_id"), F.when(n % 3 == 0, "N/A").otherwise("own").alias("title"), F.when(n % 2 == 0, "Desconhecida").otherwise("2020-01-01").alias("publish_date"),
        F.when(n % 8 == 0, 0).otherwise(5).cast("long").alias("duration_s"), F.lit("").alias("channel"), F.lit(0).cast("long").alias("view_count"),
    )
    return records.harvest(items, _infos(spark, d))


@query("with_sidecars", f"""with {_INFOS}
select 'c' || d.doc_id || '-part.pt-br.txt' as path, i.title from documents d left join i on i.doc_id = d.doc_id and d.doc_id % 4 <> 2""")
def with_sidecars(spark: SparkSession, d: str) -> DataFrame:
    files = table(spark, d, "documents").select(_cat("/x/c", _s("doc_id"), "-part.pt-br.txt").alias("path"))
    return records.with_sidecars(files, _infos(spark, d).select("path", "title")).select(F.substring_index("path", "/", -1).alias("path"), "sidecar.title")


def _databases(spark: SparkSession, d: str) -> DataFrame:
    """A source's documents as an item database, an object or a bare list, with a broken file beside them."""
    i = _s("doc_id")
    item = F.when(F.col("doc_id") % 2 == 0, _cat('{"video_id": "', F.lpad(i, 11, "a"), '", "title": "', F.col("lang"), '", "consolidated": true}')).otherwise(_cat('{"id": "', F.lpad(i, 9, "0"), '", "video_id": "", "has_no_subtitle": true}'))
    items = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("doc_id", item.alias("j")))), lambda x: x["j"]), ", ")
    by = table(spark, d, "documents").groupBy("source").agg(items.alias("items"))
    value = F.when(F.length("source") % 2 == 0, _cat('{"channel": "', F.col("source"), '", "lexis": {"processed_ids": ["', F.lit("x"), '"], "last_volume": 3}, "videos": [', F.col("items"), "]}")).otherwise(_cat(" [", F.col("items"), "]"))
    broken = by.limit(1).select(F.lit("broken").alias("path"), F.lit('{"videos": [').alias("value"))
    return by.select(F.col("source").alias("path"), value.alias("value")).union(broken)


@query("item_databases", """
select source as path, cast(row_number() over (partition by source order by doc_id) - 1 as integer) as pos, lpad(cast(doc_id as varchar), case when doc_id % 2 = 0 then 11 else 9 end, case when doc_id % 2 = 0 then 'a' else '0' end) as video_id,
  case when doc_id % 2 = 0 then lang end as title, doc_id % 2 = 0 as consolidated, doc_id % 2 = 1 as has_no_subtitle from documents""")
def item_databases(spark: SparkSession, d: str) -> DataFrame:
    return records.videos(records.channel_documents(_databases(spark, d))).select("path", "pos", "video_id", "title", "consolidated", F.coalesce("has_no_subtitle", F.lit(False)).alias("has_no_subtitle"))


@query("migrated_databases", """
select source as path, case when length(source) % 2 = 0 then source end as youtube_channel, case when length(source) % 2 = 0 then 3 else 0 end as last_volume, count(*) as n, count(*) filter (doc_id % 2 = 0) as flagged from documents group by source
union all select 'broken', null, 0, 0, 0""")
def migrated_databases(spark: SparkSession, d: str) -> DataFrame:
    doc = records.migrated(records.channel_documents(_databases(spark, d), state_key="lexis"))
    flagged = F.size(F.filter("doc.videos", lambda v: v["consolidated_notebooklm"])).cast("long")
    return doc.select("path", "doc.youtube_channel", F.coalesce("doc.state.last_volume", F.lit(0)).alias("last_volume"), F.size("doc.videos").cast("long").alias("n"), flagged.alias("flagged"))


@query("history_scan", f"""with {_INFOS}, a as (select lpad(cast(doc_id as varchar), 11, 'a') as video_id, lang as title, true as consolidated from documents where doc_id % 2 = 0 union all select lpad(cast(doc_id as varchar), 9, '0'), null, false from documents where doc_id % 2 = 1)
select coalesce(a.video_id, i.video_id) as video_id, coalesce(a.title, i.title) as title, coalesce(a.consolidated, false) as consolidated from a full outer join i on a.video_id = i.video_id""")
def history_scan(spark: SparkSession, d: str) -> DataFrame:
    return records.history(records.channel_documents(_databases(spark, d)), _infos(spark, d)).select("video_id", "title", "consolidated")


@query("rule_lines", """
with l as (select 0 as scope, c_custkey as n, 's' || c_custkey % 40 as o, case when c_custkey % 2 = 0 then c_name else 'a, b=' || c_custkey end as r from customer where c_custkey % 5 <> 0
 union all select 1, c_custkey, 's' || c_custkey % 40, c_mktsegment from customer where c_custkey % 40 < 10 and c_custkey % 5 <> 0)
select o as original, arg_max(r, struct_pack(s := scope, n := n)) as replacement from l group by o""")
def rule_lines(spark: SparkSession, d: str) -> DataFrame:
    """Rules of two scopes with comments and blank lines; a comma goes before an equals sign, and only the first counts."""
    c, k = table(spark, d, "customer"), F.col("c_custkey")
    source = _cat("s", (k % 40).cast("string"))
    line = F.when(k % 10 == 0, "  ").when(k % 5 == 0, _cat("# ", source, ", x")).when(k % 2 == 0, _cat(source, " = ", F.col("c_name"))).otherwise(_cat(" ", source, " , a, b=", _s("c_custkey")))
    base = c.select(F.lit(0).alias("scope"), k.alias("line_no"), line.alias("value"))
    local = c.where(k % 40 < 10).select(F.lit(1).alias("scope"), k.alias("line_no"), F.when(k % 5 == 0, "#").otherwise(_cat(source, "=", F.col("c_mktsegment"))).alias("value"))
    return records.rules(base.union(local))


@query("legacy_lines", """
select 'downloaded' as kind, 'i' || o_custkey as video_id from orders where o_orderkey % 3 = 0 group by o_custkey union all select 'without', 'i' || o_custkey from orders where o_orderkey % 3 = 1 group by o_custkey""")
def legacy_lines(spark: SparkSession, d: str) -> DataFrame:
    k, i = F.col("o_orderkey") % 3, _cat("i", _s("o_custkey"))
    lines = table(spark, d, "orders").select(F.when(k == 0, _cat("youtube ", i, " ")).when(k == 1, _cat("https://h/watch?v=a&u=/watch?v=", i)).otherwise(_cat("other ", i)).alias("value"))
    return records.legacy_ids(lines).select(F.lit("downloaded").alias("kind"), "video_id").union(records.legacy_without(lines).select(F.lit("without"), "video_id"))


@query("volume_manifest", """
select 'file' as kind, 'f' || c_custkey as value from customer where c_custkey % 4 < 2 union all select 'id', lpad(cast(c_custkey as varchar), 8, '0') from customer where c_custkey % 4 = 2""")
def volume_manifest(spark: SparkSession, d: str) -> DataFrame:
    i, k = _s("c_custkey"), F.col("c_custkey") % 4
    line = F.when(k == 0, _cat("ARQUIVO: f", i)).when(k == 1, _cat('file_source: "f', i, '"')).when(k == 2, _cat("video_id: ", F.lpad(i, 8, "0"))).otherwise(_cat("ID: x", i))
    lines = table(spark, d, "customer").select(line.alias("value"))
    return records.manifest(lines.union(lines))


@query("volume_scan", """
select cast(max(doc_id + 1) as integer) as last_volume, cast(arg_max(length(text), doc_id) as integer) as last_volume_size from documents where doc_id % 3 = 0""")
def volume_scan(spark: SparkSession, d: str) -> DataFrame:
    name = F.when(F.col("doc_id") % 3 == 0, "a.b-v").when(F.col("doc_id") % 3 == 1, "axb-v").otherwise("a.b-w")
    files = table(spark, d, "documents").select(_cat("/x/", name, F.lpad((F.col("doc_id") + 1).cast("string"), 9, "0"), ".txt").alias("path"), F.col("text").alias("value"))
    return records.volume_scan(files, "a.b")


def _named(spark: SparkSession, d: str) -> DataFrame:
    """A file for each document, of several folders and endings."""
    n = F.col("doc_id")
    folder = F.when(n % 3 == 0, "/r/ch/archive/").when(n % 3 == 1, "/r/ch/archives/").otherwise("/r/ch/")
    end = F.when(n % 5 == 0, ".srt").when(n % 5 == 1, "-pt-BR.md").when(n % 5 == 2, ".txt").when(n % 5 == 3, ".jpg").otherwise("-v.SRT")
    return table(spark, d, "documents").select("doc_id", _cat(folder, "ch-", F.lpad(_s("doc_id"), 11, "q"), end).alias("path"))


_NAMED = """n as (select doc_id, case doc_id % 3 when 0 then '/r/ch/archive/' when 1 then '/r/ch/archives/' else '/r/ch/' end || 'ch-' || lpad(cast(doc_id as varchar), 11, 'q') || case doc_id % 5 when 0 then '.srt' when 1 then '-pt-BR.md' when 2 then '.txt' when 3 then '.jpg' else '-v.SRT' end as path from documents)"""


@query("eligible_files", f"with {_NAMED} select doc_id, path from n where doc_id % 5 < 3")
def eligible_files(spark: SparkSession, d: str) -> DataFrame:
    return records.eligible(_named(spark, d), "ch")


@query("eligible_outside_archives", f"with {_NAMED} select doc_id, path from n where doc_id % 5 < 3 and doc_id % 3 = 2")
def eligible_outside_archives(spark: SparkSession, d: str) -> DataFrame:
    return records.eligible(_named(spark, d), "ch", archives=False)


@query("subtitle_listing", f"with {_NAMED} select doc_id, cast(doc_id % 3 as integer) as rank from n where doc_id % 5 in (0, 4)")
def subtitle_listing(spark: SparkSession, d: str) -> DataFrame:
    return records.subtitle_listing(_named(spark, d)).select("doc_id", "rank")


@query("markdown_listing", f"with {_NAMED} select doc_id, cast((doc_id + 1) % 3 as integer) as rank from n where doc_id % 5 = 1")
def markdown_listing(spark: SparkSession, d: str) -> DataFrame:
    return records.subtitle_listing(_named(spark, d), "md").select("doc_id", "rank")


@query("archived_and_restored", f"""with {_NAMED} select n.path, l.doc_id is not null as archived, '/r/ch/' || split_part(n.path, '/', -1) as restored from n left join (select distinct doc_id from labels) l on n.doc_id = l.doc_id""")
def archived_and_restored(spark: SparkSession, d: str) -> DataFrame:
    files = _named(spark, d)
    flagged = records.archived(files, files.join(table(spark, d, "labels"), "doc_id", "left_semi").select("path"))
    back = records.restored(flagged.select("doc_id", "path", "archived")).where("not archived").select("doc_id", F.col("path").alias("restored"))
    return flagged.join(back, "doc_id").select("path", "archived", "restored")


@query("files_by_item", """
select lpad(cast(user_id as varchar), 11, 'z') as video_id, string_agg(path, ',' order by path) as files from (select distinct user_id, '/d/' || event_type || '-' || lpad(cast(user_id as varchar), 11, 'z') || '.srt' as path from events) group by user_id""")
def files_by_item(spark: SparkSession, d: str) -> DataFrame:
    files = table(spark, d, "events").select(_cat("/d/", F.col("event_type"), "-", F.lpad(_s("user_id"), 11, "z"), ".srt").alias("path"))
    return records.files_by_item(files).select("video_id", F.array_join("files", ",").alias("files"))


@query("channel_folders", """
select '/r/' || case when c_custkey % 7 = 3 then '__pycache__' else c_mktsegment end || '/' || c_custkey as folder from customer where c_custkey % 3 < 2""")
def channel_folders(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("c_custkey")
    folder = _cat("/r/", F.when(k % 7 == 3, "__pycache__").otherwise(F.col("c_mktsegment")), "/", _s("c_custkey"))
    path = _cat(folder, F.when(k % 3 == 0, "//db_x.json").when(k % 3 == 1, "/archive/a.srt").otherwise("/other/db.json"))
    return records.channel_folders(table(spark, d, "customer").select(path.alias("path")), "db")


@query("vtt_discovery", """
with n as (select doc_id, case when doc_id % 2 = 0 then 'ch.x-' || lpad(cast(doc_id as varchar), 11, 'q') || '.pt.vtt' else 'ch' || doc_id || '.vtt' end as name from documents)
select 'named' as kind, name from n where doc_id = 0 union all select 'cut', name from n where doc_id % 2 = 1""")
def vtt_discovery(spark: SparkSession, d: str) -> DataFrame:
    """An item with a file of its own, and one whose file's name was cut."""
    name = F.when(F.col("doc_id") % 2 == 0, _cat("ch.x-", F.lpad(_s("doc_id"), 11, "q"), ".pt.vtt")).otherwise(_cat("ch", _s("doc_id"), ".vtt"))
    files = table(spark, d, "documents").select(_cat("/r/", name).alias("path"))
    own = lambda item, kind: records.vtt_files(files, "ch.x", item).select(F.lit(kind).alias("kind"), F.substring_index("path", "/", -1).alias("name"))
    return own("q" * 10 + "0", "named").union(own("none", "cut"))


@query("cookie_lines", """
select value from (select case c_custkey % 5 when 0 then '# note ' || c_custkey when 1 then '.video.test' || chr(9) || c_custkey when 2 then '#HttpOnly_www.video.test' || chr(9) || c_custkey when 3 then 'notvideo.test' || chr(9) || c_custkey else '#HttpOnly_.other.test' || chr(9) || c_custkey end as value, c_custkey % 5 as k from customer) where k < 3""")
def cookie_lines(spark: SparkSession, d: str) -> DataFrame:
    i, k = _s("c_custkey"), F.col("c_custkey") % 5
    host = F.when(k == 1, ".video.test").when(k == 2, "#HttpOnly_www.video.test").when(k == 3, "notvideo.test").otherwise("#HttpOnly_.other.test")
    return records.cookies(table(spark, d, "customer").select(F.when(k == 0, _cat("# note ", i)).otherwise(_cat(host, "\t", i)).alias("value")), ["video.test"])


@query("cookie_validity", "select page_id, page_id % 3 < 2 as valid from pages")
def cookie_validity(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("page_id") % 3
    text = F.when(k == 0, "# Netscape HTTP Cookie File").when(k == 1, ".h\tTRUE\t/").otherwise(_cat(F.lit("x" * 100), "Netscape TRUE"))
    return table(spark, d, "pages").select("page_id", records.valid_cookie_text(text).alias("valid"))


@query("latest_database", "select 'lista_' || o_orderkey || '.json' as name from orders order by o_orderdate desc, o_orderkey limit 1")
def latest_database(spark: SparkSession, d: str) -> DataFrame:
    files = table(spark, d, "orders").select(_cat("/x/lista_", F.lpad(_s("o_orderkey"), 12, "0"), ".json").alias("path"), F.col("o_orderdate").alias("modified"))
    newest = records.latest_database(files, "official.json")
    return newest.select(_cat("lista_", F.regexp_extract("path", "_0*([0-9]+)[.]json$", 1), ".json").alias("name"))


@query("standard_srt_names", """
select page_id, 'c-' || lpad(cast(page_id as varchar), 11, 'k') || case page_id % 3 when 0 then '-pt-BR.srt' when 1 then '-en.srt' else '.srt' end as name, page_id % 3 = 0 as legacy from pages""")
def standard_srt_names(spark: SparkSession, d: str) -> DataFrame:
    item, k = F.lpad(_s("page_id"), 11, "k"), F.col("page_id") % 3
    name = _cat("c-", item, F.when(k == 0, ".pt-BR.srt").when(k == 1, "-en.srt").otherwise(".srt"))
    return table(spark, d, "pages").select("page_id", records.standard_srt_name(name, "c", item).alias("name"), records.legacy_srt_name(name, "c", item).alias("legacy"))


@query("shortest_names", "select user_id as video_id, arg_min(p, struct_pack(n := length(p), p := p)) as path from (select user_id, event_type || '-' || event_id as p from events) group by user_id")
def shortest_names(spark: SparkSession, d: str) -> DataFrame:
    return select.shortest_name(table(spark, d, "events").select(F.col("user_id").alias("video_id"), _cat(F.col("event_type"), "-", _s("event_id")).alias("path")))


@query("numbered_rows", "select o_orderkey, row_number() over (partition by o_custkey order by o_orderdate, o_orderkey) as nth from orders")
def numbered_rows(spark: SparkSession, d: str) -> DataFrame:
    return document.numbered(table(spark, d, "orders"), "o_custkey", "o_orderdate", "o_orderkey").select("o_orderkey", F.col("nth").cast("long").alias("nth"))


@query("first_by_key", "select o_custkey, arg_min(o_orderkey, struct_pack(d := o_orderdate, k := o_orderkey)) as o_orderkey from orders group by o_custkey")
def first_by_key(spark: SparkSession, d: str) -> DataFrame:
    return merge.first_by_key(table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderdate"), "o_custkey", "o_orderdate", "o_orderkey").select("o_custkey", "o_orderkey")


@query("registered_channel", """
select c_name as item, cast(c_custkey as bigint) as pos from customer union all select '@new', max(c_custkey) + 1 from customer""")
def registered_channel(spark: SparkSession, d: str) -> DataFrame:
    """A new channel goes last; one that is there in another spelling isn't added."""
    channels = table(spark, d, "customer").select(F.col("c_name").alias("item"), F.col("c_custkey").alias("pos"))
    return merge.register_channel(merge.register_channel(channels, "new"), "@CUSTOMER#000000001")


@query("single_item", "select 'absent' as video_id, 'N/A' as title, 'N/A' as publish_date, false as has_no_subtitle union all select cast(c_custkey as varchar), c_name, 'N/A', c_nationkey = 3 from customer where c_custkey = 7")
def single_item(spark: SparkSession, d: str) -> DataFrame:
    items = table(spark, d, "customer").select(_s("c_custkey").alias("video_id"), F.col("c_name").alias("title"), F.lit(None).cast("string").alias("publish_date"), (F.col("c_nationkey") == 3).alias("has_no_subtitle"))
    return select.working_items(items, "absent").union(select.working_items(items, "7"))


@query("listing_dates", """
select o_orderkey as video_id, case when o_orderkey % 3 = 0 then strftime(o_orderdate, '%Y-%m-%d') when c.c_custkey is not null then '2020-02-02' else 'Desconhecida' end as publish_date from orders left join customer c on c.c_custkey = o_orderkey""")
def listing_dates(spark: SparkSession, d: str) -> DataFrame:
    none = F.lit(None).cast("string")
    listing = table(spark, d, "orders").select(F.col("o_orderkey").alias("video_id"), none.alias("title"), F.when(F.col("o_orderkey") % 3 == 0, F.date_format("o_orderdate", "yyyyMMdd")).otherwise("").alias("upload_date"), none.alias("publish_date"), none.alias("date"))
    known = table(spark, d, "customer").select(F.col("c_custkey").alias("video_id"), F.lit("2020-02-02").alias("publish_date"))
    return records.listing_records(listing, known).select("video_id", "publish_date")


@query("titles_by_id", "select d.doc_id, coalesce(c.c_name, 'f' || d.doc_id || '.pt') as title, case when c.c_custkey is null then 'Desconhecida' else '2024-05-06' end as publish_date from documents d left join customer c on c.c_custkey = d.doc_id")
def titles_by_id(spark: SparkSession, d: str) -> DataFrame:
    files = table(spark, d, "documents").select("doc_id", F.col("doc_id").alias("video_id"), _cat("/x/f", _s("doc_id"), ".pt.srt").alias("path"))
    lookup = table(spark, d, "customer").select(F.col("c_custkey").alias("video_id"), F.col("c_name").alias("title"), F.lit("20240506").alias("publish_date"))
    return document.titled(files, lookup).select("doc_id", "title", "publish_date")


@query("recovered_names", """
select 'c' || doc_id || '.pt.srt' as path, 'c' || doc_id || '-i' || lpad(cast(doc_id as varchar), 10, '0') || '.pt.srt' as new_path from documents where doc_id % 2 = 0""")
def recovered_names(spark: SparkSession, d: str) -> DataFrame:
    item = _cat("i", F.lpad(_s("doc_id"), 10, "0"))
    stem = F.when(F.col("doc_id") % 2 == 0, _cat("c", _s("doc_id"))).otherwise(_cat("c-", item))
    docs = table(spark, d, "documents")
    return document.recovered_names(docs.select(_cat(stem, ".pt.srt").alias("path")), docs.select(_cat(stem, ".info.json").alias("path"), item.alias("video_id")))


@query("upgrade_counts", """
select count(*) filter (doc_id % 4 = 0) as upgraded, count(*) filter (doc_id % 4 = 1) as already, count(*) filter (doc_id % 4 = 2) as skipped, count(*) filter (doc_id % 4 = 3) as failed from documents""")
def upgrade_counts(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("doc_id") % 4
    docs = table(spark, d, "documents").select("doc_id", _s("doc_id").alias("path"), F.when(k == 1, _cat("[NEW] ", F.col("text"))).otherwise(F.col("text")).alias("value"))
    after = docs.where(k < 3).select("path", F.when(k == 0, _cat("[NEW] ", F.col("value"))).otherwise(F.col("value")).alias("value"))
    return document.upgrade_counts(docs, after, "[NEW]")


@query("sync_counts", """
with s as (select distinct case when doc_id % 5 = 0 then 'ch-' || doc_id else 'v' || doc_id end as id from documents), l as (select distinct 'v' || o_custkey * 2 as id from orders), h as (select distinct 'v' || c_custkey * 3 as id from customer)
select (select count(*) from s where id like 'ch-%') as ghosts, (select count(*) from l where id not in (select id from s)) as new, (select count(*) from h where id not in (select id from s) and id not in (select id from l)) as imported""")
def sync_counts(spark: SparkSession, d: str) -> DataFrame:
    state = table(spark, d, "documents").select(F.when(F.col("doc_id") % 5 == 0, _cat("ch-", _s("doc_id"))).otherwise(_cat("v", _s("doc_id"))).alias("video_id"))
    listing = table(spark, d, "orders").select(_cat("v", (F.col("o_custkey") * 2).cast("string")).alias("video_id"))
    history = table(spark, d, "customer").select(_cat("v", (F.col("c_custkey") * 3).cast("string")).alias("video_id"))
    return status.sync_counts(state, listing, history, "ch")


@query("session_totals", "select cast(sum(n_chars) as bigint) as chars, count(*) as files from documents")
def session_totals(spark: SparkSession, d: str) -> DataFrame:
    by = table(spark, d, "documents").groupBy("source").agg(F.sum("n_chars").alias("chars"), F.count("*").alias("files"))
    return status.session_totals(by, "chars", "files")


@query("files_per_folder", f"with {_NAMED} select '/r/ch' || case doc_id % 3 when 0 then '/archive' when 1 then '/archives' else '' end as folder, count(*) as n from n group by 1")
def files_per_folder(spark: SparkSession, d: str) -> DataFrame:
    return status.counts_by(_named(spark, d).select(F.regexp_replace("path", "/[^/]*$", "").alias("folder")), "folder")


@query("reconciled_state", """
with s as (select o_custkey as channel, count(*) as v, 1000 + o_custkey as z from orders group by 1), m as (select c_custkey as channel, c_custkey % 20 as v, 7 as z from customer)
select coalesce(s.channel, m.channel) as channel, cast(greatest(coalesce(s.v, 0), coalesce(m.v, 0)) as integer) as last_volume, cast(case when m.v is not null and m.v >= coalesce(s.v, 0) then m.z else coalesce(s.z, 0) end as bigint) as last_volume_size
from s full outer join m on s.channel = m.channel""")
def reconciled_state(spark: SparkSession, d: str) -> DataFrame:
    state = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("channel")).agg(F.count("*").alias("last_volume")).withColumn("last_volume_size", F.col("channel") + 1000)
    there = table(spark, d, "customer").select(F.col("c_custkey").alias("channel"), (F.col("c_custkey") % 20).alias("last_volume"), F.lit(7).alias("last_volume_size"))
    return consolidate.reconciled(state, there)


@query("two_step_packing", f"""with recursive b0 as (select source as channel, doc_id, n_chars as n, row_number() over (partition by source order by doc_id in (select doc_id from labels), doc_id) as r from documents),
p as (select channel, doc_id, r, 1 as volume_no, cast(200 as bigint) as base, 200 + n as used from b0 where r = 1
 union all select b.channel, b.doc_id, b.r, case when p.used + b.n > 60000 then p.volume_no + 1 else p.volume_no end, cast(case when p.used + b.n > 60000 then 200 else p.used end as bigint), case when p.used + b.n > 60000 then 200 + b.n else p.used + b.n end
 from p join b0 b on b.channel = p.channel and b.r = p.r + 1)
select channel, doc_id, cast(volume_no as integer) as volume_no, base as "offset" from p""")
def two_step_packing(spark: SparkSession, d: str) -> DataFrame:
    """Documents without labels first, then those with labels, which go on in the last volumes."""
    docs, labels = table(spark, d, "documents").select(F.col("source").alias("channel"), "doc_id", "n_chars"), table(spark, d, "labels").select("doc_id")
    first = consolidate.pack(docs.join(labels, "doc_id", "left_anti").select(*docs.columns), order=["doc_id"], max_chars=60_000, header=200)
    later = docs.join(labels, "doc_id", "left_semi").select(*docs.columns)
    second = consolidate.pack(later, order=["doc_id"], max_chars=60_000, header=200, state=consolidate.last_volumes(first))
    return first.union(second).select("channel", "doc_id", "volume_no", "offset")


@query("last_volumes", f"""with recursive {_SIZES},
p as (select channel, r, 1 as volume_no, 200 + n as used from blocks where r = 1
 union all select b.channel, b.r, case when p.used + b.n > 60000 then p.volume_no + 1 else p.volume_no end, case when p.used + b.n > 60000 then 200 + b.n else p.used + b.n end from p join blocks b on b.channel = p.channel and b.r = p.r + 1)
select channel, cast(max(volume_no) as integer) as last_volume, cast(arg_max(used, r) as bigint) as last_volume_size from p group by channel""")
def last_volumes(spark: SparkSession, d: str) -> DataFrame:
    blocks = table(spark, d, "documents").select(F.col("source").alias("channel"), "doc_id", "n_chars")
    return consolidate.last_volumes(consolidate.pack(blocks, order=["doc_id"], max_chars=60_000, header=200))
