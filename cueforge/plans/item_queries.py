"""Queries about items, channels, listings and their state, over the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cueforge.functions import text as T
from cueforge.operators import consolidate, document, merge, select, sequence, status
from cueforge.plans.registry import query
from cueforge.session import table

_ITEMS = """
items as (select d.doc_id, d.source as channel, coalesce(l.quality, 0) = 1 as subtitle_downloaded, coalesce(l.toxic, 0) = 1 as has_no_subtitle, d.lang, d.n_chars
          from documents d left join labels l on d.doc_id = l.doc_id)"""


def _items(spark: SparkSession, d: str) -> DataFrame:
    labels = table(spark, d, "labels").select("doc_id", "quality", "toxic")
    docs = table(spark, d, "documents").select("doc_id", F.col("source").alias("channel"), "lang", "n_chars").join(labels, "doc_id", "left")
    flag = lambda c: F.coalesce(F.col(c), F.lit(0)) == 1
    return docs.select("doc_id", "channel", flag("quality").alias("subtitle_downloaded"), flag("toxic").alias("has_no_subtitle"), "lang", "n_chars")


@query("status_by_channel", f"""with {_ITEMS}
select channel, count(*) as total, count(*) filter (subtitle_downloaded) as downloaded, count(*) filter (has_no_subtitle) as without_subtitle,
       count(*) - count(*) filter (subtitle_downloaded) - count(*) filter (has_no_subtitle) as pending from items group by channel""")
def status_by_channel(spark: SparkSession, d: str) -> DataFrame:
    return status.channel_status(_items(spark, d))


@query("status_json", f"""with {_ITEMS}, s as (
select channel, count(*) as total, count(*) filter (subtitle_downloaded) as downloaded, count(*) filter (has_no_subtitle) as without_subtitle from items group by channel)
select channel, '{{"channel":"' || channel || '","total":' || total || ',"downloaded":' || downloaded || ',"without_subtitle":' || without_subtitle || ',"pending":' || (total - downloaded - without_subtitle) || '}}' as report from s""")
def status_json(spark: SparkSession, d: str) -> DataFrame:
    return status.status_json(_items(spark, d))


@query("skip_partition", f"""with {_ITEMS}, disk as (select distinct item_id as doc_id from benchmark),
m as (select i.*, not (subtitle_downloaded or has_no_subtitle or k.doc_id is not null) as to_download from items i left join disk k on i.doc_id = k.doc_id)
select doc_id, to_download from m""")
def skip_partition(spark: SparkSession, d: str) -> DataFrame:
    disk = table(spark, d, "benchmark").select(F.col("item_id").alias("doc_id"))
    return merge.skip_partition(_items(spark, d), disk, key="doc_id").select("doc_id", "to_download")


@query("partition_summary", f"""with {_ITEMS}, disk as (select distinct item_id as doc_id from benchmark),
m as (select i.*, not (subtitle_downloaded or has_no_subtitle or k.doc_id is not null) as to_download from items i left join disk k on i.doc_id = k.doc_id)
select count(*) as total, count(*) filter (to_download) as to_download, count(*) filter (not to_download) as skipped, count(*) filter (has_no_subtitle) as without_subtitle from m""")
def partition_summary(spark: SparkSession, d: str) -> DataFrame:
    disk = table(spark, d, "benchmark").select(F.col("item_id").alias("doc_id"))
    return status.partition_summary(merge.skip_partition(_items(spark, d), disk, key="doc_id"))


@query("processed_anti_join", "select doc_id, source from documents where doc_id not in (select doc_id from labels where doc_id is not null)")
def processed_anti_join(spark: SparkSession, d: str) -> DataFrame:
    return merge.exclude_processed(table(spark, d, "documents").select("doc_id", "source"), table(spark, d, "labels"), key="doc_id")


@query("lang_mode_first_seen", """
with c as (select source as channel, lower(lang) as c, count(*) as n, min(doc_id) as p from documents where lower(lang) not in ('na', 'none', '') group by 1, 2),
r as (select *, row_number() over (partition by channel order by n desc, p) as k from c)
select channel, regexp_extract(c, '^[^-_]*') as lang from r where k = 1""")
def lang_mode_first_seen(spark: SparkSession, d: str) -> DataFrame:
    return select.language_mode(table(spark, d, "documents").select(F.col("source").alias("channel"), "lang", F.col("doc_id").alias("pos")), "channel")


@query("date_lower_bound", "select o_orderkey, strftime(o_orderdate, '%Y-%m-%d') as publish_date from orders where strftime(o_orderdate, '%Y%m%d') >= '19970601'")
def date_lower_bound(spark: SparkSession, d: str) -> DataFrame:
    day = T.format_date(F.date_format("o_orderdate", "yyyyMMdd"))
    return select.since(table(spark, d, "orders").select("o_orderkey", day.alias("publish_date")), "19970601")


@query("format_date_cases", """
with r as (select event_id, case event_id % 6 when 0 then strftime(ts, '%Y%m%d') when 1 then strftime(ts, '%Y-%m-%d') when 2 then 'N/A' when 3 then null when 4 then ' ' else ' ' || event_type || ' ' end as raw from events)
select event_id, case when raw is null or trim(raw) in ('', 'N/A', 'None') then 'Desconhecida'
  when regexp_matches(trim(raw), '^[0-9]{8}$') then substr(trim(raw), 1, 4) || '-' || substr(trim(raw), 5, 2) || '-' || substr(trim(raw), 7, 2) else trim(raw) end as day from r""")
def format_date_cases(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("event_id") % 6
    raw = F.when(k == 0, F.date_format("ts", "yyyyMMdd")).when(k == 1, F.date_format("ts", "yyyy-MM-dd")).when(k == 2, "N/A").when(k == 4, " ").when(k == 5, F.concat(F.lit(" "), "event_type", F.lit(" ")))
    return table(spark, d, "events").select("event_id", T.format_date(raw).alias("day"))


@query("retry_horizon", """
select o_orderkey, case when o_orderkey % 7 = 0 then false else date_diff('day', cast(o_orderdate as date), date '1999-01-01') > 7 end as mark_none from orders""")
def retry_horizon(spark: SparkSession, d: str) -> DataFrame:
    day = F.when(F.col("o_orderkey") % 7 == 0, "Desconhecida").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    items = table(spark, d, "orders").select("o_orderkey", day.alias("publish_date"))
    return select.mark_without_subtitle(items, F.lit("1999-01-01").cast("date")).select("o_orderkey", "mark_none")


@query("id_validity", """
with n as (select page_id, regexp_extract(url, '([0-9]+)[^0-9]*$', 1) as a, replace(substr(url, 1, 19), '/', '_') as b from pages),
i as (select page_id, case page_id % 3 when 0 then a when 1 then '1000000' || a else substr(b, 9, 11) end as item from n)
select page_id, item, regexp_matches(item, '^[A-Za-z0-9_-]{11}$') or regexp_matches(item, '^[0-9]{7,12}$') as valid from i""")
def id_validity(spark: SparkSession, d: str) -> DataFrame:
    a, b = F.regexp_extract("url", r"([0-9]+)[^0-9]*$", 1), F.replace(F.substring("url", 1, 19), F.lit("/"), F.lit("_"))
    k = F.col("page_id") % 3
    item = F.when(k == 0, a).when(k == 1, F.concat(F.lit("1000000"), a)).otherwise(F.substring(b, 9, 11))
    return table(spark, d, "pages").select("page_id", item.alias("item")).withColumn("valid", T.valid_id(F.col("item")))


@query("provider_of_url", """
with u as (select page_id, case page_id % 4 when 0 then 'https://vimeo.com/' || page_id when 1 then cast(page_id as varchar) when 2 then '' else url end as u from pages)
select page_id, case when u like '%vimeo.com%' or regexp_matches(u, '^[0-9]+$') then 'vimeo' else 'youtube' end as provider from u""")
def provider_of_url(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("page_id") % 4
    u = F.when(k == 0, F.concat(F.lit("https://vimeo.com/"), F.col("page_id").cast("string"))).when(k == 1, F.col("page_id").cast("string")).when(k == 2, "").otherwise(F.col("url"))
    return table(spark, d, "pages").select("page_id", T.provider(u).alias("provider"))


@query("classify_input", """
with u as (select page_id, case page_id % 5 when 0 then 'https://www.youtube.com/watch?v=' || lpad(cast(page_id as varchar), 11, 'x') when 1 then 'https://vimeo.com/' || (7654321 + page_id)
  when 2 then url || '?list=PL' || page_id when 3 then '@canal' || page_id else url end as u from pages)
select page_id, case when page_id % 5 in (0, 1) then 'video' when page_id % 5 = 2 then 'playlist' else 'channel' end as kind,
  case when page_id % 5 = 3 then 'https://youtube.com/' || u else u end as target from u""")
def classify_input(spark: SparkSession, d: str) -> DataFrame:
    k, i = F.col("page_id") % 5, F.col("page_id").cast("string")
    u = (
        F.when(k == 0, F.concat(F.lit("https://www.youtube.com/watch?v="), F.lpad(i, 11, "x"))).when(k == 1, F.concat(F.lit("https://vimeo.com/"), (F.col("page_id") + 7654321).cast("string")))
        .when(k == 2, F.concat("url", F.lit("?list=PL"), i)).when(k == 3, F.concat(F.lit("@canal"), i)).otherwise(F.col("url"))
    )
    return table(spark, d, "pages").select("page_id", T.classify_input(u).alias("c")).select("page_id", "c.kind", F.col("c.url").alias("target"))


@query("host_suffix_filter", """
with h as (select page_id, lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]*)', 1)) as host from pages)
select page_id, host, host = 'example.com' or suffix(host, '.example.com') or host = 'example.net' or suffix(host, '.example.net') as allowed from h""")
def host_suffix_filter(spark: SparkSession, d: str) -> DataFrame:
    pages = table(spark, d, "pages").select("page_id", T.url_host(F.col("url")).alias("host"))
    return pages.withColumn("allowed", T.host_within(F.col("host"), ["example.com", "example.net"]))


@query("channel_handle_dedup", """
with h as (select page_id as pos, lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]*)', 1)) as host from pages),
i as (select pos, case pos % 3 when 0 then '@' || host when 1 then upper(host) else 'https://site.test/@' || host end as item, host as key from h)
select key, coalesce(arg_max(item, pos) filter (prefix(item, '@')), arg_min(item, pos)) as item, min(pos) as pos from i group by key""")
def channel_handle_dedup(spark: SparkSession, d: str) -> DataFrame:
    host, k = T.url_host(F.col("url")), F.col("page_id") % 3
    item = F.when(k == 0, F.concat(F.lit("@"), host)).when(k == 1, F.upper(host)).otherwise(F.concat(F.lit("https://site.test/@"), host))
    return merge.dedup_channels(table(spark, d, "pages").select(F.col("page_id").alias("pos"), item.alias("item")))


@query("merge_placeholders", """
with e as (select user_id, event_id, case when value < 10 then 'N/A' when value < 15 then '' else event_type end as title,
                  case when event_id % 3 = 0 then 'Desconhecida' else strftime(ts, '%Y-%m-%d') end as day, event_type = 'purchase' as flag from events)
select 'u' || user_id as video_id, min(event_id) as pos,
  coalesce(arg_min(title, event_id) filter (title not in ('N/A', '', 'Avulso')), arg_min(title, event_id)) as title,
  coalesce(arg_min(day, event_id) filter (day not in ('N/A', '', 'Desconhecida')), arg_min(day, event_id)) as publish_date, bool_or(flag) as subtitle_downloaded from e group by user_id""")
def merge_placeholders(spark: SparkSession, d: str) -> DataFrame:
    title = F.when(F.col("value") < 10, "N/A").when(F.col("value") < 15, "").otherwise(F.col("event_type"))
    day = F.when(F.col("event_id") % 3 == 0, "Desconhecida").otherwise(F.date_format("ts", "yyyy-MM-dd"))
    e = table(spark, d, "events").select(F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("video_id"), F.col("event_id").alias("pos"), title.alias("title"), day.alias("publish_date"), (F.col("event_type") == "purchase").alias("subtitle_downloaded"))
    return merge.merge_records(e)


@query("playlist_union", """
with e as (select user_id, event_type, min(event_id) as p from events group by 1, 2)
select 'u' || user_id as video_id, string_agg(event_type, ',' order by p) as playlists from e group by user_id""")
def playlist_union(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").select(F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("video_id"), F.col("event_id").alias("pos"), F.lit("N/A").alias("title"), F.lit("N/A").alias("publish_date"), F.array("event_type").alias("playlists"))
    return merge.merge_records(e).select("video_id", F.array_join("playlists", ",").alias("playlists"))


@query("upsert_listing", """
with s as (select o_custkey as id, max(o_orderkey) as k, strftime(max(o_orderdate), '%Y-%m-%d') as day from orders group by 1),
n as (select c_custkey as id, c_name as title, case when c_custkey % 4 = 0 then 'N/A' when c_custkey % 4 = 1 then 'Desconhecida' else '2024-01-' || lpad(cast(c_custkey % 28 + 1 as varchar), 2, '0') end as day from (select c_custkey + 100 as c_custkey, c_name from customer)),
b as (select coalesce(s.id, n.id) as id, s.id as sid, n.id as nid, case when s.id is not null then 'order ' || s.k end as st, s.day as sday, n.title as nt, n.day as nday from s full outer join n on s.id = n.id)
select id, coalesce(nt, st) as title, coalesce(case when nday not in ('N/A', 'Desconhecida', '') then nday end, sday, nday) as publish_date, sid is null as is_new,
  case when nid is not null then '@Chan' when sid is not null then '@ch' end as source_channel from b""")
def upsert_listing(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("id")).agg(F.concat(F.lit("order "), F.max("o_orderkey").cast("string")).alias("title"), F.date_format(F.max("o_orderdate"), "yyyy-MM-dd").alias("publish_date")).withColumn("source_channel", F.lit("@ch"))
    k = F.col("c_custkey") + 100  # so that either side has keys of its own
    day = F.when(k % 4 == 0, "N/A").when(k % 4 == 1, "Desconhecida").otherwise(F.concat(F.lit("2024-01-"), F.lpad((k % 28 + 1).cast("string"), 2, "0")))
    n = table(spark, d, "customer").select(k.alias("id"), F.col("c_name").alias("title"), day.alias("publish_date"))
    return merge.upsert_listing(s, n, key="id", tag="@Chan").select("id", "title", "publish_date", "is_new", "source_channel")


@query("reverse_history_import", """
select c_custkey as video_id, c_name as uploader from customer where (c_nationkey = 3 or c_mktsegment = 'BUILDING' or lower(c_name) like '%00007%')
  and c_custkey not in (select o_custkey from orders where o_totalprice > 450000)""")
def reverse_history_import(spark: SparkSession, d: str) -> DataFrame:
    h = table(spark, d, "customer").select(F.col("c_custkey").alias("video_id"), F.col("c_nationkey").cast("string").alias("channel_id"), F.col("c_mktsegment").alias("uploader_id"), F.col("c_name").alias("uploader"))
    s = table(spark, d, "orders").where("o_totalprice > 450000").select(F.col("o_custkey").alias("video_id")).distinct()
    return merge.reverse_import(h, s, "3", "BUILDING", "00007").select("video_id", "uploader")


@query("enrich_metadata", """
select d.doc_id, case when d.doc_id % 2 = 0 then d.source else coalesce(nullif(c.c_name, ''), 'Sem Título') end as title, coalesce(case when c.c_custkey is not null then c.c_mktsegment end, 'Desconhecida') as date
from documents d left join customer c on d.doc_id = c.c_custkey""")
def enrich_metadata(spark: SparkSession, d: str) -> DataFrame:
    files = table(spark, d, "documents").select("doc_id", F.col("doc_id").cast("string").alias("video_id"), F.concat(F.lit("f"), F.col("doc_id").cast("string")).alias("path"), F.when(F.col("doc_id") % 2 == 0, F.col("source")).otherwise(T.NO_TITLE).alias("title"), F.lit(T.UNKNOWN_DATE).alias("date"))
    items = table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("video_id"), F.col("c_name").alias("title"), F.col("c_mktsegment").alias("publish_date"))
    return merge.enrich(files, items).select("doc_id", "title", "date")


@query("flag_processed", """
select coalesce(d.doc_id, l.doc_id) as video_id, coalesce(d.source, 'N/A') as title, l.doc_id is not null as consolidated
from documents d full outer join (select distinct doc_id + 100 as doc_id from labels) l on d.doc_id = l.doc_id""")
def flag_processed(spark: SparkSession, d: str) -> DataFrame:
    v = table(spark, d, "documents").select(F.col("doc_id").alias("video_id"), F.col("source").alias("title"), F.lit("N/A").alias("publish_date"), F.lit(False).alias("consolidated"))
    p = table(spark, d, "labels").select((F.col("doc_id") + 100).alias("video_id"))
    return merge.flag_processed(v, p).select("video_id", "title", "consolidated")


@query("legacy_flags", """
select d.doc_id as video_id, l.doc_id is not null as subtitle_downloaded, b.item_id is not null as info_downloaded, c.conv_id is not null as has_no_subtitle from documents d
left join (select distinct doc_id from labels) l on d.doc_id = l.doc_id left join (select distinct item_id from benchmark) b on d.doc_id = b.item_id left join (select distinct conv_id from conversations) c on d.doc_id = c.conv_id""")
def legacy_flags(spark: SparkSession, d: str) -> DataFrame:
    no = F.lit(False)
    v = table(spark, d, "documents").select(F.col("doc_id").alias("video_id"), no.alias("subtitle_downloaded"), no.alias("info_downloaded"), no.alias("has_no_subtitle"))
    ids = lambda t, c: table(spark, d, t).select(F.col(c).alias("video_id"))
    return merge.legacy_flags(v, ids("labels", "doc_id"), ids("benchmark", "item_id"), ids("conversations", "conv_id"))


@query("best_format_per_video", """
with f as (select source as video_id, 'f' || doc_id || case lang when 'en' then '.txt' when 'fr' then '.md' when 'de' then '.srt' else '.jpg' end as path, case lang when 'en' then 1 when 'fr' then 0 when 'de' then 2 else 3 end as p from documents),
r as (select *, row_number() over (partition by video_id order by p, path) as k, count(*) over (partition by video_id) as n_files from f)
select video_id, path, n_files from r where k = 1""")
def best_format_per_video(spark: SparkSession, d: str) -> DataFrame:
    end = F.when(F.col("lang") == "en", ".txt").when(F.col("lang") == "fr", ".md").when(F.col("lang") == "de", ".srt").otherwise(".jpg")
    files = table(spark, d, "documents").select(F.col("source").alias("video_id"), F.concat(F.lit("f"), F.col("doc_id").cast("string"), end).alias("path"))
    return consolidate.best_files(files)


@query("subtitle_choice", """
with f as (select user_id, case when event_type in ('view', 'click') then 'manual' else 'auto' end as kind, case cast(event_id % 5 as int) when 0 then 'pt-BR' when 1 then 'PT' when 2 then 'en' when 3 then 'es' else 'pt' end as lang,
                  case when event_id % 2 = 0 then 'vtt' else 'json3' end as ext, event_id as pos from events),
m as (select *, min(pos) over (partition by user_id, kind, lang) as lp from f where regexp_matches(lower(lang), '^pt.*')),
r as (select *, row_number() over (partition by user_id order by case kind when 'manual' then 0 else 1 end, lp, case ext when 'vtt' then 0 else 1 end, pos) as k from m)
select user_id, lang, kind, ext, 'e' || pos as url from r where k = 1""")
def subtitle_choice(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("event_id") % 5
    lang = F.when(k == 0, "pt-BR").when(k == 1, "PT").when(k == 2, "en").when(k == 3, "es").otherwise("pt")
    kind = F.when(F.col("event_type").isin("view", "click"), "manual").otherwise("auto")
    f = table(spark, d, "events").select("user_id", kind.alias("kind"), lang.alias("lang"), F.when(F.col("event_id") % 2 == 0, "vtt").otherwise("json3").alias("ext"), F.concat(F.lit("e"), F.col("event_id").cast("string")).alias("url"), F.col("event_id").alias("pos"))
    return select.subtitle_choice(f, "^pt.*", key="user_id")


@query("smart_sync_cutoff", """
with e as (select user_id, event_id, event_type in ('view', 'click', 'error') as known from events),
i as (select *, sum(case when known then 0 else 1 end) over (partition by user_id order by event_id) as island from e),
r as (select *, sum(case when known then 1 else 0 end) over (partition by user_id, island order by event_id) as run from i),
s as (select user_id, min(event_id) as stop from r where known and run >= 4 group by user_id)
select e.user_id, e.event_id, e.known from e left join s on e.user_id = s.user_id where s.stop is null or e.event_id < s.stop""")
def smart_sync_cutoff(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").select("user_id", "event_id", F.col("event_type").isin("view", "click", "error").alias("known"))
    return sequence.known_run_cutoff(e, "user_id", "event_id", "known", run=4)


@query("json_props", "select event_id, cast(json_extract(props, '$.k') as bigint) as k from events")
def json_props(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select("event_id", F.from_json("props", "k bigint")["k"].alias("k"))


_SIZES = "blocks as (select source as channel, doc_id, n_chars as n, row_number() over (partition by source order by doc_id) as r from documents)"


@query("volume_packing", f"""with recursive {_SIZES},
p as (select channel, doc_id, r, cast(1 as integer) as volume_no, cast(200 as bigint) as base, 200 + n as used from blocks where r = 1
 union all select b.channel, b.doc_id, b.r, cast(case when p.used + b.n > 60000 then p.volume_no + 1 else p.volume_no end as integer), cast(case when p.used + b.n > 60000 then 200 else p.used end as bigint), case when p.used + b.n > 60000 then 200 + b.n else p.used + b.n end
 from p join blocks b on b.channel = p.channel and b.r = p.r + 1)
select channel, doc_id, volume_no, base as "offset" from p""")
def volume_packing(spark: SparkSession, d: str) -> DataFrame:
    blocks = table(spark, d, "documents").select(F.col("source").alias("channel"), "doc_id", "n_chars")
    return consolidate.pack(blocks, order=["doc_id"], max_chars=60_000, header=200).select("channel", "doc_id", "volume_no", "offset")


@query("volume_state", f"""with recursive {_SIZES},
p as (select channel, doc_id, r, 1 as volume_no, 200 + n as used from blocks where r = 1
 union all select b.channel, b.doc_id, b.r, case when p.used + b.n > 60000 then p.volume_no + 1 else p.volume_no end, case when p.used + b.n > 60000 then 200 + b.n else p.used + b.n end from p join blocks b on b.channel = p.channel and b.r = p.r + 1)
select channel, cast(count(*) as bigint) as n_files, cast(max(volume_no) as integer) as last_volume, cast(arg_max(used, r) as bigint) as last_volume_size from p group by channel""")
def volume_state(spark: SparkSession, d: str) -> DataFrame:
    blocks = table(spark, d, "documents").select(F.col("source").alias("channel"), "doc_id", F.col("doc_id").cast("string").alias("video_id"), F.col("doc_id").cast("string").alias("path"), "n_chars")
    placed = consolidate.pack(blocks, order=["doc_id"], max_chars=60_000, header=200)
    return consolidate.next_state(placed).select("channel", F.size("processed_files").cast("long").alias("n_files"), "last_volume", "last_volume_size")


@query("volume_index", f"""with recursive {_SIZES},
p as (select channel, doc_id, r, 1 as volume_no, 200 + n as used from blocks where r = 1
 union all select b.channel, b.doc_id, b.r, case when p.used + b.n > 60000 then p.volume_no + 1 else p.volume_no end, case when p.used + b.n > 60000 then 200 + b.n else p.used + b.n end from p join blocks b on b.channel = p.channel and b.r = p.r + 1)
select channel, cast(volume_no as integer) as volume_no, channel || '-v' || lpad(cast(volume_no as varchar), 3, '0') || '.txt' as file_name, cast(count(*) as bigint) as n_videos,
 cast(sum(length('block ' || doc_id || chr(10))) + length(repeat('=', 60) || chr(10) || 'METADADOS DO VOLUME' || chr(10) || 'CANAL: ' || channel || chr(10) || 'URL: https://youtube.com/@' || channel || chr(10) || 'DATA DE CRIAÇÃO: 2024-01-01' || chr(10) || repeat('=', 60) || chr(10))
  + length(chr(10) || chr(10) || repeat('=', 60) || chr(10) || 'ÍNDICE DE VÍDEOS NESTE VOLUME' || chr(10) || repeat('=', 60)) + sum(length(chr(10) || '* [2024-01-01] t' || doc_id || ' (ID: ' || doc_id || ')')) as bigint) as n_chars
from p group by channel, volume_no""")
def volume_index(spark: SparkSession, d: str) -> DataFrame:
    i = F.col("doc_id").cast("string")
    blocks = table(spark, d, "documents").select(F.col("source").alias("channel"), "doc_id", i.alias("video_id"), F.concat(F.lit("t"), i).alias("title"), F.lit("2024-01-01").alias("date"), F.concat(F.lit("block "), i, F.lit("\n")).alias("block"), "n_chars")
    placed = consolidate.pack(blocks, order=["doc_id"], max_chars=60_000, header=200)
    v = consolidate.volumes(placed, F.lit("2024-01-01"), order="doc_id")
    return v.select("channel", "volume_no", "file_name", F.size("video_ids").cast("long").alias("n_videos"), F.col("n_chars").cast("long").alias("n_chars"))


@query("pending_markdown", """
select doc_id as video_id, source from documents where 'p' || doc_id in (select 'p' || doc_id from labels) and doc_id not in (select item_id from benchmark where item_id is not null)""")
def pending_markdown(spark: SparkSession, d: str) -> DataFrame:
    name = lambda t, c, end: table(spark, d, t).select(F.col(c).alias("video_id"), F.concat(F.lit("p"), F.col(c).cast("string"), F.lit(end)).alias("path"))
    files = name("labels", "doc_id", ".srt").union(name("benchmark", "item_id", ".MD"))
    items = table(spark, d, "documents").select(F.col("doc_id").alias("video_id"), "source")
    return document.pending_markdown(items, files)


@query("files_and_languages", """
with n as (select page_id, case page_id % 4 when 0 then 'c-' || page_id || '.pt.srt' when 1 then 'c-' || page_id || '-en-us.SRT' when 2 then 'c_' || page_id || '.es-419.srt' else 'plain' || page_id || '.srt' end as name from pages)
select page_id, lower(coalesce(nullif(regexp_extract(name, '[.-]([a-zA-Z][a-zA-Z](-[a-zA-Z][a-zA-Z][a-zA-Z]?)?)[.][sS][rR][tT]$', 1), ''), 'pt')) as language from n""")
def files_and_languages(spark: SparkSession, d: str) -> DataFrame:
    i, k = F.col("page_id").cast("string"), F.col("page_id") % 4
    name = F.when(k == 0, F.concat(F.lit("c-"), i, F.lit(".pt.srt"))).when(k == 1, F.concat(F.lit("c-"), i, F.lit("-en-us.SRT"))).when(k == 2, F.concat(F.lit("c_"), i, F.lit(".es-419.srt"))).otherwise(F.concat(F.lit("plain"), i, F.lit(".srt")))
    return table(spark, d, "pages").select("page_id", F.lower(T.language_of_file(name)).alias("language"))


@query("language_base", "select doc_id, case when lower(left(lang, 2)) in ('pt', 'en', 'es') then lower(left(lang, 2)) else 'pt' end as base from documents")
def language_base(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", T.language_base(F.col("lang")).alias("base"))


@query("window_parameters", """
select o_orderkey, case when s < 1800 then 30 when s < 3600 then 60 else 90 end as size_s, case when s < 1800 then 0.65 when s < 3600 then 0.7 else 0.75 end::double as threshold,
       case when s < 1800 then 3 when s < 3600 then 5 else 8 end as segments from (select o_orderkey, o_orderkey * 37 % 6000 as s from orders)""")
def window_parameters(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").select("o_orderkey", sequence.window_parameters(F.col("o_orderkey") * 37 % 6000).alias("p")).select("o_orderkey", "p.size_s", "p.threshold", "p.segments")


@query("channel_filter", """
select c_custkey, h from (select c_custkey, c_mktsegment as m, case c_custkey % 4 when 0 then '@' || c_mktsegment when 1 then c_mktsegment || '.official' when 2 then lower(c_mktsegment) || '-official' else '' end as h from customer)
where replace(replace(lower(ltrim(h, '@')), '.official', ''), '-official', '') = 'building' or h = ''""")
def channel_filter(spark: SparkSession, d: str) -> DataFrame:
    m, k = F.col("c_mktsegment"), F.col("c_custkey") % 4
    h = F.when(k == 0, F.concat(F.lit("@"), m)).when(k == 1, F.concat(m, F.lit(".official"))).when(k == 2, F.concat(F.lower(m), F.lit("-official"))).otherwise("")
    items = table(spark, d, "customer").select("c_custkey", h.alias("source_channel"))
    return select.of_channel(items, "@Building.Official", first=True).withColumnRenamed("source_channel", "h")


@query("ghosts_removed", "select doc_id, case when doc_id % 3 = 0 then source || '-' || doc_id else 'v' || doc_id end as video_id from documents where doc_id % 3 <> 0 or source <> (select min(source) from documents)")
def ghosts_removed(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    i = F.col("doc_id").cast("string")
    name = F.when(F.col("doc_id") % 3 == 0, F.concat(F.col("source"), F.lit("-"), i)).otherwise(F.concat(F.lit("v"), i))
    return select.without_ghosts(docs.select("doc_id", name.alias("video_id")), docs.agg(F.min("source")).first()[0])


@query("channel_urls", "select c_custkey, 'https://youtube.com/' || case when h like '@%' then h else '@' || h end as url from (select c_custkey, case when c_custkey % 2 = 0 then '@' || c_name else c_name end as h from customer)")
def channel_urls(spark: SparkSession, d: str) -> DataFrame:
    h = F.when(F.col("c_custkey") % 2 == 0, F.concat(F.lit("@"), F.col("c_name"))).otherwise(F.col("c_name"))
    return table(spark, d, "customer").select("c_custkey", T.channel_url(h).alias("url"))


@query("volumes_resumed", """
with b as (select source as channel, doc_id, n_chars, sum(n_chars) over (partition by source order by doc_id) as upto from documents where source is not null)
select channel, doc_id, 7 as volume_no, 1000 + upto - n_chars as at from b""")
def volumes_resumed(spark: SparkSession, d: str) -> DataFrame:
    """With room for all, every channel's blocks go on in the volume of its saved state."""
    docs = table(spark, d, "documents").where("source is not null").select(F.col("source").alias("channel"), "doc_id", "n_chars")
    state = docs.select("channel").distinct().select("channel", F.lit(7).alias("last_volume"), F.lit(1000).alias("last_volume_size"))
    placed = consolidate.pack(docs, order=["doc_id"], max_chars=1 << 40, header=200, state=state)
    return placed.select("channel", "doc_id", "volume_no", F.col("offset").cast("long").alias("at"))
