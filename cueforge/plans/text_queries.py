"""Queries about transcript text, cues, windows, topics and Markdown, over the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cueforge.functions import markdown as M
from cueforge.functions import text as T
from cueforge.operators import document, sequence, topics
from cueforge.plans.registry import query
from cueforge.session import table
from cueforge.sources import records, subtitles

_SQUEEZE = "trim(regexp_replace({0}, '\\s+', ' ', 'g'))"


def _lines(spark: SparkSession, d: str) -> DataFrame:
    """(doc_id, pos, line): the lines of all documents, pos from 0."""
    return table(spark, d, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line"))


_LINES = "lines as (select doc_id, cast(unnest(range(len(string_split(text, chr(10))))) as integer) as pos, unnest(string_split(text, chr(10))) as line from documents)"


@query("asr_clean", f"select doc_id, md5({_SQUEEZE.format('''regexp_replace(translate('♪ [música] ' || text || ' [Vinheta de abertura]', '♪♫#', ''), '(?i)\\[(Música|Aplausos|Risos|Música ao fundo|Vinheta|Vinheta de abertura|Legendas pela comunidade)\\]', '', 'g')''')}) as clean from documents")
def asr_clean(spark: SparkSession, d: str) -> DataFrame:
    text = F.concat(F.lit("♪ [música] "), "text", F.lit(" [Vinheta de abertura]"))
    return table(spark, d, "documents").select("doc_id", F.md5(T.clean_sounds(text).cast("binary")).alias("clean"))


@query("noise_clean", """
select doc_id, md5(regexp_replace(regexp_replace(regexp_replace('[Intervalo: 3 s] ' || replace(text, chr(10), chr(10) || chr(10) || chr(10)) || ' [gap]', '(?i)\\[(?:Pulo de tempo|Intervalo|Gap|Pulo):?.*?\\]', '', 'g'), '\\n{3,}', chr(10) || chr(10), 'g'), '^\\s+|\\s+$', '', 'g')) as clean from documents""")
def noise_clean(spark: SparkSession, d: str) -> DataFrame:
    text = F.concat(F.lit("[Intervalo: 3 s] "), F.replace("text", F.lit("\n"), F.lit("\n\n\n")), F.lit(" [gap]"))
    return table(spark, d, "documents").select("doc_id", F.md5(T.clean_gaps(text).cast("binary")).alias("clean"))


RULES = {"the": "der", "tion": "ción", "quality": "q"}


@query("term_replace", f"select doc_id, md5(replace(replace({_SQUEEZE.format('''translate(text, '♪♫#', '')''')}, 'tion', 'ción'), 'the', 'der')) as clean from documents")
def term_replace(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", F.md5(T.clean_terms(F.col("text"), RULES).cast("binary")).alias("clean"))


@query("terminal_punctuation", """
with c as (select conv_id, turn, regexp_replace(text, '[.!?:;,\\s]+$', '') as t, (turn % 4) * 0.15 as pause, turn = max(turn) over (partition by conv_id) as last from conversations)
select conv_id, turn, md5(case when t = '' then '' else regexp_replace(t, '^\\s+', '') || case when last or pause >= 0.4 then '.' when pause >= 0.15 then ',' else '' end end) as marked from c""")
def terminal_punctuation(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "conversations")
    last = F.col("turn") == F.max("turn").over(Window.partitionBy("conv_id"))
    text = F.regexp_replace("text", r"[.!?:;,\s]+$", "")
    return c.select("conv_id", "turn", F.md5(T.end_mark(text, (F.col("turn") % 4) * 0.15, last).cast("binary")).alias("marked"))


@query("sentence_case", """
with s as (select conv_id, turn, lower(trim(regexp_replace(regexp_replace(text, '[^a-zA-Z.]+', ' ', 'g'), '[. ]+', ' ', 'g'))) as t from conversations)
select conv_id, turn, md5(case when t = '' then t when starts_with(t, 'como') or starts_with(t, 'qual') or starts_with(t, 'quem') or starts_with(t, 'onde') or starts_with(t, 'quando') or starts_with(t, 'quanto') or starts_with(t, 'porque') or starts_with(t, 'por que') or starts_with(t, 'quais')
   then upper(t[1]) || substr(t, 2) || '?' else upper(t[1]) || substr(t, 2) || '.' end) as cased from s""")
def sentence_case(spark: SparkSession, d: str) -> DataFrame:
    plain = F.lower(F.trim(F.regexp_replace(F.regexp_replace("text", "[^a-zA-Z.]+", " "), "[. ]+", " ")))
    text = F.when(plain == "", plain).otherwise(T.sentence_case(F.concat(plain, F.lit("."))))
    return table(spark, d, "conversations").select("conv_id", "turn", F.md5(text.cast("binary")).alias("cased"))


_OPENINGS = "|".join(T.QUESTION_OPENINGS)


@query("restore_punctuation", f"""
with c as (select conv_id, turn, regexp_replace(text, '^\\s+|\\s+$', '', 'g') as t, (turn % 4) * 0.15 as pause, turn = max(turn) over (partition by conv_id) as last from conversations),
m as (select conv_id, turn, t, t || case when regexp_matches(t, '[.!?:;,]$') then '' when last or pause >= 0.4 then '.' when pause >= 0.15 then ',' else '' end as e from c),
k as (select conv_id, turn, t, array_to_string(list_transform(regexp_extract_all(e, '(?s).+?(?:[.!?]\\s+|$)'), lambda p: upper(p[1]) || p[2:]), '') as e from m),
q as (select conv_id, turn, t, regexp_replace(e, '(^|[.!?]\\s+)([^.!?]+)[.]', '\\1⟦\\2⟧', 'g') as e from k)
select conv_id, turn, case when t = '' then t else replace(replace(regexp_replace(e, '(?i)⟦((?:{_OPENINGS})[^⟧]*)⟧', '\\1?', 'g'), '⟦', ''), '⟧', '.') end as restored from q""")
def restore_punctuation(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "conversations")
    last = F.col("turn") == F.max("turn").over(Window.partitionBy("conv_id"))
    return c.select("conv_id", "turn", T.restore_punctuation(F.col("text"), (F.col("turn") % 4) * 0.15, last).alias("restored"))


@query("video_id_from_name", """
with n as (select page_id, 'canal_' || page_id || '-' || lpad(cast(page_id as varchar), 11, 'aB_9') as stem from pages)
select page_id, lpad(cast(page_id as varchar), 11, 'aB_9') as video_id from n""")
def video_id_from_name(spark: SparkSession, d: str) -> DataFrame:
    i, k = F.col("page_id").cast("string"), F.col("page_id") % 4
    end = F.when(k == 0, ".info.json").when(k == 1, ".pt-BR.srt").when(k == 2, "-orig.md").otherwise(".en.VTT")
    path = F.concat(F.lit("/data/x/canal_"), i, F.lit("-"), F.lpad(i, 11, "aB_9"), end)
    return table(spark, d, "pages").select("page_id", T.video_id(path).alias("video_id"))


@query("smart_timestamps", """
with t as (select event_id, event_id * 1234567 % 9000000 as ms from events)
select event_id, case when ms >= 3600000 then printf('%02d:%02d:%02d', ms // 3600000, ms // 60000 % 60, ms // 1000 % 60) else printf('%02d:%02d', ms // 60000, ms // 1000 % 60) end as clock from t""")
def smart_timestamps(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select("event_id", T.clock(F.col("event_id") * 1234567 % 9000000).alias("clock"))


@query("yaml_safe", """select page_id, md5(replace(replace(replace(replace(html, '\\', '\\\\'), chr(10), '\\n'), chr(13), '\\r'), '"', '\\"')) as safe from pages""")
def yaml_safe(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages").select("page_id", F.md5(T.yaml_safe(F.col("html")).cast("binary")).alias("safe"))


@query("language_patterns", """
with l as (select doc_id, case doc_id % 4 when 0 then '' when 1 then 'N/A' when 2 then '^' || lang || '.*' else lang end as l from documents)
select doc_id, case when l in ('', 'N/A') or starts_with(l, '^') then l else '^' || l || '.*' end as pattern from l""")
def language_patterns(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("doc_id") % 4
    lang = F.when(k == 0, "").when(k == 1, "N/A").when(k == 2, F.concat(F.lit("^"), "lang", F.lit(".*"))).otherwise(F.col("lang"))
    return table(spark, d, "documents").select("doc_id", T.language_pattern(lang).alias("pattern"))


_EVENTS = "e as (select user_id, event_id, epoch_us(ts) // 1000 as s, epoch_us(ts) // 1000 + cast(floor(value * 1000) as bigint) as t from events)"


def _timed(spark: SparkSession, d: str) -> DataFrame:
    """Events as cues: start at ts, lasting `value` seconds."""
    start = F.unix_millis(F.col("ts").cast("timestamp"))
    return table(spark, d, "events").select("user_id", "event_id", start.alias("start_ms"), (start + F.floor(F.col("value") * 1000)).alias("end_ms"))


@query("pause_to_next", f"""with {_EVENTS}
select user_id, event_id, cast(greatest(0, coalesce(s2 // 1000 - t // 1000, 0)) as double) as pause_s, s2 is null as is_last from (select *, lead(s) over (partition by user_id order by event_id) as s2 from e)""")
def pause_to_next(spark: SparkSession, d: str) -> DataFrame:
    return sequence.pauses(_timed(spark, d), "user_id", "event_id").select("user_id", "event_id", "pause_s", "is_last")


@query("adaptive_windows", f"""with recursive {_EVENTS}, n as (select *, row_number() over (partition by user_id order by event_id) as r, (max(t) over (partition by user_id) - min(s) over (partition by user_id)) // 1000 as dur from e),
z as (select *, case when dur < 1800 then 30 when dur < 3600 then 60 else 90 end * 3600 as size from n),
w as (select user_id, event_id, r, s as clock, cast(0 as integer) as window_id, (t - s) // 1000 > size as closed, s as own from z where r = 1
 union all select z.user_id, z.event_id, z.r, case when w.closed then w.own else w.clock end, cast(case when w.closed then w.window_id + 1 else w.window_id end as integer), (z.t - case when w.closed then w.own else w.clock end) // 1000 > z.size, z.s
 from w join z on z.user_id = w.user_id and z.r = w.r + 1)
select user_id, event_id, window_id from w""")
def adaptive_windows(spark: SparkSession, d: str) -> DataFrame:
    by = Window.partitionBy("user_id")
    cues = _timed(spark, d).withColumn("dur", T.total_seconds(F.max("end_ms").over(by) - F.min("start_ms").over(by)))
    cues = cues.withColumn("size", sequence.window_parameters(F.col("dur"))["size_s"] * 3600)
    return sequence.elapsed_windows(cues, "user_id", "event_id", "size", elapsed="total")


@query("component_windows", f"""with recursive {_EVENTS}, z as (select *, row_number() over (partition by user_id order by event_id) as r from e),
w as (select user_id, event_id, r, cast(0 as integer) as window_id, (t - s) // 1000 % 60 > 30 as closed, s as own, s as clock from z where r = 1
 union all select z.user_id, z.event_id, z.r, cast(case when w.closed then w.window_id + 1 else w.window_id end as integer), (z.t - case when w.closed then w.own else w.clock end) // 1000 % 60 > 30, z.s, case when w.closed then w.own else w.clock end
 from w join z on z.user_id = w.user_id and z.r = w.r + 1)
select user_id, event_id, window_id from w""")
def component_windows(spark: SparkSession, d: str) -> DataFrame:
    """Windows by the seconds place of the time passed, as existing documents were made."""
    return sequence.elapsed_windows(_timed(spark, d).withColumn("size", F.lit(30)), "user_id", "event_id", "size")


@query("rollup_strip", f"""with recursive {_LINES}, q as (select doc_id, pos, list_filter(regexp_split_to_array(line, '\\s+'), lambda x: x <> '') as w from lines),
f as (select doc_id, -1 as pos, cast([] as varchar[]) as last, cast(null as varchar[]) as kept, cast(false as boolean) as given from q where pos = 0
 union all select q.doc_id, q.pos, case when len(k.rest) > 0 then q.w else f.last end, k.rest, len(k.rest) > 0 from f join q on q.doc_id = f.doc_id and q.pos = f.pos + 1,
  lateral (select list_filter(q.w, lambda x, i: len(list_filter(q.w[1:i], lambda y, j: y is distinct from f.last[j])) > 0) as rest) k)
select doc_id, pos, md5(array_to_string(kept, ' ')) as kept from f where given""")
def rollup_strip(spark: SparkSession, d: str) -> DataFrame:
    lines = _lines(spark, d).withColumn("line", T.squeeze(F.col("line")))
    return sequence.strip_rollup(lines, "doc_id", "pos", "line").select("doc_id", "pos", F.md5(F.col("kept").cast("binary")).alias("kept"))


@query("rollup_by_lag", f"""with {_LINES}, q as (select doc_id, pos, list_filter(regexp_split_to_array(line, '\\s+'), lambda x: x <> '') as w from lines),
l as (select doc_id, pos, w, coalesce(lag(w) over (partition by doc_id order by pos), []) as p from q)
select doc_id, pos, md5(array_to_string(list_filter(w, lambda x, i: len(list_filter(w[1:i], lambda y, j: y is distinct from p[j])) > 0), ' ')) as kept from l""")
def rollup_by_lag(spark: SparkSession, d: str) -> DataFrame:
    return sequence.rollup_by_lag(_lines(spark, d), "doc_id", "pos", "line").select("doc_id", "pos", F.md5(F.col("kept").cast("binary")).alias("kept"))


@query("line_dedup_start", f"""with recursive {_LINES}, b as (select doc_id, pos // 2 as b, list(line order by pos) as l from lines group by 1, 2),
f as (select doc_id, cast(-1 as bigint) as b, cast([] as varchar[]) as last, cast(0 as integer) as start, false as given from b where b = 0
 union all select b.doc_id, b.b, case when len(b.l) > s.start then b.l[s.start + 1:] else f.last end, s.start, len(b.l) > s.start from f join b on b.doc_id = f.doc_id and b.b = f.b + 1,
  lateral (select cast(case when len(f.last) > 0 and f.last[-1] = b.l[1] then 1 when len(f.last) > 0 and len(b.l) > len(f.last) and b.l[1:len(f.last)] = f.last then len(f.last) else 0 end as integer) as start) s)
select doc_id, cast(b as integer) as block, start from f where given""")
def line_dedup_start(spark: SparkSession, d: str) -> DataFrame:
    lines = _lines(spark, d).withColumn("block", F.floor(F.col("pos") / 2).cast("int"))
    listed = F.transform(F.array_sort(F.collect_list(F.struct("pos", "line"))), lambda x: x["line"])
    blocks = lines.groupBy("doc_id", "block").agg(listed.alias("lines"))
    return sequence.line_dedup(blocks, "doc_id", "block").select("doc_id", "block", "start")


@query("paragraph_flush", f"""with recursive {_LINES},
t as (select doc_id, pos, trim(regexp_replace(line, '\\s+', ' ', 'g')) as t from lines),
c as (select doc_id, row_number() over (partition by doc_id order by pos) as r, count(*) over (partition by doc_id) as n, cast(pos as bigint) * 20000 as s, t, list_transform(string_split(lower(t), ' '), lambda w: trim(w, '.,!?:;"' || chr(39))) as w from t where t <> ''),
f as (select doc_id, cast(0 as bigint) as r, cast(0 as bigint) as start, cast(0 as integer) as para, cast([] as varchar[]) as before, cast([] as varchar[]) as kept, true as closed from c where r = 1
 union all select c.doc_id, c.r, g.start, cast(f.para + case when f.closed and f.r > 0 then 1 else 0 end as integer), case when h.same and len(c.w) <= len(g.b) then g.b else c.w end,
  case when not h.same then list_append(g.k, c.t) when len(c.w) > len(g.b) then list_append(g.k[1:len(g.k) - 1], c.t) else g.k end,
  c.r = c.n or (c.s + 15000 - g.start) // 1000 >= 120 or ((c.s + 15000 - g.start) // 1000 >= 60 and regexp_matches(rtrim(c.t, '"' || chr(39)), '[.!?]$'))
 from f join c on c.doc_id = f.doc_id and c.r = f.r + 1, lateral (select case when f.closed then c.s else f.start end as start, case when f.closed then [] else f.before end as b, case when f.closed then [] else f.kept end as k) g,
  lateral (select len(g.b) > 0 and g.b[1:least(len(g.b), len(c.w))] = c.w[1:least(len(g.b), len(c.w))] as same) h)
select doc_id, para, start as start_ms, array_to_string(kept, ' ') as text from f where closed and r > 0""")
def paragraph_flush(spark: SparkSession, d: str) -> DataFrame:
    cues = _lines(spark, d).select("doc_id", "pos", (F.col("pos") * 20_000).alias("start_ms"), (F.col("pos") * 20_000 + 15_000).alias("end_ms"), F.col("line").alias("text"))
    return sequence.paragraphs(cues, ["doc_id"], "pos", elapsed="total")


_TFIDF = f"""{_LINES},
win as (select doc_id, cast(pos // 3 as integer) as window_id, string_agg(line, ' ' order by pos) as text from lines group by 1, 2),
tok as (select doc_id, window_id, unnest(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]{{2,}}')) as term from win),
tf as (select doc_id, window_id, term, count(*) as tf from tok group by 1, 2, 3), df as (select doc_id, term, count(*) as df from tf group by 1, 2), n as (select doc_id, count(*) as n from win group by 1),
raw as (select tf.*, tf * (ln((1.0 + n) / (1.0 + df)) + 1) as raw from tf join df using (doc_id, term) join n using (doc_id)),
wt as (select doc_id, window_id, term, tf, raw / sqrt(sum(raw * raw) over (partition by doc_id, window_id)) as weight from raw),
sim as (select w.doc_id, w.window_id, coalesce(s.sim, 0) as sim from (select * from win where window_id > 0) w left join
 (select a.doc_id, a.window_id, sum(a.weight * b.weight) as sim from wt a join wt b on a.doc_id = b.doc_id and a.window_id = b.window_id + 1 and a.term = b.term group by 1, 2) s on w.doc_id = s.doc_id and w.window_id = s.window_id)"""


def _windows(spark: SparkSession, d: str) -> DataFrame:
    """Three lines a window."""
    docs = table(spark, d, "documents").select("doc_id", "text").repartition("doc_id")  # all steps up to the similarities keep this partitioning
    lines = docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line")).withColumn("window_id", F.floor(F.col("pos") / 3).cast("int"))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "line"))), lambda x: x["line"]), " ")
    return lines.groupBy("doc_id", "window_id").agg(text.alias("text"))


@query("tfidf_weights", f"with {_TFIDF} select doc_id, window_id, term, tf, round(weight, 6) as weight from wt")
def tfidf_weights(spark: SparkSession, d: str) -> DataFrame:
    return topics.tfidf(_windows(spark, d)).withColumn("weight", F.round("weight", 6))


@query("window_similarity", f"with {_TFIDF} select doc_id, window_id, round(sim, 6) as sim from sim")
def window_similarity(spark: SparkSession, d: str) -> DataFrame:
    w = _windows(spark, d)
    return topics.neighbour_similarity(topics.tfidf(w), w).withColumn("sim", F.round("sim", 6))


@query("segments", f"""with {_TFIDF}, br as (select doc_id, window_id from sim where round(sim, 9) < 0.1)
select w.doc_id, w.window_id, cast(1 + count(b.window_id) over (partition by w.doc_id order by w.window_id) as integer) as seg_no from win w left join br b on w.doc_id = b.doc_id and w.window_id = b.window_id""")
def segments(spark: SparkSession, d: str) -> DataFrame:
    w = _windows(spark, d)
    sims = topics.neighbour_similarity(topics.tfidf(w), w).withColumn("sim", F.round("sim", 9))
    breaks = topics.topic_breaks(sims, 0.1, least=1)
    return topics.segments(w.select("doc_id", "window_id"), breaks)


def _backfilled(least: str) -> str:
    """Topic breaks below 0.02, filled up to the least number by ascending similarity, places not next to one another."""
    return f"""with recursive {_TFIDF}, g as (select doc_id, count(*) + 1 as n, list_filter(list(case when round(sim, 9) < 0.02 then window_id else -1 end), lambda x: x >= 0) as low,
  list_filter(list(case when round(sim, 9) < 0.02 then -1 else window_id end order by round(sim, 9), window_id), lambda x: x >= 0) as waiting from sim group by 1),
h as (select *, least({least}, n) as goal from g),
f as (select doc_id, 0 as i, list_prepend(cast(0 as integer), low) as chosen from h
 union all select h.doc_id, f.i + 1, case when len(f.chosen) < h.goal and not list_has_any(f.chosen, [h.waiting[f.i + 1] - 1, h.waiting[f.i + 1], h.waiting[f.i + 1] + 1]) then list_append(f.chosen, h.waiting[f.i + 1]) else f.chosen end
 from f join h using (doc_id) where f.i < len(h.waiting))
select f.doc_id, unnest(list_filter(f.chosen, lambda x: x > 0)) as window_id from f join h on h.doc_id = f.doc_id and f.i = len(h.waiting)"""


@query("topic_breaks_by_duration", _backfilled("case doc_id % 3 when 0 then 3 when 1 then 5 else 8 end"))
def topic_breaks_by_duration(spark: SparkSession, d: str) -> DataFrame:
    w = _windows(spark, d)
    sims = topics.neighbour_similarity(topics.tfidf(w), w).withColumn("sim", F.round("sim", 9))
    least = sequence.window_parameters((F.col("doc_id") % 3) * 1800)["segments"]
    return topics.topic_breaks(sims.withColumn("least", least), 0.02, least="least")


@query("topic_breaks", _backfilled("3"))
def topic_breaks(spark: SparkSession, d: str) -> DataFrame:
    w = _windows(spark, d)
    sims = topics.neighbour_similarity(topics.tfidf(w), w).withColumn("sim", F.round("sim", 9))
    return topics.topic_breaks(sims, 0.02, least=3)


@query("segment_keywords", f"""with {_TFIDF}, br as (select doc_id, window_id from sim where round(sim, 9) < 0.1),
seg as (select w.doc_id, w.window_id, cast(1 + count(b.window_id) over (partition by w.doc_id order by w.window_id) as integer) as seg_no from win w left join br b on w.doc_id = b.doc_id and w.window_id = b.window_id),
kw as (select doc_id, seg_no, term, sum(weight) as w from wt join seg using (doc_id, window_id) where length(term) > 2 and regexp_matches(term, '^\\p{{L}}+$') and term not in ('the', 'and') group by 1, 2, 3),
rk as (select *, row_number() over (partition by doc_id, seg_no order by round(w, 9) desc, term) as r from kw), best as (select doc_id, seg_no, string_agg(term, ' · ' order by r) as words from rk where r <= 3 group by 1, 2)
select s.doc_id, s.seg_no, case when s.seg_no = 1 then 'Introdução' else coalesce(words, 'Tópico ' || s.seg_no) end as label from (select distinct doc_id, seg_no from seg) s left join best b on s.doc_id = b.doc_id and s.seg_no = b.seg_no""")
def segment_keywords(spark: SparkSession, d: str) -> DataFrame:
    w = _windows(spark, d)
    weights = topics.tfidf(w)
    sims = topics.neighbour_similarity(weights, w).withColumn("sim", F.round("sim", 9))
    placed = topics.segments(w.select("doc_id", "window_id"), topics.topic_breaks(sims, 0.1, least=1))
    return topics.keywords(weights, placed, ["the", "and"])


@query("embedding_adjacent_cosine", """
with a as (select vec_id, embedding::double[] as e, lag(embedding::double[]) over (order by vec_id) as p from embeddings)
select vec_id, round(list_dot_product(e, p) / sqrt(list_dot_product(e, e) * list_dot_product(p, p)), 5) as sim from a where p is not null""")
def embedding_adjacent_cosine(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("e"))
    # ids are consecutive, so neighbours meet by an equi-join and no window orders the whole table
    p = e.select((F.col("vec_id") + 1).alias("vec_id"), F.col("e").alias("p"))
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    return e.join(p, "vec_id").select("vec_id", F.round(dot("e", "p") / F.sqrt(dot("e", "e") * dot("p", "p")), 5).alias("sim"))


@query("front_matter_extract", """
select doc_id, case when doc_id % 3 = 2 then 'Head ' || doc_id else 'Title ' || doc_id end as title, case when doc_id % 3 = 2 then '2024-03-01' else '2024-02-03' end as date,
  case when doc_id % 3 = 2 then null else 'id' || doc_id end as id from documents""")
def front_matter_extract(spark: SparkSession, d: str) -> DataFrame:
    i, k = F.col("doc_id").cast("string"), F.col("doc_id") % 3
    new = F.concat(F.lit('---\ntitle: "Title '), i, F.lit('"\nDATE: 20240203\nvideo_id: id'), i, F.lit("\n---\n"), F.col("text"))
    old = F.concat(F.lit("---\ntitulo: Title "), i, F.lit("\nupload_date: '2024-02-03'\nid: \"id"), i, F.lit('"\n---\n'), F.col("text"))
    plain = F.concat(F.lit("# **Head "), i, F.lit("**\n> **Data:** 2024-03-01\n"), F.col("text"))
    m = M.metadata(F.when(k == 0, new).when(k == 1, old).otherwise(plain))
    return table(spark, d, "documents").select("doc_id", m.alias("m")).select("doc_id", "m.title", "m.date", "m.id")


@query("article_block", """
with b as (select doc_id, case when doc_id % 2 = 0 then lpad(cast(doc_id as varchar), 11, 'v') else 'v' || doc_id end as id, trim(regexp_replace(text, '^\\s+|\\s+$', '', 'g')) as body, source as t from documents),
u as (select *, case when length(id) = 11 then 'https://youtube.com/watch?v=' || id else '' end as url from b)
select doc_id, md5(chr(10) || '<article class="video-entry">' || chr(10) || '---' || chr(10) || 'title: "' || t || '"' || chr(10) || 'video_id: "' || id || '"' || chr(10) || 'url: "' || url || '"' || chr(10) || 'date: "Desconhecida"' || chr(10) || 'file_source: "f' || doc_id || '.txt"' || chr(10) || '---' || chr(10) || chr(10)
 || case when starts_with(body, '# ') then '' else '# ' || t || chr(10) || chr(10) || '> **Data:** Desconhecida | **ID:** `' || id || '`' || case when url <> '' then ' | 🔗 [' || url || '](' || url || ')' else '' end || chr(10) || chr(10) end || body || chr(10) || '</article>' || chr(10)) as block from u""")
def article_block(spark: SparkSession, d: str) -> DataFrame:
    i = F.col("doc_id").cast("string")
    item = F.when(F.col("doc_id") % 2 == 0, F.lpad(i, 11, "v")).otherwise(F.concat(F.lit("v"), i))
    block = M.article(F.col("text"), F.concat(F.lit("f"), i, F.lit(".txt")), F.col("source"), item, F.lit(None).cast("string"))
    return table(spark, d, "documents").select("doc_id", F.md5(block.cast("binary")).alias("block"))


@query("volume_records", "select doc_id, source as title, 'v' || doc_id as id, 'Desconhecida' as date from documents")
def volume_records(spark: SparkSession, d: str) -> DataFrame:
    i = F.concat(F.lit("v"), F.col("doc_id").cast("string"))
    block = M.article(F.col("text"), i, F.col("source"), i, F.lit(None).cast("string"))
    return table(spark, d, "documents").select("doc_id", F.explode(M.volume_records(block)).alias("r")).select("doc_id", "r.*")


@query("markdown_body", """
with b as (select doc_id, trim(regexp_replace(text, '^\\s+|\\s+$', '', 'g')) as body, source from documents)
select doc_id, md5('# ' || source || chr(10) || '> a' || chr(10) || chr(10) || '### Transcrição Estruturada' || chr(10) || body) as body from b""")
def markdown_body(spark: SparkSession, d: str) -> DataFrame:
    md = F.concat(F.lit("---\nx: 1\n---\n# "), "source", F.lit("\n> a\n\nresumo\n### Transcrição Estruturada\n"), "text")
    return table(spark, d, "documents").select("doc_id", F.md5(M.markdown_body(md).cast("binary")).alias("body"))


@query("url_title_html", """
select page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) as title, md5(trim(regexp_replace(regexp_replace(replace(html, chr(10), ' '), '<[^>]+>', '', 'g'), '^\\s+|\\s+$', '', 'g'))) as plain from pages""")
def url_title_html(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages").select("page_id", F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"), F.md5(T.strip_tags(F.col("html")).cast("binary")).alias("plain"))


@query("conversation_concat", "select conv_id, md5(string_agg(text, ' ' order by turn)) as text, count(*) as turns from conversations group by conv_id")
def conversation_concat(spark: SparkSession, d: str) -> DataFrame:
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", "text"))), lambda x: x["text"]), " ")
    return table(spark, d, "conversations").groupBy("conv_id").agg(F.md5(text.cast("binary")).alias("text"), F.count("*").alias("turns"))


def _as_srt(spark: SparkSession, d: str) -> DataFrame:
    """Conversations as SRT files, a turn every 5 s."""
    cues = table(spark, d, "conversations").select(F.col("conv_id").cast("string").alias("path"), (F.col("turn") + 1).alias("seq"), (F.col("turn") * 5000 + 250).alias("start_ms"), (F.col("turn") * 5000 + 4750).alias("end_ms"), F.regexp_replace("text", r"\n\s*", "\n").alias("text"))
    return subtitles.srt_text(cues)


@query("srt_round_trip", """
select cast(conv_id as varchar) as path, turn * 5000 + 250 as start_ms, turn * 5000 + 4750 as end_ms, md5(regexp_replace(regexp_replace(text, '\\n\\s*', chr(10), 'g'), '^\\s+|\\s+$', '', 'g')) as text from conversations""")
def srt_round_trip(spark: SparkSession, d: str) -> DataFrame:
    return subtitles.srt_cues(_as_srt(spark, d)).select("path", "start_ms", "end_ms", F.md5(T.strip(F.col("text")).cast("binary")).alias("text"))


@query("fluent_text", """with recursive
b as (select conv_id, row_number() over (partition by conv_id order by turn) as r, list_filter(list_transform(string_split(regexp_replace(text, '\\n\\s*', chr(10), 'g'), chr(10)), lambda x: regexp_replace(regexp_replace(x, '<[^>]*>', '', 'g'), '^\\s+|\\s+$', '', 'g')), lambda x: x <> '') as l
  from conversations where not regexp_matches(text, '^\\s*$')),
f as (select conv_id, cast(0 as bigint) as r, cast([] as varchar[]) as last, cast([] as varchar[]) as kept from b where r = 1
 union all select b.conv_id, b.r, case when len(b.l) > s.start then b.l[s.start + 1:] else f.last end, case when len(b.l) > s.start then b.l[s.start + 1:] else [] end from f join b on b.conv_id = f.conv_id and b.r = f.r + 1,
  lateral (select cast(case when len(f.last) > 0 and f.last[-1] = b.l[1] then 1 when len(f.last) > 0 and len(b.l) > len(f.last) and b.l[1:len(f.last)] = f.last then len(f.last) else 0 end as integer) as start) s)
select cast(conv_id as varchar) as path, string_agg(array_to_string(kept, ' '), ' ' order by r) as value from f where len(kept) > 0 group by conv_id""")
def fluent_text(spark: SparkSession, d: str) -> DataFrame:
    return subtitles.fluent_text(subtitles.srt_cues(_as_srt(spark, d)))


@query("sidecar_candidates", """
select doc_id, 'c' || doc_id || '--ID.pt-br.info.json,c' || doc_id || '--ID.info.json,c' || doc_id || '-.info.json,c' || doc_id || '.info.json' as names from documents""")
def sidecar_candidates(spark: SparkSession, d: str) -> DataFrame:
    path = F.concat(F.lit("c"), F.col("doc_id").cast("string"), F.lit("--ID.pt-br.txt"))
    return table(spark, d, "documents").select("doc_id", F.array_join(records.sidecar_candidates(path), ",").alias("names"))


@query("transcript_markdown")
def transcript_markdown(spark: SparkSession, d: str) -> DataFrame:
    cues = table(spark, d, "conversations").select(F.col("conv_id").alias("doc_id"), F.col("turn").cast("int").alias("seq"), (F.col("turn") * 20_000).alias("start_ms"), (F.col("turn") * 20_000 + 19_000).alias("end_ms"), "text")
    meta = table(spark, d, "documents").select("doc_id", F.col("source").alias("title"), F.lit("20240101").alias("date"))
    return document.to_markdown(cues, meta, "en", elapsed="total")
