"""From cues to chaptered Markdown documents, and lookups over item records and files."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cueforge.functions import markdown as M
from cueforge.functions import text as T
from cueforge.operators import sequence, topics


def _joined(order: list[str], value: str, gap: str):
    """Aggregate: values in order, with a gap between."""
    return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(*order, F.col(value).alias("_v")))), lambda x: x["_v"]), gap)


def clean_cues(cues: DataFrame, pause_unit: str = "second") -> DataFrame:
    """Cues (doc_id, seq, start_ms, end_ms, text) with clean: tags off, rolled-over words off, punctuation restored; null where nothing stays.

    Pauses and the last cue are those of all cues, also of such that are dropped.
    """
    raw = sequence.pauses(cues.withColumn("text", T.strip_tags(F.coalesce("text", F.lit("")))), "doc_id", "seq", pause_unit)
    kept = sequence.strip_rollup(raw.select("doc_id", "seq", "text"), "doc_id", "seq")
    both = raw.join(kept, ["doc_id", "seq"], "left")
    return both.withColumn("clean", T.restore_punctuation(F.col("kept"), F.col("pause_s"), F.col("is_last"))).drop("kept", "pause_s", "is_last")


def to_markdown(cues: DataFrame, meta: DataFrame, language: str = "pt", rules: dict[str, str] | None = None, version: str = "Cueforge", least: int | None = 3, elapsed: str = "component", pause_unit: str = "second") -> DataFrame:
    """(doc_id, md) for each document with text; meta: (doc_id, title, date), both optional,
    and item: the id to show, if it isn't doc_id (files without an id, or several files of one item, need doc_ids of their own).

    The folds' results are read by several later steps and so persisted (recomputed if an executor is lost); spark.catalog.clearCache() frees them.
    least: the least number of topics; None for one by the document's duration.
    Windows by elapsed time, topics where neighbouring windows are unlike, a summary of topics with times, and a chapter for each with timed paragraphs.
    """
    stops = topics.stop_words(language)
    cleaned = clean_cues(cues, pause_unit)
    ends = cleaned.groupBy("doc_id").agg(F.max_by("end_ms", "seq").alias("last_ms"))
    ends = ends.withColumn("p", sequence.window_parameters(T.total_seconds(F.col("last_ms")))).select("doc_id", "last_ms", "p.size_s", "p.threshold", (F.col("p.segments") if least is None else F.lit(least)).alias("least"))
    timed = cleaned.join(ends, "doc_id").withColumn("has", F.col("clean").isNotNull() & (F.col("clean") != ""))
    placed = timed.join(sequence.elapsed_windows(timed, "doc_id", "seq", "size_s", kept="has", elapsed=elapsed), ["doc_id", "seq"]).persist()
    windows = placed.groupBy("doc_id", "window_id").agg(_joined(["seq"], "clean", " ").alias("text"))
    weights = topics.tfidf(windows, stops=stops).persist()
    sims = topics.neighbour_similarity(weights, windows).join(ends.select("doc_id", "threshold", "least"), "doc_id")
    # thresholds differ by document, so similarities are compared as distances from them
    breaks = topics.topic_breaks(sims.withColumn("sim", F.round("sim", 9) - F.col("threshold")), 0.0, "least")
    segs = topics.segments(windows.select("doc_id", "window_id"), breaks).persist()
    labels = topics.keywords(weights, segs, stops)
    inside = placed.join(segs, ["doc_id", "window_id"])
    starts = inside.groupBy("doc_id", "seg_no").agg(F.min_by("start_ms", "seq").alias("seg_ms")).join(labels, ["doc_id", "seg_no"])
    paras = sequence.paragraphs(inside.select("doc_id", "seg_no", "seq", "start_ms", "end_ms", F.col("clean").alias("text")), ["doc_id", "seg_no"], "seq", elapsed)
    text = T.clean_terms(T.restore_punctuation(F.col("text"), F.lit(0.0), F.lit(True)), rules or {})
    paras = paras.withColumn("_line", F.concat(F.lit("["), T.clock(F.col("start_ms")), F.lit("] "), text, F.lit("\n\n")))
    bodies = paras.groupBy("doc_id", "seg_no").agg(_joined(["para"], "_line", "").alias("paras"))
    segs_text = starts.join(bodies, ["doc_id", "seg_no"], "left")
    segs_text = segs_text.withColumns({
        "_item": F.concat(F.lit("* `["), T.clock(F.col("seg_ms")), F.lit("]` **"), "label", F.lit("**\n")),
        "_chapter": F.concat(F.lit("### ["), T.clock(F.col("seg_ms"), long=True), F.lit("] - Tópico: "), "label", F.lit("\n"), F.coalesce("paras", F.lit(""))),
    })
    body = segs_text.groupBy("doc_id").agg(_joined(["seg_no"], "_item", "").alias("items"), _joined(["seg_no"], "_chapter", "").alias("chapters"))
    info = body.join(ends.select("doc_id", "last_ms"), "doc_id").join(meta.select("doc_id", "title", "date", (F.col("item") if "item" in meta.columns else F.col("doc_id")).cast("string").alias("item")), "doc_id", "left")
    item = F.coalesce("item", F.col("doc_id").cast("string"))
    head = M.markdown_header(F.coalesce("title", item), item, T.format_date(F.col("date")), T.clock(F.col("last_ms")), F.lit(language), version)
    return info.select("doc_id", F.concat(head, F.lit("## Sumário e Tópicos (Timestamps)\n"), "items", F.lit("\n## Transcrição Estruturada por Capítulos\n"), "chapters").alias("md"))


def origin_of_item(history: DataFrame, item: str) -> DataFrame:
    """The channel that an item came from, by the history."""
    return history.where(F.col("video_id") == item).select("uploader", "channel_id", "uploader_id").limit(1)


def origin_of_playlist(history: DataFrame, playlist: str) -> DataFrame:
    """The channel of the first item that is in a playlist."""
    return history.where(F.array_contains("playlists", playlist)).orderBy("video_id").select("uploader", "channel_id", "uploader_id").limit(1)


def pending_markdown(items: DataFrame, files: DataFrame) -> DataFrame:
    """Items that have an SRT file and no Markdown. files: (video_id, path)."""
    name = F.lower(F.col("path"))
    own = files.groupBy("video_id").agg(F.bool_or(name.endswith(".srt")).alias("srt"), F.bool_or(name.endswith(".md")).alias("md"))
    return items.join(own.where("srt and not md").select("video_id"), "video_id", "left_semi")


def channel_of_document(documents: DataFrame) -> DataFrame:
    """(path, handle): the first channel name a document has, else its file name's end."""
    doc = F.col("doc")
    name = F.substring_index("path", "/", -1)
    fallback = F.regexp_replace(F.regexp_replace(name, r"\.json$", ""), "^[^_]*_", "")
    first = lambda c: F.get(c, F.lit(0))
    found = F.coalesce(*(F.nullif(c, F.lit("")) for c in (first(doc["youtube_channels"]), first(doc["vimeo_channels"]), doc["youtube_channel"], doc["channel"], doc["channel_context"], doc["folder_repository"])), fallback)
    return documents.select("path", T.handle(found).alias("handle"))


def recovered_names(orphans: DataFrame, infos: DataFrame) -> DataFrame:
    """(path, new_path) of files (path) beside a sidecar (path, video_id) of the same stem whose name lacks the id."""
    stem = lambda c: F.regexp_replace(F.regexp_replace(c, r"\.info\.json$", ""), r"(\.[a-zA-Z-]{2,6})?\.(srt|vtt|md|txt|json)$", "")
    side = infos.select(stem(F.col("path")).alias("_stem"), "video_id")
    both = orphans.withColumn("_stem", stem(F.col("path"))).join(side, "_stem")
    tail = F.substr("path", F.length("_stem") + 1)
    return both.where(~F.contains("path", "video_id")).select("path", F.concat("_stem", F.lit("-"), "video_id", tail).alias("new_path"))


def converted_counts(before: DataFrame, after: DataFrame) -> DataFrame:
    """(status, n): how many documents were converted and how many had no text."""
    done = before.select("doc_id").distinct().join(after.select("doc_id", F.lit(1).alias("_d")), "doc_id", "left")
    return done.groupBy(F.when(F.col("_d").isNotNull(), "converted").otherwise("skipped").alias("status")).agg(F.count("*").alias("n"))


def upgrade_counts(before: DataFrame, after: DataFrame, mark: str) -> DataFrame:
    """One row: upgraded, already, skipped, failed of texts (path, value) and their upgraded forms (path, value).

    Texts with the mark are of the new form already; others were upgraded if they changed, skipped if not, and failed where no new form is there.
    """
    both = before.alias("b").join(after.select("path", F.col("value").alias("_new")), "path", "left")
    new, old = F.coalesce(F.col("value").contains(mark), F.lit(False)), F.col("_new").eqNullSafe(F.col("value"))
    failed = F.col("_new").isNull()
    return both.agg(F.count_if(~new & ~failed & ~old).alias("upgraded"), F.count_if(new).alias("already"), F.count_if(~new & ~failed & old).alias("skipped"), F.count_if(~new & failed).alias("failed"))


def titled(files: DataFrame, lookup: DataFrame, key: str = "video_id") -> DataFrame:
    """files (path, key and others) with title and publish_date of a lookup; without one, the title is the file's stem and the date unknown."""
    own = lookup.select(F.col(key).alias("_k"), F.col("title").alias("_t"), F.col("publish_date").alias("_d"))
    stem = F.regexp_replace(F.substring_index("path", "/", -1), r"\.[^.]*$", "")
    df = files.join(own, F.col(key) == F.col("_k"), "left")
    return df.withColumns({"title": F.coalesce(F.nullif("_t", F.lit("")), stem), "publish_date": T.format_date(F.col("_d"))}).drop("_k", "_t", "_d")


def numbered(rows: DataFrame, key: str, *order: str) -> DataFrame:
    """rows with nth, counted from 1 in each key."""
    return rows.withColumn("nth", F.row_number().over(Window.partitionBy(key).orderBy(*order)))
