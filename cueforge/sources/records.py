"""Readers of item databases, sidecars, rules, manifests and other small text files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cueforge.functions import markdown as M
from cueforge.functions import text as T
from cueforge.operators.merge import NO_DATES, NO_TITLES, known

VIDEO = (
    "video_id string, id string, title string, publish_date string, subtitle_downloaded boolean, info_downloaded boolean, has_no_subtitle boolean, "
    "consolidated boolean, consolidated_notebooklm boolean, source_channel string, playlists array<string>, channel_id string, uploader string, "
    "uploader_id string, channel string, duration_s bigint, view_count bigint"
)
INFO = "id string, display_id string, title string, fulltitle string, upload_date string, publish_date string, date string, uploader string, uploader_id string, channel string, channel_id string, duration bigint, view_count bigint"
#: Folders and files that never hold item databases.
IGNORED_FOLDERS = [".git", ".venv", "__pycache__"]
SIDECAR_ID = r"([A-Za-z0-9_-]{11}|\d+)(?=\.info\.json$)"


def _fields(ddl: str) -> str:
    """A column list as struct fields."""
    return ", ".join(f"{n}: {k}" for n, k in (x.strip().split(" ", 1) for x in ddl.split(", ")))


_VIDEOS = f"array<struct<{_fields(VIDEO)}>>"
_CHANNEL = f"folder_repository string, videos {_VIDEOS}, youtube_channels array<string>, vimeo_channels array<string>, channel_context string, detected_language string, youtube_channel string, channel string"
_STATE = "struct<processed_files: array<string>, processed_ids: array<string>, last_volume: int, last_volume_size: bigint>"


def whole_files(spark: SparkSession, path: str, glob: str) -> DataFrame:
    """(path, value) of files whose name fits the glob, ignored folders left out."""
    files = spark.read.text(path, wholetext=True, pathGlobFilter=glob, recursiveFileLookup=True)
    files = files.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_modification_time").alias("modified"), "value")
    folders = F.slice(F.split("path", "/"), 1, F.size(F.split("path", "/")) - 1)
    bad = F.exists(folders, lambda x: x.isin(*IGNORED_FOLDERS) | x.endswith(".bak") | x.endswith(".backup"))
    return files.where(~bad)


def channel_documents(files: DataFrame, state_key: str = "state") -> DataFrame:
    """(path, doc): each text (path, value) as a channel document; a bare list is its videos, a broken text has none.

    state_key: the document's key of its packing state; doc has it as `state`.
    """
    kept = F.from_json("value", f"`{state_key}` {_STATE}")[state_key]
    doc = F.from_json("value", _CHANNEL).withField("state", kept)
    bare = F.from_json("value", _VIDEOS)
    is_list = F.trim("value").startswith("[")
    videos = F.when(is_list, bare).otherwise(doc["videos"])
    return files.select("path", doc.withField("videos", F.coalesce(videos, F.array().cast(_VIDEOS))).alias("doc"))


def videos(documents: DataFrame, validate_ids: bool = True) -> DataFrame:
    """One row for each video of channel_documents(): path, pos and the record; `id` stands in for video_id, the old consolidation flag for the new."""
    v = documents.select("path", F.posexplode("doc.videos").alias("pos", "v")).select("path", "pos", "v.*")
    v = v.withColumns({"video_id": F.coalesce(known(F.col("video_id"), [""]), "id"), "consolidated": F.coalesce("consolidated_notebooklm", "consolidated", F.lit(False))}).drop("id", "consolidated_notebooklm")
    return v.where(T.valid_id(F.col("video_id")) if validate_ids else F.coalesce("video_id", F.lit("")) != "")


def migrated(documents: DataFrame) -> DataFrame:
    """Documents with youtube_channel filled from the older fields, and its flags set for ids of the old state."""
    doc = F.col("doc")
    name = F.coalesce(known(doc["youtube_channel"], [""]), known(doc["channel"], [""]), known(doc["channel_context"], [""]))
    ids = F.coalesce(doc["state"]["processed_ids"], F.array().cast("array<string>"))
    flagged = F.transform(doc["videos"], lambda v: v.withField("consolidated_notebooklm", F.coalesce(v["consolidated_notebooklm"], v["consolidated"], F.lit(False)) | F.array_contains(ids, v["video_id"])))
    return documents.withColumn("doc", doc.withField("youtube_channel", name).withField("videos", flagged))


def info_records(files: DataFrame) -> DataFrame:
    """Records of sidecar texts (path, value); anything but an object is left out."""
    x = files.where(F.trim("value").startswith("{")).select("path", F.from_json("value", INFO).alias("x")).where("x is not null")
    date = T.format_date(F.coalesce(known(F.col("x.upload_date"), [""]), known(F.col("x.publish_date"), [""]), known(F.col("x.date"), [""])))
    item = F.coalesce(known(F.col("x.id"), [""]), known(F.col("x.display_id"), [""]), known(F.regexp_extract("path", SIDECAR_ID, 1), [""]))
    title = F.coalesce(known(F.col("x.title"), [""]), known(F.col("x.fulltitle"), [""]), F.lit("Avulso"))
    return x.select(
        "path", item.alias("video_id"), title.alias("title"), date.alias("publish_date"), (date != T.UNKNOWN_DATE).alias("info_downloaded"),
        F.coalesce("x.channel_id", "x.uploader_id").alias("channel_id"), F.coalesce("x.uploader_id", "x.channel_id").alias("uploader_id"),
        F.coalesce("x.uploader", "x.channel").alias("uploader"), F.coalesce("x.channel", "x.uploader").alias("channel"),
        F.col("x.duration").alias("duration_s"), F.col("x.view_count").alias("view_count"),
    )


def harvest(items: DataFrame, infos: DataFrame, key: str = "video_id") -> DataFrame:
    """Items with title and date from sidecars over placeholders, and duration, channel and views where they have none."""
    i = infos.groupBy(F.col(key).alias("_k")).agg(*(F.min_by(c, "path").alias(f"_{c}") for c in ("title", "publish_date", "duration_s", "channel", "view_count")))
    df = items.join(i, F.col(key) == F.col("_k"), "left")
    over = lambda c, gone: F.coalesce(known(F.col(c), gone), known(F.col(f"_{c}"), gone), F.col(c)).alias(c)
    fill = lambda c, none: F.coalesce(F.when(F.col(c) != none, F.col(c)), F.col(f"_{c}"), F.col(c)).alias(c)
    new = {"title": over("title", NO_TITLES), "publish_date": over("publish_date", NO_DATES), "duration_s": fill("duration_s", 0), "channel": fill("channel", ""), "view_count": fill("view_count", 0)}
    return df.select(*(new.get(c, F.col(c)) for c in items.columns))


def rules(lines: DataFrame) -> DataFrame:
    """(original, replacement) from lines (scope, line_no, value): `A,B` or else `A = B`; later lines and higher scopes win."""
    text = T.strip(F.col("value"))
    df = lines.withColumn("t", text).where((F.col("t") != "") & ~F.col("t").startswith("#"))
    parts = F.when(F.col("t").contains(","), F.split("t", ",", 2)).otherwise(F.split("t", "=", 2))
    df = df.withColumn("p", parts).where(F.size("p") == 2).select("scope", "line_no", T.strip(F.col("p")[0]).alias("original"), T.strip(F.col("p")[1]).alias("replacement")).where("original <> ''")
    return df.groupBy("original").agg(F.max_by("replacement", F.struct("scope", "line_no")).alias("replacement"))


def rule_dictionary(table: DataFrame, most: int = 10_000) -> dict[str, str]:
    """Rules as a dictionary for replace_terms(); refused above `most` rows, since it becomes part of the plan."""
    rows = table.orderBy(F.length("original").desc(), "original").limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} rules")
    return {r["original"]: r["replacement"] for r in rows}


def legacy_ids(lines: DataFrame, prefix: str = "youtube ") -> DataFrame:
    """Distinct ids of lines that begin with the prefix."""
    item = T.strip(F.substr("value", F.lit(len(prefix) + 1)))
    return lines.where(F.col("value").startswith(prefix)).select(item.alias("video_id")).where("video_id <> ''").distinct()


def legacy_without(lines: DataFrame) -> DataFrame:
    """Distinct ids after the last `watch?v=` of lines that have one."""
    return lines.where(F.col("value").contains("watch?v=")).select(T.strip(F.substring_index("value", "watch?v=", -1)).alias("video_id")).where("video_id <> ''").distinct()


def manifest(lines: DataFrame) -> DataFrame:
    """(kind file|id, value) of volume lines; ids only where they are valid. Quotes around values go."""
    value = lambda p: T.strip(F.regexp_replace(F.regexp_extract("value", rf"^(?:{p}):\s*(.*)$", 1), '^"|"$', ""))
    files = lines.select(F.lit("file").alias("kind"), value("ARQUIVO|file_source").alias("value"))
    ids = lines.select(F.lit("id").alias("kind"), value("ID|video_id").alias("value")).where(T.valid_id(F.col("value")))
    return files.where("value <> ''").union(ids).distinct()


def volume_scan(files: DataFrame, channel: str) -> DataFrame:
    """One row: last_volume and its size in characters, of files (path, value) named `<channel>-v<number>.txt`."""
    number = F.regexp_extract(F.substring_index("path", "/", -1), rf"^\Q{channel}\E-v(\d+)\.txt$", 1)
    own = files.withColumn("n", F.nullif(number, F.lit("")).cast("int")).where("n is not null")
    return own.agg(F.coalesce(F.max("n"), F.lit(0)).alias("last_volume"), F.coalesce(F.max_by(F.length("value"), "n"), F.lit(0)).alias("last_volume_size"))


def eligible(files: DataFrame, channel: str, archives: bool = True) -> DataFrame:
    """Transcript files of a channel by name, no volumes, sorted by path."""
    name = F.substring_index("path", "/", -1)
    fits = name.rlike(rf"^\Q{channel}\E-+[A-Za-z0-9_-]{{9,15}}(?:-[a-zA-Z0-9-]+)?\.(?:txt|srt|md)$")
    stored = F.col("path").rlike("/archives?/") | F.col("path").rlike("^archives?/")
    return files.where(fits & ~name.rlike(rf"^\Q{channel}\E-v\d+\.txt$") & (F.lit(archives) | ~stored)).orderBy("path")


def channel_folders(paths: DataFrame, prefix: str) -> DataFrame:
    """(folder): folders that hold an item database (`<prefix>_*.json`) or an archive or volumes folder, sorted. Excluded by their own name only."""
    full = F.regexp_replace("path", "/+", "/")
    name, folder = F.substring_index(full, "/", -1), F.regexp_replace(full, "/[^/]*$", "")
    direct = paths.where(name.rlike(rf"^\Q{prefix}\E_.*\.json$")).select(folder.alias("folder"))
    up = paths.where(folder.rlike("/(archive|volumes_notebooklm)$")).select(F.regexp_replace(folder, "/[^/]*$", "").alias("folder"))
    found = direct.union(up).distinct()
    own = F.substring_index("folder", "/", -1)
    return found.where(~own.isin(*IGNORED_FOLDERS)).orderBy("folder")


def sidecar_candidates(path: Column) -> Column:
    """Names of sidecars that may belong to a file, best first: its stem, then shortened at the last dots, then at the last dashes."""
    stem = F.regexp_replace(path, r"\.[^./]*$", "")
    cuts = lambda s, sep: F.transform(F.sequence(F.size(F.split(s, sep)) - 1, F.lit(1), F.lit(-1)), lambda n: F.array_join(F.slice(F.split(s, sep), 1, n), sep.strip("[]")))
    more = lambda s, sep: F.when(F.size(F.split(s, sep)) > 1, cuts(s, sep)).otherwise(F.array().cast("array<string>"))
    undotted = F.when(F.size(F.split(stem, "[.]")) > 1, F.element_at(F.split(stem, "[.]"), 1)).otherwise(stem)
    names = F.concat(F.array(stem), more(stem, "[.]"), more(undotted, "[-]"))
    return F.array_distinct(F.transform(F.filter(names, lambda n: n != ""), lambda n: F.concat(n, F.lit(".info.json"))))


def with_sidecars(files: DataFrame, sidecars: DataFrame) -> DataFrame:
    """files with the columns of their first sidecar that exists (sidecars: path and others)."""
    tries = files.select("path", F.posexplode(sidecar_candidates(F.col("path"))).alias("_p", "_try"))
    rest = [c for c in sidecars.columns if c != "path"]
    found = tries.join(sidecars.select(F.col("path").alias("_try"), F.struct(*rest).alias("_s")), "_try")
    best = found.groupBy("path").agg(F.min_by("_s", "_p").alias("sidecar"))
    return files.join(best, "path", "left")


def file_metadata(files: DataFrame) -> DataFrame:
    """files (path, value) with title, date and id from their own text; the id falls back on the name."""
    m = M.metadata(F.col("value"))
    return files.withColumn("m", m).select(*files.columns, F.coalesce("m.title", F.lit(T.NO_TITLE)).alias("title"), F.coalesce("m.date", F.lit(T.UNKNOWN_DATE)).alias("date"), F.coalesce("m.id", T.video_id(F.col("path"))).alias("video_id"))


def cookies(lines: DataFrame, domains: list[str]) -> DataFrame:
    """Lines of a cookie file that are comments or belong to the domains; a name that only ends like one doesn't."""
    first = F.regexp_replace(F.split("value", "\t")[0], "^#HttpOnly_", "")
    host = F.lower(F.regexp_replace(first, r"^\.", ""))
    comment = F.col("value").startswith("#") & ~F.col("value").startswith("#HttpOnly_")
    return lines.where(comment | T.host_within(host, domains))


def valid_cookie_text(text: Column) -> Column:
    head = F.substring(text, 1, 100)
    return head.contains("Netscape") | head.contains("TRUE")


def latest_database(files: DataFrame, official: str, prefixes: tuple[str, ...] = ("lista",)) -> DataFrame:
    """One row: the official file, else the newest one with a prefix (path, modified)."""
    name = F.substring_index("path", "/", -1)
    own = files.where((name == official) | name.rlike(rf"^(?:{'|'.join(prefixes)})_.*\.json$"))
    return own.orderBy((name == official).desc(), F.col("modified").desc(), "path").limit(1)


def files_by_item(files: DataFrame) -> DataFrame:
    """(video_id, files): the paths of each item's files, sorted."""
    return files.groupBy(T.video_id(F.col("path")).alias("video_id")).agg(F.array_sort(F.collect_set("path")).alias("files"))


def history(documents: DataFrame, infos: DataFrame) -> DataFrame:
    """One merged row for each item: databases first, then sidecars."""
    from cueforge.operators.merge import merge_records

    a = videos(documents).withColumn("_rank", F.lit(0))
    b = infos.withColumn("_rank", F.lit(1))
    both = a.unionByName(b, allowMissingColumns=True)
    pos = F.row_number().over(Window.partitionBy("video_id").orderBy("_rank", "path", "pos"))
    return merge_records(both.withColumn("pos", pos))


def legacy_srt_name(name: Column, channel: str, item: Column) -> Column:
    """Whether an SRT file's language follows the id after a dot, as older names had it."""
    rest = F.substr(name, F.length(item) + len(channel) + 2)
    return name.startswith(channel) & rest.startswith(".") & name.endswith(".srt") & (F.length(rest) - F.length(F.replace(rest, F.lit("."), F.lit(""))) >= 2)


def standard_srt_name(name: Column, channel: str, item: Column) -> Column:
    """The file's name with its language after a dash."""
    front = F.concat(F.lit(f"{channel}-"), item)
    tail = F.regexp_replace(F.substr(name, F.length(item) + len(channel) + 2), r"^\.+", "")
    return F.when(legacy_srt_name(name, channel, item), F.concat(front, F.lit("-"), tail)).otherwise(name)


def listing_records(listing: DataFrame, known_items: DataFrame) -> DataFrame:
    """Landed listing rows (video_id, title, upload_date, publish_date, date) with one date; an item without one has the history's, or is unknown."""
    old = known_items.select(F.col("video_id").alias("_h"), F.col("publish_date").alias("_d"))
    own = F.coalesce(*(known(F.col(c), [""]) for c in ("upload_date", "publish_date", "date")))
    both = listing.join(old, F.col("video_id") == F.col("_h"), "left")
    return both.select("video_id", "title", F.when(own.isNotNull(), T.format_date(own)).otherwise(F.coalesce("_d", F.lit(T.UNKNOWN_DATE))).alias("publish_date"))


def adopt_old_state(state: DataFrame, old: DataFrame, key: str = "channel") -> DataFrame:
    """State with rows of an older state table for channels that have none."""
    return state.unionByName(old.join(state.select(key), key, "left_anti"), allowMissingColumns=True)


def archived(files: DataFrame, processed: DataFrame) -> DataFrame:
    """files (path) with archived: whether it was processed. Files aren't moved; a reset is this table without the flag."""
    done = processed.select(F.col("path").alias("_p")).distinct()
    return files.join(done, F.col("path") == F.col("_p"), "left").withColumn("archived", F.col("_p").isNotNull()).drop("_p")


def restored(files: DataFrame) -> DataFrame:
    """archived() undone: no file counts as archived, and paths in archive folders are those before archiving."""
    path = F.regexp_replace("path", r"(^|/)archives?/([^/]+)$", "$1$2")
    return files.withColumns({"path": path, "archived": F.lit(False)})


def vtt_files(files: DataFrame, channel: str, item: str) -> DataFrame:
    """WebVTT files of an item by their names, `<channel>-<item>*.vtt`. If there is none, those without a dash that begin with the
    channel's name up to its first dot, since downloads cut names there."""
    name = F.substring_index("path", "/", -1)
    own = name.startswith(f"{channel}-{item}")
    cut = name.startswith(channel.split(".", 1)[0]) & ~name.contains("-")
    found = files.where(name.endswith(".vtt") & (own | cut)).withColumn("_own", own)
    named = found.agg(F.coalesce(F.bool_or("_own"), F.lit(False)).alias("_any"))  # one row
    return found.join(F.broadcast(named), F.col("_own") | ~F.col("_any")).drop("_own", "_any")


def subtitle_listing(files: DataFrame, ending: str = "srt") -> DataFrame:
    """Files of an ending with their rank: for srt archived ones go first, for md last; then by name."""
    stored = F.when(F.col("path").rlike("(^|/)archive/"), 0).when(F.col("path").rlike("(^|/)archives/"), 1)
    rank = F.coalesce(stored, F.lit(2)) if ending == "srt" else F.coalesce(stored + 1, F.lit(0))
    return files.where(F.lower("path").endswith(f".{ending}")).withColumn("rank", rank).orderBy("rank", F.substring_index("path", "/", -1))
