"""Merging, upserting and excluding item records, as joins and grouped aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cueforge.functions import text as T

#: What counts as no title and no date.
NO_TITLES, NO_DATES = ["N/A", "", "Avulso"], ["N/A", "Desconhecida", ""]
FLAGS = ["subtitle_downloaded", "info_downloaded", "has_no_subtitle", "consolidated"]


def known(c: Column, placeholders: list[str]) -> Column:
    """The value, or null for a placeholder."""
    return F.when(~c.isin(*placeholders), c)


def first_known(c: Column, order: Column, placeholders: list[str]) -> Column:
    """Aggregate: the first value in order that is no placeholder, else the first value."""
    value = known(c, placeholders)
    return F.coalesce(F.min_by(value, F.when(value.isNotNull(), order)), F.min_by(c, order))


def merge_records(records: DataFrame, key: str = "video_id", order: str = "pos") -> DataFrame:
    """One row for each key: first known title and date, flags true if ever true, first source channel, all playlists in order.

    Grouped aggregates with partial aggregation; only playlists are collected. Rows without a key are dropped.
    """
    pos = F.col(order)
    have = [f for f in FLAGS if f in records.columns]
    out = [
        F.min(pos).alias(order),
        first_known(F.col("title"), pos, NO_TITLES).alias("title"),
        first_known(F.col("publish_date"), pos, NO_DATES).alias("publish_date"),
        *(F.coalesce(F.bool_or(f), F.lit(False)).alias(f) for f in have),
    ]
    if "source_channel" in records.columns:
        out.append(F.min_by(known(F.col("source_channel"), [""]), F.when(known(F.col("source_channel"), [""]).isNotNull(), pos)).alias("source_channel"))
    if "playlists" in records.columns:
        lists = F.transform(F.array_sort(F.collect_list(F.when(F.size("playlists") > 0, F.struct(pos.alias("p"), F.col("playlists").alias("l"))))), lambda x: x["l"])
        out.append(F.array_distinct(F.flatten(lists)).alias("playlists"))
    return records.where(F.coalesce(F.col(key), F.lit("")) != "").groupBy(key).agg(*out)


def wider_channel(old: Column, new: Column) -> Column:
    """The new tag if there is none yet or it continues the old one, whatever the case."""
    return F.when(new.isNull(), old).when(old.isNull() | (old == "") | (F.lower(new).startswith(F.lower(old)) & (F.lower(new) != F.lower(old))), new).otherwise(old)


def upsert_listing(state: DataFrame, listing: DataFrame, key: str = "video_id", tag: str | None = None, playlist: str | None = None, parity_dates: bool = False) -> DataFrame:
    """State after a listing: known items get date, title, playlist and channel; unknown ones are added. A full outer join.

    parity_dates: any date but `N/A` replaces a known one, as `Desconhecida` does; else known dates stay.
    """
    s, n = state.alias("s"), listing.alias("n")
    both = s.join(n, F.col(f"s.{key}") == F.col(f"n.{key}"), "full_outer")
    date = known(F.col("n.publish_date"), ["N/A"] if parity_dates else NO_DATES)
    title = known(F.col("n.title"), NO_TITLES)
    seen = F.col(f"n.{key}").isNotNull()
    cols = {
        key: F.coalesce(f"s.{key}", f"n.{key}"),
        "title": F.coalesce(title, F.col("s.title"), F.col("n.title")),
        "publish_date": F.coalesce(date, F.col("s.publish_date"), F.col("n.publish_date")),
        "is_new": F.col(f"s.{key}").isNull(),
    }
    cols |= {f: F.coalesce(F.col(f"s.{f}"), F.lit(False)) for f in FLAGS if f in state.columns}
    if "source_channel" in state.columns:
        cols["source_channel"] = F.when(seen, wider_channel(F.col("s.source_channel"), F.lit(tag) if tag else F.lit(None).cast("string"))).otherwise(F.col("s.source_channel"))
    if "playlists" in state.columns:
        old = F.coalesce(F.col("s.playlists"), F.array().cast("array<string>"))
        cols["playlists"] = F.when(seen & F.lit(playlist is not None), F.array_union(old, F.array(F.lit(playlist)))).otherwise(old)
    return both.select(*(c.alias(name) for name, c in cols.items()))


def reverse_import(history: DataFrame, state: DataFrame, channel_id: str | None, uploader_id: str | None, name: str | None, key: str = "video_id") -> DataFrame:
    """History rows that the state lacks and that belong to the channel by id, uploader id or part of the uploader's name."""
    mine = F.lit(False)
    if channel_id:
        mine = mine | (F.col("channel_id") == channel_id)
    if uploader_id:
        mine = mine | (F.col("uploader_id") == uploader_id)
    if name:
        mine = mine | F.lower("uploader").contains(name.lower())
    return history.where(F.coalesce(mine, F.lit(False))).join(state.select(key), key, "left_anti")


def enrich(files: DataFrame, known_items: DataFrame, key: str = "video_id", name: str = "path") -> DataFrame:
    """Files with title and date of the known items, by id, else by name, over placeholders only."""
    no_title, no_date = ["", T.NO_TITLE], ["", T.UNKNOWN_DATE]
    info = known_items.select(F.col(key).alias("_k"), F.col("title").alias("_t"), T.format_date(F.col("publish_date")).alias("_d"))
    by_name = info.select(F.col("_k").alias("_k2"), F.col("_t").alias("_t2"), F.col("_d").alias("_d2"))
    df = files.join(info, F.col(key) == F.col("_k"), "left").join(by_name, F.col(name) == F.col("_k2"), "left")
    pick = lambda c, a, b, gone: F.coalesce(known(F.col(c), gone), known(F.col(a), gone), known(F.col(b), gone), F.col(c))
    return df.withColumns({"title": pick("title", "_t", "_t2", no_title), "date": pick("date", "_d", "_d2", no_date)}).drop("_k", "_t", "_d", "_k2", "_t2", "_d2")


def exclude_processed(items: DataFrame, processed: DataFrame, key: str = "video_id") -> DataFrame:
    """Items whose id isn't processed."""
    return items.join(processed.select(key), key, "left_anti")


def flag_processed(videos: DataFrame, processed: DataFrame, key: str = "video_id") -> DataFrame:
    """Videos with `consolidated` set for processed ids, and placeholder rows for processed ids without a video."""
    p = processed.select(F.col(key).alias("_p")).where("_p is not null").distinct()
    df = videos.join(p, F.col(key) == F.col("_p"), "full_outer")
    df = df.withColumn("consolidated", F.coalesce("consolidated", F.lit(False)) | F.col("_p").isNotNull())
    df = df.withColumns({key: F.coalesce(key, "_p"), "title": F.coalesce("title", F.lit("N/A")), "publish_date": F.coalesce("publish_date", F.lit("N/A"))})
    return df.drop("_p")


def legacy_flags(videos: DataFrame, downloaded: DataFrame, infos: DataFrame, without: DataFrame, key: str = "video_id") -> DataFrame:
    """Videos with flags set for ids in three legacy sets."""
    for flag, ids in (("subtitle_downloaded", downloaded), ("info_downloaded", infos), ("has_no_subtitle", without)):
        own = ids.select(F.col(key).alias("_l")).distinct()
        videos = videos.join(own, F.col(key) == F.col("_l"), "left").withColumn(flag, F.coalesce(F.col(flag), F.lit(False)) | F.col("_l").isNotNull()).drop("_l")
    return videos


def skip_partition(items: DataFrame, on_disk: DataFrame, key: str = "video_id", retry_without: bool = False) -> DataFrame:
    """Items with to_download: neither downloaded, nor known to have no subtitle (unless retried), nor on disk."""
    disk = on_disk.select(F.col(key).alias("_d")).distinct()
    df = items.join(disk, F.col(key) == F.col("_d"), "left")
    without = F.lit(False) if retry_without else F.coalesce("has_no_subtitle", F.lit(False))
    return df.withColumn("to_download", ~(F.coalesce("subtitle_downloaded", F.lit(False)) | without | F.col("_d").isNotNull())).drop("_d")


def dedup_channels(channels: DataFrame, item: str = "item", order: str = "pos") -> DataFrame:
    """(key, item, pos): one row for each channel, at its first place, in the form of the last `@` spelling if there is one."""
    at = F.col(item).startswith("@")
    own = channels.withColumn("key", T.handle_key(F.col(item)))
    return own.groupBy("key").agg(F.coalesce(F.max_by(item, F.when(at, F.col(order))), F.min_by(item, F.col(order))).alias(item), F.min(order).alias(order))


def first_by_key(rows: DataFrame, key: str, *order: str | Column) -> DataFrame:
    """The first row of each key."""
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where("_n = 1").drop("_n")


def register_channel(channels: DataFrame, item: str, at_head: bool = False) -> DataFrame:
    """Channels (item, pos) with one more, unless an equal one is there. Positions stay in order."""
    one = channels.sparkSession.createDataFrame([(item,)], "item string").select(T.handle(F.col("item")).alias("item"))
    one = one.where(F.coalesce(F.col("item"), F.lit("@")) != "@")
    keys = channels.select(T.handle_key(F.col("item")).alias("_k"))
    new = one.join(keys, T.handle_key(F.col("item")) == F.col("_k"), "left_anti")
    edge = channels.agg((F.coalesce(F.min("pos"), F.lit(1)) - 1 if at_head else F.coalesce(F.max("pos"), F.lit(-1)) + 1).alias("pos"))
    return channels.unionByName(new.join(edge, F.lit(True)).select("item", F.col("pos").cast(channels.schema["pos"].dataType)))
