"""Filters and choices over item records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cueforge.functions import text as T


def since(items: DataFrame, limit: str, date: str = "publish_date") -> DataFrame:
    """Items with a known date from `YYYYMMDD` on, compared as text; an empty limit keeps all."""
    if not limit:
        return items
    if not (len(limit) == 8 and limit.isdigit()):
        raise ValueError("the limit must be YYYYMMDD")
    return items.where(~F.col(date).isin("N/A", "Desconhecida", "") & (F.replace(date, F.lit("-"), F.lit("")) >= limit))


def single_item(items: DataFrame, item: str, key: str = "video_id") -> DataFrame:
    """The item's row, or a new one with defaults where it is missing."""
    one = items.sparkSession.createDataFrame([(item,)], f"{key} string")
    df = one.join(items, key, "left")
    fill = {"title": "N/A", "publish_date": "N/A", **{f: False for f in ("subtitle_downloaded", "info_downloaded", "has_no_subtitle")}}
    return df.fillna({k: v for k, v in fill.items() if k in df.columns}).select(*items.columns)


def of_channel(items: DataFrame, channel: str, first: bool = False, column: str = "source_channel") -> DataFrame:
    """Items of a channel by normalised handle; the first channel also takes items without one."""
    same = T.filter_key(F.col(column)) == T.filter_key(F.lit(channel))
    return items.where(F.coalesce(same, F.lit(False)) | (F.coalesce(column, F.lit("")) == "") & F.lit(first))


def working_items(items: DataFrame, item: str | None = None, limit: str = "", channel: str | None = None, first: bool = False) -> DataFrame:
    """A single item, else those since a date, else a channel's, else all."""
    if item:
        return single_item(items, item)
    if limit:
        return since(items, limit)
    return of_channel(items, channel, first) if channel else items


def without_ghosts(items: DataFrame, folder: str, key: str = "video_id") -> DataFrame:
    """Without rows whose id is a file name of the folder."""
    return items.where(~F.coalesce(F.col(key).startswith(f"{folder}-"), F.lit(False)))


def mark_without_subtitle(items: DataFrame, now: Column, days: int = 7, date: str = "publish_date") -> DataFrame:
    """With mark_none: published more than `days` ago. An unknown date is never marked, so the item is tried again."""
    return items.withColumn("mark_none", F.coalesce(T.age_days(F.col(date), now) > days, F.lit(False)))


def subtitle_choice(formats: DataFrame, pattern: str, key: str = "video_id", order: str = "pos") -> DataFrame:
    """(key, lang, kind, ext, url): the first language that matches, manual before automatic, in vtt if there is one.

    formats: (key, kind manual|auto, lang, ext, url, pos); pos is the order of the listing.
    """
    fit = formats.where(T.language_matches(F.col("lang"), F.lit(pattern)))
    rank = F.struct(F.when(F.col("kind") == "manual", 0).otherwise(1), F.min(order).over(_by(key, "kind", "lang")), F.when(F.col("ext") == "vtt", 0).otherwise(1), F.col(order))
    return fit.withColumn("_r", rank).groupBy(key).agg(*(F.min_by(c, "_r").alias(c) for c in ("lang", "kind", "ext", "url")))


def _by(*keys: str):
    from pyspark.sql import Window

    return Window.partitionBy(*keys)


def language_mode(samples: DataFrame, group: str | None = None, lang: str = "lang", order: str = "pos") -> DataFrame:
    """(group, lang): the most frequent code, ties to the one seen first; case-folded, NA and none don't count, the region is cut afterwards."""
    keys = [group] if group else []
    code = F.lower(F.col(lang))
    counts = samples.where(~code.isin("na", "none", "")).groupBy(*keys, code.alias("_c")).agg(F.count("*").alias("n"), F.min(order).alias("p"))
    best = F.min_by("_c", F.struct(-F.col("n"), F.col("p")))
    return counts.groupBy(*keys).agg(F.regexp_extract(best, "^[^-_]*", 0).alias("lang"))


def shortest_name(files: DataFrame, key: str = "video_id", path: str = "path") -> DataFrame:
    """The file with the shortest name for each item."""
    return files.groupBy(key).agg(F.min_by(path, F.struct(F.length(path), F.col(path))).alias(path))
