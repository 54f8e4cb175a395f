"""Status reports and counters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def channel_status(items: DataFrame, channel: str = "channel") -> DataFrame:
    """(channel, total, downloaded, without_subtitle, pending); pending is what is neither, and negative where flags overlap."""
    done, none = F.count_if(F.coalesce("subtitle_downloaded", F.lit(False))), F.count_if(F.coalesce("has_no_subtitle", F.lit(False)))
    return items.groupBy(channel).agg(F.count("*").alias("total"), done.alias("downloaded"), none.alias("without_subtitle"), (F.count("*") - done - none).alias("pending"))


def status_json(items: DataFrame, channel: str = "channel") -> DataFrame:
    """(channel, report): the status as one JSON document for each channel."""
    s = channel_status(items, channel)
    return s.select(channel, F.to_json(F.struct(*s.columns)).alias("report"))


def partition_summary(items: DataFrame) -> DataFrame:
    """One row: total, to_download, skipped, without_subtitle of items with to_download."""
    return items.agg(F.count("*").alias("total"), F.count_if("to_download").alias("to_download"), F.count_if(~F.col("to_download")).alias("skipped"), F.count_if(F.coalesce("has_no_subtitle", F.lit(False))).alias("without_subtitle"))


def sync_counts(state: DataFrame, listing: DataFrame, history: DataFrame, folder: str, key: str = "video_id") -> DataFrame:
    """One row: ghosts (state rows named like files of the folder), new (listed ids that the state lacks), imported (history ids that both lack)."""
    ids = lambda df, n: df.where(F.coalesce(F.col(key), F.lit("")) != "").select(F.col(key).alias("id"), *(F.lit(i == n).alias(c) for i, c in enumerate("slh")))
    seen = ids(state, 0).union(ids(listing, 1)).union(ids(history, 2)).groupBy("id").agg(*(F.bool_or(c).alias(c) for c in "slh"))
    ghost = F.col("s") & F.col("id").startswith(f"{folder}-")
    return seen.agg(F.count_if(ghost).alias("ghosts"), F.count_if(F.col("l") & ~F.col("s")).alias("new"), F.count_if(F.col("h") & ~F.col("s") & ~F.col("l")).alias("imported"))


def session_totals(channels: DataFrame, *counters: str) -> DataFrame:
    """One row: the sums of counters over all channels, a null as 0."""
    return channels.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in counters))


def counts_by(rows: DataFrame, column: str = "status") -> DataFrame:
    """How many rows have each value."""
    return rows.groupBy(column).agg(F.count("*").alias("n"))
