"""Structured Streaming: incremental consolidation and early stop over landed listings."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from cueforge.functions import text as T
from cueforge.operators import consolidate
from cueforge.sources.sinks import Snapshots


class Consolidation:
    """Packs new blocks into volumes micro-batch by micro-batch, going on with each channel's last volume.

    The state holds each channel's last volume and its size, as snapshots; placed blocks are a table with a folder for each batch,
    and the ids in it are the processed ones. The state remembers the last batch, so a batch that is run again after a failure changes nothing.
    """

    def __init__(self, spark: SparkSession, path: str, max_chars: int = consolidate.MAX_CHARS, header: int = 0):
        self.spark, self.path, self.max_chars, self.header = spark, path.rstrip("/"), max_chars, header
        self.state = Snapshots(spark, f"{self.path}/state")

    def next_batch(self) -> int:
        """The number of the batch that comes next, where no stream counts them."""
        old = self.state.read()
        return 0 if old is None else (old.agg(F.max("batch")).first()[0] or 0) + 1

    def batch(self, blocks: DataFrame, number: int, scanned: DataFrame | None = None) -> None:
        """Place a batch of blocks (channel, path, video_id, n_chars and others). Blocks without an id are known by their path.

        scanned (channel, last_volume, last_volume_size): the volumes that are there, which correct the state.
        """
        spark = blocks.sparkSession
        state = Snapshots(spark, f"{self.path}/state")
        old = state.read()
        if old is not None:
            if not old.where(F.col("batch") >= number).isEmpty():
                return
            key = F.when(F.coalesce("video_id", F.lit("")).isin("", T.NO_ID), F.concat(F.lit("/"), "path")).otherwise(F.col("video_id"))
            done = spark.read.parquet(f"{self.path}/placed").where(F.col("batch") < number).select("channel", key.alias("_key"))
            blocks = blocks.withColumn("_key", key).join(done, ["channel", "_key"], "left_anti").drop("_key")
            old = old.drop("batch")
            if scanned is not None:
                old = consolidate.reconciled(old, scanned)
        placed = consolidate.pack(blocks, max_chars=self.max_chars, header=self.header, state=old)
        target = f"{self.path}/placed/batch={number}"
        placed.write.mode("overwrite").parquet(target)
        placed = spark.read.parquet(target)
        new = consolidate.last_volumes(placed, old)
        state.write(new.withColumn("batch", F.lit(number)))

    def start(self, stream: DataFrame, checkpoint: str):
        """Run over a stream of blocks until what is there is placed."""
        return stream.writeStream.foreachBatch(self.batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

    def placed(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/placed")

    def reset(self) -> None:
        """Forget the state and what was placed, and so which files are archived; all blocks are placed anew from the next full run."""
        self.state.reset()
        Snapshots(self.spark, f"{self.path}/placed").reset()


def rebuilt_state(placed: DataFrame) -> DataFrame:
    """The state that placed blocks imply: what is physically there decides."""
    return consolidate.last_volumes(placed)


def early_stop(listing: DataFrame, run: int = 10, channel: str = "channel") -> DataFrame:
    """(channel, video_id) of a listing stream (channel, pos, video_id, known): rows until the one that completes a run of known ones.

    Keyed state holds the run's length and whether the channel has stopped; batches arrive in listing order, and rows of a batch are put in it.
    A channel's rows of one batch are held at once, so batches bound the memory.
    """

    def step(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        length, stopped = state.get if state.exists else (0, False)
        if stopped:
            return
        rows = pd.concat([f[["pos", "video_id", "known"]] for f in frames]).sort_values("pos", kind="stable")
        known = rows["known"].fillna(False).to_numpy(bool)
        place = np.arange(len(known))
        # how many known ones end at each row: its distance from the last unknown one, which may lie in an earlier batch
        runs = place - np.maximum.accumulate(np.where(known, -1 - length, place)) if len(known) else place
        full = np.flatnonzero(runs >= run)
        kept = rows["video_id"].iloc[: full[0] if len(full) else len(rows)]
        state.update((int(runs[-1]) if len(runs) else length, bool(len(full))))
        yield pd.DataFrame({channel: key[0], "video_id": kept})

    return listing.groupBy(channel).applyInPandasWithState(step, f"{channel} string, video_id string", "length int, stopped boolean", "append", GroupStateTimeout.NoTimeout)


def retry_pending(items: DataFrame, now, days: int = 7, retry_all: bool = False) -> DataFrame:
    """Items without a subtitle that are tried again: recent or undated ones, or all."""
    from cueforge.operators.select import mark_without_subtitle

    marked = mark_without_subtitle(items, now, days)
    return marked.where(F.lit(retry_all) | ~F.col("mark_none")).drop("mark_none")


