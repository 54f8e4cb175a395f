"""Packing items' blocks into volumes of bounded size, with headers, indexes and resumable state."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cueforge.functions import markdown as M
from cueforge.operators.fold import ordered_fold

MAX_CHARS = 2_516_582
#: File endings by preference.
PRIORITY = {"md": 0, "txt": 1, "srt": 2}


def pack(blocks: DataFrame, channel: str = "channel", order: list[str] | None = None, size: str = "n_chars", max_chars: int = MAX_CHARS, header: int = 0, state: DataFrame | None = None) -> DataFrame:
    """blocks with volume_no and offset: each channel's blocks in order, a new volume where the next block doesn't fit.

    header characters open each volume and count. A block above the limit has a volume of its own. state (channel, last_volume, last_volume_size): the volume to go
    on with; one that is full already opens the next. Only (channel, order, size) pass the fold; contents stay in Spark and are joined to
    its rows, so order must be unique in a channel there. Blocks without contents need no join and may repeat.
    """
    order = order or ["path"]
    if state is None:
        df = blocks.withColumns({"_v": F.lit(0), "_s": F.lit(0).cast("long")})
    else:
        s = state.select(F.col(channel).alias("_c"), F.col("last_volume").cast("int").alias("_v"), F.col("last_volume_size").cast("long").alias("_s"))
        df = blocks.join(s, F.col(channel).eqNullSafe(F.col("_c")), "left").drop("_c").fillna(0, ["_v", "_s"])
    names = [f"_k{i}" for i in range(len(order))]
    df = df.withColumns({n: F.col(o) for n, o in zip(names, order, strict=True)})

    def begin() -> Callable[..., list[tuple]]:
        volume, used = -1, 0

        def step(*row: object) -> list[tuple]:
            nonlocal volume, used
            if not row:
                return []
            *place, n, last, filled = row
            if volume < 0:
                volume, used = max(last, 1), filled if last else 0
            if used and used + n > max_chars:
                volume, used = volume + 1, 0
            used = used or header
            at, used = used, used + n
            return [(*place, n, volume, at)]

        return step

    kinds = ", ".join(f"{n} {df.schema[c].dataType.simpleString()}" for n, c in zip([*names, "_n"], [*names, size], strict=True))
    placed = ordered_fold(df, [channel], [*order, size], [*names, size, "_v", "_s"], begin, f"{kinds}, volume_no int, offset long")
    passed = {channel: channel, size: "_n"} | dict(zip(order, names, strict=True))
    if passed.keys() >= set(blocks.columns):
        return placed.select(*(F.col(passed[c]).alias(c) for c in blocks.columns), "volume_no", "offset")
    keys = [F.col(f"p.{channel}").eqNullSafe(F.col(f"b.{channel}"))] + [F.col(f"p.{n}").eqNullSafe(F.col(f"b.{o}")) for n, o in zip(names, order, strict=True)]
    cond = keys[0]
    for k in keys[1:]:
        cond = cond & k
    return blocks.alias("b").join(placed.alias("p"), cond).select("b.*", "p.volume_no", "p.offset")


def volumes(placed: DataFrame, created_at: Column, channel: str = "channel", order: str = "path") -> DataFrame:
    """(channel, volume_no, file_name, content, n_chars, video_ids): header, blocks in order, index of distinct ids. A volume's size is bounded by pack()."""
    w = Window.partitionBy(channel, "volume_no", "video_id").orderBy(order)
    df = placed.withColumn("_first", F.row_number().over(w) == 1)
    item = F.struct(F.col(order).alias("o"), F.col("block").alias("b"), F.when(F.col("_first") & (F.coalesce("video_id", F.lit("")) != ""), F.struct("video_id", M.index_line(F.col("title"), F.col("video_id"), F.col("date")).alias("line"))).alias("x"))
    out = df.groupBy(channel, "volume_no").agg(F.array_sort(F.collect_list(item)).alias("items"))
    body = F.array_join(F.transform("items", lambda i: i["b"]), "")
    seen = F.filter(F.transform("items", lambda i: i["x"]), lambda x: x.isNotNull())
    content = F.concat(M.volume_header(F.col(channel), created_at), body, M.volume_index(F.transform(seen, lambda x: x["line"])))
    name = F.format_string("%s-v%03d.txt", F.col(channel), F.col("volume_no"))
    return out.select(channel, "volume_no", name.alias("file_name"), content.alias("content"), F.length(content).alias("n_chars"), F.transform(seen, lambda x: x["video_id"]).alias("video_ids"))


def next_state(placed: DataFrame, state: DataFrame | None = None, channel: str = "channel", path: str = "path", size: str = "n_chars") -> DataFrame:
    """(channel, processed_files, processed_ids, last_volume, last_volume_size) after packing, sets sorted. Sizes are characters."""
    end = F.col("offset") + F.col(size)
    own = placed.groupBy(channel).agg(
        F.array_sort(F.collect_set(path)).alias("processed_files"), F.array_sort(F.collect_set("video_id")).alias("processed_ids"),
        F.max(F.struct("volume_no", end.alias("e"))).alias("last"),
    )
    own = own.select(channel, "processed_files", "processed_ids", F.col("last.volume_no").alias("last_volume"), F.col("last.e").alias("last_volume_size"))
    if state is None:
        return own
    both = own.alias("n").join(state.alias("s"), F.col(f"n.{channel}") == F.col(f"s.{channel}"), "full_outer")
    none = F.array().cast("array<string>")
    union = lambda c: F.array_sort(F.array_union(F.coalesce(f"s.{c}", none), F.coalesce(f"n.{c}", none))).alias(c)
    return both.select(F.coalesce(f"n.{channel}", f"s.{channel}").alias(channel), union("processed_files"), union("processed_ids"), F.coalesce("n.last_volume", "s.last_volume").alias("last_volume"), F.coalesce("n.last_volume_size", "s.last_volume_size").alias("last_volume_size"))


def last_volumes(placed: DataFrame, state: DataFrame | None = None, channel: str = "channel", size: str = "n_chars") -> DataFrame:
    """(channel, last_volume, last_volume_size) after packing: what the next packing needs. A partial aggregate without lists, whatever a channel's history."""
    end = F.struct(F.col("volume_no").cast("int").alias("v"), (F.col("offset") + F.col(size)).cast("long").alias("e"))
    ends = placed.groupBy(channel).agg(F.max(end).alias("last")).select(channel, F.col("last.v").alias("last_volume"), F.col("last.e").alias("last_volume_size"))
    if state is None:
        return ends
    old = state.select(channel, F.col("last_volume").cast("int").alias("last_volume"), F.col("last_volume_size").cast("long").alias("last_volume_size"))
    best = F.max(F.struct("last_volume", "last_volume_size"))  # volumes only grow
    return ends.union(old).groupBy(channel).agg(best.alias("last")).select(channel, "last.*")


def reconciled(state: DataFrame, scanned: DataFrame, channel: str = "channel") -> DataFrame:
    """State against the volumes that are there (channel, last_volume, last_volume_size): the higher number is the last volume,
    and its size is that of the file, if it is there. Channels of either side are kept."""
    s, v = state.alias("s"), scanned.alias("v")
    both = s.join(v, F.col(f"s.{channel}") == F.col(f"v.{channel}"), "full_outer")
    there = F.col("v.last_volume") >= F.coalesce("s.last_volume", F.lit(0))
    last = F.greatest(F.coalesce("s.last_volume", F.lit(0)), F.coalesce("v.last_volume", F.lit(0)))
    size = F.when(F.coalesce(there, F.lit(False)), F.col("v.last_volume_size")).otherwise(F.coalesce("s.last_volume_size", F.lit(0)))
    return both.select(F.coalesce(f"s.{channel}", f"v.{channel}").alias(channel), last.cast("int").alias("last_volume"), size.cast("long").alias("last_volume_size"))


def extension_priority(name: Column) -> Column:
    """md before txt before srt before others."""
    e = F.lower(F.regexp_extract(name, r"\.([^.]+)$", 1))
    out = F.lit(len(PRIORITY))
    for ending, rank in PRIORITY.items():
        out = F.when(e == ending, rank).otherwise(out)
    return out


def best_files(files: DataFrame, key: str = "video_id", path: str = "path") -> DataFrame:
    """One file for each item: the preferred ending, then the first path. Files without an id are items of their own (FILE_<name>)."""
    own = F.when(F.col(key).isNull() | F.col(key).isin("", "Sem ID"), F.concat(F.lit("FILE_"), F.substring_index(path, "/", -1))).otherwise(F.col(key))
    return files.withColumn(key, own).groupBy(key).agg(F.min_by(path, F.struct(extension_priority(F.col(path)), F.col(path))).alias(path), F.count("*").alias("n_files"))
