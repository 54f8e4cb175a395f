"""Operators over ordered cues: roll-up, pauses, elapsed-time windows, paragraphs, early stop."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cueforge.functions import text as T
from cueforge.operators.fold import ordered_fold


def common_start(before: list[str], now: list[str]) -> int:
    """How many leading items two lists share."""
    n = 0
    for a, b in zip(before, now, strict=False):
        if a != b:
            break
        n += 1
    return n


def strip_rollup(cues: DataFrame, key: str, order: str, text: str = "text") -> DataFrame:
    """(key, order, kept): each text without the leading words that it shares with the last kept text.

    A text of which nothing stays is dropped, and later texts are still compared with the one before it.
    """

    def begin() -> Callable[..., list[tuple]]:
        last: list[str] = []

        def step(*row: object) -> list[tuple]:
            nonlocal last
            if not row:
                return []
            words = str(row[1] or "").split()
            n = common_start(last, words)
            kept = str(row[1] or "") if not last else " ".join(words[n:])
            if not kept:
                return []
            last = words
            return [(row[0], kept)]

        return step

    kind = cues.schema[order].dataType.simpleString()
    return ordered_fold(cues, [key], [order], [order, text], begin, f"{order} {kind}, kept string")


def rollup_by_lag(cues: DataFrame, key: str, order: str, text: str = "text") -> DataFrame:
    """The declarative form of strip_rollup, which compares with the row before it whether or not that was kept."""
    words = F.filter(F.split(text, r"(?U)\s+"), lambda w: w != "")
    w = Window.partitionBy(key).orderBy(order)
    df = cues.withColumn("_now", words).withColumn("_was", F.coalesce(F.lag("_now").over(w), F.array().cast("array<string>")))
    # the first place where the lists differ; places count from 1
    same = F.transform(F.arrays_zip("_now", "_was"), lambda x: F.coalesce(x["_now"] == x["_was"], F.lit(False)))
    shared = F.coalesce(F.nullif(F.array_position(same, False), F.lit(0)) - 1, F.size(same)).cast("int")
    kept = F.array_join(F.slice("_now", shared + 1, F.greatest(F.size("_now") - shared, F.lit(0))), " ")
    return df.withColumn("kept", kept).drop("_now", "_was")


def line_dedup(blocks: DataFrame, key: str, order: str, lines: str = "lines") -> DataFrame:
    """(key, order, start, kept): each block's lines without those that repeat the last emitted block.

    start is 1 if that block's last line is this one's first, its length if it is a proper prefix, else 0. Emptied blocks are dropped.
    """

    def begin() -> Callable[..., list[tuple]]:
        last: list[str] = []

        def step(*row: object) -> list[tuple]:
            nonlocal last
            if not row:
                return []
            now = list(row[1] or [])
            start = dedup_start(last, now)
            if not now[start:]:
                return []
            last = now[start:]
            return [(row[0], start, last)]

        return step

    kind = blocks.schema[order].dataType.simpleString()
    return ordered_fold(blocks, [key], [order], [order, lines], begin, f"{order} {kind}, start int, kept array<string>")


def dedup_start(last: list[str], now: list[str]) -> int:
    """Where the new lines of a block begin."""
    if last and now and last[-1] == now[0]:
        return 1
    return len(last) if last and len(now) > len(last) and now[: len(last)] == last else 0


def fold_lines(lines: list[str]) -> list[str]:
    """Of neighbouring lines of which one's words begin the other, only the longer; case and outer punctuation don't count."""
    kept: list[tuple[list[str], str]] = []
    for line in lines:
        words = [w.strip(".,!?:;\"'") for w in line.lower().split()]
        before = kept[-1][0] if kept else []
        if before and words and common_start(before, words) == min(len(before), len(words)):
            if len(words) > len(before):
                kept[-1] = (words, line)
        else:
            kept.append((words, line))
    return [line for _, line in kept]


def pauses(cues: DataFrame, key: str, order: str, unit: str = "second") -> DataFrame:
    """With pause_s, the time to the next cue's start, at least 0, and is_last. unit: whole seconds of both times, or `millisecond`."""
    w = Window.partitionBy(key).orderBy(order)
    following = F.lead("start_ms").over(w)
    gap = T.total_seconds(following) - T.total_seconds(F.col("end_ms")) if unit == "second" else (following - F.col("end_ms")) / 1000
    return cues.withColumns({"pause_s": F.greatest(F.lit(0.0), F.coalesce(gap, F.lit(0)).cast("double")), "is_last": F.lead(F.lit(1)).over(w).isNull()})


def window_parameters(duration_s: Column) -> Column:
    """struct(size_s, threshold, segments) for a duration. Fixed values."""
    row = lambda a, b, c: F.struct(F.lit(a).alias("size_s"), F.lit(b).alias("threshold"), F.lit(c).alias("segments"))
    return F.when(duration_s < 1800, row(30, 0.65, 3)).when(duration_s < 3600, row(60, 0.70, 5)).otherwise(row(90, 0.75, 8))


def elapsed_windows(cues: DataFrame, key: str, order: str, size_s: str, kept: str | None = None, elapsed: str = "component") -> DataFrame:
    """(key, order, window_id) of each kept cue, windows counted from 0.

    A window closes at the cue whose end is more than size_s after the window's clock; the next clock starts at that cue's start. elapsed: `component` compares
    the seconds place of the difference (0 to 59), `total` the whole of it. kept: a boolean column; other cues move the clock but are in no window.
    """

    def begin() -> Callable[..., list[tuple]]:
        clock, number, filled = None, 0, False

        def step(*row: object) -> list[tuple]:
            nonlocal clock, number, filled
            if not row:
                return []
            place, start, end, size, keep = row
            clock = start if clock is None else clock
            out = [(place, number)] if keep else []
            filled = filled or bool(keep)
            seconds = (end - clock) // 1000
            if (seconds % 60 if elapsed == "component" else seconds) > size and filled:
                clock, number, filled = start, number + 1, False
            return out

        return step

    df = cues.withColumn("_keep", F.col(kept) if kept else F.lit(True))
    kind = cues.schema[order].dataType.simpleString()
    return ordered_fold(df, [key], [order], [order, "start_ms", "end_ms", size_s, "_keep"], begin, f"{order} {kind}, window_id int")


def paragraphs(cues: DataFrame, keys: list[str], order: str, elapsed: str = "component") -> DataFrame:
    """(keys, para, start_ms, text): cues gathered until 60 s have passed and a sentence ends, or 120 s; text is folded lines."""

    def begin() -> Callable[..., list[tuple]]:
        lines: list[str] = []
        start, number = None, 0

        def flush() -> list[tuple]:
            nonlocal lines, start, number
            out = [(number, start, " ".join(" ".join(fold_lines(lines)).split()))] if lines else []
            lines, start, number = [], None, number + len(out)
            return out

        def step(*row: object) -> list[tuple]:
            nonlocal start
            if not row:
                return flush()
            begins, ends, text = row
            text = " ".join(str(text or "").split())
            if not text:
                return []
            start = begins if start is None else start
            lines.append(text)
            seconds = (ends - start) // 1000
            seconds = seconds % 60 if elapsed == "component" else seconds
            closed = text.rstrip("\"'")[-1:] in tuple(".!?")
            return flush() if seconds >= 120 or (seconds >= 60 and closed) else []

        return step

    return ordered_fold(cues, keys, [order], ["start_ms", "end_ms", "text"], begin, "para int, start_ms long, text string")


def known_run_cutoff(listing: DataFrame, key: str, order: str, known: str, run: int = 10) -> DataFrame:
    """The rows before the one that completes the first run of `run` known ones in a row (that one is not kept)."""
    w = Window.partitionBy(key).orderBy(order)
    island = F.sum(F.when(F.col(known), 0).otherwise(1)).over(w)
    df = listing.withColumn("_island", island)
    length = F.sum(F.when(F.col(known), 1).otherwise(0)).over(Window.partitionBy(key, "_island").orderBy(order))
    df = df.withColumn("_stop", F.max(F.when(F.col(known) & (length >= run), 1).otherwise(0)).over(Window.partitionBy(key, "_island").orderBy(order)))
    return df.withColumn("_over", F.max("_stop").over(w)).where("_over = 0").drop("_island", "_stop", "_over")
