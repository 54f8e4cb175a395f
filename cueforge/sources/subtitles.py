"""SRT and WebVTT files: table functions over whole texts, and Python data sources."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from cueforge.functions import text as T

CUES = "path string, seq int, start_ms long, end_ms long, text string"
_TIME = r"(?:(\d+):)?(\d{1,2}):(\d{2})[.,](\d{1,3})"


def _ms(line: Column, which: int) -> Column:
    """A time of a time line, in milliseconds; which: 0 start, 1 end."""
    at = F.trim(F.element_at(F.split(line, "-->"), which + 1))
    part = lambda i: F.coalesce(F.nullif(F.regexp_extract(at, "^" + _TIME, i), F.lit("")), F.lit("0")).cast("long")
    return F.when(at.rlike("^" + _TIME), ((part(1) * 60 + part(2)) * 60 + part(3)) * 1000 + F.rpad(F.regexp_extract(at, "^" + _TIME, 4), 3, "0").cast("long"))


def texts(spark: SparkSession, path: str, ending: str) -> DataFrame:
    """(path, value): whole files with an ending, a leading byte order mark off; undecodable bytes are replaced."""
    files = spark.read.text(path, wholetext=True, pathGlobFilter=f"*.{ending}", recursiveFileLookup=True)
    return files.select(F.col("_metadata.file_path").alias("path"), F.regexp_replace("value", "^﻿", "").alias("value"))


def srt_cues(files: DataFrame) -> DataFrame:
    """Cues of whole SRT texts (path, value): a line of digits followed by a time line begins one, blank lines end it.

    Cues without text are left out, as are files without cues; seq counts the cues of a file from 1.
    """
    body = F.regexp_replace("value", "\r\n?", "\n")
    parts = F.split(F.concat(F.lit("\n"), body), r"\n(?=\d+[ \t]*\n[^\n]*-->)")
    cue = files.select("path", F.posexplode(parts).alias("pos", "part")).where(F.col("part").rlike(r"^\d+[ \t]*\n[^\n]*-->"))
    lines = F.split(F.regexp_replace("part", r"(?s)^\d+[ \t]*\n", ""), "\n")
    cue = cue.withColumn("lines", lines).withColumn("time", F.element_at("lines", 1))
    text = F.regexp_extract(F.array_join(F.slice("lines", 2, F.greatest(F.size("lines") - 1, F.lit(0))), "\n"), r"(?s)^(.*?)(?:\n[ \t]*(?:\n.*)?)?$", 1)
    cue = cue.select("path", F.col("pos").alias("seq"), _ms(F.col("time"), 0).alias("start_ms"), _ms(F.col("time"), 1).alias("end_ms"), text.alias("text"))
    return cue.where(F.col("start_ms").isNotNull() & (T.strip(F.col("text")) != ""))


def file_report(files: DataFrame) -> DataFrame:
    """(path, n_cues, problem) of whole SRT texts (path, value): why a file gives no document (`missing`, `empty`, `undecodable`, `no cues`), else null.

    missing: a null text. undecodable: bytes that were no UTF-8 were replaced, and nothing of a cue is left.
    """
    counts = srt_cues(files).groupBy(F.col("path").alias("_p")).agg(F.count("*").alias("n_cues"))
    df = files.join(counts, F.col("path") == F.col("_p"), "left").withColumn("n_cues", F.coalesce("n_cues", F.lit(0)))
    none = F.when(F.col("value").isNull(), "missing").when(T.strip(F.col("value")) == "", "empty").when(F.col("value").contains("\ufffd"), "undecodable").otherwise("no cues")
    return df.select("path", "n_cues", F.when(F.col("n_cues") == 0, none).alias("problem"))


def vtt_cues(files: DataFrame) -> DataFrame:
    """Cues of whole WebVTT texts (path, value): the header block goes, each block's first time line counts, ids and settings are dropped. seq counts from 1."""
    body = F.regexp_replace("value", "\r\n?", "\n")
    body = F.when(body.startswith("WEBVTT"), F.regexp_replace(body, r"(?s)^.*?(?:\n\s*\n|$)", "")).otherwise(body)
    block = files.select("path", F.posexplode(F.split(body, r"\n[ \t]*\n+")).alias("pos", "block")).where(F.col("block").contains("-->"))
    lines = F.split(T.strip(F.col("block")), "\n")
    at = F.array_position(F.transform(lines, lambda x: x.contains("-->")), True).cast("int")
    cue = block.withColumns({"lines": lines, "at": at})
    time = F.get("lines", F.col("at") - 1)
    text = F.array_join(F.slice("lines", F.col("at") + 1, F.greatest(F.size("lines") - F.col("at"), F.lit(0))), "\n")
    cue = cue.select("path", "pos", _ms(time, 0).alias("start_ms"), _ms(time, 1).alias("end_ms"), text.alias("text"))
    cue = cue.where(F.col("start_ms").isNotNull() & F.col("end_ms").isNotNull())
    from pyspark.sql import Window

    seq = F.row_number().over(Window.partitionBy("path").orderBy("pos"))
    return cue.select("path", seq.alias("seq"), "start_ms", "end_ms", "text")


def _clock(ms: Column) -> Column:
    h, m, s = F.floor(ms / 3_600_000), F.floor(ms / 60_000) % 60, F.floor(ms / 1000) % 60
    return F.format_string("%02d:%02d:%02d,%03d", h, m, s, ms % 1000)


def srt_text(cues: DataFrame, key: str = "path") -> DataFrame:
    """(key, value): cues as SRT files, blocks apart by blank lines, a line end last."""
    block = F.concat(F.col("seq").cast("string"), F.lit("\n"), _clock(F.col("start_ms")), F.lit(" --> "), _clock(F.col("end_ms")), F.lit("\n"), F.col("text"))
    listed = F.array_sort(F.collect_list(F.struct("seq", block.alias("b"))))
    return cues.groupBy(key).agg(F.concat(F.array_join(F.transform(listed, lambda x: x["b"]), "\n\n"), F.lit("\n")).alias("value"))


def fluent_text(cues: DataFrame, key: str = "path") -> DataFrame:
    """(key, value): a file's text in one line, tags off, lines that roll over from the block before left out."""
    from cueforge.operators.sequence import line_dedup

    clean = F.transform(F.split("text", "\n"), lambda x: T.strip(F.regexp_replace(x, "<[^>]*>", "")))
    lines = cues.select(key, "seq", F.filter(clean, lambda x: x != "").alias("lines"))
    kept = line_dedup(lines, key, "seq")
    listed = F.array_sort(F.collect_list(F.struct("seq", F.array_join("kept", " ").alias("t"))))
    return kept.groupBy(key).agg(F.array_join(F.transform(listed, lambda x: x["t"]), " ").alias("value"))


class _Files(DataSourceReader):
    """One partition for each file; lines are read one by one."""

    def __init__(self, options: dict, vtt: bool):
        self.path, self.vtt = options.get("path", "."), vtt

    def partitions(self) -> list[InputPartition]:
        import glob
        import os

        ending = "vtt" if self.vtt else "srt"
        names = glob.glob(os.path.join(self.path, "**", f"*.{ending}"), recursive=True) if os.path.isdir(self.path) else [self.path]
        return [InputPartition(n) for n in sorted(names)]

    def read(self, partition: InputPartition):
        import re

        time = re.compile(r"\s*" + _TIME + r"\s*-->\s*" + _TIME)
        ms = lambda g: ((int(g[0] or 0) * 60 + int(g[1])) * 60 + int(g[2])) * 1000 + int(g[3].ljust(3, "0"))
        seq, now, before = 0, None, ""
        with open(partition.value, encoding="utf-8-sig", errors="replace") as f:
            for line in chain(f, ["\n"]):
                line = line.rstrip("\r\n")
                m = time.match(line)
                if m and (self.vtt or before.strip().isdigit()):
                    now = (ms(m.groups()[:4]), ms(m.groups()[4:]), [])
                elif now and line.strip():
                    now[2].append(line)
                elif now:
                    if now[2] or self.vtt:
                        seq += 1
                        yield (partition.value, seq, now[0], now[1], "\n".join(now[2]))
                    now = None
                before = line


class SrtSource(DataSource):
    """spark.read.format("srt").load(path on a shared file system)"""

    @classmethod
    def name(cls) -> str:
        return "srt"

    def schema(self) -> str:
        return CUES

    def reader(self, schema) -> DataSourceReader:
        return _Files(self.options, vtt=False)


class VttSource(SrtSource):
    """spark.read.format("vtt").load(path on a shared file system)"""

    @classmethod
    def name(cls) -> str:
        return "vtt"

    def reader(self, schema) -> DataSourceReader:
        return _Files(self.options, vtt=True)


def register(spark: SparkSession) -> None:
    """Make the srt and vtt formats known to a session."""
    for source in (SrtSource, VttSource):
        spark.dataSource.register(source)
