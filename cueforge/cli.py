"""python -m cueforge.cli status|markdown|consolidate: thin front end over landed files."""

from __future__ import annotations

import argparse

from pyspark.sql import Window
from pyspark.sql import functions as F

from cueforge.functions import markdown as M
from cueforge.functions import text as T
from cueforge.operators import consolidate, document, status
from cueforge.session import session
from cueforge.sources import records, sinks, subtitles
from cueforge.streaming.incremental import Consolidation


def channel_argument(parts: list[str]) -> str:
    """A channel given in several words: parts of a url belong together, those of a name are words."""
    return ("" if parts and "://" in parts[0] else " ").join(parts)


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="cueforge")
    sub = p.add_subparsers(dest="command", required=True)
    for name in ("status", "markdown", "consolidate"):
        s = sub.add_parser(name)
        s.add_argument("path")
        if name != "status":
            s.add_argument("out")
        if name == "markdown":
            s.add_argument("--language", default="pt")
        if name == "consolidate":
            s.add_argument("channel", nargs="+")
            s.add_argument("--created-at", default="")
            s.add_argument("--max-chars", type=int, default=consolidate.MAX_CHARS)
            s.add_argument("--reset", action="store_true", help="place all files anew, from volume 1")
    a = p.parse_args(argv)
    if a.command == "consolidate":
        a.channel = channel_argument(a.channel)
    spark = session()
    spark.sparkContext.setLogLevel("ERROR")
    if a.command == "status":
        docs = records.channel_documents(records.whole_files(spark, a.path, "*.json"))
        items = records.videos(docs).withColumn("channel", F.col("path"))
        for row in status.status_json(items).toLocalIterator():
            print(row["report"])
    elif a.command == "markdown":
        # a file is a document: files without an id, or of one item in several languages, stay apart
        cues = subtitles.srt_cues(subtitles.texts(spark, a.path, "srt")).withColumn("doc_id", F.col("path"))
        meta = cues.select("doc_id", F.lit(None).cast("string").alias("title"), F.lit(None).cast("string").alias("date"), T.video_id(F.col("path")).alias("item")).distinct()
        md = document.to_markdown(cues.drop("path"), meta, a.language)
        stem = F.regexp_replace(F.substring_index("doc_id", "/", -1), r"(?i)\.srt$", "")
        again = F.row_number().over(Window.partitionBy("stem").orderBy("doc_id"))  # the same name in another folder
        md = md.withColumn("stem", stem).withColumn("file_name", F.concat("stem", F.when(again > 1, F.concat(F.lit("-"), again.cast("string"))).otherwise(""), F.lit(".md")))
        print(sinks.write_texts(md, a.out, text="md", bom=True).count(), "files")
    else:
        files = records.whole_files(spark, a.path, f"{a.channel}-*").where(F.substring_index("path", "/", -1).rlike(r"\.(md|txt)$"))
        own = records.file_metadata(records.eligible(files, a.channel)).withColumn("channel", F.lit(a.channel))
        body = T.clean_gaps(M.transcript(F.col("value"), F.col("path"), F.lit("")))
        block = M.article(body, F.substring_index("path", "/", -1), F.col("title"), F.col("video_id"), F.col("date"))
        blocks = own.withColumn("block", block).withColumn("n_chars", F.length("block"))
        # the last volume is filled on: items that were placed before are passed by, and volumes with new ones are written
        run = Consolidation(spark, f"{a.out}/state/{a.channel}", a.max_chars)
        if a.reset:
            run.reset()
        number = run.next_batch()
        run.batch(blocks.drop("value"), number)
        placed = run.placed()
        touched = placed.where(F.col("batch") == number).select("channel", "volume_no").distinct()
        v = consolidate.volumes(placed.join(touched, ["channel", "volume_no"], "left_semi"), F.lit(a.created_at), order="offset")
        print(sinks.write_texts(v, a.out, bom=True).count(), "volumes")
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
