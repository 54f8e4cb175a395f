"""Markdown, front matter and volume texts as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cueforge.functions.text import NO_ID, NO_TITLE, UNKNOWN_DATE, channel_url, format_date, item_url, strip, yaml_safe

#: Rules, marks and labels of volumes and Markdown files that are there.
RULE, OLD_RULE = "=" * 60, "-" * 60
INTEGRAL = "TRANSCRIÇÃO INTEGRAL:"
BODY_MARKS = ["### Segmentos de Tópicos", "### Transcrição Estruturada"]
HEAD_CHARS = 2048
#: The spellings of each front matter key.
KEYS = {"title": ["title", "titulo"], "date": ["date", "data", "publish_date", "upload_date"], "id": ["video_id", "id"]}


def _entry(lines: Column, keys: list[str]) -> Column:
    """The value of the first line `key: value` with one of the keys, in any case, and a value; quotes off; null without one."""
    value = lambda x: strip(F.regexp_replace(strip(F.substr(x, F.instr(x, ":") + 1)), "^[\"']|[\"']$", ""))
    own = F.filter(lines, lambda x: x.contains(":") & F.lower(F.substring_index(x, ":", 1)).isin(*keys) & (value(x) != ""))
    return value(F.get(own, F.lit(0)))


def _day(text: Column) -> Column:
    """The first date that follows the word for one with no other digits between, or null."""
    after = F.split(text, "(?iu)dat[ae]")
    days = F.transform(F.slice(after, 2, F.size(after)), lambda x: F.regexp_extract(F.regexp_replace(x, r"^\D+", ""), r"^\d{4}-?\d{2}-?\d{2}", 0))
    return F.get(F.filter(days, lambda x: x != ""), F.lit(0))


def front_matter(text: Column) -> Column:
    """The block between a first line `---` and the next line that starts with it, or null."""
    inner = F.regexp_extract(text, r"(?s)\A---\n(.*?)\n---", 1)
    return F.when(text.rlike(r"(?s)\A---\n.*?\n---"), inner)


def front_field(block: Column, field: str) -> Column:
    """A key's value in a front matter block, quotes off; null if absent or blank."""
    return _entry(F.split(block, "\n"), KEYS[field])


def metadata(text: Column, head: int | None = HEAD_CHARS) -> Column:
    """struct(title, date, id) from the first `head` characters: front matter, then the first heading and date line."""
    text = F.substring(text, 1, head) if head else text
    block = front_matter(text)
    titles = F.transform(F.split(text, "\n"), lambda x: F.when(strip(x).rlike(r"^#\s"), strip(F.translate(F.substr(strip(x), F.lit(2)), "*_", ""))))
    heading = F.get(F.filter(titles, lambda x: x != ""), F.lit(0))
    own, day = front_field(block, "date"), _day(text)
    date = F.when(own.isNotNull(), format_date(own)).when(day.isNotNull(), format_date(day))
    return F.struct(F.coalesce(front_field(block, "title"), heading).alias("title"), date.alias("date"), front_field(block, "id").alias("id"))


def header_block(text: Column, level: int = 1) -> Column:
    """A heading that opens the text, with the quote lines after it; empty without."""
    return strip(F.regexp_extract(text, r"\A(#{" + str(level) + r"}\s+.+?\n(?:\n?>.*\n)*)", 1))


def markdown_body(text: Column) -> Column:
    """Without front matter and what stands before the first body mark; an opening heading block stays in front."""
    text = strip(text)
    rest = strip(F.when(text.rlike(r"(?s)\A---\n.*?\n---\n"), F.regexp_replace(text, r"(?s)\A---\n.*?\n---\n", "")).otherwise(F.regexp_replace(text, r"(?s)\A---\n.*?\n---", "")))
    head = F.when(header_block(rest) != "", header_block(rest)).otherwise(header_block(text, 2))
    body = rest
    for mark in reversed(BODY_MARKS):
        at = F.instr(rest, mark)
        body = F.when(at > 0, F.substr(rest, at)).otherwise(body)
    return F.when(head != "", strip(F.concat(head, F.lit("\n\n"), body))).otherwise(body)


def transcript(text: Column, name: Column, srt_text: Column) -> Column:
    """The transcript of a file by its marker, else by its ending; srt_text is its text as subtitles."""
    at = F.instr(text, INTEGRAL)
    return F.when(at > 0, strip(F.substr(text, at + len(INTEGRAL)))).when(name.endswith(".srt"), srt_text).when(name.endswith(".md"), markdown_body(text)).otherwise(strip(text))


def article(text: Column, name: Column, title: Column, item: Column, date: Column) -> Column:
    """An item's block in a volume: article tags, front matter, and a heading unless the text opens with one."""
    title, item, date = F.coalesce(title, F.lit(NO_TITLE)), F.coalesce(item, F.lit("")), F.coalesce(date, F.lit(UNKNOWN_DATE))
    url = F.when(F.length(item) == 11, F.concat(F.lit("https://youtube.com/watch?v="), item)).otherwise("")
    link = F.when(url != "", F.concat(F.lit(" | 🔗 ["), url, F.lit("]("), url, F.lit(")"))).otherwise("")
    body = strip(text)
    quoted = lambda key, v: F.concat(F.lit(f'{key}: "'), v, F.lit('"'))
    head = F.concat(F.lit("# "), title, F.lit("\n\n> **Data:** "), date, F.lit(" | **ID:** `"), item, F.lit("`"), link, F.lit("\n\n"))
    front = F.concat_ws("\n", F.lit('\n<article class="video-entry">'), F.lit("---"), quoted("title", title), quoted("video_id", item), quoted("url", url), quoted("date", date), quoted("file_source", name), F.lit("---"), F.lit(""))
    return F.concat(front, F.lit("\n"), F.when(body.startswith("# "), "").otherwise(head), body, F.lit("\n</article>\n"))


def markdown_header(title: Column, item: Column, date: Column, duration: Column, language: Column, version: str) -> Column:
    """Front matter, heading and quote lines of an item's Markdown."""
    url = item_url(item)
    quoted = lambda key, v: F.concat(F.lit(f'{key}: "'), yaml_safe(v), F.lit('"'))
    front = F.concat_ws("\n", F.lit("---"), quoted("title", title), quoted("video_id", item), quoted("url", url), quoted("date", date), quoted("duration", duration), quoted("language", language), quoted("source", F.lit(version)), F.lit("---"))
    facts = F.concat(F.lit("> **Data:** "), date, F.lit(" · **Duração:** "), duration, F.lit(" · **Idioma:** "), language, F.lit("  "))
    return F.concat(front, F.lit("\n\n# "), title, F.lit("\n\n"), facts, F.lit("\n> 🔗 ["), url, F.lit("]("), url, F.lit(")\n\n"))


def volume_header(channel: Column, created_at: Column) -> Column:
    """The first lines of a volume."""
    return F.concat_ws("\n", F.lit(RULE), F.lit("METADADOS DO VOLUME"), F.concat(F.lit("CANAL: "), channel), F.concat(F.lit("URL: "), channel_url(channel)), F.concat(F.lit("DATA DE CRIAÇÃO: "), created_at), F.lit(RULE + "\n"))


def index_line(title: Column, item: Column, date: Column) -> Column:
    """An item's line in a volume's index."""
    return F.concat(F.lit("* ["), F.coalesce(date, F.lit(UNKNOWN_DATE)), F.lit("] "), F.coalesce(title, F.lit(NO_TITLE)), F.lit(" (ID: "), F.coalesce(item, F.lit(NO_ID)), F.lit(")"))


def volume_index(lines: Column) -> Column:
    """The index after a volume's blocks, from an array of lines."""
    return F.concat(F.lit(f"\n\n{RULE}\nÍNDICE DE VÍDEOS NESTE VOLUME\n{RULE}"), F.when(F.size(lines) > 0, F.concat(F.lit("\n"), F.array_join(lines, "\n"))).otherwise(""))


def volume_records(text: Column) -> Column:
    """array of struct(title, id, date): the front matters of a volume's articles; the old form's records only where there is none.

    A front matter is what stands between two lines `---` and has nothing but `key: value` lines, the three keys among them in any order.
    In the old form the three lines before each rule of dashes hold the record.
    """
    lines = lambda block: F.filter(F.split(block, "\n"), lambda x: strip(x) != "")
    record = lambda own, title, item, date: F.struct(_entry(own, [title]).alias("title"), _entry(own, [item]).alias("id"), _entry(own, [date]).alias("date"))
    whole = lambda r: r["title"].isNotNull() & r["id"].isNotNull() & r["date"].isNotNull()
    fronts = F.filter(F.split(text, r"(?m)^---\s*$"), lambda b: F.forall(lines(b), lambda x: x.rlike(r"^\w+:")))
    new = F.filter(F.transform(fronts, lambda b: record(lines(b), "title", "video_id", "date")), whole)
    ends = F.split(text, rf"\n{OLD_RULE}")
    last = F.transform(F.slice(ends, 1, F.size(ends) - 1), lambda b: F.slice(F.reverse(F.split(b, "\n")), 1, 3))
    old = F.filter(F.transform(last, lambda own: record(own, "titulo", "id", "data")), whole)
    return F.when(F.size(new) > 0, new).otherwise(old)


def old_metadata(text: Column) -> Column:
    """struct(title, url, date, duration) of a Markdown file of the old form, or null without a `## ` title."""
    line = lambda p: F.regexp_extract(text, p, 1)
    title = line(r"(?m)^## (.+)$")
    return F.when(title != "", F.struct(title.alias("title"), line(r"(?im)^.*URL.*?(https?://[^\s)\]]+)").alias("url"), line(r"(?imu)^.*Data\W+(\d{4}-\d{2}-\d{2}|\d{8})").alias("date"), line(r"(?imu)^.*Dura[cç][aã]o\W+([0-9:]+)").alias("duration")))


def upgraded(text: Column, version: str, language: Column) -> Column:
    """A Markdown file of the old form with the present header; null where it has one already or no old title."""
    old = old_metadata(text)
    item = F.regexp_extract(old["url"], r"(?:watch\?v=|vimeo\.com/)([A-Za-z0-9_-]+)", 1)
    at = F.instr(text, "### Segmentos")
    lines = F.filter(F.split(text, "\n"), lambda x: ~x.rlike(r"^(## |\s*$|.*(URL|Data|Dura[cç][aã]o)\W)"))
    body = F.when(at > 0, F.substr(text, at)).otherwise(F.array_join(lines, "\n"))
    return F.when(~text.startswith("---") & old.isNotNull(), F.concat(markdown_header(old["title"], item, format_date(old["date"]), old["duration"], language, version), body))
