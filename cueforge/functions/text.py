"""Text scalars as Column expressions; all run inside the JVM.

White space and letters are Unicode's, as `(?U)` patterns. Null stays null and empty stays empty unless said otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

#: Sound marks, bracketed sound labels, gap labels and question openings of automatic transcripts.
SOUND_MARKS = "♪♫#"
SOUND_LABELS = ["Música", "Aplausos", "Risos", "Música ao fundo", "Vinheta", "Vinheta de abertura", "Legendas pela comunidade"]
GAP_LABELS = ["Pulo de tempo", "Intervalo", "Gap", "Pulo"]
QUESTION_OPENINGS = ["por que", "porque", "como", "onde", "qual", "quais", "quem", "quando", "quanto", "quantos", "quantas", "será que", "será"]
UNKNOWN_DATE, NO_TITLE, NO_ID = "Desconhecida", "Sem Título", "Sem ID"
_OPEN, _CLOSE = "\ufdd0", "\ufdd1"  # marks around a match, between two replacements: noncharacters, which texts never hold


def strip(c: Column) -> Column:
    """Without white space at both ends."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def squeeze(c: Column) -> Column:
    """Runs of white space as one space, none at the ends."""
    return strip(F.regexp_replace(c, r"(?U)\s+", " "))


def strip_tags(c: Column, empty_tags: bool = False) -> Column:
    """Without `<...>`, line ends as spaces, trimmed. empty_tags: `<>` goes as well."""
    return strip(F.regexp_replace(F.replace(c, F.lit("\n"), F.lit(" ")), "<[^>]*>" if empty_tags else "<[^>]+>", ""))


def clean_sounds(c: Column) -> Column:
    """Without sound marks and bracketed sound labels, white space squeezed."""
    labels = "|".join(SOUND_LABELS)
    return squeeze(F.regexp_replace(F.translate(c, SOUND_MARKS, ""), rf"(?iu)\[(?:{labels})\]", ""))


def clean_gaps(c: Column) -> Column:
    """Without bracketed gap labels; three or more line ends become two; trimmed."""
    labels = "|".join(GAP_LABELS)
    return strip(F.regexp_replace(F.regexp_replace(c, rf"(?iu)\[(?:{labels}):?.*?\]", ""), r"\n{3,}", "\n\n"))


def replace_terms(c: Column, rules: dict[str, str]) -> Column:
    """All rules in one pass: at each place the longest source that matches, case-sensitive; results aren't read again.

    A first replacement marks the matches; then each marked source is exchanged, so rules that overlap don't meet.
    """
    ordered = sorted((s for s in rules if s), key=lambda s: (-len(s), list(rules).index(s)))
    if not ordered:
        return c
    quoted = "|".join("\\Q" + s.replace("\\E", "\\E\\\\E\\Q") + "\\E" for s in ordered)
    out = F.regexp_replace(c, f"({quoted})", f"{_OPEN}$1{_CLOSE}")
    for s in ordered:
        out = F.replace(out, F.lit(f"{_OPEN}{s}{_CLOSE}"), F.lit(rules[s]))
    return out


def clean_terms(c: Column, rules: dict[str, str]) -> Column:
    """clean_sounds, then replace_terms."""
    return replace_terms(clean_sounds(c), rules)


def sentence_case(c: Column) -> Column:
    """Capitals at the start and after `.`, `!`, `?`; sentences that open like a question end with `?` instead of `.`.

    Sentences are read from the left and each takes its own final stop, so a sentence right after one that was read
    is passed over. An opening counts by its letters only, also inside a longer word.
    """
    text = strip(c)
    pieces = F.split(text, r"(?U)(?<=[.!?]\s{1,99})(?=\w)")
    capital = F.array_join(F.transform(pieces, lambda p: F.concat(F.upper(F.substring(p, 1, 1)), F.substr(p, F.lit(2)))), "")
    read = F.regexp_replace(capital, r"(?U)(^|[.!?]\s+)([^.!?]+)\.", f"$1{_OPEN}$2{_CLOSE}")
    asked = F.regexp_replace(read, rf"(?iu){_OPEN}((?:{'|'.join(QUESTION_OPENINGS)})[^{_CLOSE}]*){_CLOSE}", "$1?")
    done = F.replace(F.replace(asked, F.lit(_OPEN), F.lit("")), F.lit(_CLOSE), F.lit("."))
    return F.when(text == "", c).otherwise(done)


def end_mark(c: Column, pause_s: Column, is_last: Column) -> Column:
    """A stop after the last piece or a pause of 0.4 s, a comma after 0.15 s, unless there is a mark; trimmed."""
    text = strip(c)
    open_end = ~text.rlike(r"[.!?:;,]$")
    mark = F.when(open_end & (is_last | (pause_s >= 0.4)), ".").when(open_end & (pause_s >= 0.15), ",").otherwise("")
    return F.when(text == "", c).otherwise(F.concat(text, mark))


def restore_punctuation(c: Column, pause_s: Column, is_last: Column) -> Column:
    """end_mark, then sentence_case."""
    return sentence_case(end_mark(c, pause_s, is_last))


def format_date(c: Column) -> Column:
    """`YYYYMMDD` as `YYYY-MM-DD`; nothing, `N/A` and `None` as unknown; anything else trimmed."""
    text = strip(c.cast("string"))
    dashed = F.concat_ws("-", F.substring(text, 1, 4), F.substring(text, 5, 2), F.substring(text, 7, 2))
    known = F.when(text.rlike(r"^\d{8}$"), dashed).otherwise(text)
    return F.when(c.isNull() | text.isin("", "N/A", "None"), UNKNOWN_DATE).otherwise(known)


def video_id(path: Column, strict: bool = False) -> Column:
    """The item id in a file's name, or NO_ID.

    The last 11 characters if they are id characters; else of all runs of 11, found from the left, the last one that
    no id character follows; else the last run. strict: a numeric id of 7 to 12 digits after `-` goes first.
    """
    name = F.substring_index(path, "/", -1)
    name = F.when(F.lower(name).endswith(".info.json"), F.substr(name, F.lit(1), F.length(name) - 10)).otherwise(F.regexp_replace(name, r"(?i)\.(srt|md|txt|json|vtt)$", ""))
    name = F.regexp_replace(F.regexp_replace(name, r"(?i)-orig$", ""), r"(?i)[.\-][a-z]{2}(?:-[a-z]{2,3})?$", "")
    run = "[A-Za-z0-9_-]{11}"
    runs = F.regexp_extract_all(name, F.lit(f"({run})"), F.lit(1))
    free = F.filter(runs, lambda r: ~F.coalesce(F.substring(F.call_function("substring_index", name, r, F.lit(-1)), 1, 1).rlike("^[A-Za-z0-9_-]"), F.lit(False)))
    found = F.when(name.rlike(f"{run}$"), F.regexp_extract(name, f"({run})$", 1)).when(F.size(free) > 0, F.element_at(free, -1)).when(F.size(runs) > 0, F.element_at(runs, -1)).otherwise(NO_ID)
    if strict:
        digits = F.regexp_extract(name, r"-(\d{7,12})$", 1)
        found = F.when(digits != "", digits).otherwise(found)
    return F.when(path.isNull(), None).otherwise(found)


def valid_id(c: Column) -> Column:
    """Whether it is an 11-character or a 7 to 12 digit id."""
    return F.coalesce(c.rlike(r"^[A-Za-z0-9_-]{11}$") | c.rlike(r"^\d{7,12}$"), F.lit(False))


def total_seconds(ms: Column) -> Column:
    return F.floor(ms / 1000)


def clock(ms: Column, long: bool = False) -> Column:
    """`MM:SS`, or `HH:MM:SS` from an hour on; long: always with hours."""
    s = total_seconds(ms)
    h, m, r = F.floor(s / 3600), F.floor(s / 60) % 60, s % 60
    full = F.format_string("%02d:%02d:%02d", h, m, r)
    return full if long else F.when(h > 0, full).otherwise(F.format_string("%02d:%02d", m, r))


def provider(url: Column) -> Column:
    """`vimeo` for its host or digits only, else `youtube`."""
    return F.when(F.coalesce(url, F.lit("")) == "", "youtube").when(url.contains("vimeo.com") | url.rlike(r"^\d+$"), "vimeo").otherwise("youtube")


def item_url(item: Column) -> Column:
    return F.when(provider(item) == "vimeo", F.concat(F.lit("https://vimeo.com/"), item)).otherwise(F.concat(F.lit("https://youtube.com/watch?v="), item))


def yaml_safe(c: Column) -> Column:
    """Escaped for a place between double quotes: backslash, line feed, carriage return, quote."""
    for plain, escaped in (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r"), ('"', '\\"')):
        c = F.replace(c, F.lit(plain), F.lit(escaped))
    return c


def language_pattern(c: Column) -> Column:
    """A language code as the pattern `^code.*`; patterns, empty and `N/A` stay."""
    return F.when((c == "") | (c == "N/A") | c.startswith("^") | c.contains("*"), c).otherwise(F.concat(F.lit("^"), c, F.lit(".*")))


def language_matches(code: Column, pattern: Column) -> Column:
    return F.call_function("rlike", code, F.concat(F.lit("(?i)"), pattern))


def language_of_file(name: Column, default: str = "pt") -> Column:
    """The code before `.srt`, after `.` or `-`."""
    code = F.regexp_extract(name, r"(?i)[.\-]([a-z]{2}(?:-[a-z]{2,3})?)\.srt$", 1)
    return F.when(code == "", default).otherwise(code)


def language_base(c: Column) -> Column:
    """The two-letter code among those with resources, else pt."""
    code = F.lower(F.substring(c, 1, 2))
    return F.when(code.isin("pt", "en", "es"), code).otherwise("pt")


def handle(c: Column) -> Column:
    """With `@` in front, unless it is a url or has it."""
    return F.when(c.startswith("http") | c.startswith("@"), c).otherwise(F.concat(F.lit("@"), c))


def handle_key(c: Column) -> Column:
    """What two spellings of a channel share: the handle of a url, or the text, in lower case without `@`."""
    inside = F.regexp_extract(c, r"/@([^/?#]+)", 1)
    return F.lower(F.when(inside != "", inside).otherwise(F.regexp_replace(strip(c), "^@+", "")))


def filter_key(c: Column) -> Column:
    """A handle for comparison with a channel filter: without `@` and official endings."""
    return F.replace(F.replace(F.regexp_replace(F.lower(c), "^@+", ""), F.lit(".official"), F.lit("")), F.lit("-official"), F.lit(""))


def channel_url(name: Column) -> Column:
    return F.concat(F.lit("https://youtube.com/"), F.when(name.startswith("@"), name).otherwise(F.concat(F.lit("@"), name)))


def classify_input(c: Column) -> Column:
    """struct(kind, url): video, playlist or channel, with the full url. The first rule that fits decides."""
    text = strip(c)
    of_watch = F.regexp_extract(text, r"[?&]v=([A-Za-z0-9_-]{11})", 1)
    short = F.regexp_extract(text, r"youtu\.be/([A-Za-z0-9_-]{11})", 1)
    vimeo = F.regexp_extract(text, r"vimeo\.com/(?:video/)?(\d{7,12})", 1)
    watch = lambda i: F.concat(F.lit("https://www.youtube.com/watch?v="), i)
    kind = F.when((of_watch != "") | (short != "") | (vimeo != "") | text.rlike(r"^(?:[A-Za-z0-9_-]{11}|\d{7,12})$") & ~text.startswith("@"), "video").when(text.contains("list="), "playlist").otherwise("channel")
    url = (
        F.when(of_watch != "", watch(of_watch)).when(short != "", watch(short)).when(vimeo != "", F.concat(F.lit("https://vimeo.com/"), vimeo))
        .when(text.rlike(r"^\d{7,12}$"), F.concat(F.lit("https://vimeo.com/"), text)).when(kind == "video", watch(text))
        .when(text.startswith("http"), text).when(kind == "playlist", text).otherwise(channel_url(text))
    )
    return F.struct(kind.alias("kind"), url.alias("url"))


def url_host(c: Column) -> Column:
    return F.lower(F.regexp_extract(c, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]*)", 1))


def host_within(host: Column, domains: list[str]) -> Column:
    """Whether a host is one of the domains or below one; a host that only ends alike isn't."""
    out = F.lit(False)
    for d in domains:
        out = out | (host == d) | host.endswith("." + d)
    return F.coalesce(out, F.lit(False))


def age_days(day: Column, now: Column) -> Column:
    """Days from a `YYYY-MM-DD` string to now; null where it is no date."""
    return F.datediff(now, F.try_to_date(day, "yyyy-MM-dd"))


def title_of_stem(stem: Column, item: Column) -> Column:
    """A title from a file's stem: without its id and language endings, words apart, each with a capital."""
    plain = F.replace(stem, F.concat(F.lit("-"), item), F.lit(""))
    for tail in ("-pt", "-en"):
        plain = F.replace(plain, F.lit(tail), F.lit(""))
    parts = F.split(F.lower(F.replace(plain, F.lit("_"), F.lit(" "))), r"(?U)(?<=[^\p{L}])(?=\p{L})")
    return F.array_join(F.transform(parts, lambda p: F.concat(F.upper(F.substring(p, 1, 1)), F.substr(p, F.lit(2)))), "")


def register_sql_functions(spark: SparkSession) -> None:
    """Temporary SQL functions of some of these scalars."""
    spark.sql(r"""create or replace temporary function cue_format_date(d string) returns string return
        case when d is null or trim(d) in ('', 'N/A', 'None') then 'Desconhecida'
             when trim(d) rlike '^\\d{8}$' then concat_ws('-', substr(trim(d), 1, 4), substr(trim(d), 5, 2), substr(trim(d), 7, 2)) else trim(d) end""")
    spark.sql("""create or replace temporary function cue_clock(ms bigint) returns string return
        case when ms >= 3600000 then format_string('%02d:%02d:%02d', ms div 3600000, (ms div 60000) % 60, (ms div 1000) % 60)
             else format_string('%02d:%02d', ms div 60000, (ms div 1000) % 60) end""")
    spark.sql(r"""create or replace temporary function cue_provider(u string) returns string return
        case when u like '%vimeo.com%' or u rlike '^\\d+$' then 'vimeo' else 'youtube' end""")
    spark.sql("""create or replace temporary function cue_handle(h string) returns string return
        case when h like 'http%' or h like '@%' then h else '@' || h end""")
