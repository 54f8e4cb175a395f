import pytest
from pyspark.sql import functions as F
from pyspark.sql.functions import lit

from cueforge.functions import markdown as M
from cueforge.functions import text as T


def none():
    return lit(None).cast("string")


@pytest.mark.parametrize(("text", "expected"), [
    ("olá mundo. este é um teste. como você vai?", "Olá mundo. Este é um teste. Como você vai?"),
    ("como vai. onde está. quem é.", "Como vai? Onde está. Quem é?"),  # a sentence takes its stop, the next is passed over
    ("comodo é. fim", "Comodo é? Fim"),
    ("", ""), ("  ", "  "), (None, None),
])
def test_sentence_case(value, text, expected):
    assert value(T.sentence_case(lit(text).cast("string"))) == expected


@pytest.mark.parametrize(("text", "pause", "last", "expected"), [
    ("nós estamos aprendendo python", 1.2, False, "Nós estamos aprendendo python."),
    ("primeiro passo", 0.25, False, "Primeiro passo,"),
    ("como podemos resolver este problema", 1.5, False, "Como podemos resolver este problema?"),
    ("este texto já tem ponto final.", 2.0, False, "Este texto já tem ponto final."),
    ("sem pausa", 0.0, False, "Sem pausa"), ("fim", 0.0, True, "Fim."), ("já,", 1.0, False, "Já,"),
])
def test_restore_punctuation(value, text, pause, last, expected):
    assert value(T.restore_punctuation(lit(text), lit(pause), lit(last))) == expected


def test_terms(value):
    rules = {"Sete Montanhas": "Sete Montes", "Eclesia": "Igreja"}
    assert value(T.clean_terms(lit("Sete Montanhas e Eclesia"), rules)) == "Sete Montes e Igreja"
    assert value(T.clean_terms(lit("♪ [música]  a\nb #"), {})) == "a b"
    assert value(T.clean_terms(none(), rules)) is None
    assert value(T.clean_terms(lit("Hello World"), rules)) == "Hello World"
    # one pass: results aren't read again, the longest source wins, the leftmost match goes first
    assert value(T.replace_terms(lit("ab b abc"), {"a": "b", "ab": "a", "b": "c"})) == "a c ac"
    assert value(T.replace_terms(lit("xabcd"), {"ab": "1", "bcd": "2"})) == "x1cd"
    assert value(T.replace_terms(lit("a.b$1"), {"a.b": "$1", "$1": "z"})) == "$1z"


@pytest.mark.parametrize(("raw", "expected"), [("20240115", "2024-01-15"), ("2024-01-15", "2024-01-15"), ("N/A", "Desconhecida"), ("None", "Desconhecida"), ("", "Desconhecida"), (None, "Desconhecida"), (" x ", "x")])
def test_format_date(value, raw, expected):
    assert value(T.format_date(lit(raw).cast("string"))) == expected


@pytest.mark.parametrize(("path", "expected"), [
    ("meu_canal-ZHbX0yoC8uo.info.json", "ZHbX0yoC8uo"), ("canal-123456789.pt.srt", "l-123456789"), ("x.txt", "Sem ID"),
    ("a/canal--ABC12345678.pt-br.txt", "ABC12345678"), ("foo-ABC12345678-orig.md", "ABC12345678"), ("ABCDEFGHIJK (x).md", "ABCDEFGHIJK"),
])
def test_video_id(value, path, expected):
    assert value(T.video_id(lit(path))) == expected


def test_video_id_strict(value):
    assert value(T.video_id(lit("canal-123456789.pt.srt"), strict=True)) == "123456789"
    assert value(T.video_id(none())) is None


@pytest.mark.parametrize(("raw", "kind", "url"), [
    ("https://www.youtube.com/watch?v=dQw4w9WgXcQ&x=1", "video", "https://www.youtube.com/watch?v=dQw4w9WgXcQ"),
    ("https://youtu.be/dQw4w9WgXcQ", "video", "https://www.youtube.com/watch?v=dQw4w9WgXcQ"),
    ("dQw4w9WgXcQ", "video", "https://www.youtube.com/watch?v=dQw4w9WgXcQ"), ("123456789", "video", "https://vimeo.com/123456789"),
    ("https://www.youtube.com/playlist?list=PL1", "playlist", "https://www.youtube.com/playlist?list=PL1"), ("@MeuCanal", "channel", "https://youtube.com/@MeuCanal"),
])
def test_classify_input(value, raw, kind, url):
    assert tuple(value(T.classify_input(lit(raw)))) == (kind, url)


def test_small_scalars(value):
    assert value(T.clock(lit(3_725_999))) == "01:02:05"
    assert value(T.clock(lit(65_000))) == "01:05"
    assert value(T.provider(lit("https://vimeo.com/1"))) == "vimeo"
    assert value(T.provider(none())) == "youtube"
    assert value(T.yaml_safe(lit('O "Novo"\n\\'))) == 'O \\"Novo\\"\\n\\\\'
    assert value(T.language_pattern(lit("pt_BR"))) == "^pt_BR.*"
    assert value(T.language_of_file(lit("a-abc.PT-br.srt"))) == "PT-br"
    assert value(T.language_base(lit("fr"))) == "pt"
    assert value(T.handle_key(lit("https://www.youtube.com/@A"))) == "a"
    assert value(T.clean_gaps(lit(" a[Pulo de tempo: 3]\n\n\n\nb "))) == "a\n\nb"
    assert value(T.strip_tags(lit("<i>a</i>\nb"))) == "a b"
    assert value(T.title_of_stem(lit("meu_canal-x-pt-abc"), lit("abc"))) == "Meu Canal-X"
    assert value(T.age_days(lit("2024-01-01"), lit("2024-01-09").cast("date"))) == 8
    assert value(T.age_days(lit("N/A"), F.current_date())) is None


def test_host_within(value):
    hosts = {"google.com": True, "a.google.com": True, "evilgoogle.com": False, None: False}
    for host, expected in hosts.items():
        assert value(T.host_within(lit(host).cast("string"), ["google.com"])) is expected


def test_sql_functions(spark):
    T.register_sql_functions(spark)
    assert tuple(spark.sql("select cue_format_date('20240101'), cue_clock(3725999), cue_provider('12'), cue_handle('a')").first()) == ("2024-01-01", "01:02:05", "vimeo", "@a")


def test_article(value):
    block = value(M.article(lit("corpo"), lit("video.md"), lit("T"), lit("VID123"), lit("2024-01-01")))
    for part in ('file_source: "video.md"', 'video_id: "VID123"', 'title: "T"', 'date: "2024-01-01"', "# T\n"):
        assert part in block
    assert "# T\n" not in value(M.article(lit("# X\ncorpo"), lit("v"), lit("T"), lit("V"), lit("d")))


def test_metadata(value):
    assert tuple(value(M.metadata(lit("---\ntitle: \"A\"\ndate: 20240101\nid: x1\n---\n# H\n")))) == ("A", "2024-01-01", "x1")
    assert tuple(value(M.metadata(lit("# **Meu _t_**\n> **Data:** 20260316")))) == ("Meu t", "2026-03-16", None)


def test_volume_records_and_body(value):
    text = M.article(lit("corpo"), lit("video.md"), lit("T"), lit("VID123"), lit("2024-01-01"))
    assert [tuple(r) for r in value(M.volume_records(text))] == [("T", "VID123", "2024-01-01")]
    old = "ID: a\nDATA: b\nTITULO: c\n" + "-" * 60
    assert [tuple(r) for r in value(M.volume_records(lit(old)))] == [("c", "a", "b")]
    assert value(M.markdown_body(lit("---\na: 1\n---\n# T\n> q\n\nresumo\n### Transcrição Estruturada\ntexto"))) == "# T\n> q\n\n### Transcrição Estruturada\ntexto"
    assert value(M.transcript(lit("x TRANSCRIÇÃO INTEGRAL: y "), lit("a.txt"), lit(""))) == "y"


def test_header_upgrade(value):
    old = "## Meu título\n**URL:** https://youtube.com/watch?v=dQw4w9WgXcQ\n**Data:** 20240115\n**Duração:** 10:00\n### Segmentos\nx"
    new = value(M.upgraded(lit(old), "v1", lit("pt")))
    assert new.startswith('---\ntitle: "Meu título"\nvideo_id: "dQw4w9WgXcQ"') and 'date: "2024-01-15"' in new and new.endswith("### Segmentos\nx")
    assert value(M.upgraded(lit("---\n## x"), "v1", lit("pt"))) is None
