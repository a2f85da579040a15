import sys
import unicodedata

import pytest
from pyspark.sql import functions as F

from savora import fixed_values as fixed
from savora.functions import text


def test_fold_equals_compatibility_decomposition_for_every_code_point(spark):
    points = [p for p in range(1, sys.maxunicode + 1) if not 0xD800 <= p <= 0xDFFF]
    rows = [("".join(map(chr, points[i:i + 512])),) for i in range(0, len(points), 512)]
    out = spark.createDataFrame(rows, "t string").select("t", text.fold_accents(F.col("t")).alias("f"))
    for row in out.collect():
        expected = "".join(c for c in unicodedata.normalize("NFKD", row.t) if not unicodedata.combining(c))
        assert row.f == expected


@pytest.mark.parametrize("left,right,same", [
    ("Café Perú", "cafe peru", True),
    ("Brisamarina Restaurant", "Brisamarina  Restaurante", True),
    ("Sugoi Obarrio", "Sugoi Costa del Este", False)])
def test_name_key(value, left, right, same):
    assert (value(text.name_key, left) == value(text.name_key, right)) is same


@pytest.mark.parametrize("name", ["", "   ", None, "Café Bar"])
def test_blank_name_key(value, name):
    assert value(text.name_key, name) == ""


def test_stable_id(value):
    got = value(text.stable_id, "brisamarina")
    assert got.startswith("r_") and len(got) == 12
    assert got == value(text.stable_id, "brisamarina")


@pytest.mark.parametrize("raw,clean", [
    ("Visita http://x.com/a?b=1 ya", "Visita ya"), ("ver www.sitio.com hoy", "ver hoy"),
    ("<b>Muy</b> rico", "Muy rico"), ("  a \t b\n", "a b"), ("café Niño Señor", "café Niño Señor"),
    ("10 € @casa #1", "10  casa 1"), ("co²mida½ ٣", "co²mida½ ٣"), (None, "")])
def test_clean_text(value, raw, clean):
    assert value(text.clean_text, raw) == clean


@pytest.mark.parametrize("raw,out", [("HELLO World", "hello world"), ("café Niño", "cafe nino"), ("a  b\x1cc", "a b c"), (None, "")])
def test_normalize_text(value, raw, out):
    assert value(text.normalize_text, raw) == out


def test_accented_stopwords_survive_folding(value):
    body = lambda c: text.remove_stopwords(text.normalize_text(c), ["más", "de"])
    assert value(body, "Más de lo bueno") == "mas lo bueno"


def test_no_stopwords_leaves_the_text_alone(value):
    assert value(lambda c: text.remove_stopwords(c, []), "a  b") == "a  b"


@pytest.mark.parametrize("raw,language", [
    (" ".join(fixed.SPANISH_INDICATORS), "spanish"), (" ".join(fixed.ENGLISH_INDICATORS), "english"), ("", "unknown"), ("xyz", "mixed")])
def test_detect_language(value, raw, language):
    assert value(text.detect_language, raw) == language


@pytest.mark.parametrize("raw,words,chars,mean", [("uno dos  tres", 3, 13, 10 / 3), ("", 0, 0, 0.0), (None, 0, 0, 0.0)])
def test_word_statistics(value, raw, words, chars, mean):
    assert value(text.word_count, raw) == words
    assert value(text.char_count, raw) == chars
    assert value(text.avg_word_length, raw) == pytest.approx(mean)


@pytest.mark.parametrize("raw,slug", [("Panameña", "panamena"), ("Latinoamericana, con café", "latinoamericana_con_cafe"), ("***", "otros"),
                                      ("a" * 23 + " bc", "a" * 23)])
def test_slug(value, raw, slug):
    assert value(text.slug, raw) == slug


def test_translate_phrases_priority(value):
    build = lambda c: text.translate_phrases(c, {"Good food": "EXACT"}, [("Good", "PREFIX")])
    assert value(build, "Good food") == "EXACT"
    assert value(build, "Good things") == "PREFIX"
    assert value(build, "All Good choice, slices") == "All buena opción, porciones"


def test_clean_display_and_preview(value):
    assert value(text.clean_display, " NaN ") is None
    assert value(text.clean_display, "x") == "x"
    assert value(lambda c: text.preview(c, 3), "abcd") == "abc..."
    assert value(lambda c: text.preview(c, 4), "abcd") == "abcd"


def test_language_binds_the_lowered_text(spark):
    """Written out for each indicator, the text would be lower-cased dozens of times."""
    assert str(text.detect_language(F.col("body"))).lower().count("lower(") == 1


@pytest.mark.parametrize("raw", ["a b\x1c c　", " ", "ab", " x​ y"])
def test_letters_are_what_is_not_space(value, raw):
    letters = sum(not c.isspace() for c in raw)
    assert value(text.avg_word_length, raw) == pytest.approx(letters / max(1, len(raw.split())))
