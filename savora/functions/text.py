"""Text expressions: folding, keys, cleaning, language, word statistics.

Everything here is a Column built from JVM functions, so it stays in the scan
stage and never leaves the executor's JVM.
"""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache
from typing import Callable, Sequence

from pyspark.sql import Column, functions as F

from savora import fixed_values as fixed

# Unicode white space plus the four separators that only Python counts as such.
SPACE = r"[\s\x1c-\x1f]"
NOT_SPACE = r"[^\s\x1c-\x1f]"
U = "(?U)"  # Java classes are ASCII-only without it


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind ``value`` once and use it many times inside ``body``.

    A column that a lambda refers to is evaluated again per element; a lambda
    variable is not.  Mapping over a one-element array gives such a variable.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def squeeze(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, U + SPACE + "+", " "))


def strip(text: Column) -> Column:
    return F.regexp_replace(text, f"{U}^{SPACE}+|{SPACE}+$", "")


def blank_to_null(text: Column) -> Column:
    """The text is bound first: written out twice, each step around another one would double the work."""
    return let(text, lambda t: F.when(t != "", t))


# --- accents -----------------------------------------------------------------

HANGUL_FIRST, HANGUL_LAST = 0xAC00, 0xD7A3


@lru_cache(maxsize=1)
def _folding_tables() -> tuple[str, str, str, str, tuple[str, ...]]:
    """Derive the compatibility decomposition without marks, per code point.

    Returns (from, to, dropped, expanding, expansions): one-to-one pairs, code
    points that vanish, and code points that grow into several letters.
    Composed Hangul follows arithmetic and is left out of the tables.
    """
    source, target, dropped, expanding, expansions = [], [], [], [], []
    for point in range(0x80, sys.maxunicode + 1):
        if HANGUL_FIRST <= point <= HANGUL_LAST or 0xD800 <= point <= 0xDFFF:
            continue
        char = chr(point)
        folded = "".join(
            c for c in unicodedata.normalize("NFKD", char) if not unicodedata.combining(c))
        if folded == char:
            continue
        if not folded:
            dropped.append(char)
        elif len(folded) == 1:
            source.append(char)
            target.append(folded)
        else:
            expanding.append(char)
            expansions.append(folded)
    return ("".join(source), "".join(target), "".join(dropped),
            "".join(expanding), tuple(expansions))


def _expand_char(char: Column) -> Column:
    """One code point that decomposes into several, else the code point itself."""
    _, _, _, expanding, expansions = _folding_tables()
    table = F.split(F.lit("\u0001".join(expansions)), "\u0001")
    place = F.instr(F.lit(expanding), char)

    syllable = F.ascii(char) - HANGUL_FIRST
    def jamo(first: int, count: int, index: Column) -> Column:
        letters = "".join(chr(first + i) for i in range(count))
        return F.substr(F.lit(letters), index.cast("int") + 1, F.lit(1))
    lead = jamo(0x1100, 19, F.floor(syllable / 588))
    vowel = jamo(0x1161, 21, F.floor((syllable % 588) / 28))
    tail = F.when(syllable % 28 != 0, jamo(0x11A8, 27, syllable % 28 - 1)).otherwise("")

    return (F.when(char.between(chr(HANGUL_FIRST), chr(HANGUL_LAST)), F.concat(lead, vowel, tail))
            .when(place > 0, F.get(table, place - 1))
            .otherwise(char))


def fold_accents(text: Column) -> Column:
    """Compatibility-decompose and drop the combining marks.

    Pure ASCII rows pass through untouched.  Other rows take one ``translate``;
    only rows that hold ligatures, fractions or Hangul are walked by character.
    """
    source, target, dropped, expanding, _ = _folding_tables()
    translated = F.translate(text, source + dropped, target)
    has_expanding = (
        (F.length(F.translate(text, expanding, "")) < F.length(text))
        | text.rlike(f"[{chr(HANGUL_FIRST)}-{chr(HANGUL_LAST)}]"))
    walked = F.array_join(F.transform(F.split(translated, ""), _expand_char), "")
    return (F.when(F.octet_length(text) == F.length(text), text)
            .when(has_expanding, walked)
            .otherwise(translated))


# --- keys --------------------------------------------------------------------

def name_key(name: Column) -> Column:
    """Comparable key of an entity name; blank or missing gives ''."""
    words = F.regexp_replace(F.lower(fold_accents(name)), U + fixed.NAME_NOISE_PATTERN, " ")
    return F.coalesce(F.trim(F.regexp_replace(words, "[^a-z0-9]+", " ")), F.lit(""))


def review_key(text: Column) -> Column:
    """Comparable key of a review text; missing gives ''."""
    plain = F.lower(fold_accents(text))
    return F.coalesce(F.trim(F.regexp_replace(plain, "[^a-z0-9]+", " ")), F.lit(""))


def stable_id(key: Column, prefix: str = "r_") -> Column:
    return F.concat(F.lit(prefix), F.substring(F.md5(key), 1, 10))


def slug(value: Column, width: int = 24) -> Column:
    plain = F.regexp_replace(F.lower(fold_accents(value)), "[^a-z0-9]+", "_")
    cut = F.substring(F.regexp_replace(plain, "^_+|_+$", ""), 1, width)
    return F.coalesce(blank_to_null(F.regexp_replace(cut, "_+$", "")), F.lit("otros"))


# --- cleaning and normalising ------------------------------------------------

def clean_text(text: Column) -> Column:
    """Drop links, tags and symbols.  White space is squeezed before symbols go,
    so a dropped symbol may leave two spaces behind."""
    out = F.regexp_replace(text, rf"{U}http{NOT_SPACE}+|www\.{NOT_SPACE}+", "")
    out = F.regexp_replace(out, "<[^>]+>", "")
    out = squeeze(out)
    out = F.regexp_replace(out, rf"{U}[^\p{{L}}\p{{N}}_\s\x1c-\x1f.,!?¡¿]", "")
    return F.coalesce(out, F.lit(""))


def normalize_text(text: Column) -> Column:
    return F.coalesce(squeeze(fold_accents(F.lower(text))), F.lit(""))


def words_of(text: Column) -> Column:
    """Words between white space."""
    return F.regexp_extract_all(text, F.lit(f"({U}{NOT_SPACE}+)"), F.lit(1))


def remove_stopwords(text: Column, stopwords: Sequence[str]) -> Column:
    """Without stop words the text is left exactly as it is."""
    if not stopwords:
        return text
    kept = F.filter(words_of(text), lambda w: ~F.lower(w).isin(list(stopwords)))
    return F.array_join(kept, " ")


def tokenize(text: Column) -> Column:
    """Words and single punctuation marks."""
    pattern = rf"([\p{{L}}\p{{N}}_]+|{U}[^\p{{L}}\p{{N}}_\s\x1c-\x1f])"
    return F.coalesce(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)),
                      F.array().cast("array<string>"))


def detect_language(text: Column,
                    spanish: Sequence[str] = tuple(fixed.SPANISH_INDICATORS),
                    english: Sequence[str] = tuple(fixed.ENGLISH_INDICATORS)) -> Column:
    """Compare how many indicator substrings of each language occur.

    The lower-cased text and the difference are bound: written out, each indicator would lower-case the text again.
    """
    def hits(lowered: Column, words: Sequence[str]) -> Column:
        total = F.lit(0)
        for word in words:
            total = total + F.contains(lowered, F.lit(word)).cast("int")
        return total

    lead = let(F.lower(text), lambda low: hits(low, spanish) - hits(low, english))
    named = let(lead, lambda n: F.when(n > 0, "spanish").when(n < 0, "english").otherwise("mixed"))
    return F.when(F.coalesce(text, F.lit("")) == "", "unknown").otherwise(named)


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(f"{U}{NOT_SPACE}+")), F.lit(0)).cast("long")


def char_count(text: Column) -> Column:
    return F.coalesce(F.length(text), F.lit(0)).cast("long")


def avg_word_length(text: Column) -> Column:
    letters = F.length(text) - F.regexp_count(text, F.lit(f"{U}{SPACE}"))
    return F.coalesce(letters / F.greatest(word_count(text), F.lit(1)), F.lit(0.0))


def preview(text: Column, width: int) -> Column:
    return (F.when(F.length(text) > width, F.concat(F.substring(text, 1, width), F.lit("...")))
            .otherwise(text))


def clean_display(value: Column) -> Column:
    """Hide blanks and the text 'nan'."""
    value = value.cast("string")
    return F.when(~F.lower(strip(value)).isin("", "nan"), value)


# --- translations ------------------------------------------------------------

def translate_value(value: Column, table: dict[str, str] = fixed.VALUE_TRANSLATIONS) -> Column:
    pairs = [item for pair in table.items() for item in map(F.lit, pair)]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), value), value)


def translate_phrases(text: Column,
                      exact: dict[str, str] | None = None,
                      prefixes: Sequence[tuple[str, str]] = (),
                      replacements: Sequence[tuple[str, str]] = fixed.PHRASE_REPLACEMENTS) -> Column:
    """An exact match wins, then the first matching prefix, then the ordered
    replacements.  The two review-specific dictionaries are parameters."""
    replaced = text
    for old, new in replacements:
        replaced = F.replace(replaced, F.lit(old), F.lit(new))
    rules = [(text == old, new) for old, new in (exact or {}).items()]
    rules += [(F.startswith(text, F.lit(old)), new) for old, new in prefixes]
    if not rules:
        return replaced
    chosen = F.when(rules[0][0], F.lit(rules[0][1]))
    for condition, new in rules[1:]:
        chosen = chosen.when(condition, F.lit(new))
    return chosen.otherwise(replaced)


# --- line breaks -------------------------------------------------------------

BREAKS = {"\\": "\\\\", "\n": "\\n", "\r": "\\r"}


def escape_breaks(c: Column) -> Column:
    """Line breaks as two visible characters, and backslashes doubled."""
    for plain, escaped in BREAKS.items():
        c = F.replace(c, F.lit(plain), F.lit(escaped))
    return c


def unescape_breaks(c: Column) -> Column:
    """What ``escape_breaks`` was given.  Doubled backslashes split the text, so that what follows one is not taken for a break."""
    def restored(part: Column) -> Column:
        return F.replace(F.replace(part, F.lit("\\n"), F.lit("\n")), F.lit("\\r"), F.lit("\r"))
    parts = F.transform(F.split(c, r"\\\\"), restored)
    return F.when(c.isNotNull(), F.array_join(parts, "\\"))
