"""Expressions that read numbers, prices, dates, zones and stored maps from text."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, functions as F

from savora import fixed_values as fixed
from savora.functions.text import SPACE, U, blank_to_null, let, strip

ABSOLUTE_FORMATS = (
    "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd", "yyyy/MM/dd",
    "MM/dd/yyyy", "d MMM yyyy", "d MMMM yyyy", "MMM d, yyyy", "MMMM d, yyyy",
)

RELATIVE_PATTERN = (
    rf"(?iU)hace{SPACE}+(un|una|unos|unas|\d+){SPACE}*"
    r"(d[ií]as?|semanas?|mes(?:es)?|a[ñn]os?|horas?|minutos?)"
)


def to_number(value: Column) -> Column:
    """Numbers only; anything else, 'nan' included, is missing."""
    number = value.try_cast("double")
    return F.when(~F.isnan(number), number)


# --- prices ------------------------------------------------------------------

def price_level(label: Column) -> Column:
    """Level 1..4 of a price label; unlisted labels count their dollar signs."""
    text = F.lower(strip(label.cast("string")))
    listed = None
    for level, labels in fixed.PRICE_LABELS_BY_LEVEL.items():
        hit = text.isin(list(labels))
        listed = F.when(hit, float(level)) if listed is None else listed.when(hit, float(level))
    dollars = F.length(text) - F.length(F.replace(text, F.lit("$"), F.lit("")))
    counted = F.when(dollars > 0, F.least(dollars, F.lit(4)).cast("double"))
    return listed.otherwise(counted)


def price_band(level: Column) -> Column:
    band = None
    for number, label in fixed.PRICE_BANDS.items():
        hit = level == number
        band = F.when(hit, label) if band is None else band.when(hit, label)
    return band


# --- categories and addresses ------------------------------------------------

def split_categories(category: Column) -> Column:
    """Write every category separator as a comma."""
    return F.regexp_replace(category, rf"{U}{SPACE}*[·/|]{SPACE}*", ", ")


def primary_category(category: Column) -> Column:
    first = strip(F.get(F.split(category, ",", -1), F.lit(0)))
    return F.when(first != "nan", blank_to_null(first))


def zone_of_address(address: Column, cities: Sequence[str] = fixed.CITY_NAMES) -> Column:
    """Last part of the address once the city names at its end are dropped."""
    def zone(parts: Column) -> Column:
        last = F.array_max(F.transform(
            parts, lambda part, i: F.when(~F.lower(part).isin(list(cities)), i)))
        return F.when(last >= 1, F.get(parts, last))
    return let(F.filter(F.transform(F.split(address, " - ", -1), strip), lambda p: p != ""), zone)


# --- numbers in running text -------------------------------------------------

NUMBER = r"(\d+(?:[.,]\d+)?)"


def number_with_suffix(value: Column) -> Column:
    """First number of the text; a comma is a decimal point and K means thousand."""
    def number(v: Column) -> Column:
        plain = F.replace(F.regexp_extract(v, NUMBER, 1), F.lit(","), F.lit(".")).try_cast("double")
        return plain * F.when(F.regexp_extract(v, rf"{NUMBER}({SPACE}*[kK])?", 2) != "", 1000).otherwise(1)
    return let(value, number)


def labelled_rating(text: Column, label: str) -> Column:
    """The rating that follows ``label``, when it lies in 0..5."""
    digits = F.regexp_extract(text, rf"{U}{label}{SPACE}*{NUMBER}", 1)
    return let(number_with_suffix(digits), lambda v: F.when(v.between(0, 5), v))


def class_token_rating(css_class: Column) -> Column:
    """'bubble_45' reads as 4.5."""
    digits = blank_to_null(F.regexp_extract(css_class, r"bubble_(\d+)", 1))
    return digits.try_cast("int") / 10


def first_decimal(text: Column) -> Column:
    """'4.5 of 5' reads as 4.5."""
    return F.regexp_extract(text, r"(\d+\.?\d*)", 1).try_cast("double")


def grouped_count(text: Column) -> Column:
    """'1,234 reviews' reads as 1234; no digits reads as 0."""
    digits = F.regexp_extract(F.replace(text, F.lit(","), F.lit("")), r"(\d+)", 1)
    return F.coalesce(digits.try_cast("long"), F.lit(0).cast("long"))


# --- dates -------------------------------------------------------------------

def relative_date(value: Column, reference: Column) -> Column:
    """'hace 3 meses' counted back from ``reference``; anything else is missing."""
    amount_text = F.lower(F.regexp_extract(value, RELATIVE_PATTERN, 1))
    unit = F.lower(F.regexp_extract(value, RELATIVE_PATTERN, 2))
    amount = F.when(F.startswith(amount_text, F.lit("un")), 1).otherwise(amount_text.try_cast("int"))
    start = reference.cast("timestamp_ntz")

    def back(years=None, months=None, days=None, hours=None, mins=None) -> Column:
        zero = F.lit(0)
        if years is not None or months is not None:
            return start - F.make_ym_interval(zero if years is None else years,
                                              zero if months is None else months)
        return start - F.make_dt_interval(zero if days is None else days,
                                          zero if hours is None else hours,
                                          zero if mins is None else mins)

    return (F.when(F.startswith(unit, F.lit("minuto")), back(mins=amount))
            .when(F.startswith(unit, F.lit("hora")), back(hours=amount))
            .when(unit.rlike("^d[ií]a"), back(days=amount))
            .when(F.startswith(unit, F.lit("semana")), back(days=amount * 7))
            .when(F.startswith(unit, F.lit("mes")), back(months=amount))
            .when(unit.rlike("^a[ñn]o"), back(years=amount)))


def mixed_date(value: Column, reference: Column,
               formats: Sequence[str] = ABSOLUTE_FORMATS) -> Column:
    """Relative dates first, then the absolute formats in order."""
    absolute = [F.try_to_timestamp(value, F.lit(f)).cast("timestamp_ntz") for f in formats]
    return F.coalesce(relative_date(value, reference), *absolute)


# --- maps stored as text -----------------------------------------------------

def _as_json(value: Column) -> Column:
    quoted = F.replace(value, F.lit("'"), F.lit('"'))
    quoted = F.regexp_replace(quoted, r"\bTrue\b", "true")
    quoted = F.regexp_replace(quoted, r"\bFalse\b", "false")
    return F.regexp_replace(quoted, r"\bNone\b", "null")


def stored_map(value: Column) -> Column:
    """Map of a stored cell; malformed or missing gives NULL."""
    return F.from_json(_as_json(value), "map<string,string>")


def stored_label(value: Column, aspect: str) -> Column:
    """Lower-case label of one aspect, 'neutral' when the cell does not say."""
    cell = stored_map(value)
    stated = F.when(F.map_contains_key(cell, aspect),
                    F.coalesce(F.try_element_at(cell, F.lit(aspect)), F.lit("none")))
    return F.lower(F.coalesce(stated, F.lit("neutral")))


def stored_flag(value: Column, aspect: str) -> Column:
    """Mention flag of one aspect, true when the cell does not say."""
    cell = stored_map(value)
    stated = F.when(
        F.map_contains_key(cell, aspect),
        ~F.coalesce(F.try_element_at(cell, F.lit(aspect)), F.lit("")).isin("", "false", "0", "0.0"))
    return F.coalesce(stated, F.lit(True))


def external_labels(response: Column) -> Column:
    """Map of the first {...} block of a service's answer, NULL when unreadable."""
    return F.from_json(F.regexp_extract(response, r"(?s)\{.*\}", 0), "map<string,string>")
