from datetime import datetime

import pytest
from pyspark.sql import functions as F

from savora.functions import parse

def REFERENCE():
    return F.lit("2026-07-19").cast("timestamp_ntz")


@pytest.mark.parametrize("raw,day", [
    ("hace 3 meses", datetime(2026, 4, 19)), ("hace un mes", datetime(2026, 6, 19)), ("hace 2 años", datetime(2024, 7, 19)),
    ("Hace una semana", datetime(2026, 7, 12)), ("hace 5 días", datetime(2026, 7, 14)), ("hace 5 dia", datetime(2026, 7, 14)),
    ("hace 2 horas", datetime(2026, 7, 18, 22)), ("hace unos minutos", datetime(2026, 7, 18, 23, 59)), ("hace un ano", datetime(2025, 7, 19)),
    ("2025-03-12", None), (None, None)])
def test_relative_date(value, raw, day):
    assert value(lambda c: parse.relative_date(c, REFERENCE()), raw) == day


def test_relative_date_clamps_month_ends(value):
    end = F.lit("2026-03-31").cast("timestamp_ntz")
    assert value(lambda c: parse.relative_date(c, end), "hace un mes") == datetime(2026, 2, 28)


@pytest.mark.parametrize("raw,day", [("2025-03-12", datetime(2025, 3, 12)), ("2025-03-12T10:00:00", datetime(2025, 3, 12, 10)),
                                     ("hace 3 meses", datetime(2026, 4, 19)), ("ayer", None), (None, None)])
def test_mixed_date(value, raw, day):
    assert value(lambda c: parse.mixed_date(c, REFERENCE()), raw) == day


@pytest.mark.parametrize("label,level", [
    ("Hasta $15", 1), ("Desde $15 hasta $25", 2), ("Desde $25 hasta $35", 3), ("Más de $35", 4), ("$", 1), ("$$", 2), ("$$$", 3), ("$$$$", 4),
    ("$$ - $$$", 2), ("Desde $40 hasta $60", 2), ("$$ -$$$", 4), ("caro", None), ("nan", None), ("", None), (None, None)])
def test_price_level(value, label, level):
    assert value(parse.price_level, label) == level


def test_price_vocabularies_share_a_band(value):
    band = lambda c: parse.price_band(parse.price_level(c))
    assert value(band, "Desde $15 hasta $25") == value(band, "$$") == "$$ ($15-$25)"


@pytest.mark.parametrize("raw,primary", [("Italiana, Pizzeria", "Italiana"), (" , x", None), ("nan", None), (None, None)])
def test_primary_category(value, raw, primary):
    assert value(parse.primary_category, raw) == primary


def test_category_separators(value):
    assert value(parse.split_categories, "Vasca · Peruana/Cubana|Andina") == "Vasca, Peruana, Cubana, Andina"


@pytest.mark.parametrize("raw,number", [("1.9K", 1900.0), ("4,5", 4.5), ("2 k reseñas", 2000.0), ("nota 3", 3.0), ("", None), (None, None)])
def test_number_with_suffix(value, raw, number):
    assert value(parse.number_with_suffix, raw) == number


@pytest.mark.parametrize("address,zone", [
    ("Casa Azul & Co - Colina", "Colina"), ("Calle 50, Casa 1206 - Bella Vista - Panamá", "Bella Vista"),
    ("Solo - Panama - Ciudad de Panamá", None), ("Panamá", None), ("x -  - y", "y"), (None, None)])
def test_zone_of_address(value, address, zone):
    assert value(parse.zone_of_address, address) == zone


def test_labelled_rating(value):
    text = "Comida 4.4 /5 Servicio 4,5 /5 Ambiente 9 /5"
    assert value(lambda c: parse.labelled_rating(c, "Comida"), text) == 4.4
    assert value(lambda c: parse.labelled_rating(c, "Servicio"), text) == 4.5
    assert value(lambda c: parse.labelled_rating(c, "Ambiente"), text) is None


def test_card_ratings(value):
    assert value(parse.class_token_rating, "ui bubble_45") == 4.5
    assert value(parse.first_decimal, "4.5 of 5 bubbles") == 4.5
    assert value(parse.grouped_count, "1,234 reviews") == 1234


CELL = "{'comida': 'Positive', 'servicio': 'neutral'}"


@pytest.mark.parametrize("cell,comida,precio", [(CELL, "positive", "neutral"), ("garbage", "neutral", "neutral"), (None, "neutral", "neutral"), ("[1]", "neutral", "neutral")])
def test_stored_labels(value, cell, comida, precio):
    assert value(lambda c: parse.stored_label(c, "comida"), cell) == comida
    assert value(lambda c: parse.stored_label(c, "precio"), cell) == precio


@pytest.mark.parametrize("cell,comida,precio", [("{'comida': True, 'precio': False}", True, False), ("{'comida': True}", True, True), ("x", True, True), (None, True, True)])
def test_stored_flags(value, cell, comida, precio):
    assert value(lambda c: parse.stored_flag(c, "comida"), cell) is comida
    assert value(lambda c: parse.stored_flag(c, "precio"), cell) is precio


def test_external_labels(value):
    assert value(parse.external_labels, 'Claro:\n{"comida": "Positive"}\nfin') == {"comida": "Positive"}
    assert value(parse.external_labels, "no json") is None
