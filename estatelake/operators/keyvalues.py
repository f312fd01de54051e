"""Attribute columns from key/value maps."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estatelake.functions.text import floor_m


def kv_keys(df: DataFrame, column: str) -> DataFrame:
    """Every key in use, once."""
    return df.select(F.explode(F.map_keys(column)).alias("key")).distinct()


def widen(df: DataFrame, column: str, keys: Iterable[str]) -> DataFrame:
    """One column per wanted key, null where a row lacks it."""
    return df.select("*", *(F.try_element_at(column, F.lit(key)).alias(key) for key in keys))


def _value(column: str, key: str) -> Column:
    return F.try_element_at(F.col(column), F.lit(key))


def attributes_o(column: str) -> dict[str, Column]:
    """C7. The source's attribute labels."""
    return {
        "rooms": _value(column, "Liczba pokoi"),
        "floors_number": _value(column, "Liczba pięter"),
        "floor": _value(column, "Piętro"),
        "type_building": F.lower(_value(column, "Rodzaj zabudowy")),
        "material_building": F.lower(_value(column, "Materiał budynku")),
        "year": _value(column, "Rok budowy"),
    }


def attributes_m(column: str) -> dict[str, Column]:
    """C8. The source's attribute labels."""
    return {
        "floors_number": _value(column, "Liczba pięter"),
        "floor": floor_m(_value(column, "Piętro")),
        "type_building": F.lower(_value(column, "Typ budynku")),
        "material_building": F.lower(_value(column, "Materiał budowlany")),
        "year": _value(column, "Rok budowy"),
    }
