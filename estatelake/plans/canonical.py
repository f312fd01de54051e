"""Raw records of either profile to the 27-column canonical offer.

Both projections are row-wise: no shuffle, and Python only for the few
descriptions that need the exact word wrap. A language model, where one is
given, adds joins for the long descriptions. With ``keep_lines`` all wrapped
pieces of a description come along as ``_lines``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from estatelake.functions import text as T
from estatelake.functions.wrap import description_columns, with_lines
from estatelake.operators.keyvalues import attributes_m, attributes_o
from estatelake.operators.language import keep_language
from estatelake.operators.records import combine
from estatelake.profiles import PROFILE_M, PROFILE_O
from estatelake.schemas import CANONICAL_COLUMNS, OFFERS


def _clean_cells(raw: DataFrame, clean_breaks) -> DataFrame:
    """C1 on list cells, then the profile's break cleaning on all text.

    Columns whose name starts with an underscore were read off earlier and stay.
    """

    def cell(field) -> Column:
        column = F.col(field.name)
        if field.name.startswith("_"):
            return column
        if isinstance(field.dataType, ArrayType):
            return clean_breaks(T.join_list(column)).alias(field.name)
        if isinstance(field.dataType, StringType):
            return clean_breaks(column).alias(field.name)
        return column

    return raw.select(*(cell(field) for field in raw.schema))


def _finish(
    df: DataFrame, columns: dict[str, Column], run_date: str, page_name: str,
    model: DataFrame | None, keep_lines: bool = False,
) -> DataFrame:
    """C16 to C23 and the fixed column order."""
    df = keep_language(df, "description", model)
    df = with_lines(df, "description", "_lines")
    # An offer starts active, with a dash as inactive date.
    columns |= {
        "active": F.lit("Yes"),
        "scrape_date": F.lit(run_date),
        "inactive_date": F.lit("-"),
        "page_name": F.lit(page_name),
        "offer_title": F.col("title"),
    }
    columns |= dict(zip(CANONICAL_COLUMNS[-4:], description_columns(F.col("_lines"))))

    def output(field) -> Column:
        column = columns[field.name]
        clean = T.blank_to_null if isinstance(field.dataType, StringType) else T.nan_to_null
        return clean(column).alias(field.name)

    lines = ["_lines"] if keep_lines else []
    return df.select(*(output(field) for field in OFFERS), *lines)


def canonical_o(
    raw: DataFrame, run_date: str, page_name: str = PROFILE_O.page_name,
    model: DataFrame | None = None, keep_lines: bool = False,
) -> DataFrame:
    """Profile O."""
    df = _clean_cells(raw, T.clean_breaks_o).withColumn("_kv", T.key_values_o(F.col("details")))
    columns = {
        "area": F.col("Area").try_cast("double"),
        "latitude": F.col("lat"),
        "longitude": F.col("lng"),
        "link": F.col("link"),
        "price": T.price_o(F.col("price")),
        "currency": T.currency_o(F.col("price")),
        **attributes_o("_kv"),
        "headers": F.col("additional_info_headers"),
        "additional_info": T.additional_info(F.col("additional_info"), F.col("details")),
        **{name: F.col(name) for name in ("city", "address", "district", "voivodeship")},
    }
    return _finish(df, columns, run_date, page_name, model, keep_lines)


def canonical_m(
    raw: DataFrame, run_date: str, page_name: str = PROFILE_M.page_name,
    model: DataFrame | None = None, keep_lines: bool = False,
) -> DataFrame:
    """Profile M. Address, currency and numbers are read off the uncleaned lists."""
    path = T.address_m(F.col("localization_path"))
    early = {
        "_area": T.number_m(F.col("area")),
        "_price": T.number_m(F.col("price")),
        "_currency": T.currency_m(F.col("price")),
        **{f"_{name}": column for name, column in path.items()},
    }
    df = _clean_cells(raw.withColumns(early), T.clean_breaks_m).withColumn(
        "_kv", T.key_values_m(F.col("params_tables"))
    )
    columns = {
        "area": F.col("_area"),
        "latitude": F.col("lat").try_cast("double"),
        "longitude": F.col("lng").try_cast("double"),
        "link": F.col("link"),
        "price": F.col("_price"),
        "currency": F.col("_currency"),
        "rooms": F.col("rooms"),
        **attributes_m("_kv"),
        "headers": F.col("params_h3"),
        "additional_info": T.additional_info(F.col("params_p"), F.col("params_tables")),
        "city": F.col("_city"),
        "address": F.col("_street"),
        "district": F.col("_district"),
        "voivodeship": F.col("_voivodeship"),
    }
    return _finish(df, columns, run_date, page_name, model, keep_lines)


def offers_all(*offers: DataFrame) -> DataFrame:
    """The offers of all sites as one table."""
    return combine(offers)
