"""Does a frame keep the declared widths and not-null columns of its sink?"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def contract_report(
    df: DataFrame, widths: Mapping[str, int], required: Iterable[str] = ()
) -> DataFrame:
    """One row per checked column: over-long values, nulls, and whether null is allowed.

    All columns are counted in a single aggregate over the data.
    """
    required = set(required)
    names = [name for name in df.columns if name in widths or name in required]

    def entry(name):
        too_long = F.length(name) > widths[name] if name in widths else F.lit(False)
        return F.struct(
            F.lit(name).alias("column"),
            F.count_if(too_long).alias("too_long"),
            F.count_if(F.col(name).isNull()).alias("nulls"),
            F.lit(name not in required).alias("nullable"),
        )

    report = df.agg(F.array(*(entry(name) for name in names)).alias("_r"))
    return report.select(F.inline("_r"))
