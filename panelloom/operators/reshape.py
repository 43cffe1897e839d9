"""Wide and long forms of report-sized tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelloom.functions.scalars import quoted


def pivot_periods(df: DataFrame, entity: str, period: str, periods: Sequence[str], measure: str, digits: int | None = None) -> DataFrame:
    """One column per period. The periods are given, so no job is needed to discover them."""
    value = F.first(measure, ignorenulls=True)
    if digits is not None:
        value = F.round(value, digits)
    return df.groupBy(entity).pivot(period, list(periods)).agg(value)


def melt(df: DataFrame, ids: Sequence[str], columns: Sequence[str], name: str, value: str, drop_null: bool = True) -> DataFrame:
    """Columns to rows; cells without a value are left out unless asked for."""
    long = df.unpivot([quoted(c) for c in ids], [quoted(c) for c in columns], name, value)
    return long.where(F.col(value).isNotNull()) if drop_null else long
