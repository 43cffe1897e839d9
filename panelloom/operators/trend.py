"""Rank inside a period and change between editions. All inputs are aggregated tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelloom.functions.scalars import position_in


def with_rank(df: DataFrame, period: str, measure: str, name: str = "rank") -> DataFrame:
    """Competition rank, highest first: ties share a rank and leave a gap after it."""
    return df.withColumn(name, F.rank().over(Window.partitionBy(period).orderBy(F.desc(measure))))


def with_change(df: DataFrame, entity: str, period: str, periods: Sequence[str], measure: str, name: str, scale: float = 100.0) -> DataFrame:
    """Change against the edition directly before, NULL where the entity is missing in either.

    An entity that skips an edition gets no change across the gap.
    """
    ordinal = position_in(F.col(period), periods)
    by_time = Window.partitionBy(entity).orderBy(ordinal)
    adjacent = F.lag(ordinal).over(by_time) == ordinal - 1
    return df.withColumn(name, F.when(adjacent, (F.col(measure) - F.lag(measure).over(by_time)) * scale))


def growth_between(period: str, first: str, last: str, measure: str, scale: float = 100.0) -> Column:
    """Aggregate: measure of the last edition minus that of the first, NULL if either is missing."""
    def at(edition: str) -> Column:
        return F.max(F.when(F.col(period) == edition, F.col(measure)))

    return (at(last) - at(first)) * scale


def first_to_last(df: DataFrame, entity: str, period: str, first: str, last: str, measure: str, name: str, scale: float = 100.0) -> DataFrame:
    """Growth of each entity from the first to the last edition."""
    return df.groupBy(entity).agg(growth_between(period, first, last, measure, scale).alias(name))


def without_trend(growth: DataFrame, entity: str, name: str) -> DataFrame:
    """Entities that have no growth because an end of the trend is missing."""
    return growth.where(F.col(name).isNull()).select(entity)
