"""Sorts, top-k and latest-edition cuts. Every sort takes a tie-break key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelloom.functions.scalars import position_in, sign_label


def latest_only(df: DataFrame, period: str) -> DataFrame:
    """Rows of the latest edition. The maximum is a scalar subquery, so it prunes partitions."""
    newest = df.select(F.max(period)).scalar()
    return df.where(F.col(period) == newest)


def sort_desc(df: DataFrame, measure: str, tiebreak: str) -> DataFrame:
    return df.orderBy(F.desc_nulls_last(measure), F.asc(tiebreak))


def top_k(df: DataFrame, k: int, measure: str, tiebreak: str) -> DataFrame:
    return df.where(F.col(measure).isNotNull()).orderBy(F.desc(measure), F.asc(tiebreak)).limit(k)


def bottom_k(df: DataFrame, k: int, measure: str, tiebreak: str) -> DataFrame:
    return df.where(F.col(measure).isNotNull()).orderBy(F.asc(measure), F.asc(tiebreak)).limit(k)


def movers(df: DataFrame, k: int, entity: str, change: str, labels: tuple[str, str], sign: str = "sign") -> DataFrame:
    """The k largest gains and the k largest drops, each entity once, with a sign label."""
    rows = df.select(entity, change)
    both = top_k(rows, k, change, entity).unionByName(bottom_k(rows, k, change, entity))
    return both.dropDuplicates([entity]).withColumn(sign, sign_label(F.col(change), *labels))


def in_domain_order(df: DataFrame, column: str, order: Sequence[str], *then: str) -> DataFrame:
    """Sort by a fixed category order instead of by name."""
    return df.orderBy(position_in(F.col(column), order), *then)
