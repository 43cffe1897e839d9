"""Counts, shares within a period, and representation of an attribute inside buckets.

Rows are first counted per combination of the requested dimensions. That is one partial
aggregation over the scan with one hash update per row, and a hot category collapses in
every map task. The long format is then built from the counts, not from the rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelloom.functions.scalars import ratio

WEIGHT = "__n"


def count_combinations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows per combination of ``keys``, the count in a weight column; a table that holds counts already has them added up."""
    return df.groupBy(*keys).agg(rows_of(df).alias(WEIGHT))


def rows_of(df: DataFrame) -> Column:
    """Aggregate: number of rows, by their weights where the table holds counts."""
    return F.sum(WEIGHT) if WEIGHT in df.columns else F.count(F.lit(1))


def rows_where(df: DataFrame, condition: Column) -> Column:
    """Aggregate: number of rows that meet a condition, by their weights where the table holds counts."""
    return F.coalesce(F.sum(F.when(condition, F.col(WEIGHT))), F.lit(0)) if WEIGHT in df.columns else F.count_if(condition)


def counts_by(df: DataFrame, keys: Sequence[str], name: str = "respondent_count") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def share_of_total(df: DataFrame, within: Sequence[str], measure: str, name: str) -> DataFrame:
    """``measure`` divided by its sum over the rows that agree on ``within``."""
    total = F.sum(measure).over(Window.partitionBy(*within))
    return df.withColumn(name, ratio(F.col(measure), total))


def share_within(
    df: DataFrame,
    period: str,
    dimensions: Sequence[str],
    count_name: str = "respondent_count",
    share_name: str = "respondent_share_within_year",
    null_policy: str = "drop",
) -> DataFrame:
    """Long table period x dimension x value with counts and shares within the period.

    ``null_policy="drop"`` leaves rows without a value out of the count and of the denominator,
    so the shares of a dimension with missing values still sum to one over its known values.
    ``"keep"`` reports them as a group of their own.
    """
    if null_policy not in ("drop", "keep"):
        raise ValueError("null_policy is 'drop' or 'keep'")
    long = (
        count_combinations(df, [period, *dimensions])
        .unpivot([period, WEIGHT], list(dimensions), "dimension", "dimension_value")
    )
    if null_policy == "drop":
        long = long.where(F.col("dimension_value").isNotNull())
    counted = long.groupBy(period, "dimension", "dimension_value").agg(F.sum(WEIGHT).alias(count_name))
    return share_of_total(counted, [period, "dimension"], count_name, share_name)


def representation(
    df: DataFrame,
    period: str,
    attribute: str,
    value: str,
    buckets: Mapping[str, str | None],
    keep: Mapping[str, Column] | None = None,
    min_sample: int = 30,
) -> DataFrame:
    """Share of an attribute value inside each bucket, with the cell's median of ``value``.

    ``buckets`` maps the published dimension name to a column, or to None for the one bucket
    ``ALL``. ``keep`` holds a condition per dimension name on ``cross_dimension_value``; rows
    without a bucket value never count. ``value`` is a banded measure, so the combinations are
    bounded by the vocabularies and the bands.
    """
    columns = [c for c in buckets.values() if c is not None]
    cells = count_combinations(df, [period, attribute, *columns, value]).select(
        period, attribute, value, WEIGHT,
        *[(F.lit("ALL") if c is None else F.col(c).cast("string")).alias(f"__b_{name}") for name, c in buckets.items()],
    )
    long = (
        cells.unpivot([period, attribute, value, WEIGHT], [f"__b_{name}" for name in buckets], "__dim", "cross_dimension_value")
        .withColumn("cross_dimension", F.substr("__dim", F.lit(len("__b_") + 1)))
        .where(F.col("cross_dimension_value").isNotNull())
    )
    for name, condition in (keep or {}).items():
        long = long.where((F.col("cross_dimension") != name) | condition)
    bucket = Window.partitionBy(period, "cross_dimension", "cross_dimension_value")
    counted = long.groupBy(period, attribute, "cross_dimension", "cross_dimension_value").agg(
        F.sum(WEIGHT).alias("respondent_count"),
        F.percentile(value, 0.5, F.col(WEIGHT)).alias(f"median_{value}"),
    )
    return (
        counted.withColumn("bucket_total", F.sum("respondent_count").over(bucket))
        .where(F.col(attribute).isNotNull())
        .select(
            period,
            attribute,
            "cross_dimension",
            "cross_dimension_value",
            "respondent_count",
            "bucket_total",
            ratio(F.col("respondent_count"), F.col("bucket_total")).alias("share_within_bucket"),
            f"median_{value}",
            (F.col("respondent_count") < min_sample).alias("low_sample_flag"),
        )
    )
