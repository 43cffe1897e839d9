"""Conditional rates that keep "not available", "not asked" and "no" apart."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelloom.functions.scalars import any_of, ratio
from panelloom.operators.shares import rows_where

NOT_AVAILABLE = "NOT_AVAILABLE"
NOT_ASKED = "NOT_ASKED"


def availability_rates(
    df: DataFrame,
    period: str,
    category: str,
    category_metric: str,
    positive: Sequence[str],
    flags: Mapping[str, str],
    flag_available: str,
    flag_eligible: str,
    complement_of: str,
    complement_metric: str,
) -> DataFrame:
    """Long table period x metric: availability, eligible respondents, numerator, rate.

    * ``category``: share of ``positive`` among those who were asked; every answer other than
      NOT_ASKED is in the denominator, an honest "don't know" included.
    * ``flags`` (column to metric): share of each flag among the eligible.
    * the complement: eligible respondents for whom ``complement_of`` is false.

    A period in which the question did not exist keeps its rows, with zero eligible and NULL
    numerator and rate. One aggregate gives one row per period, and only those are unpivoted.
    """
    shown = F.coalesce(F.col(flag_eligible), F.lit(False))
    answered = (F.col(category) != NOT_ASKED) & (F.col(category) != NOT_AVAILABLE)
    per_period = df.groupBy(period).agg(
        F.bool_or(F.col(category) != NOT_AVAILABLE).alias("__cat_available"),
        rows_where(df, answered).alias("__cat_eligible"),
        rows_where(df, answered & any_of(F.col(category), positive)).alias("__cat_num"),
        F.bool_or(F.col(flag_available)).alias("__flag_available"),
        rows_where(df, shown).alias("__flag_eligible"),
        *[rows_where(df, shown & F.col(c)).alias(f"__num_{i}") for i, c in enumerate(flags)],
        rows_where(df, shown & ~F.coalesce(F.col(complement_of), F.lit(False))).alias("__num_complement"),
    )

    def metric(name: str, available: str, eligible: str, numerator: str):
        return F.struct(
            F.lit(name).alias("metric"),
            F.col(available).alias("question_available"),
            F.col(eligible).alias("eligible_respondents"),
            F.col(numerator).alias("numerator"),
        )

    metrics = [
        metric(category_metric, "__cat_available", "__cat_eligible", "__cat_num"),
        *[metric(m, "__flag_available", "__flag_eligible", f"__num_{i}") for i, m in enumerate(flags.values())],
        metric(complement_metric, "__flag_available", "__flag_eligible", "__num_complement"),
    ]
    available = F.coalesce("question_available", F.lit(False))
    return per_period.select(period, F.inline(F.array(*metrics))).select(
        period,
        "metric",
        available.alias("question_available"),
        F.when(available, F.col("eligible_respondents")).otherwise(F.lit(0)).alias("eligible_respondents"),
        F.when(available, F.col("numerator").cast("double")).alias("numerator"),
        F.when(available, ratio(F.col("numerator"), F.col("eligible_respondents"))).alias("rate"),
    )


def scaffold(rates: DataFrame, period: str, periods: Sequence[str], metric: str, metrics: Sequence[str]) -> DataFrame:
    """One row for every period and metric, also where ``rates`` has none (not available)."""
    grid = (
        rates.sparkSession.range(1)
        .select(F.explode(F.array(*[F.lit(p) for p in periods])).alias(period))
        .select(period, F.explode(F.array(*[F.lit(m) for m in metrics])).alias(metric))
    )
    return grid.join(rates, [period, metric], "left").select(
        period,
        metric,
        F.coalesce("question_available", F.lit(False)).alias("question_available"),
        F.coalesce("eligible_respondents", F.lit(0)).alias("eligible_respondents"),
        "numerator",
        "rate",
    )


def availability_by_period(rates: DataFrame, period: str, flag: str = "question_available") -> DataFrame:
    return rates.groupBy(period).agg(F.bool_or(flag).alias(flag))
