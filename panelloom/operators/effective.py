"""Effective-dated mappings: a raw value means what its mapping row in force at that time says.

A mapping row is in force from ``start`` (included) to ``end`` (not included); a NULL bound is open. Times are whatever orders:
dates, timestamps, numbers, edition names. For one raw value the rows must neither overlap nor leave a gap, which
:func:`require_intervals` checks before a lookup; so a lookup meets at most one row and never multiplies the data.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelloom.functions.scalars import position_in, quoted

START, END, VERSION = "valid_from", "valid_to", "mapping_version"


def interval_problems(mapping: DataFrame, keys: Sequence[str], start: str = START, end: str = END) -> DataFrame:
    """``keys, problem, start, end`` of every interval that is empty, overlaps the one before it or leaves a gap to it.

    A NULL key (the blank answer) is a key like any other. The rows of one key are one group: the versions of one raw value.
    """
    by_time = Window.partitionBy(*keys).orderBy(F.col(start).asc_nulls_first(), F.col(end).asc_nulls_last())
    first = F.row_number().over(by_time) == 1
    before = F.lag(end).over(by_time)
    problem = (
        F.when(F.col(start) >= F.col(end), F.lit("empty"))
        .when(first, F.lit(None))
        .when(F.col(start).isNull() | before.isNull() | (before > F.col(start)), F.lit("overlap"))
        .when(before < F.col(start), F.lit("gap"))
    )
    found = mapping.select(*keys, start, end, problem.alias("problem")).where(F.col("problem").isNotNull())
    return found.select(*keys, "problem", start, end)


def require_intervals(mapping: DataFrame, keys: Sequence[str], start: str = START, end: str = END, sample: int = 20) -> None:
    found = interval_problems(mapping, keys, start, end).limit(sample).collect()
    if found:
        raise ValueError(f"mapping intervals overlap, leave a gap or are empty: {sorted(map(str, (tuple(r) for r in found)))}")


def in_force(at: Column, start: Column, end: Column) -> Column:
    return (start.isNull() | (at >= start)) & (end.isNull() | (at < end))


def map_as_of(
    df: DataFrame,
    source: str,
    targets: Mapping[str, str],
    mapping: DataFrame,
    at: str,
    raw: str = "raw_value",
    start: str = START,
    end: str = END,
) -> DataFrame:
    """Left lookup of ``source`` in the mapping row in force at ``at``; every target takes one column of the mapping.

    The join is on the raw value (a NULL meets the mapping row without one) with the times as a further condition. Spark sends the
    mapping to all tasks when it has measured it as small; beyond that it is a shuffle on the raw value, whose hot values adaptive execution splits.
    Values that no row covers at their time stay NULL and are what :func:`uncovered_values` lists.
    """
    renamed = mapping.select(
        F.col(raw).alias("__raw"), F.col(start).alias("__start"), F.col(end).alias("__end"),
        *[F.col(c).alias(f"__value_{i}") for i, c in enumerate(targets.values())],
    )
    on = quoted(source).eqNullSafe(F.col("__raw")) & in_force(quoted(at), F.col("__start"), F.col("__end"))
    values = {target: F.col(f"__value_{i}") for i, target in enumerate(targets)}
    return df.join(renamed, on, "left").withColumns(values).drop(*renamed.columns)


def uncovered_values(df: DataFrame, source: str, mapping: DataFrame, at: str, raw: str = "raw_value", start: str = START, end: str = END) -> DataFrame:
    """``raw_value, first_at, last_at, rows`` of values that no mapping row covers at their time.

    Values are counted per time before they leave the scan, so only the vocabulary is joined.
    """
    seen = df.select(quoted(source).cast("string").alias("raw_value"), quoted(at).alias("at")).groupBy("raw_value", "at").agg(F.count(F.lit(1)).alias("n"))
    known = mapping.select(F.col(raw).alias("__raw"), F.col(start).alias("__start"), F.col(end).alias("__end"))
    on = F.col("raw_value").eqNullSafe(F.col("__raw")) & in_force(F.col("at"), F.col("__start"), F.col("__end"))
    missing = seen.join(known, on, "left_anti")
    return missing.groupBy("raw_value").agg(F.min("at").alias("first_at"), F.max("at").alias("last_at"), F.sum("n").alias("rows"))


def expand_validity(mapping: DataFrame, periods: Sequence[str], period: str, start: str = START, end: str = END) -> DataFrame:
    """One mapping row per edition it is in force in; bounds are edition names in the order of ``periods``."""
    for bound in (start, end):
        unknown = mapping.where(F.col(bound).isNotNull() & (position_in(F.col(bound), periods) == 0)).select(bound).distinct().limit(5).collect()
        if unknown:
            raise ValueError(f"{bound} names no edition: {[r[0] for r in unknown]}")
    places = F.sequence(
        F.coalesce(position_in(F.col(start), periods), F.lit(1).cast("bigint")),
        F.coalesce(position_in(F.col(end), periods) - 1, F.lit(len(periods)).cast("bigint")),
    )
    every = F.array(*[F.lit(p) for p in periods])
    return mapping.withColumn(period, F.explode(F.transform(places, lambda i: F.get(every, (i - 1).cast("int"))))).drop(start, end)
