"""Data-quality reports: reconciliation, uniqueness, missingness, duplicates, consistency."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelloom.functions.scalars import quoted, ratio


def reconcile(before: DataFrame, after: DataFrame, period: str) -> DataFrame:
    """Rows per period on both sides and the difference; a NULL period is one like any other."""
    sides = before.select(period, F.lit(1).alias("__b"), F.lit(0).alias("__a")).unionByName(
        after.select(period, F.lit(0).alias("__b"), F.lit(1).alias("__a"))
    )
    return sides.groupBy(period).agg(
        F.sum("__b").alias("rows_before"), F.sum("__a").alias("rows_after"), (F.sum("__b") - F.sum("__a")).alias("rows_lost")
    )


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once; empty for a sound surrogate key."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > 1)


def key_profile(df: DataFrame, period: str, key: str) -> DataFrame:
    """Rows, distinct keys, smallest and largest key per period.

    Texts are ordered by length first: the numbers of surrogate keys widen beyond their padding, ``_999999`` comes before ``_1000000``.
    """
    ordered = quoted(key)
    if isinstance(df.schema[key].dataType, T.StringType):
        ordered = F.when(ordered.isNotNull(), F.struct(F.length(ordered).alias("length"), ordered.alias("key")))
    found = df.groupBy(period).agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct(quoted(key)).alias("distinct_keys"), F.min(ordered).alias("first_key"), F.max(ordered).alias("last_key")
    )
    if isinstance(df.schema[key].dataType, T.StringType):
        found = found.withColumns({"first_key": F.col("first_key.key"), "last_key": F.col("last_key.key")})
    return found


def value_rate_matrix(df: DataFrame, period: str, periods: Sequence[str], fields: Sequence[str], value: str = "UNKNOWN") -> DataFrame:
    """Share of ``value`` per field and period, one column per period."""
    per_period = df.groupBy(period).agg(
        *[F.avg(F.when(quoted(c) == value, 1.0).otherwise(0.0)).alias(c) for c in fields]
    )
    long = per_period.unpivot([period], list(fields), "field", "rate")
    return long.groupBy("field").pivot(period, list(periods)).agg(F.first("rate"))


def missing_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Share of missing cells per column, in one pass."""
    columns = list(columns or df.columns)
    row = df.agg(*[F.avg(F.when(quoted(c).isNull(), 1.0).otherwise(0.0)).alias(c) for c in columns])
    return row.unpivot([], columns, "column", "missing_rate")


def missing_cells(df: DataFrame, period: str, columns: Sequence[str]) -> DataFrame:
    """Share of all cells of the given columns that are missing, per period."""
    per_row = sum((F.when(quoted(c).isNull(), 1).otherwise(0) for c in columns), F.lit(0))
    return df.groupBy(period).agg(
        ratio(F.sum(per_row), F.count(F.lit(1)) * len(columns)).alias("missing_rate")
    )


def _row_hash(df: DataFrame, columns: Sequence[str], seed: int) -> Column:
    """64-bit hash of a row. A NULL leaves Spark's hash as it was, so which columns are NULL is hashed too."""
    values = []
    for c in columns:
        number = isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType))
        values += [quoted(c).isNull(), quoted(c) + 0.0 if number else quoted(c)]  # 0.0 and -0.0 are equal
    return F.xxhash64(F.lit(seed), *values)


def duplicate_rows(df: DataFrame, period: str, ignore: Sequence[str] = ()) -> DataFrame:
    """Surplus copies per period: rows equal to an earlier one in every column not ignored.

    One pass over the table; two independent 64-bit hashes stand for a row, so a few dozen bytes a row are shuffled
    and rows of any width stay where they are. A NULL period is one like any other.
    """
    compared = [c for c in df.columns if c not in (*ignore, period)]
    rows = df.select(period, *[_row_hash(df, compared, seed).alias(f"__h{seed}") for seed in (1, 2)])
    return (
        rows.groupBy(period, "__h1", "__h2").agg(F.count(F.lit(1)).alias("__n"))
        .groupBy(period).agg(F.sum(F.col("__n") - 1).alias("duplicated_rows"))
    )


def band_counts(df: DataFrame, period: str, open_ended: str, anomaly: str) -> DataFrame:
    """Open-ended and anomalous band answers per period."""
    return df.groupBy(period).agg(
        F.count_if(F.col(open_ended).isin("UPPER_OPEN", "LOWER_OPEN")).alias("open_ended_rows"),
        F.count_if(F.col(anomaly)).alias("anomaly_rows"),
    )


def answer_status(df: DataFrame, period: str, field: str, available: Mapping[str, bool], eligible: str, invalid: Sequence[str] = ()) -> DataFrame:
    """Rows per period and kind of answer of one field.

    NOT_AVAILABLE: the edition had no such question. NOT_ELIGIBLE: the respondent was not led to
    its block. NOT_ANSWERED: shown and left blank. INVALID: a value marked as an entry error.
    """
    missing_in = [p for p, has in available.items() if not has]
    status = F.when(F.col(period).isin(*missing_in), "NOT_AVAILABLE") if missing_in else F.when(F.lit(False), "NOT_AVAILABLE")
    status = status.when(F.col(field).isNull() & ~F.coalesce(F.col(eligible), F.lit(False)), "NOT_ELIGIBLE")
    status = status.when(F.col(field).isNull(), "NOT_ANSWERED")
    if invalid:
        status = status.when(F.col(field).isin(*invalid), "INVALID")
    return df.groupBy(period, status.otherwise("ANSWERED").alias("answer_status")).agg(
        F.count(F.lit(1)).alias("respondent_count")
    )
