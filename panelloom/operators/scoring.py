"""A composite score that always travels with its components."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelloom.functions.scalars import any_of, ratio, relative_lift
from panelloom.operators.shares import WEIGHT, count_combinations
from panelloom.operators.stats import one_row


def normalize(df: DataFrame, columns: Sequence[str], prefix: str = "normalized_") -> DataFrame:
    """Min-max to [0, 1] over the whole table; a constant column becomes 0.

    For tables with one row per scored entity (see :func:`numbered_by`). The bounds come from a
    window, so the table behind the components is computed once.
    """
    everything = Window.partitionBy()
    normalized = {}
    for c in columns:
        low, high = F.min(c).over(everything), F.max(c).over(everything)
        normalized[f"{prefix}{c}"] = F.when(high == low, F.col(c) * 0.0).otherwise(ratio(F.col(c) - low, high - low))
    return df.withColumns(normalized)


def normalize_rows(df: DataFrame, columns: Sequence[str], prefix: str = "normalized_") -> DataFrame:
    """The same for tables of any size: a second pass over ``df`` with the one row of bounds."""
    bounds = one_row(df, **{f"lo_{c}": F.min(c) for c in columns}, **{f"hi_{c}": F.max(c) for c in columns})
    normalized = {}
    for c in columns:
        low, high = bounds[f"lo_{c}"], bounds[f"hi_{c}"]
        normalized[f"{prefix}{c}"] = F.when(high == low, F.col(c) * 0.0).otherwise(ratio(F.col(c) - low, high - low))
    return df.withColumns(normalized)


def weighted_score(df: DataFrame, weights: Mapping[str, float], name: str, prefix: str = "normalized_") -> DataFrame:
    """Weighted sum of normalized components; the weights are rescaled to sum to one."""
    total = sum(weights.values())
    score = sum((F.lit(w / total) * F.col(f"{prefix}{c}") for c, w in weights.items()), F.lit(0.0))
    return df.withColumn(name, score)


def numbered_by(df: DataFrame, measure: str, tiebreak: str, name: str = "rank") -> DataFrame:
    """Position after sorting by ``measure``. For one row per scored entity only: options are
    columns of a questionnaire, so there are at most a few hundred."""
    return df.withColumn(name, F.row_number().over(Window.orderBy(F.desc(measure), F.asc(tiebreak))))


def selected_users(bridge: DataFrame, fact: DataFrame, keys: Sequence[str], option: str, attributes: Sequence[str]) -> DataFrame:
    """Selected bridge rows with the respondent's attributes, from stored tables.

    ``keys`` identify a respondent, so no key is hot; only selected rows are shuffled. Where options
    and attributes still sit in one wide row, build the bridge with the attributes as ids
    instead: that needs no join.
    """
    users = bridge.where(F.col("selected")).select(*keys, option)
    return users.join(fact.select(*keys, *attributes), list(keys), "left")


def user_profile(
    users: DataFrame,
    people: DataFrame,
    period: str,
    option: str,
    category: str,
    level: str,
    value: str,
    senior_levels: Sequence[str],
    min_users: int,
    unknown: str = "UNKNOWN",
) -> DataFrame:
    """Per period and option: users, breadth of categories, lift of the median value and of the
    senior share against everybody in the period.

    ``users`` has one row per option a respondent uses, ``people`` one per respondent. Both are
    first counted per (option, category, level, value), a table bounded by the vocabularies, so
    a popular option is no hot group. The totals are one row per period.
    """
    known = F.when(F.col(category) != unknown, F.col(category))
    senior = F.sum(F.when(any_of(F.col(level), senior_levels), F.col(WEIGHT)).otherwise(0))

    def profile(rows: DataFrame, keys: list[str], prefix: str) -> DataFrame:
        return count_combinations(rows, [*keys, category, level, value]).groupBy(*keys).agg(
            F.sum(WEIGHT).alias(f"{prefix}users"),
            F.count_distinct(known).alias(f"{prefix}categories"),
            F.percentile(value, 0.5, F.col(WEIGHT)).alias(f"{prefix}median"),
            ratio(senior, F.sum(WEIGHT)).alias(f"{prefix}senior"),
        )

    per_option = profile(users, [period, option], "").where(F.col("users") >= min_users)
    everybody = profile(people, [period], "all_")
    return per_option.join(everybody, period).select(
        period,
        option,
        "users",
        ratio(F.col("categories"), F.col("all_categories")).alias("breadth"),
        relative_lift(F.col("median"), F.col("all_median")).alias("value_lift"),
        relative_lift(F.col("senior"), F.col("all_senior")).alias("senior_lift"),
    )
