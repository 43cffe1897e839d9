"""Distribution statistics with exact, interpolated percentiles.

Banded measures (a midpoint per answer band) take one aggregation to ``(keys, value) -> n``
and one over that, which holds at most one row per band and group however many rows a group
has. Measures with an open value domain take :func:`exact_quantiles`, which never brings the
values of a group together.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelloom.functions.scalars import ratio
from panelloom.operators.shares import WEIGHT, count_combinations
from panelloom.session import new_folder


def distribution_stats(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    min_sample: int = 30,
    names: Mapping[str, str] | None = None,
) -> DataFrame:
    """Group size, known values, median, mean, quartiles, IQR and small-sample flag.

    Rows without a value count in the group size and nowhere else, so a group of unknowns is
    kept with NULL statistics. A group below ``min_sample`` is flagged, never dropped.
    """
    names = {**SALARY_NAMES, **(names or {})}
    known = F.col(value).isNotNull()
    quartiles = F.percentile(value, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), F.col(WEIGHT))
    grouped = (
        count_combinations(df, [*keys, value])
        .groupBy(*keys)
        .agg(
            F.sum(WEIGHT).alias("__size"),
            F.coalesce(F.sum(F.when(known, F.col(WEIGHT))), F.lit(0)).alias("__known"),
            F.sum(F.col(value) * F.col(WEIGHT)).alias("__total"),
            quartiles.alias("__quartiles"),
        )
    )
    return with_spread(
        grouped.select(
            *keys,
            F.col("__size").alias("respondent_count"),
            F.col("__known").alias(names["known"]),
            F.get("__quartiles", 1).alias(names["median"]),
            ratio(F.col("__total"), F.col("__known")).alias(names["mean"]),
            F.get("__quartiles", 0).alias(names["p25"]),
            F.get("__quartiles", 2).alias(names["p75"]),
        ),
        names,
        min_sample,
    )


SALARY_NAMES = {
    "known": "salary_known_count",
    "median": "median_salary_midpoint",
    "mean": "mean_salary_midpoint",
    "p25": "salary_p25",
    "p75": "salary_p75",
    "iqr": "salary_iqr",
}


def with_spread(df: DataFrame, names: Mapping[str, str], min_sample: int) -> DataFrame:
    return df.withColumn(names["iqr"], F.col(names["p75"]) - F.col(names["p25"])).withColumn(
        "low_sample_flag", F.col("respondent_count") < min_sample
    )


def one_row(df: DataFrame, **aggregates: Column) -> Column:
    """Global aggregates as one struct, a scalar subquery: no join, no trip through the driver."""
    return df.agg(F.struct(*[agg.alias(name) for name, agg in aggregates.items()]).alias("__row")).scalar()


_ACCURACY = 2000
# A bracket that missed its rank is made so many times wider.
_WIDER = 8


def exact_quantiles(df: DataFrame, keys: Sequence[str], value: str, probabilities: Sequence[float], accuracy: int = _ACCURACY) -> DataFrame:
    """Interpolated percentiles of an open-domain measure, one array per group.

    A first pass brackets each wanted rank between two approximate percentiles. Two more passes count what lies below each bracket and
    the distinct values inside it, about four parts in ``accuracy`` of a group; a running count over these finds the ranks exactly. All
    three are plain aggregates with a map-side combine. Every rank is checked against the exact counts: where a bracket
    turns out not to hold its rank, the group goes through the passes again with wider brackets, in the end from minimum to maximum. So
    no result rests on the error of the approximation. Brackets and results, one row per group, are stored, so Spark
    knows their size and broadcasts them where they are small; the rows of a group are never brought together.
    """
    spark = df.sparkSession
    keys = list(keys)
    groups = [f"__k{i}" for i in range(len(keys))]
    rows = df.where(F.col(value).isNotNull()).select(*[F.col(k).alias(g) for k, g in zip(keys, groups)], F.col(value).cast("double").alias("__v"))
    path, width, missed = new_folder(spark, "quantiles"), 2.0 / accuracy, None
    for attempt in range(64):
        pending = rows if missed is None else _join_groups(rows, missed, groups)
        brackets = _brackets(pending, groups, probabilities, width, accuracy)
        brackets.write.parquet(f"{path}/brackets/{attempt}")
        ranked = _ranked(pending, spark.read.schema(brackets.schema).parquet(f"{path}/brackets/{attempt}"), groups, probabilities)
        ranked.write.parquet(f"{path}/results/attempt={attempt}")
        results = spark.read.schema(ranked.schema).parquet(f"{path}/results/attempt={attempt}")
        missed = results.where(F.exists("quantiles", lambda q: q.isNull())).select(*groups)
        if missed.limit(1).count() == 0:
            break
        width *= _WIDER
    found = spark.read.schema(ranked.schema).parquet(*[f"{path}/results/attempt={i}" for i in range(attempt + 1)])
    return found.where(F.forall("quantiles", lambda q: q.isNotNull())).withColumnsRenamed(dict(zip(groups, keys)))


def _brackets(rows: DataFrame, groups: Sequence[str], probabilities: Sequence[float], width: float, accuracy: int) -> DataFrame:
    """``__size, __lo, __hi`` per group: the values ``width`` of the ranks below and above each probability, about."""
    ends = [min(max(p + side * width, 0.0), 1.0) for p in probabilities for side in (-1, 1)]
    found = rows.groupBy(*groups).agg(
        F.count(F.lit(1)).alias("__size"), F.min("__v").alias("__min"), F.max("__v").alias("__max"),
        F.percentile_approx("__v", [float(e) for e in ends], accuracy).alias("__e"),
    )

    def edge(i: int) -> Column:
        extreme = F.col("__min") if ends[i] == 0.0 else F.col("__max") if ends[i] == 1.0 else None
        return F.get("__e", i) if extreme is None else extreme

    count = range(len(probabilities))
    return found.select(*groups, "__size", F.array(*[edge(2 * i) for i in count]).alias("__lo"), F.array(*[edge(2 * i + 1) for i in count]).alias("__hi"))


def _ranked(rows: DataFrame, brackets: DataFrame, groups: Sequence[str], probabilities: Sequence[float]) -> DataFrame:
    """``quantiles`` per group, NULL where the exact counts show that a rank is not in its bracket."""
    count = len(probabilities)
    placed = _join_groups(rows, brackets, groups)
    low, high = [F.get("__lo", i) for i in range(count)], [F.get("__hi", i) for i in range(count)]
    below = placed.groupBy(*groups).agg(
        F.max("__size").alias("__size"),
        *[F.count_if(F.col("__v") < low[i]).alias(f"__b{i}") for i in range(count)],
        *[F.count_if(F.col("__v") > high[i]).alias(f"__c{i}") for i in range(count)],
        *[F.max(F.when(F.col("__v") < low[i], F.col("__v"))).alias(f"__z{i}") for i in range(count)],
        *[F.min(F.when(F.col("__v") > high[i], F.col("__v"))).alias(f"__a{i}") for i in range(count)],
    )
    inside = (
        placed.select(
            *groups, "__v", F.explode(F.array_compact(F.array(*[
                F.when(F.col("__v").between(F.get("__lo", i), F.get("__hi", i)), F.lit(i)) for i in range(count)
            ]))).alias("__i"),
        )
        .groupBy(*groups, "__i", "__v").agg(F.count(F.lit(1)).alias(WEIGHT))
    )
    upto = F.sum(WEIGHT).over(Window.partitionBy(*groups, "__i").orderBy("__v").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    # One row per group and probability, also where nothing lies inside the bracket.
    each = below.select(
        *groups, "__size", F.inline(F.array(*[
            F.struct(F.lit(i).alias("__i"), F.lit(float(p)).alias("__p"), *[F.col(f"__{x}{i}").alias(f"__{x}") for x in "bcza"])
            for i, p in enumerate(probabilities)
        ])),
    )
    ranked = _join_groups(each, inside.withColumn("__upto", upto), [*groups, "__i"], "left")
    place = F.col("__p") * (F.col("__size") - 1)

    def at(rank: Column) -> Column:
        """The value of a rank: inside the bracket or, as exactly known, right beside it; else NULL."""
        above = F.col("__size") - F.col("__c")  # the first rank above the bracket
        return (
            F.when(F.max(rank == F.col("__b") - 1), F.max("__z"))
            .when(F.max(rank == above), F.max("__a"))
            .when(F.max((rank >= F.col("__b")) & (rank < above)), F.min(F.when(F.col("__b") + F.col("__upto") > rank, F.col("__v"))))
        )

    ends_at = [at(F.floor(place)), at(F.ceil(place))]
    one = ranked.groupBy(*groups, "__i").agg((ends_at[0] + (ends_at[1] - ends_at[0]) * F.max(place - F.floor(place))).alias("__q"))
    return one.groupBy(*groups).agg(F.array(*[F.max(F.when(F.col("__i") == i, F.col("__q"))) for i in range(count)]).alias("quantiles"))


def open_distribution_stats(df: DataFrame, keys: Sequence[str], value: str, min_sample: int = 30, names: Mapping[str, str] | None = None) -> DataFrame:
    """:func:`distribution_stats` for a measure with any number of distinct values, however large a group is."""
    names = {**SALARY_NAMES, **(names or {})}
    sizes = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("respondent_count"), F.count(value).alias(names["known"]), F.avg(F.col(value).cast("double")).alias(names["mean"])
    )
    joined = _join_groups(sizes, exact_quantiles(df, keys, value, (0.25, 0.5, 0.75)), keys, "left")
    return with_spread(
        joined.select(
            *keys, "respondent_count", names["known"], F.get("quantiles", 1).alias(names["median"]), names["mean"],
            F.get("quantiles", 0).alias(names["p25"]), F.get("quantiles", 2).alias(names["p75"]),
        ),
        names,
        min_sample,
    )


def _join_groups(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on group keys where a NULL key is a group like any other."""
    renamed = right.select(*[F.col(k).alias(f"{k}_r") for k in keys], *[c for c in right.columns if c not in keys])
    on = F.lit(True)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"{k}_r"))
    return left.join(renamed, on, how).drop(*[f"{k}_r" for k in keys])

