"""Multi-select option blocks: eligibility, long bridge, adoption over eligible respondents.

A respondent is eligible when at least one option of the block is answered. Only eligible
respondents have rows in the bridge and count in a denominator, because a blank block means
the question was not shown, not that nothing was selected.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelloom.functions.scalars import any_answered, is_selected, quoted, ratio, selected_or_null_sql, selected_sql
from panelloom.operators.shares import rows_of, rows_where


def eligible(columns: Sequence[str]) -> Column:
    return any_answered(columns)


def option_bridge(
    df: DataFrame,
    ids: Sequence[str],
    options: Mapping[str, str],
    option: str = "technology",
    family: str | None = None,
    offered_in: Mapping[str, Sequence[str]] | None = None,
    period: str = "survey_year",
    shown: str | None = None,
) -> DataFrame:
    """One row per eligible respondent and option: ids, option name, optional family, selected.

    ``options`` maps columns to canonical names. ``offered_in`` limits an option to the editions
    whose questionnaire had it. ``shown`` names a stored eligibility column; give it where the block is
    computed rather than stored, because a filter over dozens of computed columns below a join
    makes the optimizer's constraint inference explode. One scan, one Expand; ineligible rows go before they multiply.
    """
    names = F.array(*[F.lit(name) for name in options.values()])
    number = F.substr("__option", F.lit(len("__o") + 1)).cast("int")
    answers = df.where(eligible(list(options)) if shown is None else F.col(shown)).select(
        *ids, *[quoted(c).alias(f"__o{i}") for i, c in enumerate(options)]
    )
    # The answer is read after the unpivot: one small expression instead of one per option.
    long = answers.unpivot(list(ids), [f"__o{i}" for i in range(len(options))], "__option", "__answer")
    selected = is_selected("__answer").alias("selected")
    tags = [F.lit(family).alias(f"{option}_family")] if family else []
    bridge = long.select(*ids, F.get(names, number).alias(option), *tags, selected)
    if len(set(options.values())) < len(options):  # two columns, one option: one row all the same
        keys = [c for c in bridge.columns if c != "selected"]
        bridge = bridge.groupBy(*keys).agg(F.bool_or("selected").alias("selected"))
    for name, editions in (offered_in or {}).items():
        bridge = bridge.where((F.col(option) != name) | F.col(period).isin(*editions))
    return bridge


def eligible_counts(df: DataFrame, period: str, columns: Sequence[str], name: str = "eligible_respondents") -> DataFrame:
    return df.groupBy(period).agg(F.count_if(eligible(columns)).alias(name))


def option_adoption(
    df: DataFrame,
    options: Mapping[str, str],
    period: str = "survey_year",
    option: str = "technology",
    users: str = "technology_users",
    offered_in: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """Users, eligible respondents and adoption rate per period and option, from the wide block.

    Users are counted in the wide layout, one counter per option, and only the one row per
    period is unpivoted, so rows never multiply. A respondent who selected several columns of one
    canonical name is one user of it.
    """
    columns_of: dict[str, list[str]] = {}
    for column, name in options.items():
        columns_of.setdefault(name, []).append(column)
    counters = [
        F.expr(f"count(coalesce({', '.join(selected_or_null_sql(c) for c in columns)})) AS __o{i}")
        for i, columns in enumerate(columns_of.values())
    ]
    wide = df.groupBy(period).agg(F.count_if(eligible(list(options))).alias("eligible_respondents"), *counters)
    names = F.array(*[F.lit(name) for name in columns_of])
    number = F.substr("__option", F.lit(len("__o") + 1)).cast("int")
    long = wide.unpivot(
        [period, "eligible_respondents"], [f"__o{i}" for i in range(len(columns_of))], "__option", users
    ).select(period, F.get(names, number).alias(option), users, "eligible_respondents")
    for name, editions in (offered_in or {}).items():
        long = long.where((F.col(option) != name) | F.col(period).isin(*editions))
    return _with_rate(long.where(F.col("eligible_respondents") > 0), users)


_WORD = 62  # options whose answers go into one number


def option_users(
    df: DataFrame,
    respondent: str,
    options: Mapping[str, str],
    option: str = "technology",
    users: str = "users",
    offered_in: Mapping[str, Sequence[str]] | None = None,
    period: str = "survey_year",
) -> DataFrame:
    """Distinct respondents per option that has any, from the wide block, however many rows a respondent has.

    All answers of a row are bits of one number (one per ``_WORD`` options), and a respondent's numbers are united. So the shuffle has a row per
    respondent instead of one per option used, and no task holds more than that.
    """
    columns_of: dict[str, list[str]] = {}
    for column, name in options.items():
        columns_of.setdefault(name, []).append(column)
    names = list(columns_of)

    def bit(name: str, place: int) -> str:
        chosen = " OR ".join(selected_sql(c) for c in columns_of[name])
        if name in (offered_in or {}):
            listed = ", ".join("'" + e.replace("\\", "\\\\").replace("'", "\\'") + "'" for e in offered_in[name])
            chosen = f"({chosen}) AND {period} IN ({listed})"
        return f"IF({chosen}, {1 << place}L, 0L)"

    words = [names[i : i + _WORD] for i in range(0, len(names), _WORD)]
    packed = [F.expr(" | ".join(bit(name, i) for i, name in enumerate(word))).alias(f"__w{w}") for w, word in enumerate(words)]
    rows = df.where(quoted(respondent).isNotNull()).select(quoted(respondent).alias("__id"), *packed)
    united = rows.groupBy("__id").agg(*[F.bit_or(f"__w{w}").alias(f"__w{w}") for w in range(len(words))])
    counts = united.agg(*[F.expr(f"count_if((__w{i // _WORD} & {1 << i % _WORD}L) <> 0L) AS __o{i}") for i in range(len(names))])
    number = F.substr("__option", F.lit(len("__o") + 1)).cast("int")
    long = counts.unpivot([], [f"__o{i}" for i in range(len(names))], "__option", users)
    return long.where(F.col(users) > 0).select(F.get(F.array(*[F.lit(n) for n in names]), number).alias(option), users)


def adoption_from_bridge(
    bridge: DataFrame,
    eligible: DataFrame | None = None,
    period: str = "survey_year",
    option: str = "technology",
    users: str = "technology_users",
) -> DataFrame:
    """The same table from a stored bridge.

    Without ``eligible`` the denominator is the number of rows an option has in the period: the
    bridge holds every eligible respondent once per option.
    """
    counted = bridge.groupBy(period, option).agg(
        rows_where(bridge, F.col("selected")).alias(users), rows_of(bridge).alias("eligible_respondents")
    )
    if eligible is not None:
        counted = counted.drop("eligible_respondents").join(eligible, period)
    return _with_rate(counted, users)


def _with_rate(df: DataFrame, users: str) -> DataFrame:
    return df.withColumn("adoption_rate", ratio(F.col(users), F.col("eligible_respondents")))


def nullable_flags(options: Mapping[str, str], asked: Column | None = None) -> dict[str, Column]:
    """Option columns as three-valued booleans: NULL unless the respondent was eligible."""
    shown = eligible(list(options))
    if asked is not None:
        shown = asked & shown
    return {name: F.when(shown, is_selected(c)) for c, name in options.items()}


def eligibility_agreement(df: DataFrame, period: str, blocks: Mapping[str, Sequence[str]]) -> DataFrame:
    """Eligible respondents of each block per period, and whether all blocks agree."""
    counts = df.groupBy(period).agg(*[F.count_if(eligible(cols)).alias(name) for name, cols in blocks.items()])
    first, *others = [F.col(name) for name in blocks]
    agree = F.lit(True)
    for other in others:
        agree = agree & (first == other)
    return counts.withColumn("blocks_agree", agree)

