"""The nine Gold tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelloom.operators.mapping import UNKNOWN
from panelloom.operators.options import adoption_from_bridge, option_bridge
from panelloom.operators.rates import availability_rates
from panelloom.operators.scoring import normalize, numbered_by, selected_users, user_profile, weighted_score
from panelloom.operators.shares import representation, share_within
from panelloom.operators.stats import distribution_stats
from panelloom.operators.trend import first_to_last, growth_between, with_change, with_rank
from panelloom.plans import survey_config as S

EDITION = "survey_year"
MARKET_DIMENSIONS = ("seniority", "gender", "current_work_model", "region", "employment_status")
YOY = "yoy_pp_change_vs_prev_survey"

# Dimensions that went through a mapping table carry UNKNOWN instead of NULL.
_MAPPED = ("current_role", "seniority", "current_work_model", "comparability_group")


def known(dimension: str):
    return F.col(dimension) != UNKNOWN if dimension in _MAPPED else F.col(dimension).isNotNull()


def market_overview(fact: DataFrame, null_policy: str = "drop") -> DataFrame:
    return share_within(fact, EDITION, MARKET_DIMENSIONS, null_policy=null_policy)


def compensation_by(fact: DataFrame, dimension: str) -> DataFrame:
    """Salary statistics per edition and value of one dimension."""
    return distribution_stats(fact.where(known(dimension)), [EDITION, dimension], "salary_midpoint", S.MIN_SAMPLE_SIZE)


def gender_representation(fact: DataFrame) -> DataFrame:
    value = F.col("cross_dimension_value")
    return representation(
        fact, EDITION, "gender", "salary_midpoint",
        {"overall": None, "seniority": "seniority", "current_role": "current_role", "region": "region"},
        keep={"seniority": value != UNKNOWN, "current_role": value != UNKNOWN},
        min_sample=S.MIN_SAMPLE_SIZE,
    )


def technology_adoption(adoption: DataFrame) -> DataFrame:
    """Rank and change against the previous edition on top of the adoption rates."""
    ranked = with_rank(adoption, EDITION, "adoption_rate")
    changed = with_change(ranked, "technology", EDITION, S.EDITIONS, "adoption_rate", YOY)
    return changed.select(
        "technology", EDITION, "technology_users", "eligible_respondents", "adoption_rate", "rank", YOY
    ).orderBy(EDITION, "rank", "technology")


def technology_adoption_from_bridge(bridge: DataFrame) -> DataFrame:
    return technology_adoption(adoption_from_bridge(bridge))


def ai_adoption_overview(fact: DataFrame) -> DataFrame:
    return availability_rates(
        fact, EDITION, "enterprise_ai_priority", S.AI_PRIORITY_METRIC, S.AI_TOP_PRIORITY, S.GENAI_METRICS,
        "genai_question_available", "genai_eligible", "genai_no_use", S.GENAI_USAGE_METRIC,
    )


def adoption_growth(adoption: DataFrame) -> DataFrame:
    return first_to_last(
        adoption, "technology", EDITION, S.EDITIONS[0], S.EDITIONS[-1], "adoption_rate", "adoption_growth_pp"
    )


PROFILE = ("current_role", "seniority", "salary_midpoint")


def skill_priority_score(bridge: DataFrame, fact: DataFrame, adoption: DataFrame, min_users: int = S.MIN_SAMPLE_SIZE) -> DataFrame:
    """Composite score of the latest edition from the stored bridge and fact."""
    now = F.col(EDITION) == S.EDITIONS[-1]
    people = fact.where(now)
    users = selected_users(bridge.where(now), people, ["respondent_id", EDITION], "technology", PROFILE)
    return score_users(users, people, adoption, min_users)


def skill_priority_score_wide(
    wide: DataFrame, options: Mapping[str, str], adoption: DataFrame, min_users: int = S.MIN_SAMPLE_SIZE, shown: str | None = None
) -> DataFrame:
    """The same score from rows that hold the harmonized profile and the option block side by side.

    Nothing is joined and no row-level data is shuffled: each task counts its own combinations.
    """
    people = wide.where(F.col(EDITION) == S.EDITIONS[-1])
    offered = {c: name for c, name in options.items() if S.EDITIONS[-1] in S.DATABASE_OFFERED_IN.get(name, S.EDITIONS)}
    users = option_bridge(people, [EDITION, *PROFILE], offered, shown=shown).where(F.col("selected"))
    return score_users(users, people, adoption, min_users)


def score_users(users: DataFrame, people: DataFrame, adoption: DataFrame, min_users: int) -> DataFrame:
    """Every component, its normalized form and the score, one row per option of the latest edition.

    Options without a first-to-last trend and options with too few users are not scored.
    """
    latest = S.EDITIONS[-1]
    now = F.col(EDITION) == latest
    profile = user_profile(users, people, EDITION, "technology", *PROFILE, S.SENIOR_LEVELS, min_users)
    trend = (
        adoption.groupBy("technology")
        .agg(
            growth_between(EDITION, S.EDITIONS[0], latest, "adoption_rate").alias("adoption_growth_pp"),
            F.max(F.when(now, F.col("eligible_respondents"))).alias("eligible"),
        )
        .where(F.col("adoption_growth_pp").isNotNull())
    )
    components = profile.join(trend, "technology").select(
        "technology",
        F.col("users").alias(f"{latest}_users"),
        F.col("eligible").alias(f"{latest}_eligible_respondents"),
        "adoption_growth_pp",
        F.col("breadth").alias("cross_role_prevalence"),
        F.col("value_lift").alias("salary_association"),
        F.col("senior_lift").alias("senior_role_prevalence"),
    )
    scored = weighted_score(normalize(components, list(S.SCORE_WEIGHTS)), S.SCORE_WEIGHTS, "priority_score")
    noted = scored.withColumn("future_interest_component", F.lit(S.FUTURE_INTEREST_NOTE))
    return numbered_by(noted, "priority_score", "technology")
