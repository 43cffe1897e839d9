"""The sixteen answer tables. Each reads Gold tables only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelloom.operators.ranking import latest_only, sort_desc
from panelloom.operators.reshape import pivot_periods
from panelloom.plans import survey_config as S
from panelloom.plans.gold import EDITION, YOY

MEDIAN = "median_salary_midpoint"


def market_structure(overview: DataFrame, dimension: str) -> DataFrame:
    """Share within the edition, one column per edition, four decimals."""
    return pivot_periods(
        overview.where(F.col("dimension") == dimension),
        "dimension_value", EDITION, S.EDITIONS, "respondent_share_within_year", digits=4,
    )


def roles_by_salary(by_role: DataFrame) -> DataFrame:
    view = latest_only(by_role, EDITION).select(
        "current_role", "respondent_count", MEDIAN, "salary_iqr", "low_sample_flag"
    )
    return sort_desc(view, MEDIAN, "current_role")


def seniority_salary(by_seniority: DataFrame) -> DataFrame:
    return by_seniority.select(EDITION, "seniority", "respondent_count", MEDIAN)


def gender_overall(representation: DataFrame) -> DataFrame:
    return representation.where(F.col("cross_dimension") == "overall").select(
        EDITION, "gender", "respondent_count", "share_within_bucket", MEDIAN
    )


def _female(representation: DataFrame, dimension: str) -> DataFrame:
    return representation.where(
        (F.col("cross_dimension") == dimension) & (F.col("gender") == "FEMALE")
    ).withColumnRenamed("cross_dimension_value", dimension)


def female_share_by_seniority(representation: DataFrame) -> DataFrame:
    return _female(representation, "seniority").select(
        EDITION, "seniority", "respondent_count", "bucket_total", "share_within_bucket"
    )


def female_share_by_role(representation: DataFrame) -> DataFrame:
    newest = representation.select(F.max(EDITION)).scalar()
    view = (
        _female(representation, "current_role")
        .where(F.col(EDITION) == newest)
        .select("current_role", "respondent_count", "bucket_total", "share_within_bucket")
    )
    return sort_desc(view, "bucket_total", "current_role")


def technology_ranking(adoption: DataFrame) -> DataFrame:
    view = latest_only(adoption, EDITION).select(
        "technology", "technology_users", "eligible_respondents", "adoption_rate", YOY
    )
    return sort_desc(view, "adoption_rate", "technology")


def technology_change(adoption: DataFrame) -> DataFrame:
    view = latest_only(adoption, EDITION).select("technology", "adoption_rate", YOY)
    return sort_desc(view, YOY, "technology")


def ai_adoption(overview: DataFrame) -> DataFrame:
    return overview.select(EDITION, "metric", "question_available", "eligible_respondents", "numerator", "rate")


def ai_adoption_available(overview: DataFrame) -> DataFrame:
    """Only editions that had the question; the others are omitted, never shown as zero."""
    return overview.where(F.col("question_available")).select(EDITION, "metric", "eligible_respondents", "rate")


def region_salary(by_region: DataFrame) -> DataFrame:
    view = latest_only(by_region, EDITION).select(
        "region", "respondent_count", MEDIAN, "salary_iqr", "low_sample_flag"
    )
    return sort_desc(view, MEDIAN, "region")


def salary_by(compensation: DataFrame, dimension: str) -> DataFrame:
    """Median and spread per edition, for seniority or work model."""
    return compensation.select(EDITION, dimension, "respondent_count", MEDIAN, "salary_iqr")


def skill_ranking(score: DataFrame) -> DataFrame:
    view = score.select("rank", "technology", "priority_score", *S.SCORE_WEIGHTS)
    return sort_desc(view, "priority_score", "technology")


def all_answers(gold: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Answer name to table, from the Gold tables by name."""
    overview = gold["gold_market_overview"]
    representation = gold["gold_gender_representation"]
    adoption = gold["gold_technology_adoption_by_year"]
    by_seniority = gold["gold_compensation_by_seniority"]
    return {
        **{
            f"q1_market_structure_{d}": market_structure(overview, d)
            for d in ("seniority", "current_work_model", "employment_status", "region")
        },
        "q2_compensation_by_role_latest_year": roles_by_salary(gold["gold_compensation_by_role"]),
        "q2_compensation_by_seniority_all_years": seniority_salary(by_seniority),
        "q3_gender_overall_by_year": gender_overall(representation),
        "q3_gender_share_by_seniority": female_share_by_seniority(representation),
        "q3_gender_share_by_role_latest_year": female_share_by_role(representation),
        "q4_technology_adoption_latest_year": technology_ranking(adoption),
        "q4_technology_yoy_change_latest_year": technology_change(adoption),
        "q5_ai_adoption_overview": ai_adoption(gold["gold_ai_adoption_overview"]),
        "q6_compensation_by_region_latest_year": region_salary(gold["gold_compensation_by_region"]),
        "q6_compensation_by_seniority_all_years": salary_by(by_seniority, "seniority"),
        "q6_compensation_by_work_model_all_years": salary_by(
            gold["gold_compensation_by_work_model"], "current_work_model"
        ),
        "q7_skill_priority_ranking": skill_ranking(gold["gold_skill_priority_score"]),
    }
