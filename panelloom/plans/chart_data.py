"""Data behind the charts: answer tables with display labels, cut to what is drawn."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelloom.functions.scalars import display_label, position_in
from panelloom.operators.ranking import in_domain_order, movers, top_k
from panelloom.operators.reshape import melt
from panelloom.plans import survey_config as S
from panelloom.plans.answers import MEDIAN
from panelloom.plans.gold import EDITION, YOY

EDITION_LABEL = "survey_year_label"


def with_edition_label(df: DataFrame) -> DataFrame:
    return df.withColumn(EDITION_LABEL, display_label(F.col(EDITION), S.EDITION_LABELS, keep_unknown=False))


def share_mix(structure: DataFrame, labels: Mapping[str, str]) -> DataFrame:
    """Shares of the named categories, long by edition, in the order of ``labels``."""
    shown = structure.where(F.col("dimension_value").isin(*labels))
    long = melt(shown, ["dimension_value"], list(S.EDITIONS), EDITION, "value")
    labelled = with_edition_label(long).withColumn("dimension_label", display_label(F.col("dimension_value"), labels))
    ordered = in_domain_order(labelled, "dimension_value", list(labels), EDITION)
    return ordered.select("dimension_label", EDITION, EDITION_LABEL, "value")


def salary_by_role(roles: DataFrame, k: int = 10) -> DataFrame:
    """Best-paid roles; an asterisk marks a small sample."""
    label = F.concat(
        display_label(F.col("current_role"), S.ROLE_LABELS),
        F.when(F.col("low_sample_flag"), F.lit("*")).otherwise(F.lit("")),
    )
    return top_k(roles, k, MEDIAN, "current_role").select(label.alias("role_label"), MEDIAN, "respondent_count")


def salary_by_category(table: DataFrame, column: str, label: str, labels: Mapping[str, str]) -> DataFrame:
    shown = with_edition_label(table).withColumn(label, display_label(F.col(column), labels, keep_unknown=False))
    return shown.select(EDITION, EDITION_LABEL, label, MEDIAN).orderBy(position_in(F.col(column), list(labels)), EDITION)


def gender_by_edition(overall: DataFrame) -> DataFrame:
    shown = with_edition_label(overall.where(F.col("gender").isin(*S.GENDER_LABELS)))
    return shown.withColumn("gender_label", display_label(F.col("gender"), S.GENDER_LABELS)).select(
        EDITION, EDITION_LABEL, "gender_label", "share_within_bucket"
    )


def gender_funnel(by_seniority: DataFrame) -> DataFrame:
    """Female share along the career, first against last edition."""
    ends = (S.EDITIONS[0], S.EDITIONS[-1])
    shown = with_edition_label(by_seniority.where(F.col(EDITION).isin(*ends)))
    labelled = shown.withColumn("seniority_label", display_label(F.col("seniority"), S.SENIORITY_LABELS, keep_unknown=False))
    return in_domain_order(labelled, "seniority", list(S.SENIORITY_LABELS), EDITION).select(
        "seniority_label", EDITION, EDITION_LABEL, "share_within_bucket"
    )


def top_technologies(ranking: DataFrame, k: int = 10) -> DataFrame:
    return top_k(ranking, k, "adoption_rate", "technology").select("technology", "adoption_rate")


def technology_movers(change: DataFrame, k: int = 6) -> DataFrame:
    return movers(change, k, "technology", YOY, S.CHANGE_SIGN_LABELS)


def ai_metrics(overview: DataFrame) -> DataFrame:
    """Three headline metrics for the editions that asked."""
    shown = overview.where(F.col("question_available") & F.col("metric").isin(*S.AI_METRIC_LABELS))
    return with_edition_label(shown).select(
        EDITION, EDITION_LABEL, display_label(F.col("metric"), S.AI_METRIC_LABELS).alias("metric_label"), "rate"
    )


def region_spread(regions: DataFrame) -> DataFrame:
    """Median with half the IQR to either side, and the group size."""
    half = F.col("salary_iqr") / 2
    return regions.select(
        "region", "respondent_count", MEDIAN, half.alias("spread"),
        (F.col(MEDIAN) - half).alias("low"), (F.col(MEDIAN) + half).alias("high"),
    )


def top_skills(ranking: DataFrame, k: int = 10) -> DataFrame:
    return top_k(ranking, k, "priority_score", "technology").select("technology", "priority_score")


def all_charts(answers: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    seniority = answers["q2_compensation_by_seniority_all_years"]
    work_model = answers["q6_compensation_by_work_model_all_years"]
    return {
        "chart_seniority_mix": share_mix(answers["q1_market_structure_seniority"], S.SENIORITY_LABELS),
        "chart_work_model_mix": share_mix(answers["q1_market_structure_current_work_model"], S.WORK_MODEL_MIX_LABELS),
        "chart_salary_by_role": salary_by_role(answers["q2_compensation_by_role_latest_year"]),
        "chart_salary_by_seniority": salary_by_category(seniority, "seniority", "seniority_label", S.SENIORITY_LABELS),
        "chart_gender_by_edition": gender_by_edition(answers["q3_gender_overall_by_year"]),
        "chart_gender_funnel": gender_funnel(answers["q3_gender_share_by_seniority"]),
        "chart_top_technologies": top_technologies(answers["q4_technology_adoption_latest_year"]),
        "chart_technology_movers": technology_movers(answers["q4_technology_yoy_change_latest_year"]),
        "chart_ai_metrics": ai_metrics(answers["q5_ai_adoption_overview"]),
        "chart_region_spread": region_spread(answers["q6_compensation_by_region_latest_year"]),
        "chart_salary_by_work_model": salary_by_category(
            work_model, "current_work_model", "work_model_label", S.WORK_MODEL_SALARY_LABELS
        ),
        "chart_top_skills": top_skills(answers["q7_skill_priority_ranking"]),
    }
