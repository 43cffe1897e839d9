"""Gold that follows every landing: each batch is counted once, Gold is made from the counts of all batches.

Four tables of counts hold what the nine Gold tables need: respondents by harmonized dimensions and salary midpoint, options by
edition and answer, users of an option by profile, and the AI block. They are bounded by the vocabularies, not by the rows, so Gold costs the
same after the thousandth batch as after the first, and landing reads nothing but the new batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelloom.operators import state
from panelloom.operators.options import adoption_from_bridge
from panelloom.operators.scoring import selected_users
from panelloom.plans import gold as G
from panelloom.plans import survey_config as S
from panelloom.plans.survey_job import DIMENSION_TABLES, SilverTables

EDITION, OPTION = "survey_year", "technology"
PEOPLE = tuple(dict.fromkeys((EDITION, *G.MARKET_DIMENSIONS, *DIMENSION_TABLES.values(), "salary_midpoint")))
_AI = (EDITION, "enterprise_ai_priority", *S.GENAI_METRICS, "genai_question_available", "genai_eligible")


def count_batch(tables: SilverTables, root: str, batch: str, users: DataFrame | None = None) -> None:
    """Count one batch's Silver rows; the same batch again replaces its counts.

    ``users`` has one row per option a respondent uses, with the profile. Give it where option block and profile sit in one row (see
    :func:`panelloom.operators.options.option_bridge`, with the profile as ids); otherwise the bridge is joined with the respondents.
    """
    if users is None:
        users = selected_users(tables.bridge, tables.fact, ["respondent_id", EDITION], OPTION, G.PROFILE)
    for name, (df, keys) in {
        "people": (tables.fact, PEOPLE),
        "options": (tables.bridge, (EDITION, OPTION, "selected")),
        "users": (users, (EDITION, OPTION, *G.PROFILE)),
        "ai": (tables.ai, _AI),
    }.items():
        state.write_counts(df, keys, f"{root.rstrip('/')}/{name}", batch)


def gold_from_counts(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The nine Gold tables over all batches counted below ``root``."""
    def counts(name: str) -> DataFrame:
        return state.read_counts(spark, f"{root.rstrip('/')}/{name}")

    people, options = counts("people"), counts("options")
    adoption = adoption_from_bridge(options)
    latest = F.col(EDITION) == S.EDITIONS[-1]
    return {
        "gold_market_overview": G.market_overview(people),
        **{name: G.compensation_by(people, dimension) for name, dimension in DIMENSION_TABLES.items()},
        "gold_gender_representation": G.gender_representation(people),
        "gold_technology_adoption_by_year": G.technology_adoption(adoption),
        "gold_ai_adoption_overview": G.ai_adoption_overview(counts("ai")),
        "gold_skill_priority_score": G.score_users(counts("users").where(latest), people.where(latest), adoption, S.MIN_SAMPLE_SIZE),
    }
