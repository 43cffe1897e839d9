"""Formulas against published result tables, where a folder with them is at hand.

Set PANELLOOM_GOLDEN_DIR to a folder of ``<table>/<table>.csv`` results and their
``business_answers``. The tables are fed back into the operators and the answers.
"""

from __future__ import annotations

import os

import pytest

from panelloom.operators import trend as TR
from panelloom.operators.scoring import normalize, numbered_by, weighted_score
from panelloom.plans import answers as AN
from panelloom.plans import survey_config as S
from panelloom.plans.gold import YOY

GOLDEN = os.environ.get("PANELLOOM_GOLDEN_DIR", "")
pytestmark = pytest.mark.skipif(not os.path.isdir(GOLDEN), reason="no golden tables at hand")

TABLES = (
    "gold_compensation_by_role", "gold_compensation_by_seniority", "gold_compensation_by_region", "gold_compensation_by_work_model",
    "gold_gender_representation", "gold_technology_adoption_by_year", "gold_ai_adoption_overview", "gold_skill_priority_score",
)


def read(spark, path):
    return spark.read.option("header", True).option("inferSchema", True).option("escape", '"').csv(path)


@pytest.fixture(scope="module")
def gold(spark):
    tables = {name: read(spark, f"{GOLDEN}/{name}/{name}.csv") for name in TABLES}
    tables["gold_market_overview"] = read(spark, f"{GOLDEN}/market_overview/gold_market_overview.csv")
    return tables


def same(got, want, digits=9):
    def cells(df):
        ordered = sorted(df.columns)
        return sorted(
            tuple(f"{round(v, digits) + 0.0}" if isinstance(v, float) else str(v) for v in (r[c] for c in ordered))
            for r in df.collect()
        )

    assert sorted(got.columns) == sorted(want.columns)
    assert cells(got) == cells(want)


def test_rank_and_change(gold):
    golden = gold["gold_technology_adoption_by_year"]
    ranked = TR.with_rank(golden.drop("rank", YOY), "survey_year", "adoption_rate")
    same(TR.with_change(ranked, "technology", "survey_year", S.EDITIONS, "adoption_rate", YOY), golden)


def test_score_recomposed_from_its_components(gold):
    golden = gold["gold_skill_priority_score"].drop("future_interest_component")
    parts = golden.select("technology", "year_3_users", "year_3_eligible_respondents", *S.SCORE_WEIGHTS)
    scored = weighted_score(normalize(parts, list(S.SCORE_WEIGHTS)), S.SCORE_WEIGHTS, "priority_score")
    same(numbered_by(scored, "priority_score", "technology"), golden)


def test_growth_component(gold):
    growth = TR.first_to_last(
        gold["gold_technology_adoption_by_year"], "technology", "survey_year", "year_1", "year_3", "adoption_rate", "adoption_growth_pp"
    )
    scored = gold["gold_skill_priority_score"].select("technology", "adoption_growth_pp")
    same(growth.join(scored.select("technology"), "technology", "left_semi"), scored)
    assert [r[0] for r in TR.without_trend(growth, "technology", "adoption_growth_pp").collect()] == ["SAP"]


def test_all_sixteen_answers(spark, gold):
    answers = AN.all_answers(gold)
    assert len(answers) == 16
    for name, table in answers.items():
        same(table, read(spark, f"{GOLDEN}/business_answers/{name}.csv"))
