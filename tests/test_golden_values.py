"""Published result values, recomputed from the counts published with them."""

from __future__ import annotations

import pytest

from panelloom.operators import rates as A
from panelloom.operators import shares as SH
from panelloom.operators import stats as ST
from panelloom.plans import gold as G
from panelloom.plans import survey_config as S

EDITION = "survey_year"


def test_female_share_of_the_first_edition(spark):
    people = spark.createDataFrame([("year_1", "FEMALE", 1.0)] * 493 + [("year_1", "MALE", 1.0)] * (2645 - 493), f"{EDITION} string, gender string, salary_midpoint double")
    got = SH.representation(people, EDITION, "gender", "salary_midpoint", {"overall": None}).where("gender = 'FEMALE'").first()
    assert (got["respondent_count"], got["bucket_total"], round(got["share_within_bucket"], 5)) == (493, 2645, 0.18639)


def test_remote_share_falls(spark):
    published = {"year_1": (0.5047, 2645), "year_2": (0.4158, 5293), "year_3": (0.3668, 3495)}
    rows = [(e, m, n) for e, (share, total) in published.items() for m, n in (("REMOTE", round(share * total)), ("ON_SITE", total - round(share * total)))]
    counts = spark.createDataFrame(rows, f"{EDITION} string, current_work_model string, {SH.WEIGHT} bigint")
    got = {r[EDITION]: round(r["respondent_share_within_year"], 4) for r in SH.share_within(counts, EDITION, ["current_work_model"]).where("dimension_value = 'REMOTE'").collect()}
    assert got == {e: share for e, (share, _) in published.items()}


def test_adoption_of_the_latest_edition_and_its_change(spark):
    """Users of the second edition follow from the published rate and change."""
    rows = [(e, t, u, n, u / n) for e, t, u, n in (
        ("year_2", "PostgreSQL", 1068, 3772), ("year_3", "PostgreSQL", 771, 2096), ("year_2", "Databricks", 807, 3772), ("year_3", "Databricks", 689, 2096))]
    adoption = spark.createDataFrame(rows, f"{EDITION} string, technology string, technology_users bigint, eligible_respondents bigint, adoption_rate double")
    got = [(r["technology"], r["rank"], round(r["adoption_rate"], 5), r[G.YOY] and round(r[G.YOY], 3)) for r in G.technology_adoption(adoption).collect()]
    assert got == [("PostgreSQL", 1, 0.28314, None), ("Databricks", 2, 0.21394, None), ("PostgreSQL", 1, 0.36784, 8.47), ("Databricks", 2, 0.32872, 11.478)]


@pytest.mark.parametrize(("edition", "positive", "asked", "rate"), [("year_2", 324, 896, 0.36161), ("year_3", 395, 652, 0.60583)])
def test_enterprise_priority(spark, edition, positive, asked, rate):
    rows = [(edition, "TOP_PRIORITY_MAIN", positive), (edition, "DONT_KNOW", asked - positive), (edition, "NOT_ASKED", 1000)]
    facts = spark.createDataFrame([(e, a, n, True, False) for e, a, n in rows], f"{EDITION} string, a string, {SH.WEIGHT} bigint, available boolean, shown boolean")
    facts = facts.withColumn("no_use", facts["shown"])
    got = A.availability_rates(facts, EDITION, "a", "priority", S.AI_TOP_PRIORITY, {"no_use": "no_use_rate"}, "available", "shown", "no_use", "usage")
    found = got.where("metric = 'priority'").first()
    assert (found["eligible_respondents"], found["numerator"], round(found["rate"], 5)) == (asked, positive, rate)


@pytest.mark.parametrize(("edition", "eligible", "rate"), [("year_2", 3772, 0.80276), ("year_3", 2106, 0.97911)])
def test_personal_usage_is_the_complement_of_no_use(spark, edition, eligible, rate):
    users = round(rate * eligible)
    facts = spark.createDataFrame([(edition, "NOT_ASKED", users, True, True, False), (edition, "NOT_ASKED", eligible - users, True, True, True), (edition, "NOT_ASKED", 500, True, False, None)],
                                  f"{EDITION} string, a string, {SH.WEIGHT} bigint, available boolean, shown boolean, no_use boolean")
    got = A.availability_rates(facts, EDITION, "a", "priority", S.AI_TOP_PRIORITY, {"no_use": "no_use_rate"}, "available", "shown", "no_use", "usage")
    found = got.where("metric = 'usage'").first()
    assert (found["eligible_respondents"], round(found["rate"], 5)) == (eligible, rate)


def test_interpolated_quartile(spark):
    """A quartile between two band midpoints: a quarter of the way from 1500.5 and 2500.5 gives 2250.5."""
    rows = [("year_1", "ACADEMIC", v) for v in [1500.5, 2500.5, 2500.5, 3500.5]]
    got = ST.distribution_stats(spark.createDataFrame(rows, f"{EDITION} string, current_role string, v double"), [EDITION, "current_role"], "v").first()
    assert got["salary_p25"] == 2250.5


def test_the_weights_of_the_score_leave_out_what_was_not_measured():
    assert round(sum(S.SCORE_WEIGHTS.values()), 10) == 0.9
