"""Row order, which the comparison with SQL does not see."""

from __future__ import annotations

import random

from panelloom.operators import ranking as R
from panelloom.plans import gold as G
from panelloom.plans import survey_config as S


def test_descending_with_ties_and_missing_values(spark):
    r = random.Random(1)
    data = [(f"k{i:02d}", r.choice([1.0, 2.0, 3.5, None])) for i in range(40)]
    df = spark.createDataFrame(data, "k string, v double").repartition(6)
    got = [tuple(x) for x in R.sort_desc(df, "v", "k").collect()]
    assert got == sorted(data, key=lambda x: (x[1] is None, -(x[1] or 0), x[0]))
    known = [x for x in data if x[1] is not None]
    assert [tuple(x) for x in R.top_k(df, 7, "v", "k").collect()] == sorted(known, key=lambda x: (-x[1], x[0]))[:7]
    assert [tuple(x) for x in R.bottom_k(df, 7, "v", "k").collect()] == sorted(known, key=lambda x: (x[1], x[0]))[:7]


def test_a_fixed_category_order(spark):
    order = ["JUNIOR", "MID", "SENIOR", "SPECIALIST"]
    data = [(o, n) for n in (2, 1) for o in ("SENIOR", "JUNIOR", "SPECIALIST", "MID")]
    df = spark.createDataFrame(data, "level string, n int").repartition(4)
    got = [tuple(x) for x in R.in_domain_order(df, "level", order, "n").collect()]
    assert got == sorted(data, key=lambda x: (order.index(x[0]), x[1]))


def test_adoption_is_sorted_by_edition_rank_and_name(spark):
    r = random.Random(2)
    data = [(e, f"t{i:02d}", 10, 100, r.choice([0.1, 0.2, 0.3])) for e in S.EDITIONS for i in range(12)]
    df = spark.createDataFrame(data, "survey_year string, technology string, technology_users bigint, eligible_respondents bigint, adoption_rate double").repartition(5)
    got = [(x["survey_year"], x["technology"]) for x in G.technology_adoption(df).collect()]
    assert got == [(e, t) for e, t, _, _, v in sorted(data, key=lambda x: (x[0], -x[4], x[1]))]
