"""Operators on small frames, including NULL, tie and empty cases."""

from __future__ import annotations

import random

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from panelloom.functions import scalars as X
from panelloom.operators import options as O
from panelloom.operators import quality as Q
from panelloom.operators import ranking as R
from panelloom.operators import rates as A
from panelloom.operators import reshape as RS
from panelloom.operators import scoring as SC
from panelloom.operators import shares as SH
from panelloom.operators import stats as ST
from panelloom.operators import trend as TR


def test_flags_keys_and_ratios(spark):
    df = spark.createDataFrame([("1.0",), ("0",), ("2",), ("x",), (None,)], "v string")
    got = df.select("v", X.flag_to_boolean(F.col("v")).alias("f"), X.is_selected("v").alias("s"))
    assert {r["v"]: (r["f"], r["s"]) for r in got.collect()} == {
        "1.0": (True, True), "0": (False, False), "2": (None, False), "x": (None, False), None: (None, False),
    }
    one = spark.range(1)
    assert one.select(X.numbered_key(F.lit("year_1"), F.lit(42))).first()[0] == "year_1_000042"
    assert one.select(X.numbered_key(F.lit("year_1"), F.lit(12345678))).first()[0] == "year_1_12345678"
    assert one.select(X.ratio(F.lit(1), F.lit(0))).first()[0] is None
    assert one.select(X.relative_lift(F.lit(3.0), F.lit(2.0))).first()[0] == 0.5


PEOPLE = [
    ("year_1", "A", "x", 10.0), ("year_1", "A", None, None), ("year_1", "B", "x", 20.0), ("year_2", "A", "y", 5.0),
]
PEOPLE_SCHEMA = "survey_year string, g string, d string, v double"


def test_share_drops_missing_values_from_both_sides(spark):
    df = spark.createDataFrame(PEOPLE, PEOPLE_SCHEMA)
    drop = SH.share_within(df, "survey_year", ["g", "d"])
    assert rows(drop.where("survey_year = 'year_1'")) == [
        ("year_1", "d", "x", 2, 1.0), ("year_1", "g", "A", 2, 2 / 3), ("year_1", "g", "B", 1, 1 / 3),
    ]
    keep = SH.share_within(df, "survey_year", ["d"], null_policy="keep").where("survey_year = 'year_1'")
    assert rows(keep) == [("year_1", "d", None, 1, 1 / 3), ("year_1", "d", "x", 2, 2 / 3)]
    with pytest.raises(ValueError):
        SH.share_within(df, "survey_year", ["d"], null_policy="fill")


def test_representation_totals_and_missing_medians(spark):
    df = spark.createDataFrame(PEOPLE, PEOPLE_SCHEMA)
    out = SH.representation(df, "survey_year", "g", "v", {"overall": None, "d": "d"}, min_sample=2)
    assert rows(out.where("survey_year = 'year_1'")) == [
        ("year_1", "A", "d", "x", 1, 2, 0.5, 10.0, True),
        ("year_1", "A", "overall", "ALL", 2, 3, 2 / 3, 10.0, False),
        ("year_1", "B", "d", "x", 1, 2, 0.5, 20.0, True),
        ("year_1", "B", "overall", "ALL", 1, 3, 1 / 3, 20.0, True),
    ]


def test_stats_match_numpy_and_keep_groups_without_values(spark):
    random.seed(3)
    data = [("a", random.choice([1.5, 2.5, 7.0, None])) for _ in range(101)] + [("b", None)] * 3
    out = {r["k"]: r for r in ST.distribution_stats(spark.createDataFrame(data, "k string, v double"), ["k"], "v").collect()}
    known = [v for k, v in data if k == "a" and v is not None]
    a, b = out["a"], out["b"]
    assert (a["respondent_count"], a["salary_known_count"], a["low_sample_flag"]) == (101, len(known), False)
    assert a["mean_salary_midpoint"] == pytest.approx(np.mean(known))
    assert [a["salary_p25"], a["median_salary_midpoint"], a["salary_p75"]] == list(np.percentile(known, [25, 50, 75]))
    assert (b["respondent_count"], b["salary_known_count"], b["low_sample_flag"]) == (3, 0, True)
    assert b["median_salary_midpoint"] is None and b["salary_iqr"] is None and b["mean_salary_midpoint"] is None


def test_interpolated_quartile(spark):
    df = spark.createDataFrame([(1, 1500.5), (1, 1500.5), (1, 2500.5), (1, 3500.5)], "k int, v double")
    assert ST.distribution_stats(df, ["k"], "v").first()["salary_p75"] == 2750.5


@pytest.mark.parametrize("shift", [-1e6, -3.0, 2.0, 1e6])
def test_a_bracket_that_misses_its_rank_is_widened(spark, monkeypatch, shift):
    """The first brackets lie beside the values asked for; the exact counts show it and the groups go round again."""
    true_brackets, widths = ST._brackets, []

    def misplaced(rows, groups, probabilities, width, accuracy):
        widths.append(width)
        found = true_brackets(rows, groups, probabilities, width, accuracy)
        if len(widths) > 2:
            return found
        moved = {c: F.transform(c, lambda e: e + F.lit(shift)) for c in ("__lo", "__hi")}
        return found.withColumns({c: F.when(F.col("__k0") == "a", m).otherwise(F.col(c)) for c, m in moved.items()})

    monkeypatch.setattr(ST, "_brackets", misplaced)
    rng = np.random.default_rng(4)
    values = {k: rng.normal(size=400) for k in ("a", "b")}
    df = spark.createDataFrame([(k, float(v)) for k, vs in values.items() for v in vs], "k string, v double")
    got = {r["k"]: r["quantiles"] for r in ST.exact_quantiles(df, ["k"], "v", [0.25, 0.5, 0.9], accuracy=100).collect()}
    assert len(widths) == 3 and widths[0] < widths[1] < widths[2]
    for k in values:
        assert np.allclose(got[k], np.quantile(values[k], [0.25, 0.5, 0.9]), rtol=0, atol=1e-12)


@pytest.mark.parametrize("accuracy", [20, 2000])
def test_exact_quantiles_match_numpy_on_skewed_and_stretched_groups(spark, accuracy):
    rng = np.random.default_rng(5)
    groups = {
        "hot": list(rng.normal(100, 20, 4000)),
        "log-normal": list(rng.lognormal(0, 5, 4000)),
        "same": [7.0] * 50,
        "one": [3.25],
        "stretched": [*rng.uniform(0, 1, 500), 1e12, -1e12],
        "ties": [float(v) for v in rng.integers(0, 4, 300)],
        None: [1.0, 2.0, 4.0],
    }
    data = [(k, float(v)) for k, vs in groups.items() for v in vs] + [("hot", None), ("none", None)]
    probabilities = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]
    df = spark.createDataFrame(data, "k string, v double").repartition(5)
    got = {r["k"]: r["quantiles"] for r in ST.exact_quantiles(df, ["k"], "v", probabilities, accuracy).collect()}
    assert set(got) == set(groups)
    for key, values in groups.items():
        np.testing.assert_allclose(got[key], np.percentile(values, [p * 100 for p in probabilities]), rtol=1e-9, atol=1e-9)


BLOCK = [
    ("r1", "year_1", "1.0", "0.0", None), ("r2", "year_1", None, None, None), ("r3", "year_1", "0.0", None, "1"),
    ("r4", "year_2", "1", "1", None),
]
BLOCK_SCHEMA = "respondent_id string, survey_year string, `4.d.1_A` string, b string, c string"
OPTIONS = {"4.d.1_A": "A", "b": "B", "c": "C"}


def test_bridge_holds_eligible_respondents_times_offered_options(spark):
    df = spark.createDataFrame(BLOCK, BLOCK_SCHEMA)
    bridge = O.option_bridge(df, ["respondent_id", "survey_year"], OPTIONS, family="F", offered_in={"C": ["year_1"]})
    assert rows(bridge) == [
        ("r1", "year_1", "A", "F", True), ("r1", "year_1", "B", "F", False), ("r1", "year_1", "C", "F", False),
        ("r3", "year_1", "A", "F", False), ("r3", "year_1", "B", "F", False), ("r3", "year_1", "C", "F", True),
        ("r4", "year_2", "A", "F", True), ("r4", "year_2", "B", "F", True),
    ]
    wide = O.option_adoption(df, OPTIONS, offered_in={"C": ["year_1"]})
    long = O.adoption_from_bridge(bridge)
    columns = ["survey_year", "technology", "technology_users", "eligible_respondents", "adoption_rate"]
    assert rows(wide.select(columns)) == rows(long.select(columns))


def test_two_columns_of_one_option_count_once_in_the_bridge(spark):
    df = spark.createDataFrame(BLOCK, BLOCK_SCHEMA)
    merged = O.option_bridge(df, ["respondent_id", "survey_year"], {"4.d.1_A": "A", "b": "A", "c": "C"})
    assert rows(merged.where("technology = 'A'")) == [
        ("r1", "year_1", "A", True), ("r3", "year_1", "A", False), ("r4", "year_2", "A", True),
    ]


def test_nullable_flags_keep_three_values_apart(spark):
    df = spark.createDataFrame(BLOCK, BLOCK_SCHEMA)
    flags = O.nullable_flags({"4.d.1_A": "a", "b": "b"}, F.col("survey_year") == "year_1")
    got = df.select("respondent_id", *[c.alias(n) for n, c in flags.items()])
    assert rows(got) == [("r1", True, False), ("r2", None, None), ("r3", False, False), ("r4", None, None)]


ADOPTION = [
    ("year_1", "A", 0.5), ("year_1", "B", 0.5), ("year_1", "C", 0.1), ("year_2", "A", 0.6), ("year_3", "A", 0.4), ("year_3", "B", 0.7),
]


def test_rank_leaves_gaps_and_change_never_crosses_a_gap(spark):
    df = spark.createDataFrame(ADOPTION, "survey_year string, technology string, rate double")
    ranked = TR.with_rank(df, "survey_year", "rate").where("survey_year = 'year_1'")
    assert rows(ranked.select("technology", "rank")) == [("A", 1), ("B", 1), ("C", 3)]
    changed = TR.with_change(df, "technology", "survey_year", ["year_1", "year_2", "year_3"], "rate", "pp")
    got = {(r["technology"], r["survey_year"]): r["pp"] for r in changed.collect()}
    assert got[("A", "year_2")] == pytest.approx(10.0) and got[("A", "year_3")] == pytest.approx(-20.0)
    assert got[("B", "year_3")] is None and got[("A", "year_1")] is None
    growth = TR.first_to_last(df, "technology", "survey_year", "year_1", "year_3", "rate", "pp")
    assert {r["technology"]: r["pp"] and round(r["pp"], 6) for r in growth.collect()} == {"A": -10.0, "B": 20.0, "C": None}
    assert rows(TR.without_trend(growth, "technology", "pp")) == [("C",)]


def test_rates_tell_not_available_from_zero(spark):
    data = [
        ("year_1", "NOT_AVAILABLE", None, False, False), ("year_2", "TOP", True, True, True), ("year_2", "DONT_KNOW", False, True, True),
        ("year_2", "NOT_ASKED", None, True, False),
    ]
    df = spark.createDataFrame(data, "y string, p string, no_use boolean, av boolean, el boolean")
    out = A.availability_rates(df, "y", "p", "priority", ["TOP"], {"no_use": "no_use_rate"}, "av", "el", "no_use", "use_rate")
    assert rows(out) == [
        ("year_1", "no_use_rate", False, 0, None, None), ("year_1", "priority", False, 0, None, None),
        ("year_1", "use_rate", False, 0, None, None), ("year_2", "no_use_rate", True, 2, 1.0, 0.5),
        ("year_2", "priority", True, 2, 1.0, 0.5), ("year_2", "use_rate", True, 2, 1.0, 0.5),
    ]
    full = A.scaffold(out, "y", ["year_1", "year_2", "year_3"], "metric", ["priority"])
    assert rows(full)[-1] == ("year_3", "priority", False, 0, None, None)
    assert rows(A.availability_by_period(out, "y")) == [("year_1", False), ("year_2", True)]


def test_normalize_constant_column_and_score(spark):
    df = spark.createDataFrame([("a", 1.0, 5.0), ("b", 3.0, 5.0), ("c", 2.0, 5.0)], "t string, x double, y double")
    for normalize in (SC.normalize, SC.normalize_rows):
        assert rows(normalize(df, ["x", "y"]).select("t", "normalized_x", "normalized_y")) == [
            ("a", 0.0, 0.0), ("b", 1.0, 0.0), ("c", 0.5, 0.0),
        ]
    scored = SC.numbered_by(SC.weighted_score(SC.normalize(df, ["x", "y"]), {"x": 0.3, "y": 0.1}, "s"), "s", "t")
    assert {r["t"]: (round(r["s"], 9), r["rank"]) for r in scored.collect()} == {"b": (0.75, 1), "c": (0.375, 2), "a": (0.0, 3)}


def test_top_k_movers_and_latest(spark):
    df = spark.createDataFrame([("a", 3.0), ("b", -2.0), ("c", 3.0), ("d", None), ("e", 0.0)], "t string, x double")
    assert [r["t"] for r in R.top_k(df, 2, "x", "t").collect()] == ["a", "c"]
    assert [r["t"] for r in R.bottom_k(df, 2, "x", "t").collect()] == ["b", "e"]
    moved = R.movers(df, 3, "t", "x", ("up", "down"))
    assert rows(moved) == [("a", 3.0, "up"), ("b", -2.0, "down"), ("c", 3.0, "up"), ("e", 0.0, "down")]
    years = spark.createDataFrame([("year_1", 1), ("year_3", 2), ("year_3", 3)], "y string, n int")
    assert rows(R.latest_only(years, "y")) == [("year_3", 2), ("year_3", 3)]
    ordered = R.in_domain_order(df, "t", ["c", "a", "b", "d", "e"])
    assert [r["t"] for r in ordered.collect()] == ["c", "a", "b", "d", "e"]


def test_pivot_and_melt(spark):
    df = spark.createDataFrame([("A", "year_1", 0.12345), ("A", "year_2", 0.5), ("B", "year_2", 1.0)], "v string, y string, s double")
    wide = RS.pivot_periods(df, "v", "y", ["year_1", "year_2"], "s", digits=4)
    assert rows(wide) == [("A", 0.1235, 0.5), ("B", None, 1.0)]
    assert rows(RS.melt(wide, ["v"], ["year_1", "year_2"], "y", "s")) == [("A", "year_1", 0.1235), ("A", "year_2", 0.5), ("B", "year_2", 1.0)]


def test_quality_reports(spark):
    df = spark.createDataFrame(
        [("year_1", 1, "a", None), ("year_1", 2, "a", None), ("year_1", 3, "b", "UNKNOWN"), ("year_2", 4, "a", None)],
        "y string, id int, v string, w string",
    )
    assert rows(Q.duplicate_rows(df, "y", ignore=["id"])) == [("year_1", 1), ("year_2", 0)]
    assert rows(Q.duplicate_rows(df, "y")) == [("year_1", 0), ("year_2", 0)]
    assert rows(Q.repeated_keys(df, ["v"])) == [("a", 3)]
    assert rows(Q.missing_profile(df, ["v", "w"])) == [("v", 0.0), ("w", 0.75)]
    assert rows(Q.value_rate_matrix(df, "y", ["year_1", "year_2"], ["w"])) == [("w", pytest.approx(1 / 3), 0.0)]
    assert rows(Q.reconcile(df, df.where("id < 4"), "y")) == [("year_1", 3, 3, 0), ("year_2", 1, 0, 1)]
    status = Q.answer_status(df.withColumn("e", F.col("id") != 4), "y", "w", {"year_1": True, "year_2": True}, "e", ["UNKNOWN"])
    assert rows(status) == [("year_1", "INVALID", 1), ("year_1", "NOT_ANSWERED", 2), ("year_2", "NOT_ELIGIBLE", 1)]


def test_empty_input_gives_empty_output(spark):
    df = spark.createDataFrame([], PEOPLE_SCHEMA)
    assert rows(SH.share_within(df, "survey_year", ["g"])) == []
    assert rows(ST.distribution_stats(df, ["g"], "v")) == []
    assert rows(ST.exact_quantiles(df, ["g"], "v", [0.5])) == []


def test_null_period_counts_like_any_other(spark):
    df = spark.createDataFrame([(None, "a", None, 0.0), (None, "a", None, -0.0), ("y", "a", None, 1.0), ("y", None, "a", 1.0)], "y string, p string, q string, d double")
    assert rows(Q.duplicate_rows(df, "y")) == [(None, 1), ("y", 0)]
    assert rows(Q.reconcile(df, df.limit(0), "y")) == [(None, 2, 0, 2), ("y", 2, 0, 2)]


def test_an_option_in_two_columns_counts_a_respondent_once(spark):
    df = spark.createDataFrame([("year_1", "1", "1"), ("year_1", "0", "0"), ("year_1", "0", "1")], "survey_year string, a string, b string")
    options = {"a": "X", "b": "X"}
    wide = O.option_adoption(df, options)
    long = O.adoption_from_bridge(O.option_bridge(df.withColumn("id", F.monotonically_increasing_id()), ["id", "survey_year"], options))
    assert rows(wide.select("technology_users", "eligible_respondents")) == rows(long.select("technology_users", "eligible_respondents")) == [(2, 3)]


def test_keys_beyond_six_digits_come_after_shorter_ones(spark):
    keys = [("y1", f"y1_{n:06d}") for n in (999_999, 1_000_000, 1_000_000, 7)] + [("y2", "y2_000000"), ("y2", None)]
    found = rows(Q.key_profile(spark.createDataFrame(keys, "survey_year string, k string"), "survey_year", "k"))
    assert found == [("y1", 4, 3, "y1_000007", "y1_1000000"), ("y2", 2, 1, "y2_000000", "y2_000000")]
    numbers = spark.createDataFrame([("y1", 9), ("y1", 10), ("y1", -30)], "survey_year string, k bigint")
    assert rows(Q.key_profile(numbers, "survey_year", "k")) == [("y1", 3, 3, -30, 10)]


def test_distinct_users_over_repeated_rows_and_many_options(spark):
    options = {f"c{i}": f"O'{i}" for i in range(70)} | {"c70": "O'3"}
    rng = random.Random(5)
    data = [(rng.choice([None, "a", "b", "c", "d"]), rng.choice(["y1", "y2"]), *[rng.choice(["1", "0.0", None, "x"]) if i % 9 else "0" for i in range(71)]) for _ in range(12)]
    df = spark.createDataFrame(data, "id string, survey_year string, " + ", ".join(f"c{i} string" for i in range(71)))
    offered = {"O'3": ["y1"], "O'69": ["y2"]}
    bridge = O.option_bridge(df.withColumn("row", F.monotonically_increasing_id()), ["row", "id", "survey_year"], options, offered_in=offered)
    want = rows(bridge.where("selected and id is not null").groupBy("technology").agg(F.count_distinct("id")))
    got = O.option_users(df, "id", options, offered_in=offered)
    assert want and rows(got) == want
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan.split("bit_or")[-1]  # options are taken apart after respondents were united
    assert rows(O.option_users(df.limit(0), "id", options)) == []
