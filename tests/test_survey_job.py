"""Three generated editions from raw CSV to answers, against a plain recount."""

from __future__ import annotations

import csv
import random
from collections import Counter

import numpy as np
import pytest
from conftest import rows

from panelloom.plans import landing, silver, survey_job
from panelloom.plans import survey_config as S

SENIORITY = ["Júnior", "Pleno", "Sênior", "Especialista/Staff+", ""]
REGIONS = ["Sudeste", "Sul", ""]
ROLES = {e: [r for r, scope, *_ in S.ROLE if r and (scope == "all" or e in scope)] + [""] for e in S.EDITIONS}


def make_edition(edition: str, count: int, seed: int) -> tuple[list[str], list[dict]]:
    """Header and answers: blank blocks, all-zero blocks, blanks in every mapped field."""
    rng = random.Random(seed)
    headers = landing.edition_headers(edition)
    people = []
    for number in range(count):
        block = rng.choice(["blank", "zeros", "some", "some"])
        person = {}
        for header, field in headers.items():
            if field is None:
                value = ""
            elif field.startswith(("db_", "ai_")) and field != "ai_priority":
                value = "" if block == "blank" else "0.0" if block == "zeros" else rng.choice(["1.0", "0.0", ""])
            elif field == "ai_priority":
                value = rng.choice([a or "" for a, _ in S.AI_PRIORITY])
            elif field == "seniority":
                value = rng.choice(SENIORITY)
            elif field == "gender":
                value = rng.choice(["Masculino", "Feminino", "Outro", ""])
            elif field == "region":
                value = rng.choice(REGIONS)
            elif field == "current_role":
                value = rng.choice(ROLES[edition])
            elif field == "salary_band":
                value = rng.choice([*S.SALARY_BAND_LABELS, ""])
            elif field in ("current_work_model", "ideal_work_model"):
                value = rng.choice([a or "" for a, _ in S.WORK_MODEL])
            elif field == "employment_status":
                value = rng.choice([a or "" for a, _ in S.EMPLOYMENT_STATUS])
            elif field == "manager_flag":
                value = rng.choice(["1.0", "0.0", "", "5"])
            else:
                value = f"{field} {number % 5}"
            person[header] = value
        people.append(person)
    return list(headers), people


def write_edition(folder, edition: str, header: list[str], people: list[dict], files: int = 2) -> str:
    target = folder / "raw" / edition
    target.mkdir(parents=True, exist_ok=True)
    size = -(-len(people) // files)
    for i in range(files):
        with open(target / f"part-{i}.csv", "w", newline="", encoding="utf-8") as handle:
            writer = csv.DictWriter(handle, header)
            writer.writeheader()
            writer.writerows(people[i * size:(i + 1) * size])
    return str(target)


@pytest.fixture(scope="module")
def survey(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("survey")
    data = {e: make_edition(e, n, seed) for seed, (e, n) in enumerate(zip(S.EDITIONS, (70, 90, 240)))}
    raw = {e: write_edition(root, e, header, people) for e, (header, people) in data.items()}
    tables = survey_job.run(spark, raw, str(root / "lake"))
    return root, data, tables


def answers_of(data, edition: str, field: str) -> list[str]:
    header = next(h for h, f in landing.edition_headers(edition).items() if f == field)
    return [person[header] for person in data[edition][1]]


def test_no_row_is_lost_and_keys_follow_the_file(spark, survey):
    root, data, _ = survey
    fact = survey_job.read_silver(spark, str(root / "lake")).fact
    for edition in S.EDITIONS:
        got = fact.where(fact.survey_year == edition).orderBy("respondent_id").select("respondent_id", "region", "sector").collect()
        assert [r["respondent_id"] for r in got] == [f"{edition}_{i:06d}" for i in range(len(data[edition][1]))]
        assert [r["region"] or "" for r in got] == answers_of(data, edition, "region")
        assert [r["sector"] for r in got] == answers_of(data, edition, "sector")
    assert set(fact.columns) == set(silver.FACT_COLUMNS)


def test_market_overview_counts(survey):
    _, data, tables = survey
    got = {(r[0], r[1], r[2]): r[3] for r in rows(tables["gold_market_overview"])}
    names = dict(S.SENIORITY)
    for edition in S.EDITIONS:
        want = Counter(names[a or None] for a in answers_of(data, edition, "seniority"))
        assert {k[2]: v for k, v in got.items() if k[:2] == (edition, "seniority")} == want
        regions = Counter(a for a in answers_of(data, edition, "region") if a)
        assert {k[2]: v for k, v in got.items() if k[:2] == (edition, "region")} == regions
    shares = {}
    for year, dimension, _, _, share in rows(tables["gold_market_overview"]):
        shares[(year, dimension)] = shares.get((year, dimension), 0) + share
    assert all(abs(total - 1) < 1e-12 for total in shares.values())


def test_role_compensation_matches_numpy(spark, survey):
    root, data, tables = survey
    fact = survey_job.read_silver(spark, str(root / "lake")).fact
    people = fact.select("survey_year", "current_role", "salary_midpoint").collect()
    for r in tables["gold_compensation_by_role"].collect():
        group = [p["salary_midpoint"] for p in people if (p[0], p[1]) == (r["survey_year"], r["current_role"])]
        known = [v for v in group if v is not None]
        assert r["respondent_count"] == len(group) and r["salary_known_count"] == len(known)
        assert r["low_sample_flag"] == (len(group) < 30) and r["current_role"] != "UNKNOWN"
        if known:
            assert [r["salary_p25"], r["median_salary_midpoint"], r["salary_p75"]] == list(np.percentile(known, [25, 50, 75]))


def test_bridge_is_eligible_times_offered_and_adoption_follows(spark, survey):
    root, data, tables = survey
    bridge = survey_job.read_silver(spark, str(root / "lake")).bridge
    total = 0
    for edition in S.EDITIONS:
        options = [h for h, f in landing.edition_headers(edition).items() if f and f.startswith("db_")]
        shown = [p for p in data[edition][1] if any(p[h] for h in options)]
        total += len(shown) * len(options)
        sql_server = next(h for h in options if "SQL SERVER" in h)
        users = sum(p[sql_server] == "1.0" for p in shown)
        row = tables["gold_technology_adoption_by_year"].where(
            f"survey_year = '{edition}' AND technology = 'SQL SERVER'"
        ).first()
        assert (row["technology_users"], row["eligible_respondents"]) == (users, len(shown))
        assert row["adoption_rate"] == users / len(shown)
    assert bridge.count() == total
    adoption = tables["gold_technology_adoption_by_year"]
    assert adoption.where("technology = 'DynamoDB'").count() == 3
    assert rows(adoption.where("technology = 'SAP'").select("survey_year")) == [("year_1",)]


def test_ai_overview_has_every_edition_and_no_invented_zero(survey):
    _, data, tables = survey
    overview = {(r["survey_year"], r["metric"]): r for r in tables["gold_ai_adoption_overview"].collect()}
    assert len(overview) == 21
    first = [r for (year, _), r in overview.items() if year == "year_1"]
    assert all(not r["question_available"] and r["rate"] is None and r["eligible_respondents"] == 0 for r in first)
    answered = [a for a in answers_of(data, "year_3", "ai_priority") if a]
    names = dict(S.AI_PRIORITY)
    top = sum(names[a] in S.AI_TOP_PRIORITY for a in answered)
    row = overview[("year_3", S.AI_PRIORITY_METRIC)]
    assert (row["eligible_respondents"], row["numerator"]) == (len(answered), top)


def test_score_is_the_weighted_sum_of_its_components(survey):
    _, _, tables = survey
    scored = tables["gold_skill_priority_score"].collect()
    assert scored and all(r["year_3_users"] >= 30 and r["technology"] != "SAP" for r in scored)
    for r in scored:
        want = sum(w * r[f"normalized_{c}"] for c, w in S.SCORE_WEIGHTS.items()) / 0.90
        assert r["priority_score"] == pytest.approx(want, abs=1e-12)
    assert sorted(r["rank"] for r in scored) == list(range(1, len(scored) + 1))


def test_all_answers_are_stored_as_csv(spark, survey):
    root, _, tables = survey
    answers = [n for n in tables if n.startswith("q")]
    assert len(answers) == 16
    for name in answers:
        stored = spark.read.option("header", True).csv(str(root / "lake" / "gold" / "business_answers" / name))
        assert stored.columns == tables[name].columns and stored.count() == tables[name].count()


def test_more_partitions_and_another_edition_order_change_nothing(spark, survey):
    root, _, tables = survey
    stored = survey_job.read_silver(spark, str(root / "lake"))
    spread = survey_job.SilverTables(*(t.repartition(8) for t in (stored.fact, stored.bridge, stored.ai)))
    single = survey_job.SilverTables(*(t.coalesce(1).orderBy("respondent_id") for t in (stored.fact, stored.bridge, stored.ai)))
    for variant in (spread, single):
        gold = survey_job.gold_tables(variant)
        for name in ("gold_market_overview", "gold_gender_representation", "gold_technology_adoption_by_year", "gold_skill_priority_score"):
            assert rows(gold[name]) == rows(tables[name]), name


@pytest.mark.parametrize("field, value", [("seniority", "Trainee"), ("salary_band", "de R$ 1/mês"), ("current_role", "Astronauta")])
def test_an_unmapped_value_stops_the_job(spark, tmp_path, field, value):
    header, people = make_edition("year_2", 12, 9)
    column = next(h for h, f in landing.edition_headers("year_2").items() if f == field)
    people[7][column] = value
    bronze = survey_job.land_bronze(spark, {"year_2": write_edition(tmp_path, "year_2", header, people)}, str(tmp_path))
    with pytest.raises(ValueError, match=value.replace("$", r"\$")):
        silver.build_fact_respondent(bronze, silver.default_mappings(spark))


def test_an_unknown_option_label_stops_the_bridge(spark, tmp_path):
    header, people = make_edition("year_2", 3, 9)
    people = [{**p, "('P4_g_99 ', 'NovoDB')": "1.0"} for p in people]
    path = write_edition(tmp_path, "year_2", [*header, "('P4_g_99 ', 'NovoDB')"], people, files=1)
    bronze = survey_job.land_bronze(spark, {"year_2": path}, str(tmp_path))
    with pytest.raises(ValueError, match="NovoDB"):
        silver.build_technology_bridge(bronze)


def silver_files(lake):
    return {p: p.stat().st_mtime_ns for p in (lake / "silver").rglob("*.parquet") if "_inputs" not in str(p)}


def test_only_editions_touched_by_a_change_are_processed(spark, tmp_path):
    """A mapping row of one edition, then a raw file of another: everything else stays as stored."""
    data = {e: make_edition(e, 30, seed) for seed, e in enumerate(S.EDITIONS)}
    raw = {e: write_edition(tmp_path, e, header, people) for e, (header, people) in data.items()}
    lake, folder = tmp_path / "lake", str(tmp_path / "maps")
    landing.write_versioned_mappings(spark, folder)
    first = survey_job.run(spark, raw, str(lake), mappings=folder)
    genders = rows(first["gold_market_overview"].where("dimension = 'gender'"))
    before = silver_files(lake)
    assert survey_job.refresh(spark, raw, str(lake), folder)[1] == [] and silver_files(lake) == before

    later = landing.literal_table(
        spark,
        [(r, v, None, "year_3", "v1") for r, v in S.SENIORITY] + [(r, "TOP" if v == "SPECIALIST" else v, "year_3", None, "v3") for r, v in S.SENIORITY],
        "raw_value string, canonical_value string, valid_from string, valid_to string, mapping_version string",
    )
    landing.write_mappings({"seniority": later}, folder)
    tables = survey_job.run(spark, raw, str(lake), mappings=folder)
    after = silver_files(lake)
    gone = {p for p in before if p not in after or after[p] != before[p]}
    # Seniority of the second edition went back from v2 to v1 as well.
    assert {e for e in S.EDITIONS for p in gone if f"survey_year={e}" in str(p)} == {"year_2", "year_3"}
    fact = survey_job.read_silver(spark, str(lake)).fact
    assert rows(fact.where("seniority in ('TOP', 'SPECIALIST')").select("survey_year", "seniority").distinct()) == [
        ("year_1", "SPECIALIST"), ("year_2", "SPECIALIST"), ("year_3", "TOP")
    ]
    assert genders == rows(tables["gold_market_overview"].where("dimension = 'gender'"))

    header, people = data["year_1"]
    write_edition(tmp_path, "year_1", list(reversed(header)), people + people[:5])
    _, changed = survey_job.refresh(spark, raw, str(lake), folder)
    assert changed == ["year_1"] and survey_job.read_silver(spark, str(lake)).fact.count() == 95


def test_an_interrupted_refresh_repeats_its_work(spark, tmp_path, monkeypatch):
    header, people = make_edition("year_1", 20, 1)
    raw = {"year_1": write_edition(tmp_path, "year_1", header, people)}
    lake = str(tmp_path / "lake")
    survey_job.refresh(spark, raw, lake)
    write_edition(tmp_path, "year_1", header, people[:10])
    with monkeypatch.context() as m:
        m.setattr(survey_job, "write_silver", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            survey_job.refresh(spark, raw, lake)
    stored, changed = survey_job.refresh(spark, raw, lake)
    assert changed == ["year_1"] and stored.fact.count() == 10
