"""Silver pieces that the end-to-end survey does not reach."""

from __future__ import annotations

import pytest
from conftest import rows
from pyspark.sql import functions as F

from panelloom.plans import silver
from panelloom.plans import survey_config as S
from panelloom.plans.panel import scan
from panelloom.sources import sinks


def bronze_of(spark, edition, headers, people):
    df = spark.createDataFrame([(edition, f"{edition}_{i:06d}", *p) for i, p in enumerate(people)],
                               ", ".join(["survey_year string", "respondent_id string", *[f"c{i} string" for i in range(len(headers))]]))
    return df.toDF("survey_year", "respondent_id", *headers)


def test_other_option_families_are_configuration_only(spark):
    bronze = {
        "year_1": bronze_of(spark, "year_1", ["('P4_d_a ', 'SQL')", "('P4_d_b ', 'R ')", "('P4_f_a ', 'MySQL')"],
                            [("1.0", "0.0", None), (None, None, "1.0")]),
        "year_3": bronze_of(spark, "year_3", ["4.c.1_SQL", "4.c.2_R", "4.c_linguagem_preferida", "3.h.1 Falta de casos", "3.h_motivos"],
                            [("0.0", "1.0", "Python", "1", None)]),
    }
    assert rows(silver.build_family_bridge(bronze, "LANGUAGE")) == [
        ("year_1_000000", "year_1", "R", "LANGUAGE", False), ("year_1_000000", "year_1", "SQL", "LANGUAGE", True),
        ("year_3_000000", "year_3", "R", "LANGUAGE", True), ("year_3_000000", "year_3", "SQL", "LANGUAGE", False),
    ]
    blockers = silver.build_family_bridge(bronze, "AI_BLOCKER", option="blocker")
    assert blockers.columns == ["respondent_id", "survey_year", "blocker", "blocker_family", "selected"]
    assert rows(blockers) == [("year_3_000000", "year_3", "Falta de casos", "AI_BLOCKER", True)]


def test_a_newer_mapping_replaces_the_default(spark):
    tables = silver.default_mappings(spark)
    tables["seniority"] = spark.createDataFrame([("Trainee", "TRAINEE"), (None, "NONE")], "raw_value string, canonical_value string")
    raw = spark.createDataFrame([("year_1", "Trainee"), ("year_1", None)], "survey_year string, seniority string")
    assert rows(silver.harmonize(raw, tables)) == [("year_1", "NONE"), ("year_1", "TRAINEE")]


def test_a_field_not_asked_is_a_typed_null_column(spark):
    headers = [f"('{code} ', 'x')" for code in S.field_codes("year_1").values() if code]
    df = bronze_of(spark, "year_1", headers, [("",) * len(headers)]).withColumns(
        {"source_file": F.lit("f"), "ingestion_timestamp": F.current_timestamp()}
    )
    fields = silver.canonical_fields(df, "year_1")
    assert dict(fields.dtypes)["ethnicity"] == "string"
    assert fields.select("ethnicity", "region", "gender").first() == (None, None, None)


def test_publish_registers_an_external_table(spark, tmp_path):
    sinks.publish(spark.range(3), "panelloom_published", str(tmp_path / "t"))
    try:
        assert spark.sql("SELECT count(*) FROM panelloom_published").first()[0] == 3
    finally:
        spark.sql("DROP TABLE panelloom_published")


def test_a_table_is_opened_once_per_application(spark, tmp_path):
    spark.range(2).write.parquet(str(tmp_path / "t.parquet"))
    assert scan(spark, str(tmp_path), "t") is scan(spark, str(tmp_path), "t")


def test_scores_need_every_weight_component():
    assert sum(S.SCORE_WEIGHTS.values()) == pytest.approx(0.90)
