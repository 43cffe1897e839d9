"""Mapping operators: NULL rows, scopes, bands, and values no mapping knows."""

from __future__ import annotations

import pytest
from conftest import rows
from pyspark.sql import functions as F

from panelloom.functions.bands import parse_band
from panelloom.operators import mapping as M
from panelloom.plans import survey_config as S
from panelloom.plans.silver import default_mappings
from panelloom.sources.tables import literal_table, mapping_table


def test_null_takes_the_null_row_and_unknown_without_one(spark):
    df = spark.createDataFrame([(1, "x"), (2, None), (3, "z")], "id int, v string")
    with_null = mapping_table(spark, [("x", "X"), (None, "NOT_ASKED")])
    without = mapping_table(spark, [("x", "X")])
    assert rows(M.map_values(df, "v", {"v": "canonical_value"}, with_null)) == [(1, "X"), (2, "NOT_ASKED"), (3, None)]
    assert rows(M.map_values(df, "v", {"c": "canonical_value"}, without)) == [(1, "x", "X"), (2, None, "UNKNOWN"), (3, "z", None)]


def test_literals_with_quotes_backslashes_and_newlines_survive(spark):
    values = [("it's",), ("back\\slash",), ("two\nlines",), ("acentuação",)]
    assert sorted(tuple(r) for r in literal_table(spark, values, "v string").collect()) == sorted(values)


def test_scope_all_and_comma_list(spark):
    roles = default_mappings(spark)["role"]
    df = spark.createDataFrame(
        [("year_1", "Analista de BI/BI Analyst/Analytics Engineer"), ("year_2", "Analista de BI/BI Analyst"),
         ("year_3", "DBA/Administrador de Banco de Dados"), ("year_1", "Analytics Engineer"), ("year_2", None)],
        "survey_year string, r string",
    )
    mapped = M.map_values(df, "r", {"role": "canonical_role"}, roles, also_on={"survey_year": "survey_year"})
    assert {(r["survey_year"], r["r"]): r["role"] for r in mapped.collect()} == {
        ("year_1", "Analista de BI/BI Analyst/Analytics Engineer"): "BI_ANALYST_OR_ANALYTICS_ENGINEER",
        ("year_2", "Analista de BI/BI Analyst"): "BI_ANALYST",
        ("year_3", "DBA/Administrador de Banco de Dados"): "DBA",
        ("year_1", "Analytics Engineer"): None,  # not an option of that edition
        ("year_2", None): "UNKNOWN",
    }


def test_unmapped_values_are_reported_for_all_columns_at_once(spark):
    df = spark.createDataFrame(
        [("year_1", "a", "Outro"), ("year_2", "b", "Outro"), ("year_2", None, None), ("year_1", "b", "Professor")],
        "survey_year string, v string, role string",
    )
    roles = default_mappings(spark)["role"]
    specs = [("v", mapping_table(spark, [("a", "A")]), "raw_value"), ("role", roles, "raw_value")]
    assert rows(M.unmapped_values(df, specs, "survey_year")) == [("role", "year_2", "Outro"), ("v", None, "b")]
    with pytest.raises(ValueError, match="Outro"):
        M.require_mapped(df, specs, "survey_year")
    M.require_mapped(df.where("survey_year = 'year_1' AND v = 'a'"), specs, "survey_year")


def test_no_default_mapping_can_fan_out(spark):
    tables = default_mappings(spark)
    for name in ("gender", "seniority", "work_model", "employment_status", "ai_priority", "company_size", "salary_band", "technology"):
        assert rows(M.duplicate_mapping_keys(tables[name], ["raw_value"])) == []
    assert rows(M.duplicate_mapping_keys(tables["role"], ["raw_value", "survey_year"])) == []


BANDS = [
    ("Menos de R$ 1.000/mês", None, 1000.0, None, "LOWER_OPEN", False),
    ("Acima de R$ 40.001/mês", 40001.0, None, None, "UPPER_OPEN", False),
    ("de R$ 101/mês a R$ 2.000/mês", 101.0, 2000.0, 1050.5, "CLOSED", False),
    ("de R$ 2.001/mês a R$ 3000/mês", 2001.0, 3000.0, 2500.5, "CLOSED", False),
    ("de R$ 2.001/mês a R$ 3.000/mês", 2001.0, 3000.0, 2500.5, "CLOSED", False),
    ("de R$ 25.001/mês a R$ 3000/mês", 25001.0, 3000.0, None, "CLOSED", True),
    ("prefiro não dizer", None, None, None, None, False),
    (None, None, None, None, None, False),
]


def test_band_parser_truth_table(spark):
    labels = literal_table(spark, [(b[0],) for b in BANDS], "label string")
    parsed = labels.withColumn("b", parse_band(F.col("label"))).select("label", "b.*")
    assert rows(parsed) == rows(literal_table(spark, BANDS, "l string, lo double, hi double, m double, o string, a boolean"))


def test_twelve_midpoints_and_unmatched_anomaly_is_false(spark):
    bands = default_mappings(spark)["salary_band"]
    assert bands.select("salary_midpoint").where("salary_midpoint IS NOT NULL").distinct().count() == 12
    df = spark.createDataFrame([("???",), (S.SALARY_BAND_LABELS[9],)], "band string")
    found = M.attach_bands(df, "band", bands).select("band", "salary_midpoint", "salary_anomaly_flag")
    assert rows(found) == [("???", None, False), (S.SALARY_BAND_LABELS[9], None, True)]


def test_label_table_falls_back_to_the_code(spark):
    df = spark.createDataFrame([("A",), ("B",)], "code string")
    labels = literal_table(spark, [("A", "Letra A")], "k string, l string")
    assert rows(M.label_table(df, "code", "label", labels, "k", "l")) == [("A", "Letra A"), ("B", "B")]
