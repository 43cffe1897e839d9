"""Effective-dated mappings and the mapping store, against plain lookups."""

from __future__ import annotations

import random

import pytest
from conftest import rows

from panelloom.operators import effective as EF
from panelloom.plans import mapping_store, silver
from panelloom.plans import survey_config as S
from panelloom.sources.tables import literal_table

SCHEMA = "raw_value string, canonical_value string, valid_from int, valid_to int, mapping_version string"


def test_the_row_in_force_is_found(spark):
    r = random.Random(1)
    mapping, table = [], {}
    for raw in [*"abcdef", None]:
        cuts = sorted(r.sample(range(1, 50), r.randrange(4)))
        ends = [None if r.random() < 0.5 else 0, *cuts, None if r.random() < 0.5 else 60]
        for i in range(len(ends) - 1):
            mapping.append((raw, f"{raw}{i}", ends[i], ends[i + 1], f"v{i}"))
        table[raw] = mapping[-(len(ends) - 1):]
    frame = spark.createDataFrame(mapping, SCHEMA)
    EF.require_intervals(frame, ["raw_value"])
    facts = [(i, r.choice([*"abcdefg", None]), r.choice([-3, 0, 5, 17, 30, 49, 59, 60, 70, None])) for i in range(500)]
    df = spark.createDataFrame(facts, "id int, raw string, at int")
    got = EF.map_as_of(df, "raw", {"value": "canonical_value", "version": "mapping_version"}, frame, "at")

    def plain(raw, at):
        for _, value, start, end, version in table.get(raw, ()):
            if (start is None or (at is not None and at >= start)) and (end is None or (at is not None and at < end)):
                return value, version
        return None, None

    assert sorted(map(tuple, got.select("id", "value", "version").collect())) == [(i, *plain(raw, at)) for i, raw, at in facts]
    missing: dict = {}
    for _, raw, at in facts:
        if plain(raw, at) == (None, None):
            missing.setdefault(raw, []).append(at)
    want = [(raw, min((a for a in ats if a is not None), default=None), max((a for a in ats if a is not None), default=None), len(ats)) for raw, ats in missing.items()]
    assert rows(EF.uncovered_values(df, "raw", frame, "at")) == sorted(want, key=lambda x: tuple((v is not None, str(v)) for v in x))


@pytest.mark.parametrize(
    ("intervals", "problem"),
    [([(1, 3), (2, 4)], "overlap"), ([(1, 3), (4, 5)], "gap"), ([(3, 3)], "empty"), ([(5, 2)], "empty"), ([(None, 3), (None, 4)], "overlap"),
     ([(1, None), (3, 4)], "overlap"), ([(1, 3), (1, 3)], "overlap"), ([(1, 9), (2, 3), (3, 12)], "overlap"), ([(None, 3), (3, None)], None), ([(None, None)], None)],
)
@pytest.mark.parametrize("raw", ["x", None])
def test_interval_problems(spark, raw, intervals, problem):
    frame = spark.createDataFrame([(raw, "c", a, b, "v") for a, b in intervals] + [("fine", "c", None, None, "v")], SCHEMA)
    found = EF.interval_problems(frame, ["raw_value"]).collect()
    assert {r["problem"] for r in found} >= ({problem} if problem else set()) and bool(found) == bool(problem)
    if problem:
        with pytest.raises(ValueError, match=problem):
            EF.require_intervals(frame, ["raw_value"])


def test_validity_becomes_editions(spark):
    frame = literal_table(spark, [("a", "x", None, "e2"), ("a", "y", "e2", None), ("b", "z", "e2", "e3"), ("c", "w", None, None)], "raw_value string, canonical_value string, valid_from string, valid_to string")
    got = EF.expand_validity(frame, ["e1", "e2", "e3"], "edition")
    assert rows(got) == [("a", "x", "e1"), ("a", "y", "e2"), ("a", "y", "e3"), ("b", "z", "e2"), ("c", "w", "e1"), ("c", "w", "e2"), ("c", "w", "e3")]
    with pytest.raises(ValueError, match="e9"):
        EF.expand_validity(frame.replace("e3", "e9"), ["e1", "e2", "e3"], "edition")


HISTORY = "raw_value string, canonical_value string, valid_from string, valid_to string, mapping_version string, notes string"


def test_stored_mappings_replace_tables_and_keep_their_history(spark, tmp_path):
    old = [(raw, value, None, "year_3", "v1", "n") for raw, value in S.SENIORITY]
    new = [(raw, "LEAD" if value == "SPECIALIST" else value, "year_3", None, "v2", None) for raw, value in S.SENIORITY]
    mapping_store.write_mappings({"seniority": literal_table(spark, old + new, HISTORY)}, str(tmp_path))
    tables = mapping_store.StoredMappings(spark, str(tmp_path))
    raw = spark.createDataFrame([(e, "Especialista/Staff+") for e in S.EDITIONS] + [("year_2", None)], "survey_year string, seniority string")
    got = silver.harmonize(raw, tables)
    assert rows(got.select("survey_year", "seniority", "mapping_versions")) == [
        ("year_1", "SPECIALIST", "seniority=v1"), ("year_2", "SPECIALIST", "seniority=v1"), ("year_2", "UNKNOWN", "seniority=v1"), ("year_3", "LEAD", "seniority=v2")
    ]
    assert rows(tables["gender"]) == rows(silver.default_mappings(spark)["gender"])


def test_fingerprints_change_only_where_a_row_is_in_force(spark, tmp_path):
    def marks(version: str, canonical: str, folder: str):
        rows_ = [(raw, value, None, "year_2", "v1", "n") for raw, value in S.SENIORITY]
        rows_ += [(raw, canonical if raw == "Pleno" else value, "year_2", "year_3", version, "n") for raw, value in S.SENIORITY]
        rows_ += [(raw, value, "year_3", None, "v1", folder) for raw, value in S.SENIORITY]
        mapping_store.write_mappings({"seniority": literal_table(spark, rows_, HISTORY)}, str(tmp_path / folder))
        return mapping_store.fingerprints(mapping_store.StoredMappings(spark, str(tmp_path / folder)))

    one, same, other = marks("v1", "MID", "a"), marks("v1", "MID", "b"), marks("v2", "MIDDLE", "c")
    assert one == same
    assert {k for k in one if one[k] != other[k]} == {("year_2", "seniority")}
    assert set(one) == {(e, n) for e in S.EDITIONS for n in mapping_store.NAMES}


def test_bad_mapping_files_fail(spark, tmp_path):
    gap = [("Pleno", "MID", None, "year_2", "v1", ""), ("Pleno", "MID", "year_3", None, "v1", "")]
    mapping_store.write_mappings({"seniority": literal_table(spark, gap, HISTORY)}, str(tmp_path / "gap"))
    with pytest.raises(ValueError, match="gap"):
        mapping_store.StoredMappings(spark, str(tmp_path / "gap"))["seniority"]
    twice = literal_table(spark, [("Pleno", "MID"), ("Pleno", "OTHER")], "raw_value string, canonical_value string")
    mapping_store.write_mappings({"seniority": twice}, str(tmp_path / "twice"))
    with pytest.raises(ValueError, match="several rows"):
        mapping_store.StoredMappings(spark, str(tmp_path / "twice"))["seniority"]
    (tmp_path / "none").mkdir()
    with pytest.raises(FileNotFoundError):
        mapping_store.StoredMappings(spark, str(tmp_path / "none"))
