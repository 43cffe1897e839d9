"""Counts taken while a table is written, against the reports that scan it."""

from __future__ import annotations

import random

import pytest
from conftest import rows

from panelloom.operators import observed as OB
from panelloom.operators import quality as Q
from panelloom.sources import sinks

SCHEMA = "period string, gender string, role string, `odd name` string, open string, bad boolean"


def people(spark, n=400, periods=("e1", "e2", "e3", "e9", None)):
    r = random.Random(5)
    return spark.createDataFrame(
        [(r.choice(periods), r.choice(["UNKNOWN", "F", None]), r.choice(["UNKNOWN", "x"]), r.choice([None, "", "a"]),
          r.choice(["UPPER_OPEN", "LOWER_OPEN", "CLOSED", None]), r.choice([True, False, None])) for _ in range(n)], SCHEMA,
    ).repartition(7)


def watched(spark, df, tmp_path, **more):
    watch = OB.Observed("period", ["e1", "e2", "e3"], ["gender", "odd name", "open"], ["gender", "role"], open_ended="open", anomaly="bad")
    sinks.write_table(watch.watch(df), str(tmp_path / "t"))
    return watch.counts(spark)


def test_reports_equal_the_scanning_ones(spark, tmp_path):
    df = people(spark, periods=("e1", "e2", "e3"))
    counts = watched(spark, df, tmp_path)
    assert rows(OB.missing_profile(counts)) == rows(Q.missing_profile(df, ["gender", "odd name", "open"]))
    assert rows(OB.value_rate_matrix(counts, "period", ["e1", "e2", "e3"])) == rows(Q.value_rate_matrix(df, "period", ["e1", "e2", "e3"], ["gender", "role"]))
    assert rows(OB.band_counts(counts, "period")) == rows(Q.band_counts(df, "period", "open", "bad"))
    assert rows(OB.reconcile(counts, counts, "period")) == rows(Q.reconcile(df, df, "period"))


def test_rows_of_other_periods_are_not_lost(spark, tmp_path):
    df = people(spark)
    counts = watched(spark, df, tmp_path)
    got = {r["period"]: r["rows"] for r in OB.rows_per_period(counts, "period").collect()}
    want = {}
    for r in df.collect():
        p = r["period"] if r["period"] in ("e1", "e2", "e3") else None
        want[p] = want.get(p, 0) + 1
    assert got == want


def test_counts_need_a_written_table_and_an_empty_one_has_none(spark, tmp_path):
    with pytest.raises(ValueError, match="watched"):
        OB.Observed("period", ["e1"]).counts(spark)
    assert watched(spark, people(spark).where("false"), tmp_path).count() == 0


def test_writing_takes_the_counts_without_a_second_scan(spark, tmp_path):
    """One job reads the source once: its rows are counted by an accumulator in the scan's only consumer."""
    df = people(spark)
    seen = spark.sparkContext.accumulator(0)

    def touch(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    watch = OB.Observed("period", ["e1", "e2", "e3"], ["gender"])
    sinks.write_table(watch.watch(df.mapInArrow(touch, SCHEMA)), str(tmp_path / "t"))
    assert OB.missing_profile(watch.counts(spark)).count() == 1 and seen.value == 400
