"""Gold from counts of landed batches, against Gold of a full run."""

from __future__ import annotations

import random
import shutil

import pytest
from conftest import TESTDATA, rows
from pyspark.sql import functions as F
from test_survey_job import make_edition

from panelloom.operators import shares as SH
from panelloom.operators import state
from panelloom.operators import stats as ST
from panelloom.plans import incremental, panel, silver, survey_job
from panelloom.plans import survey_config as S
from panelloom.streaming.landing import land_new_files, landed_batches, read_landed


def silver_of(bronze, tables):
    return survey_job.SilverTables(silver.build_fact_respondent(bronze, tables), silver.build_technology_bridge(bronze, tables), silver.build_ai_fact(bronze, tables))


def close(a, b) -> bool:
    return len(a) == len(b) and all(
        len(x) == len(y) and all(u == v or (isinstance(u, float) and v is not None and abs(u - v) < 1e-9) for u, v in zip(x, y)) for x, y in zip(a, b)
    )


def test_one_more_drop_gives_the_gold_of_a_full_run(spark, tmp_path):
    """The second drop is counted after the first one's Bronze files are gone, so it cannot have read them."""
    import csv

    tables = silver.default_mappings(spark)
    data = {e: make_edition(e, n, seed) for seed, (e, n) in enumerate(zip(S.EDITIONS, (40, 50, 160)))}
    bronze, counted = str(tmp_path / "bronze"), str(tmp_path / "counts")
    for drop in range(2):
        for edition, (header, people) in data.items():
            half = len(people) // 2
            (tmp_path / "drop" / edition).mkdir(parents=True, exist_ok=True)
            with open(tmp_path / "drop" / edition / f"{drop}.csv", "w", newline="", encoding="utf-8") as handle:
                writer = csv.DictWriter(handle, header)
                writer.writeheader()
                writer.writerows(people[:half] if drop == 0 else people[half:])
            land_new_files(spark, str(tmp_path / "drop" / edition), bronze, str(tmp_path / "progress" / edition), edition)
        if drop == 0:
            first = {e: landed_batches(spark, bronze, e)[0] for e in S.EDITIONS}
            new = first
        else:
            new = {e: next(b for b in landed_batches(spark, bronze, e) if b != first[e]) for e in S.EDITIONS}
            whole = silver_of({e: read_landed(spark, bronze, e) for e in S.EDITIONS}, tables)
            want = {name: rows(table) for name, table in survey_job.gold_tables(whole).items()}
            for e in S.EDITIONS:
                shutil.move(f"{bronze}/{e}/landing_batch={first[e]}", f"{tmp_path}/away-{e}")
        batch = silver_of({e: read_landed(spark, bronze, e, new[e]) for e in S.EDITIONS}, tables)
        for _ in range(2):  # counted twice, as after a failure
            incremental.count_batch(batch, counted, f"drop-{drop}")
    got = {name: rows(table) for name, table in incremental.gold_from_counts(spark, counted).items()}
    assert set(got) == set(want)
    for name in want:
        assert close(got[name], want[name]), name
    assert state.batches(spark, f"{counted}/people") == ["drop-0", "drop-1"]


def test_counts_merge_and_a_batch_replaces_itself(spark, tmp_path):
    r = random.Random(2)
    path = str(tmp_path / "c")
    parts = {f"b{i}": [(r.choice("xyz"), r.choice([1.0, 2.5, None]), r.random()) for _ in range(50 * i)] for i in range(4)}
    state.write_counts(spark.createDataFrame([("w", 9.0, 1.0)], "k string, v double, other double"), ["k", "v"], path, "b1")
    for name, part in parts.items():
        state.write_counts(spark.createDataFrame(part, "k string, v double, other double"), ["k", "v"], path, name)
    everything = spark.createDataFrame([x for part in parts.values() for x in part], "k string, v double, other double")
    merged = state.read_counts(spark, path)
    assert rows(merged) == rows(SH.count_combinations(everything, ["k", "v"]))
    assert rows(ST.distribution_stats(merged, ["k"], "v")) == rows(ST.distribution_stats(everything, ["k"], "v"))
    assert state.batches(spark, path) == ["b0", "b1", "b2", "b3"] and state.batches(spark, str(tmp_path / "none")) == []
    for name in ("", "a/b", "a=b", "../x"):
        with pytest.raises(ValueError):
            state.write_counts(everything, ["k"], path, name)


def test_conditions_count_weights(spark):
    df = spark.createDataFrame([("a", 3, True), ("b", 5, False), ("c", 7, None)], f"k string, {SH.WEIGHT} bigint, yes boolean")
    assert df.agg(SH.rows_of(df), SH.rows_where(df, F.col("yes")), SH.rows_where(df, F.col("k") == "z")).first() == (15, 3, 0)
    plain = df.drop(SH.WEIGHT)
    assert plain.agg(SH.rows_of(plain), SH.rows_where(plain, F.col("yes"))).first() == (3, 1)


def test_drops_of_narrow_rows_count_as_the_stored_tables_do(spark, tmp_path):
    """Users come with their profile from the row they sit in: no join, and the same counts as with one."""
    path = f"{TESTDATA}/sf0.001"
    tables, users = panel.silver_tables(panel.answer_sources(spark, path, panel.SILVER_FIELDS))
    fact = panel.fact(spark, path, [c for c in incremental.PEOPLE if c != panel.EDITION])
    whole = survey_job.SilverTables(fact, panel.bridge(spark, path), panel.ai_facts(spark, path))
    for name, batch in {"a": (tables, users), "b": (whole, None)}.items():
        incremental.count_batch(batch[0], str(tmp_path / name), "one", batch[1])
    for table in ("people", "options", "users", "ai"):
        a, b = (rows(state.read_counts(spark, str(tmp_path / name / table))) for name in "ab")
        assert a == b and a
