"""Files of one edition under different headers, and row numbers that survive any number of part files."""

from __future__ import annotations

import csv
import gzip
import os

import pytest
from conftest import rows
from pyspark.sql import functions as F

from panelloom.plans import survey_job
from panelloom.sources import bronze, header_index, tables

A, B, C, D = "('P2_h ', 'Faixa')", "('P4_d_1 ', 'SQL')", "('P4_d_2 ', 'R, \"etc\"')", "('P9_z ', 'Unbekannt')"


def write(path, header, records, opener=open):
    path.parent.mkdir(parents=True, exist_ok=True)
    with opener(path, "wt", newline="", encoding="utf-8") as handle:
        writer = csv.writer(handle)
        writer.writerow(header)
        writer.writerows(records)


def land(spark, tmp_path, folder, **more):
    return bronze.ingest_edition(spark, str(tmp_path / folder), str(tmp_path / f"bronze-{folder}"), "year_1", dialect="tuple", **more)


def content(df, columns):
    return rows(df.select("respondent_id", "source_file", *[F.col(f"`{c}`") for c in columns]))


def test_reordered_files_give_the_same_bronze(spark, tmp_path):
    people = [[f"f{i}", f"{i % 2}.0", "" if i % 3 else "x\ny"] for i in range(40)]
    write(tmp_path / "plain" / "a.csv", [A, B, C], people[:20])
    write(tmp_path / "plain" / "b.csv", [A, B, C], people[20:])
    write(tmp_path / "mixed" / "a.csv", [A, B, C], people[:20])
    write(tmp_path / "mixed" / "b.csv", [C, A, B], [[c, a, b] for a, b, c in people[20:]])
    want = land(spark, tmp_path, "plain")
    got = land(spark, tmp_path, "mixed")
    assert got.columns == want.columns and content(got, [A, B, C]) == content(want, [A, B, C])
    assert {r["respondent_id"] for r in got.collect()} == {f"year_1_{i:06d}" for i in range(40)}


def test_reworded_and_extended_files(spark, tmp_path):
    write(tmp_path / "x" / "a.csv", [A, B], [["f0", "1.0"]])
    write(tmp_path / "x" / "b.csv", [C, "('P2_h', 'Faixa salarial (nova)')", B], [["0.0", "f1", ""]])
    got = land(spark, tmp_path, "x", known={"P2_h", "P4_d_"})
    assert got.columns[3:-1] == [A, B, C]
    assert content(got, [A, B, C]) == [("year_1_000000", "a.csv", "f0", "1.0", None), ("year_1_000001", "b.csv", "f1", None, "0.0")]


@pytest.mark.parametrize(
    ("second", "message"),
    [([A, B, D], "unknown question code 'P9_z'"), ([A, B, "nota"], "no question"), ([A, B, B], "twice")],
)
def test_what_no_code_explains_fails(spark, tmp_path, second, message):
    write(tmp_path / "x" / "a.csv", [A, B, C], [["1", "2", "3"]])
    write(tmp_path / "x" / "b.csv", second, [["1"] * len(second)])
    with pytest.raises(ValueError, match=message):
        land(spark, tmp_path, "x", known={"P2_h", "P4_d_"})


def test_a_code_that_heads_several_columns_is_matched_by_its_text(spark):
    many = ["('P3_d_ ', 'eins')", "('P3_d_ ', 'zwei')"]
    found = header_index.index_headers({"a": tuple(many), "b": tuple(reversed(many))}, "tuple")
    assert found.columns == tuple(many) and found.groups[1].names == tuple(reversed(many))
    with pytest.raises(ValueError, match="unknown"):
        header_index.index_headers({"a": tuple(many), "b": (*many, "('P3_d_ ', 'drei')")}, "tuple", known={"P2_h"})


def test_headers_are_read_whole_and_alone(spark, tmp_path):
    long = [f"('P1_{i} ', 'line\n\"{i}\" {'é' * 50}')" for i in range(3000)]
    write(tmp_path / "long.csv", long, [["x"] * 3000])
    write(tmp_path / "only.csv", [A, B], [])
    write(tmp_path / "packed.csv.gz", [A, C], [["1", "2"]], gzip.open)
    (tmp_path / "bom.csv").write_bytes(b"\xef\xbb\xbfa,b\r\n1,2\r\n")
    read = {n: header_index.read_header(spark, str(tmp_path / n)) for n in ("long.csv", "only.csv", "packed.csv.gz", "bom.csv")}
    assert read == {"long.csv": tuple(long), "only.csv": (A, B), "packed.csv.gz": (A, C), "bom.csv": ("a", "b")}


def test_files_are_listed_without_markers(spark, tmp_path):
    for name in ("b.csv", "sub/a.csv", "_SUCCESS", ".hidden.csv", "_temporary/c.csv"):
        (tmp_path / "x" / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "x" / name).write_text("h\n1\n")
    (tmp_path / "x" / "empty.csv").write_text("")
    names = [os.path.relpath(f.removeprefix("file:"), tmp_path / "x") for f in header_index.list_files(spark, str(tmp_path / "x"))]
    assert names == ["b.csv", "sub/a.csv"]
    state = header_index.files_state(spark, str(tmp_path / "x"))
    (tmp_path / "x" / "b.csv").write_text("h\n1\n2\n")
    assert header_index.files_state(spark, str(tmp_path / "x")) != state
    with pytest.raises(FileNotFoundError):
        (tmp_path / "none").mkdir()
        header_index.index_files(spark, str(tmp_path / "none"))


@pytest.mark.parametrize("limit", ["0", "7", "100"])
def test_numbers_with_several_part_files_a_task(spark, tmp_path, limit):
    """A task that starts a new part file every few rows, and splits of a few rows."""
    for part in range(3):
        write(tmp_path / "raw" / f"part-{part}.csv", ["n", "t"], [[part * 400 + i, "é" * (i % 7)] for i in range(400)])
    settings = {"spark.sql.files.maxRecordsPerFile": limit, "spark.sql.files.maxPartitionBytes": "900"}
    old = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        landed = bronze.ingest_edition(spark, str(tmp_path / "raw"), str(tmp_path / "b"), "year_1", multi_line=False)
        assert landed.where(F.col("respondent_id") != F.format_string("year_1_%06d", F.col("n").cast("long"))).count() == 0
        assert landed.select("respondent_id").distinct().count() == 1200
        numbered = bronze.number_rows(tables.read_headered_csv(spark, str(tmp_path / "raw"), multi_line=False), "row", 5)
        assert numbered.where("row <> n + 5").count() == 0 and numbered.count() == 1200
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_raw_rows_are_written_once(spark, tmp_path):
    write(tmp_path / "raw" / "a.csv", ["n"], [[i] for i in range(1000)])
    bronze.ingest_edition(spark, str(tmp_path / "raw"), str(tmp_path / "b"), "year_1")
    written = spark.read.parquet(str(tmp_path / "b" / "year_1" / "survey_year=year_1"))
    assert written.count() == 1000
    others = [p for p in (tmp_path / "b").rglob("*.parquet") if "survey_year=" not in str(p)]
    assert others and all("_numbers" in str(p) for p in others)


def test_an_interrupted_landing_is_noticed(spark, tmp_path):
    write(tmp_path / "raw" / "a.csv", ["n"], [[1], [2]])
    bronze.ingest_edition(spark, str(tmp_path / "raw"), str(tmp_path / "b"), "year_1")
    spark.range(3).select(F.current_timestamp().alias("ingestion_timestamp"), F.lit("f").alias("source_file"), F.lit("f").alias("__source_path"), F.lit(0).cast("bigint").alias("__source_block"), F.lit("1").alias("n")).write.mode("overwrite").parquet(str(tmp_path / "b" / "year_1" / "survey_year=year_1"))
    with pytest.raises(Exception, match="row numbers are missing"):
        bronze.read_bronze(spark, str(tmp_path / "b"), "year_1").collect()


def test_known_codes_hold_what_the_configuration_reads():
    assert {"P2_h", "P4_f_", "P4_f", "P4_d_"} <= survey_job.known_codes("year_1")
    assert {"3.e", "4.j.", "4.j"} <= survey_job.known_codes("year_3")
