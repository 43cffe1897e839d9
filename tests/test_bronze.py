"""Landing: stable row numbers, untouched values, incremental drops."""

from __future__ import annotations

import csv

import pytest

from conftest import rows
from pyspark.sql import functions as F

from panelloom.sources import bronze, sinks, tables
from panelloom.streaming.landing import land_new_files

HEADER = ["('P1_b ', 'Genero, \"livre\"')", "n", "texto"]


def write_csv(path, records, header=HEADER):
    path.parent.mkdir(parents=True, exist_ok=True)
    with open(path, "w", newline="", encoding="utf-8") as handle:
        writer = csv.writer(handle)
        writer.writerow(header)
        writer.writerows(records)


def test_numbers_follow_file_order_across_splits_and_files(spark, tmp_path):
    """Three files, split into many small pieces: still 0..n-1 in file order."""
    count, start = 3000, 0
    for part in range(3):
        write_csv(tmp_path / "raw" / f"part-{part}.csv", [["x", start + i, "é" * (i % 7)] for i in range(count)])
        start += count
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "7000")
    try:
        df = tables.read_headered_csv(spark, str(tmp_path / "raw"), multi_line=False)
        assert df.rdd.getNumPartitions() > 8
        numbered = bronze.number_rows(df, "row").select(F.col("row"), F.col("n").cast("long").alias("n"))
        assert numbered.where("row <> n").count() == 0
        assert numbered.select("row").distinct().count() == start
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_parquet_numbers_need_no_position_pass(spark, tmp_path):
    path = str(tmp_path / "p")
    spark.range(1000).repartitionByRange(4, "id").sortWithinPartitions("id").write.parquet(path)
    numbered = bronze.number_parquet_rows(spark.read.parquet(path), "row")
    assert numbered.where("row <> id").count() == 0 and numbered.count() == 1000


def test_bronze_keeps_values_and_headers_and_puts_lineage_first(spark, tmp_path):
    records = [["Fem", "1", 'says ""hi"", ok'], ["", "2", "linha 1\nlinha 2"]]
    write_csv(tmp_path / "raw.csv", records)
    stored = bronze.ingest_edition(spark, str(tmp_path / "raw.csv"), str(tmp_path / "b"), "year_1", "raw.csv", multi_line=True)
    assert stored.columns == ["source_file", "ingestion_timestamp", "respondent_id", *HEADER, "survey_year"]
    got = {r["respondent_id"]: r for r in stored.collect()}
    assert set(got) == {"year_1_000000", "year_1_000001"}
    assert got["year_1_000000"]["texto"] == 'says ""hi"", ok'
    assert got["year_1_000001"]["texto"] == "linha 1\nlinha 2" and got["year_1_000001"][HEADER[0]] is None
    lineage = bronze.with_lineage(spark.range(1), "year_1", "raw.csv").columns
    assert lineage == ["survey_year", "source_file", "ingestion_timestamp", "id"]


def test_partition_overwrite_leaves_other_editions(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([("year_1", 1), ("year_2", 2)], "survey_year string, n int")
    sinks.write_partitioned(df, path)
    sinks.write_partitioned(spark.createDataFrame([("year_2", 3)], "survey_year string, n int"), path)
    assert rows(spark.read.parquet(path).select("survey_year", "n")) == [("year_1", 1), ("year_2", 3)]


def test_typed_mapping_file(spark, tmp_path):
    write_csv(tmp_path / "m.csv", [["a", "1.5", "False"], ["", "", "True"]], ["raw_value", "salary_midpoint", "anomaly_flag"])
    mapping = tables.read_mapping(spark, str(tmp_path / "m.csv"), ["raw_value", "salary_midpoint", "anomaly_flag"])
    assert rows(mapping) == [(None, None, True), ("a", 1.5, False)]


def test_stream_lands_only_new_files_and_numbers_continue(spark, tmp_path):
    drop, args = tmp_path / "drop", (str(tmp_path / "bronze"), str(tmp_path / "progress"), "year_2")
    write_csv(drop / "a.csv", [["x", i, ""] for i in range(5)])
    assert land_new_files(spark, str(drop), *args).count() == 5
    write_csv(drop / "b.csv", [["x", i, ""] for i in range(5, 12)])
    landed = land_new_files(spark, str(drop), *args)
    assert land_new_files(spark, str(drop), *args).count() == 12  # nothing new, nothing doubled
    assert [r["n"] for r in landed.orderBy("respondent_id").collect()] == [str(i) for i in range(12)]
    assert rows(landed.select("source_file").distinct()) == [("a.csv",), ("b.csv",)]


def test_numbers_do_not_depend_on_how_splits_are_packed(spark, tmp_path):
    """The packing changes between planning and every later use, as when executors come and go."""
    for part in range(40):
        write_csv(tmp_path / "raw" / f"part-{part:02d}.csv", [["x", part * 50 + i, ""] for i in range(50)])
    numbered = bronze.number_rows(tables.read_headered_csv(spark, str(tmp_path / "raw"), multi_line=False), "row")
    for partitions in ("1", "17", "40"):
        spark.conf.set("spark.sql.files.minPartitionNum", partitions)
        try:
            assert numbered.where("row <> n").count() == 0 and numbered.count() == 2000
        finally:
            spark.conf.unset("spark.sql.files.minPartitionNum")


def test_any_text_survives_csv(spark, tmp_path):
    texts = ['a "b", c', "line\nbreak", "  blanks  ", "", None, 'back\\slash \\" q', '"', "a,b", "tab\t", "\n"]
    df = spark.createDataFrame(list(enumerate(texts)), "n int, text string")
    sinks.write_csv(df, str(tmp_path / "t"))
    back = tables.read_headered_csv(spark, str(tmp_path / "t"))
    assert {int(r["n"]): r["text"] for r in back.collect()} == {n: t or None for n, t in enumerate(texts)}


def test_files_with_another_column_order_fail(spark, tmp_path):
    write_csv(tmp_path / "raw" / "a.csv", [["1", "2"]], ["x", "y"])
    write_csv(tmp_path / "raw" / "b.csv", [["20", "10"]], ["y", "x"])
    with pytest.raises(Exception, match="(?i)header"):
        tables.read_headered_csv(spark, str(tmp_path / "raw")).collect()


def test_a_new_checkpoint_does_not_overwrite_landed_rows(spark, tmp_path):
    target = str(tmp_path / "bronze")
    write_csv(tmp_path / "one" / "a.csv", [["x", i, ""] for i in range(3)])
    write_csv(tmp_path / "two" / "b.csv", [["x", i, ""] for i in range(3, 7)])
    land_new_files(spark, str(tmp_path / "one"), target, str(tmp_path / "p1"), "year_1")
    landed = land_new_files(spark, str(tmp_path / "two"), target, str(tmp_path / "p2"), "year_1")
    assert [r["n"] for r in landed.orderBy("respondent_id").collect()] == [str(i) for i in range(7)]
    assert landed.select("respondent_id").distinct().count() == 7


def test_few_partitions_are_written_without_a_sort(spark, tmp_path):
    spark.conf.unset("spark.sql.maxConcurrentOutputFileWriters")
    df = spark.range(0, 3000, 1, 1).selectExpr("id", "concat('year_', id % 3 + 1) AS survey_year")
    sinks.write_partitioned(df, str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    assert rows(stored.groupBy("survey_year").count()) == [("year_1", 1000), ("year_2", 1000), ("year_3", 1000)]
    spark.sql(f"CREATE TABLE unsorted_rows (id bigint, survey_year string) USING parquet PARTITIONED BY (survey_year) LOCATION '{tmp_path}/u'")
    df.createOrReplaceTempView("rows_to_write")
    plan = spark.sql("EXPLAIN INSERT INTO unsorted_rows SELECT * FROM rows_to_write").first()[0]
    spark.sql("DROP TABLE unsorted_rows")
    assert "Sort" not in plan
    spark.conf.set("spark.sql.maxConcurrentOutputFileWriters", "3")
    sinks.write_partitioned(df, str(tmp_path / "t"))
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "3"
    spark.conf.unset("spark.sql.maxConcurrentOutputFileWriters")
