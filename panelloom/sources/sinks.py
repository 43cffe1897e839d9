"""Writers. None of them narrows the output to one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from panelloom.sources.tables import CSV_FORMAT


# Partition folders a task keeps open at once. Up to here rows are written as they come; Spark's default sorts all rows of a task by
# partition first, which for the bridge is thirty rows a respondent in memory or spilled. A task that meets more folders sorts the rest.
_OPEN_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"
_WRITERS = 8


def unsorted_partitions(spark: SparkSession) -> None:
    """Partitioned writes of few partitions need no sort; a setting of the session's own stays."""
    if int(spark.conf.get(_OPEN_WRITERS, "0")) == 0:
        spark.conf.set(_OPEN_WRITERS, str(_WRITERS))


def write_partitioned(df: DataFrame, path: str, partition_by: Sequence[str] = ("survey_year",)) -> None:
    """Overwrite only the partitions present in ``df``; others stay."""
    unsorted_partitions(df.sparkSession)
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )


def write_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Headered CSV that :func:`panelloom.sources.tables.read_headered_csv` reads back as it was, any text included."""
    df.write.mode(mode).options(**CSV_FORMAT).csv(path)


def write_answer(df: DataFrame, path: str) -> None:
    """Headered CSV of a report-sized answer table."""
    write_csv(df, path)


def publish(df: DataFrame, name: str, path: str) -> None:
    """Register a table over an external location in the session catalog."""
    df.write.mode("overwrite").option("path", path).saveAsTable(name)
