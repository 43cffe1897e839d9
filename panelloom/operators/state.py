"""Mergeable counts: a table's combination counts per landed batch, added up when they are read.

What the Gold operators need of a table is how often each combination of some columns occurs. Counts of two batches add up to
those of both, so a new batch is counted alone and rows landed earlier are never read again. A batch owns one folder named
after it and writes just that: counting it again, after a failure or a correction, replaces its share and doubles nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from panelloom.operators.shares import WEIGHT, count_combinations

BATCH = "batch"


def write_counts(df: DataFrame, keys: Sequence[str], path: str, batch: str) -> None:
    """Count the combinations of ``keys`` in one batch and store them in place of what that batch had before."""
    if not batch or any(c in batch for c in "/=:\\"):
        raise ValueError(f"{batch!r} does not name a batch")
    count_combinations(df, keys).write.mode("overwrite").parquet(f"{path.rstrip('/')}/{BATCH}={batch}")


def read_counts(spark: SparkSession, path: str) -> DataFrame:
    """Combination counts over all batches; a weighted table for every operator that counts combinations."""
    stored = spark.read.option("recursiveFileLookup", "true").parquet(path)
    return count_combinations(stored, [c for c in stored.columns if c not in (WEIGHT, BATCH)])


def batches(spark: SparkSession, path: str) -> list[str]:
    """Names of the batches stored below ``path``, from the folder names alone."""
    return stored_values(spark, path, BATCH)


def stored_values(spark: SparkSession, path: str, column: str) -> list[str]:
    """Values of a partition column as its folders name them."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(root):
        return []
    names = [status.getPath().getName() for status in system.listStatus(root)]
    return sorted(n[len(column) + 1 :] for n in names if n.startswith(f"{column}="))
