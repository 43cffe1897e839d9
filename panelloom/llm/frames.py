"""Spark helpers the operators share."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelloom.session import new_folder

# Arrow batches between the JVM and Python: rows and bytes of text at once in a worker.
BATCH_ROWS = 2000
BATCH_BYTES = 4 << 20
# Workers give freed arrays back to the machine instead of keeping them for later.
WORKER_MEMORY = {"MALLOC_MMAP_THRESHOLD_": "1048576", "MALLOC_TRIM_THRESHOLD_": "1048576", "MALLOC_ARENA_MAX": "2", "ARROW_DEFAULT_MEMORY_POOL": "system"}
# Shuffle files go when the query that made them is done, not when the driver happens to collect its garbage.
_FILE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_ROOT = str(Path(__file__).resolve().parents[2])


def bounded_batches(spark: SparkSession) -> None:
    """Limit Arrow batches by bytes, so a run of long texts does not fill a worker.

    Workers also look for this package where the driver found it; on a cluster ship it as usual (``--py-files``).
    """
    environment = spark.sparkContext.environment
    for name, value in WORKER_MEMORY.items():
        environment.setdefault(name, value)
    if _ROOT not in environment.get("PYTHONPATH", "").split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [environment.get("PYTHONPATH", ""), _ROOT]))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def map_batches(df: DataFrame, function: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``function`` over each Arrow batch; it sees one batch at a time and keeps nothing."""
    bounded_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield from function(batch)

    return df.mapInArrow(run, schema)


def crc32_of_id(doc_id: Column) -> Column:
    """crc32 of the id's decimal text; NULL counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))


_scratch: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables stored inside are deleted at the end, but for those stored with ``keep``: they belong to that many scratches further out, if any."""
    _scratch.append([])
    try:
        yield
    finally:
        for name in _scratch.pop():
            path = spark._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def stored(df: DataFrame, label: str, keep: int = 0) -> DataFrame:
    """``df`` written to the shared folder and read back: short lineage that outlives executors, and ``keep`` scratches."""
    spark = df.sparkSession
    path, before = new_folder(spark, label), spark.conf.get(_FILE_CLEANUP)
    spark.conf.set(_FILE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_FILE_CLEANUP, before)
    if len(_scratch) > keep:
        _scratch[-1 - keep].append(path)
    return spark.read.schema(df.schema).parquet(path)


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/documents.parquet")


def read_labels(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/labels.parquet")


def read_embeddings(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/embeddings.parquet")
