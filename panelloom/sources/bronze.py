"""Bronze: raw rows as received, lineage columns in front, one lasting row number.

The row number is the only identity a respondent has. It follows from the stored rows themselves: raw rows are written once, each
with the file and split it came from, and a small table beside them holds for every (part file, split) the number of its first row.
The number of a row is that plus its place in the part file, whatever splits were packed into a task and however many part
files a task wrote. Read Bronze through :func:`read_bronze`; rewriting its part files would lose the numbers, so nothing does.
"""

from __future__ import annotations

from collections.abc import Collection
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelloom.functions.scalars import numbered_key, quoted
from panelloom.session import new_folder
from panelloom.sources.header_index import HeaderIndex, index_files
from panelloom.sources.tables import CSV_READ, string_schema

ROW_ID = "respondent_id"
LINEAGE = ("survey_year", "source_file", "ingestion_timestamp")

# The first numbers per part file and split are sent to all tasks up to this size, measured (some 130 bytes a row); beyond it the
# join is a shuffle with the same numbers. At 128 MB a split that is about 256 TB of raw files.
_SENT_BYTES = 256 << 20
_ROW_BYTES = 130

#: File and split a stored row came from.
SOURCE = _FILE, _BLOCK = "__source_path", "__source_block"


def with_lineage(df: DataFrame, edition: str, source_file: Column | str) -> DataFrame:
    """Edition, source file and ingestion time in front of the untouched columns."""
    source = F.lit(source_file) if isinstance(source_file, str) else source_file
    return df.select(
        F.lit(edition).alias("survey_year"),
        source.alias("source_file"),
        F.current_timestamp().alias("ingestion_timestamp"),
        "*",
    )


def first_numbers(stored: DataFrame, base: int = 0) -> DataFrame:
    """``part, __source_path, __source_block, shift``: a row's number is its place in the part file plus ``shift``.

    ``stored`` is a plain scan of rows written by a task per run of splits. A task writes the rows of a split one after the
    other, into one part file or, with ``spark.sql.files.maxRecordsPerFile``, into several that are counted up in their names. So the
    order is source file, split, part file (longer names are later ones), place.
    """
    # One row per (part file, split): a few bytes for every 128 MB of raw files.
    in_order = Window.orderBy(_FILE, _BLOCK, F.length("part"), "part").rowsBetween(Window.unboundedPreceding, -1)
    counted = (
        stored.select(F.col("_metadata.file_name").alias("part"), _FILE, _BLOCK, F.col("_metadata.row_index").alias("__index"))
        .groupBy("part", _FILE, _BLOCK)
        .agg(F.count(F.lit(1)).alias("rows"), F.min("__index").alias("first"))
    )
    before = F.coalesce(F.sum("rows").over(in_order), F.lit(0))
    return counted.select("part", _FILE, _BLOCK, (before - F.col("first") + F.lit(base)).alias("shift"))


def numbered(stored: DataFrame, numbers: DataFrame, name: str) -> DataFrame:
    """``stored`` with the number of each row; its two source columns go."""
    sent = F.broadcast(numbers) if numbers.count() * _ROW_BYTES <= _SENT_BYTES else numbers
    placed = stored.select("*", F.col("_metadata.file_name").alias("part"), F.col("_metadata.row_index").alias("__index"))
    # Rows whose numbers were not finished (a landing cut off between its two writes) must not vanish.
    shift = F.coalesce("shift", F.raise_error(F.lit("row numbers are missing; land the files again")).cast("bigint"))
    joined = placed.join(sent, ["part", _FILE, _BLOCK], "left")
    return joined.withColumn(name, F.col("__index") + shift).drop("part", _FILE, _BLOCK, "__index", "shift")


def tagged(df: DataFrame) -> DataFrame:
    """A plain file scan (or its columns and ``_metadata``) with the file and split of each row."""
    placed = df.select("*", F.col("_metadata.file_path").alias(_FILE), F.col("_metadata.file_block_start").alias(_BLOCK))
    return placed.drop("_metadata")


def number_rows(df: DataFrame, name: str = "row_number", base: Column | int = 0) -> DataFrame:
    """Consecutive numbers from ``base`` in file order: file name, then position in the file.

    ``df`` must be a plain file scan. Its rows are stored once in the shared folder and numbered there, see :func:`first_numbers`.
    """
    path = new_folder(df.sparkSession, "numbering")
    tagged(df).write.parquet(f"{path}/rows")
    stored = df.sparkSession.read.parquet(f"{path}/rows")
    first_numbers(stored).write.parquet(f"{path}/numbers")
    keyed = numbered(stored, df.sparkSession.read.parquet(f"{path}/numbers"), name)
    return keyed.withColumn(name, F.col(name) + base)


def number_parquet_rows(df: DataFrame, name: str = "row_number") -> DataFrame:
    """Like :func:`number_rows` for parquet, whose scan already knows the row's index in its file."""
    spark = df.sparkSession
    tagged = df.select("*", F.col("_metadata.file_path").alias("__file"), F.col("_metadata.row_index").alias("__index"))
    before = Window.orderBy("__file").rowsBetween(Window.unboundedPreceding, -1)
    path = new_folder(spark, "numbering")
    (
        df.groupBy(F.col("_metadata.file_path").alias("__file"))
        .agg(F.count(F.lit(1)).alias("__rows"))
        .select("__file", F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__offset"))
        .write.parquet(path)
    )
    files = spark.read.parquet(path)
    sent = F.broadcast(files) if files.count() * _ROW_BYTES <= _SENT_BYTES else files
    return tagged.join(sent, "__file").withColumn(name, F.col("__offset") + F.col("__index")).drop("__file", "__index", "__offset")


def scan_edition(spark: SparkSession, index: HeaderIndex, multi_line: bool = True) -> DataFrame:
    """All files of an indexed edition under the edition's columns, with the file and split of each row.

    One scan per distinct header; a column a file does not print is NULL in its rows.
    """
    reader = spark.read.options(**CSV_READ).option("multiLine", multi_line)
    parts = []
    for group in index.groups:
        rows = tagged(reader.schema(string_schema(group.header)).csv(list(group.files)))
        parts.append(rows.select(F.col("_metadata.file_name").alias("__source"), _FILE, _BLOCK, *[quoted(c).alias(n) for c, n in zip(group.header, group.names)]))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def ingest_edition(
    spark: SparkSession,
    raw_path: str,
    bronze_path: str,
    edition: str,
    source_file: str | None = None,
    multi_line: bool = True,
    dialect: str | None = None,
    known: Collection[str] | None = None,
) -> DataFrame:
    """Land one edition below its own Bronze folder and return the stored table.

    Raw rows are written once, by the tasks that read them; no sort or shuffle comes between, so a split stays in order. Editions
    have different headers, so each has a folder of its own rather than one merged schema with a thousand mostly-NULL
    columns. ``dialect`` and ``known`` are those of :func:`panelloom.sources.header_index.index_headers`.
    """
    index = index_files(spark, raw_path, dialect, known)
    rows = scan_edition(spark, index, multi_line)
    source = F.lit(source_file) if source_file else F.col("__source")
    landed = rows.select(source.alias("source_file"), F.current_timestamp().alias("ingestion_timestamp"), _FILE, _BLOCK, *[quoted(c) for c in index.columns])
    target = f"{bronze_path.rstrip('/')}/{edition}"
    folder = f"{target}/survey_year={edition}"
    landed.write.mode("overwrite").parquet(folder)
    first_numbers(spark.read.parquet(folder)).write.mode("overwrite").parquet(f"{target}/_numbers")
    return read_bronze(spark, bronze_path, edition)


def read_bronze(spark: SparkSession, bronze_path: str, edition: str) -> DataFrame:
    """A landed edition: lineage, the surrogate key ``{edition}_{row:06d}``, raw columns."""
    target = f"{bronze_path.rstrip('/')}/{edition}"
    stored = spark.read.option("basePath", target).parquet(f"{target}/survey_year={edition}")
    raw = [c for c in stored.columns if c not in (*LINEAGE, _FILE, _BLOCK)]
    keyed = numbered(stored, spark.read.parquet(f"{target}/_numbers"), "__row")
    return keyed.select(
        "source_file", "ingestion_timestamp", numbered_key(F.lit(edition), F.col("__row")).alias(ROW_ID), *[quoted(c) for c in raw], "survey_year"
    )
