"""Scans: parquet tables, headered CSV, mapping tables, small literal tables."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


# How CSV files are written and read: quotes doubled, blanks kept, columns checked against each file's header.
CSV_FORMAT = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}
CSV_READ = {**CSV_FORMAT, "enforceSchema": "false"}


def string_schema(columns: Iterable[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def read_headered_csv(spark: SparkSession, path: str | list[str], multi_line: bool = True, schema: T.StructType | None = None) -> DataFrame:
    """Headered CSV with every column a string, as :func:`panelloom.sources.sinks.write_csv` writes it.

    A file whose header differs from the schema (by default the first file's), in names or in order, fails: no value is
    ever taken by position. Empty text and NULL are both blank in a file and come back as NULL. Line breaks inside quoted answers need ``multi_line``. Such a file is read by one task,
    so land large editions as several files; ``multi_line=False`` splits files that have no such answers.
    """
    reader = spark.read.options(**CSV_READ).option("inferSchema", False).option("multiLine", multi_line)
    if schema is None:
        schema = reader.csv(path).schema
    return reader.schema(schema).csv(path)


def _sql_literal(value: object) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "TRUE" if value else "FALSE"
    if isinstance(value, (int, float)):
        return repr(value)
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def literal_table(spark: SparkSession, rows: Iterable[Sequence[object]], schema: str) -> DataFrame:
    """A small constant table whose exact size is known to the optimizer.

    ``schema`` is a DDL string. The table is an inline relation, so joins against it broadcast
    because Spark has measured it, and projections over it are evaluated while planning.
    """
    fields = T.StructType.fromDDL(schema).fields
    columns = ", ".join(f"CAST(c{i} AS {f.dataType.simpleString()}) AS `{f.name}`" for i, f in enumerate(fields))
    values = ", ".join("(" + ", ".join(_sql_literal(v) for v in row) + ")" for row in rows)
    names = ", ".join(f"c{i}" for i in range(len(fields)))
    return spark.sql(f"SELECT {columns} FROM VALUES {values} AS t({names})")


def mapping_table(spark: SparkSession, rows: Iterable[Sequence[object]]) -> DataFrame:
    return literal_table(spark, rows, "raw_value string, canonical_value string")


# Columns of the mapping files; anything else in a file is carried as a string.
_MAPPING_TYPES = {
    "ordinal_rank": T.IntegerType(),
    "salary_lower_bound": T.DoubleType(),
    "salary_upper_bound": T.DoubleType(),
    "salary_midpoint": T.DoubleType(),
    "anomaly_flag": T.BooleanType(),
}


def read_mapping(spark: SparkSession, path: str | list[str], columns: Sequence[str] | None = None) -> DataFrame:
    """A versioned mapping file with typed columns; a blank raw value is NULL. The columns are by default the file's own."""
    if columns is None:
        columns = read_headered_csv(spark, path).columns
    schema = T.StructType([T.StructField(c, _MAPPING_TYPES.get(c, T.StringType())) for c in columns])
    return read_headered_csv(spark, path, schema=schema)


def register_views(tables: dict[str, DataFrame]) -> None:
    """Expose tables to ad-hoc ``spark.sql``."""
    for name, table in tables.items():
        table.createOrReplaceTempView(name)
