"""Raw edition files derived from the driver tables, in the questionnaire's own header dialects.

They feed the full path from raw CSV on, including header resolution and row numbering.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelloom.plans import incremental, panel
from panelloom.plans import survey_config as S
from panelloom.plans.mapping_store import write_mappings
from panelloom.plans.survey_job import SilverTables, gold_tables, read_gold, read_quality, refresh, write_all
from panelloom.session import new_folder, side_by_side
from panelloom.sources.sinks import unsorted_partitions, write_csv
from panelloom.sources.tables import literal_table

_ALIAS_OF = {canonical: label for label, canonical in S.DATABASE_ALIASES.items()}


def _header(edition: str, code: str, label: str) -> str:
    if S.HEADER_DIALECT[edition] == "tuple":
        return str((f"{code} ", label))
    return f"{code}_{label}"


def edition_headers(edition: str) -> dict[str, str | None]:
    """Header to panel field for one edition; None marks an umbrella column, which stays blank."""
    headers: dict[str, str | None] = {}
    for field, code in S.field_codes(edition).items():
        if code is not None:
            headers[_header(edition, code, f"pergunta {field}")] = field
    prefix = S.DATABASE_PREFIX[edition]
    headers[_header(edition, prefix[:-1], "bancos de dados")] = None
    for i, (column, name) in enumerate(panel.OPTION_COLUMNS.items(), start=1):
        if edition in S.DATABASE_OFFERED_IN.get(name, S.EDITIONS):
            label = _ALIAS_OF.get(name, name) if edition == "year_1" else name
            headers[_header(edition, f"{prefix}{i}", label)] = column
    if S.AI_PRIORITY_CODE[edition] is not None:
        headers[_header(edition, S.AI_PRIORITY_CODE[edition], "prioridade")] = "ai_priority"
        prefix = S.GENAI_PREFIX[edition]
        headers[_header(edition, prefix[:-1], "uso no trabalho")] = None
        for i, (label, name) in enumerate(S.GENAI_ITEMS.items(), start=1):
            column = next(c for c, n in panel.GENAI_COLUMNS.items() if n == name)
            spaced = f"{prefix}{i} {label}"
            headers[spaced if S.HEADER_DIALECT[edition] == "dot" else _header(edition, f"{prefix}{i}", label)] = column
    return headers


def raw_edition(answers: DataFrame, edition: str) -> DataFrame:
    """One edition's wide raw frame under its printed headers, all strings."""
    columns = [
        (F.lit(None).cast("string") if field is None else F.col(field).cast("string")).alias(header)
        for header, field in edition_headers(edition).items()
    ]
    return answers.where(F.col("survey_year") == edition).select(*columns)


def write_raw_editions(spark: SparkSession, sf_dir: str, root: str) -> dict[str, str]:
    """Write the three raw CSV editions below ``root``/raw and return their paths."""
    fields = [f for f in S.FIELD_CODES] + list(panel.OPTION_COLUMNS) + list(panel.GENAI_COLUMNS) + ["ai_priority"]
    # Stored once: three writers read it, and the joins behind it are not repeated. The answers are printed when they are read, as
    # the dozen columns they are made from are far less than the dozens of printed ones.
    staged = f"{root}/staged"
    unsorted_partitions(spark)
    orders = panel.answer_sources(spark, sf_dir, fields)
    orders.withColumn("survey_year", F.expr(panel.EDITION_SQL)).write.mode("overwrite").partitionBy("survey_year").parquet(staged)
    answers = panel.printed_answers(spark.read.schema(orders.schema.add("survey_year", "string")).parquet(staged), fields)
    paths = {}
    for edition in S.EDITIONS:
        paths[edition] = f"{root}/raw/{edition}"
    side_by_side(spark, [partial(write_csv, raw_edition(answers, edition), path) for edition, path in paths.items()])
    return paths


def write_versioned_mappings(spark: SparkSession, folder: str) -> str:
    """Mapping files with a history: roles by edition, and seniority in a second version from the second edition on."""
    roles = literal_table(spark, S.ROLE, "raw_value string, survey_year_scope string, canonical_role string, comparability_group string")
    first, second = S.EDITIONS[0], S.EDITIONS[1]
    history = [(raw, value, None, second, "v1") for raw, value in S.SENIORITY] + [(raw, value, second, None, "v2") for raw, value in S.SENIORITY]
    seniority = literal_table(spark, history, "raw_value string, canonical_value string, valid_from string, valid_to string, mapping_version string")
    gender = literal_table(spark, [(raw, value, first, None, S.MAPPING_VERSION) for raw, value in S.GENDER], "raw_value string, canonical_value string, valid_from string, valid_to string, mapping_version string")
    write_mappings({"role": roles.withColumn("mapping_version", F.lit(S.MAPPING_VERSION)), "seniority": seniority, "gender": gender}, folder)
    return folder


_stored: dict[tuple[str, str], tuple[str, SilverTables]] = {}


def stored_silver(spark: SparkSession, sf_dir: str) -> SilverTables:
    """Silver tables after the full path from raw CSV, built once per application and data set."""
    return _job(spark, sf_dir)[1]


def stored_quality(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The quality report of the same job."""
    return read_quality(spark, _job(spark, sf_dir)[0])


def _job(spark: SparkSession, sf_dir: str) -> tuple[str, SilverTables]:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _stored:
        root = new_folder(spark, "survey")
        raw = write_raw_editions(spark, sf_dir, root)
        _stored[key] = root, refresh(spark, raw, root, write_versioned_mappings(spark, f"{root}/mappings"))[0]
    return _stored[key]


_DROPS = 3
_counted: dict[tuple[str, str], str] = {}


def counted_gold(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One Gold table from the counts of several drops, each counted alone and the first one twice.

    A drop is a third of the respondents, stored by itself.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _counted:
        root = new_folder(spark, "counts")
        # What the answers are made from is stored, one narrow row a respondent; bridge rows are counted as they are made and never kept.
        orders = panel.answer_sources(spark, sf_dir, panel.SILVER_FIELDS)
        drop = F.pmod(F.xxhash64("o_orderkey"), F.lit(_DROPS)).cast("int")
        unsorted_partitions(spark)
        orders.withColumn("drop", drop).write.partitionBy("drop").parquet(f"{root}/orders")
        for number in [*range(_DROPS), 0]:
            part = spark.read.schema(orders.schema).parquet(f"{root}/orders/drop={number}")
            tables, users = panel.silver_tables(part)
            incremental.count_batch(tables, f"{root}/counts", f"drop-{number}", users)
        _counted[key] = f"{root}/counts"
    return incremental.gold_from_counts(spark, _counted[key])[name]


_gold: dict[tuple[str, str], dict[str, DataFrame]] = {}


def forget() -> None:
    """The next query over the raw path goes the whole way again."""
    _stored.clear()
    _gold.clear()
    _counted.clear()


def stored_gold(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Gold tables after the full path, written and read back, built once per application and data set."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _gold:
        root = new_folder(spark, "gold")
        write_all(spark, gold_tables(stored_silver(spark, sf_dir)), f"{root}/gold")
        _gold[key] = read_gold(spark, root)
    return _gold[key]
