"""Silver: harmonized respondents, option bridge and AI fact from Bronze."""

from __future__ import annotations

from collections.abc import Callable, Collection, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelloom.functions.headers import name_options, option_block, resolve_column, resolve_fields
from panelloom.functions.scalars import blank_to_null, flag_to_boolean, quoted
from panelloom.operators import mapping as M
from panelloom.operators.effective import VERSION
from panelloom.operators.options import eligible, nullable_flags, option_adoption, option_bridge
from panelloom.operators.rates import NOT_ASKED, NOT_AVAILABLE
from panelloom.operators.similar import align_labels
from panelloom.plans import survey_config as S
from panelloom.sources.bronze import LINEAGE, ROW_ID
from panelloom.sources.tables import literal_table, mapping_table

EDITION = "survey_year"

# Harmonized column: mapping table it goes through.
_CATEGORIES = {
    "gender": "gender",
    "employment_status": "employment_status",
    "seniority": "seniority",
    "current_work_model": "work_model",
    "ideal_work_model": "work_model",
}
_BAND_FIELDS = ("salary_lower_bound", "salary_upper_bound", "salary_midpoint", "salary_open_ended", "salary_anomaly_flag")
_KEPT_RAW = ("ethnicity", "pcd_flag", "company_size", "current_role", "salary_band", "rto_attitude")

FACT_COLUMNS = (
    "survey_year", "respondent_id", "age_band", "gender", "ethnicity_raw", "pcd_flag_raw", "state",
    "region", "education_level", "education_area", "employment_status", "sector", "company_size_raw",
    "manager_flag", "current_role_raw", "current_role", "seniority", "salary_band_raw",
    "salary_lower_bound", "salary_upper_bound", "salary_midpoint", "salary_open_ended",
    "salary_anomaly_flag", "data_experience_band", "it_experience_band", "current_work_model",
    "ideal_work_model", "rto_attitude_raw", "source_file", "ingestion_timestamp", "pipeline_version",
    "processing_timestamp", "mapping_versions",
)


class Mappings(dict):
    """The nine mapping tables by name, each built when first used.

    Assign to an entry, for instance a table read from a newer mapping file, to replace it.
    """

    def __init__(self, spark: SparkSession):
        super().__init__()
        self._spark = spark

    def __missing__(self, name: str) -> DataFrame:
        self[name] = self._build(name)
        return self[name]

    def _build(self, name: str) -> DataFrame:
        pairs = {
            "gender": S.GENDER, "seniority": S.SENIORITY, "work_model": S.WORK_MODEL,
            "employment_status": S.EMPLOYMENT_STATUS, "ai_priority": S.AI_PRIORITY,
        }
        version = F.lit(S.MAPPING_VERSION).alias(VERSION)
        if name in pairs:
            return mapping_table(self._spark, pairs[name]).select("*", version)
        if name == "company_size":
            schema = "raw_value string, canonical_value string, ordinal_rank int"
            return literal_table(self._spark, S.COMPANY_SIZE, schema).select("*", version)
        if name == "role":
            schema = "raw_value string, survey_year_scope string, canonical_role string, comparability_group string"
            roles = literal_table(self._spark, S.ROLE, schema)
            return M.expand_scope(roles, S.EDITIONS, "survey_year_scope", EDITION).select("*", version)
        if name == "salary_band":
            labels = literal_table(self._spark, [(label,) for label in S.SALARY_BAND_LABELS], "raw_value string")
            return M.band_table(labels).select("*", version)
        if name == "technology":
            return mapping_table(self._spark, technology_names().items()).select("*", version)
        raise KeyError(name)


def default_mappings(spark: SparkSession) -> Mappings:
    return Mappings(spark)


def technology_names() -> dict[str, str]:
    """Option label to canonical name for the database block."""
    return {**{label: label for label in S.DATABASE_OPTIONS}, **S.DATABASE_ALIASES}


def canonical_fields(bronze: DataFrame, edition: str, codes: Mapping[str, str | None] | None = None) -> DataFrame:
    """Lineage, key and the canonical fields of one edition, found by question code.

    A field the edition did not ask is a typed NULL column. Only these columns are read.
    """
    dialect = S.HEADER_DIALECT[edition]
    columns = resolve_fields(bronze.columns, codes or S.field_codes(edition), dialect)
    fields = [
        (F.lit(None).cast("string") if c is None else blank_to_null(quoted(c))).alias(field)
        for field, c in columns.items()
    ]
    return bronze.select(*LINEAGE, ROW_ID, *fields)


def mapping_specs(tables: Mapping[str, DataFrame]) -> list[tuple[str, DataFrame, str]]:
    """Every mapped raw column with its mapping, for the one-job validation."""
    specs = [(column, tables[table], "raw_value") for column, table in _CATEGORIES.items()]
    return [*specs, ("current_role", tables["role"], "raw_value"), ("salary_band", tables["salary_band"], "raw_value")]


def _scope(table: DataFrame) -> dict[str, str]:
    """A mapping with rows per edition is looked up within the edition."""
    return {EDITION: EDITION} if EDITION in table.columns else {}


def harmonize(raw: DataFrame, tables: Mapping[str, DataFrame], fields: Collection[str] | None = None) -> DataFrame:
    """Raw canonical fields to harmonized ones; ``fields`` limits the work to what is read.

    With ``mapping_versions`` among them, that column says which version of its mapping each category of the row went through,
    ``gender=v1,seniority=v2``; a value no mapping row stands for has none.
    """
    versions = []

    def targets(column: str, table: str, wanted_columns: dict[str, str]) -> dict[str, str]:
        if not wanted("mapping_versions") or VERSION not in tables[table].columns:
            return wanted_columns
        versions.append(column)
        return {**wanted_columns, f"__version_{column}": VERSION}

    def wanted(*names: str) -> bool:
        return (fields is None or any(n in fields for n in names))

    df = raw
    for column, table in _CATEGORIES.items():
        if column in raw.columns and wanted(column):
            df = M.map_values(df, column, targets(column, table, {column: "canonical_value"}), tables[table], also_on=_scope(tables[table]))
    df = df.withColumnsRenamed({c: f"{c}_raw" for c in _KEPT_RAW})
    if "current_role" in raw.columns and wanted("current_role", "comparability_group"):
        df = M.map_values(
            df, "current_role_raw",
            targets("current_role", "role", {"current_role": "canonical_role", "comparability_group": "comparability_group"}),
            tables["role"], also_on=_scope(tables["role"]),
        )
    if "salary_band" in raw.columns and wanted(*_BAND_FIELDS):
        df = M.attach_bands(df, "salary_band_raw", tables["salary_band"])
    if "manager_flag" in raw.columns and wanted("manager_flag"):
        df = df.withColumn("manager_flag", flag_to_boolean(F.col("manager_flag")))
    if versions:
        used = [F.concat(F.lit(f"{c}="), F.nullif(F.col(f"__version_{c}"), F.lit(M.UNKNOWN))) for c in sorted(versions)]
        df = df.withColumn("mapping_versions", F.concat_ws(",", *used)).drop(*[f"__version_{c}" for c in versions])
    return df


def stack(editions: Mapping[str, DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), editions.values())


def build_fact_respondent(
    bronze: Mapping[str, DataFrame], tables: Mapping[str, DataFrame], validate: bool = True, watch: Callable[[DataFrame], DataFrame] | None = None
) -> DataFrame:
    """``fact_respondent`` over all editions; fails on values no mapping table knows. ``watch`` is put on the raw answers."""
    raw = stack({edition: canonical_fields(df, edition) for edition, df in bronze.items()})
    if validate:
        M.require_mapped(raw, mapping_specs(tables), EDITION)
    fact = harmonize(raw if watch is None else watch(raw), tables)
    return fact.withColumns(
        {"pipeline_version": F.lit(S.PIPELINE_VERSION), "processing_timestamp": F.current_timestamp()}
    ).select(*FACT_COLUMNS)


def database_options(columns: list[str], edition: str, names: Mapping[str, str] | None = None) -> dict[str, str]:
    """Column to canonical option of the database block; an unknown label fails."""
    block = option_block(columns, S.DATABASE_PREFIX[edition], S.HEADER_DIALECT[edition])
    return name_options(block, technology_names() if names is None else names)


def build_technology_bridge(bronze: Mapping[str, DataFrame], tables: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """The bridge of the database block; option names from the mapping table, read once for all editions (labels of a header)."""
    rows = [] if tables is None else tables["technology"].collect()
    parts = {}
    for edition, df in bronze.items():
        held = [r for r in rows if EDITION not in tables["technology"].columns or r[EDITION] == edition]
        names = None if tables is None else {r["raw_value"]: r["canonical_value"] for r in held}
        parts[edition] = option_bridge(df, [ROW_ID, EDITION], database_options(df.columns, edition, names), family="DATABASE")
    return stack(parts)


def family_labels(headers: Mapping[str, Collection[str]], families: Collection[str] | None = None) -> list[tuple[str, str, str]]:
    """``(family, edition, label)`` of every option printed in the editions' headers."""
    return [
        (family, edition, label)
        for family in families or S.OPTION_FAMILIES
        for edition, prefix in S.OPTION_FAMILIES[family].items()
        for _, label in option_block(headers.get(edition, ()), prefix, S.HEADER_DIALECT[edition])
    ]


def family_names(
    spark: SparkSession, headers: Mapping[str, Collection[str]], families: Collection[str] | None = None, aliases: Mapping[str, str] | None = None
) -> dict[tuple[str, str], dict[str, str]]:
    """Per family and edition the label of each option and the name it has in all editions.

    Names are aligned over the headers alone, before any answer is read; an option that could be two others fails.
    """
    labels = family_labels(headers, families)
    if not labels:
        return {}
    table = literal_table(spark, dict.fromkeys(labels), f"family string, {EDITION} string, label string")
    aligned = align_labels(table, "family", EDITION, "label", S.EDITIONS, S.OPTION_ALIASES if aliases is None else aliases)
    names: dict[tuple[str, str], dict[str, str]] = {}
    for r in aligned.collect():
        names.setdefault((r["family"], r[EDITION]), {})[r["label"]] = r["name"]
    return names


def family_options(columns: Collection[str], family: str, edition: str, names: Mapping[tuple[str, str], Mapping[str, str]]) -> dict[str, str]:
    """Column to aligned option name of one family's block; nothing if the edition had no such block."""
    prefix = S.OPTION_FAMILIES[family].get(edition)
    if prefix is None:
        return {}
    return name_options(option_block(columns, prefix, S.HEADER_DIALECT[edition]), names.get((family, edition), {}))


def _family_parts(bronze: Mapping[str, DataFrame], family: str, names: Mapping[tuple[str, str], Mapping[str, str]] | None):
    if names is None:
        spark = next(iter(bronze.values())).sparkSession
        names = family_names(spark, {e: df.columns for e, df in bronze.items()}, [family])
    for edition, df in bronze.items():
        options = family_options(df.columns, family, edition, names)
        if options:
            yield edition, df, options


def build_family_bridge(
    bronze: Mapping[str, DataFrame], family: str, option: str = "technology", names: Mapping[tuple[str, str], Mapping[str, str]] | None = None
) -> DataFrame:
    """The bridge of any configured option family under names that hold in all editions.

    Editions whose questionnaire had no such block contribute no rows.
    """
    return stack({
        edition: option_bridge(df, [ROW_ID, EDITION], options, option=option, family=family)
        for edition, df, options in _family_parts(bronze, family, names)
    })


def family_adoption(bronze: Mapping[str, DataFrame], family: str, names: Mapping[tuple[str, str], Mapping[str, str]] | None = None) -> DataFrame:
    """Users, eligible respondents and rate per edition and option, counted in the wide layout: one scan an edition."""
    return stack({edition: option_adoption(df, options) for edition, df, options in _family_parts(bronze, family, names)})


def ai_fact(df: DataFrame, priority: str | None, options: Mapping[str, str], available: Column, tables: Mapping[str, DataFrame]) -> DataFrame:
    """AI adoption per respondent with three-valued flags.

    Where the questions did not exist the priority is NOT_AVAILABLE and every flag NULL; where
    they did, a blank priority is NOT_ASKED and the flags are NULL unless the block was shown.
    """
    shown = (available & eligible(list(options))) if options else F.lit(False)
    flags = nullable_flags(options, available) if options else {}
    flags = {name: flags.get(name, F.lit(None).cast("boolean")) for name in S.GENAI_METRICS}
    if priority is None:
        mapped = df.withColumn("__priority", F.lit(NOT_AVAILABLE))
    else:
        mapping = tables["ai_priority"]
        mapped = M.map_values(df, priority, {"__priority": "canonical_value"}, mapping, also_on=_scope(mapping), unknown=NOT_ASKED)
    return mapped.select(
        ROW_ID,
        EDITION,
        F.when(available, F.col("__priority")).otherwise(F.lit(NOT_AVAILABLE)).alias("enterprise_ai_priority"),
        *[flag.alias(name) for name, flag in flags.items()],
        available.alias("genai_question_available"),
        shown.alias("genai_eligible"),
    )


def build_ai_fact(bronze: Mapping[str, DataFrame], tables: Mapping[str, DataFrame], validate: bool = True) -> DataFrame:
    parts = {}
    for edition, df in bronze.items():
        code, prefix = S.AI_PRIORITY_CODE[edition], S.GENAI_PREFIX[edition]
        if code is None:
            parts[edition] = ai_fact(df, None, {}, F.lit(False), tables)
            continue
        dialect = S.HEADER_DIALECT[edition]
        priority = resolve_column(df.columns, code, dialect)
        options = name_options(option_block(df.columns, prefix, dialect), S.GENAI_ITEMS, strict=False)
        keyed = df.select(
            ROW_ID, EDITION, blank_to_null(quoted(priority)).alias("__raw_priority"),
            *[quoted(c) for c in options],
        )
        if validate:
            M.require_mapped(keyed, [("__raw_priority", tables["ai_priority"], "raw_value")], EDITION)
        parts[edition] = ai_fact(keyed, "__raw_priority", options, F.lit(True), tables)
    return stack(parts)


def question_availability(spark: SparkSession, headers: Mapping[str, list[str]]) -> DataFrame:
    """Which canonical field each edition asked, under which code and column."""
    rows = []
    for edition, columns in headers.items():
        dialect = S.HEADER_DIALECT[edition]
        codes = S.field_codes(edition)
        for field, column in resolve_fields(columns, codes, dialect).items():
            rows.append((field, edition, codes[field], column, column is not None))
    return literal_table(
        spark, rows,
        "field string, survey_year string, question_code string, source_column string, question_available boolean",
    )
