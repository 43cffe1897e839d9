"""The whole survey in order: raw files to Bronze, Silver, Gold and answers."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from functools import partial

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from panelloom.operators import observed
from panelloom.operators.observed import Observed
from panelloom.plans import answers as answer_plans
from panelloom.plans import gold as G
from panelloom.plans import silver
from panelloom.plans import survey_config as S
from panelloom.plans.mapping_store import StoredMappings, fingerprints
from panelloom.session import side_by_side
from panelloom.sources.bronze import LINEAGE, ingest_edition, read_bronze
from panelloom.sources.header_index import files_state
from panelloom.sources.sinks import write_answer, write_partitioned, write_table
from panelloom.sources.tables import literal_table

DIMENSION_TABLES = {
    "gold_compensation_by_role": "current_role",
    "gold_compensation_by_seniority": "seniority",
    "gold_compensation_by_region": "region",
    "gold_compensation_by_work_model": "current_work_model",
}


# Fields whose share of UNKNOWN the quality report gives.
UNKNOWN_FIELDS = ("gender", "employment_status", "seniority", "current_work_model", "current_role")


@dataclass(frozen=True)
class SilverTables:
    fact: DataFrame
    bridge: DataFrame
    ai: DataFrame


def known_codes(edition: str) -> set[str]:
    """Question codes and block prefixes the configuration knows in an edition; only these may extend a header."""
    codes = {c for c in S.field_codes(edition).values() if c} | {p[edition] for p in S.OPTION_FAMILIES.values() if p.get(edition)}
    codes |= {c for c in (S.AI_PRIORITY_CODE[edition], S.GENAI_PREFIX[edition]) if c}
    return codes | {prefix[:-1] for prefix in codes if prefix.endswith(("_", "."))}


def land_bronze(spark: SparkSession, raw: Mapping[str, str], root: str, multi_line: bool = True) -> dict[str, DataFrame]:
    """Ingest each edition's raw CSV (edition to path) below ``root``/bronze."""
    def land(edition: str) -> DataFrame:
        return ingest_edition(
            spark, raw[edition], f"{root}/bronze", edition, multi_line=multi_line, dialect=S.HEADER_DIALECT[edition], known=known_codes(edition)
        )

    return dict(zip(raw, side_by_side(spark, [partial(land, e) for e in raw]), strict=True))


def write_silver(spark: SparkSession, bronze: Mapping[str, DataFrame], root: str, tables: Mapping[str, DataFrame] | None = None) -> SilverTables:
    """Write the three Silver tables and return them as stored, so nothing is computed twice.

    Only the partitions of the editions in ``bronze`` are written. The counts of the quality report are taken by the job that writes the
    respondents and stored by edition, see :func:`read_quality`.
    """
    tables = tables or silver.default_mappings(spark)
    raw = Observed(silver.EDITION, S.EDITIONS)
    watched = Observed(
        silver.EDITION, S.EDITIONS, [c for c in silver.FACT_COLUMNS if c not in LINEAGE], UNKNOWN_FIELDS,
        open_ended="salary_open_ended", anomaly="salary_anomaly_flag",
    )
    tables["ai_priority"]  # built once, before the tables are made side by side

    def write(name: str, make: Callable[[], DataFrame]) -> None:
        write_partitioned(make(), f"{root}/silver/{name}")

    side_by_side(spark, [
        partial(write, "respondents", lambda: watched.watch(silver.build_fact_respondent(bronze, tables, watch=raw.watch))),
        partial(write, "bridge_respondent_technology", lambda: silver.build_technology_bridge(bronze, tables)),
        partial(write, "fact_ai_adoption", lambda: silver.build_ai_fact(bronze, tables)),
    ])
    for name, counts in {"raw": raw, "respondents": watched}.items():
        write_partitioned(counts.counts(spark), f"{root}/quality/{name}")
    return read_silver(spark, root)


def read_quality(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The quality report over all stored editions, from counts taken while Silver was written."""
    raw, counts = spark.read.parquet(f"{root}/quality/raw"), spark.read.parquet(f"{root}/quality/respondents")
    return {
        "reconcile": observed.reconcile(raw, counts, silver.EDITION),
        "unknown_matrix": observed.value_rate_matrix(counts, silver.EDITION, S.EDITIONS),
        "missing_profile": observed.missing_profile(counts),
        "band_flags": observed.band_counts(counts, silver.EDITION),
    }


def read_silver(spark: SparkSession, root: str) -> SilverTables:
    return SilverTables(
        spark.read.parquet(f"{root}/silver/respondents"),
        spark.read.parquet(f"{root}/silver/bridge_respondent_technology"),
        spark.read.parquet(f"{root}/silver/fact_ai_adoption"),
    )


# Inputs of the stored Silver tables: one row per edition and input.
_INPUTS = "edition string, input string, state string"
_RAW, _CODE = "raw files", "pipeline"


def _stored_inputs(spark: SparkSession, root: str) -> dict[tuple[str, str], str]:
    try:
        rows = spark.read.schema(_INPUTS).parquet(f"{root}/silver/_inputs").collect()
    except AnalysisException:  # nothing stored yet
        return {}
    return {(r["edition"], r["input"]): r["state"] for r in rows}


def changed_editions(before: Mapping[tuple[str, str], str], now: Mapping[tuple[str, str], str]) -> list[str]:
    """Editions of which any input is new, gone or in another state."""
    return sorted({key[0] for key in {**before, **now} if before.get(key) != now.get(key)} & {e for e, _ in now})


def refresh(spark: SparkSession, raw: Mapping[str, str], root: str, mappings: str | None = None, multi_line: bool = True) -> tuple[SilverTables, list[str]]:
    """Bring Bronze and Silver up to date and say which editions had to be processed.

    An edition is landed again if its raw files changed, and harmonized again if they did or if any mapping row in force in it did.
    The state of all inputs is kept beside the Silver tables; it is dropped before they are touched and written when they
    are complete, so an interrupted run repeats its work.
    """
    tables = silver.default_mappings(spark) if mappings is None else StoredMappings(spark, mappings)
    before = _stored_inputs(spark, root)
    meanings = fingerprints(tables)
    files = {edition: files_state(spark, path) for edition, path in raw.items()}
    now = {
        **{(edition, _RAW): state for edition, state in files.items()},
        **{(edition, _CODE): S.PIPELINE_VERSION for edition in raw},
        **{key: state for key, state in meanings.items() if key[0] in raw},
    }
    changed = changed_editions(before, now)
    if changed:
        _write_inputs(spark, {k: v for k, v in before.items() if k[0] not in changed}, root)
        new_files = [e for e in changed if before.get((e, _RAW)) != files[e]]
        bronze = land_bronze(spark, {e: raw[e] for e in new_files}, root, multi_line)
        bronze.update({e: read_bronze(spark, f"{root}/bronze", e) for e in changed if e not in new_files})
        write_silver(spark, {e: bronze[e] for e in changed}, root, tables)
        kept = {**{k: v for k, v in before.items() if k[0] not in changed}, **{k: v for k, v in now.items() if k[0] in changed}}
        _write_inputs(spark, kept, root)
    return read_silver(spark, root), changed


def _write_inputs(spark: SparkSession, states: Mapping[tuple[str, str], str], root: str) -> None:
    rows = [(edition, name, state) for (edition, name), state in states.items()] or [(None, None, None)]
    write_table(literal_table(spark, rows, _INPUTS).where("edition is not null"), f"{root}/silver/_inputs")


def gold_tables(tables: SilverTables, adoption: DataFrame | None = None) -> dict[str, DataFrame]:
    """The nine Gold tables by name. ``adoption`` replaces the bridge as source of the rates."""
    technology = G.technology_adoption_from_bridge(tables.bridge) if adoption is None else G.technology_adoption(adoption)
    return {
        "gold_market_overview": G.market_overview(tables.fact),
        **{name: G.compensation_by(tables.fact, dimension) for name, dimension in DIMENSION_TABLES.items()},
        "gold_gender_representation": G.gender_representation(tables.fact),
        "gold_technology_adoption_by_year": technology,
        "gold_ai_adoption_overview": G.ai_adoption_overview(tables.ai),
        "gold_skill_priority_score": G.skill_priority_score(tables.bridge, tables.fact, technology),
    }


def run(spark: SparkSession, raw: Mapping[str, str], root: str, multi_line: bool = True, mappings: str | None = None) -> dict[str, DataFrame]:
    """Raw CSV files to stored answers. Every layer is read back from storage by the next one.

    ``mappings`` is a folder of mapping files, see :mod:`panelloom.plans.mapping_store`. Run again on the same ``root``, only editions
    whose raw files or mapping rows changed are processed; with nothing changed the stored tables are returned.
    """
    stored, changed = refresh(spark, raw, root, mappings, multi_line)
    if changed:
        bronze = {e: read_bronze(spark, f"{root}/bronze", e) for e in raw}
        write_all(spark, {**gold_tables(stored), **family_tables(spark, bronze)}, f"{root}/gold")
    gold = read_gold(spark, root)
    answers = answer_plans.all_answers(gold)
    if changed:
        side_by_side(spark, [partial(write_answer, table, f"{root}/gold/business_answers/{name}") for name, table in answers.items()])
    return {**gold, **answers}


def write_all(spark: SparkSession, tables: Mapping[str, DataFrame], folder: str) -> None:
    side_by_side(spark, [partial(write_table, table, f"{folder}/{name}") for name, table in tables.items()])


def family_tables(spark: SparkSession, bronze: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Adoption, rank and change of every further option family whose block some edition printed."""
    headers = {e: df.columns for e, df in bronze.items()}
    present = sorted({family for family, _, _ in silver.family_labels(headers)} - {"DATABASE"})
    if not present:
        return {}
    names = silver.family_names(spark, headers, present)
    return {f"gold_{family.lower()}_adoption": G.technology_adoption(silver.family_adoption(bronze, family, names)) for family in present}


def read_gold(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    names = (
        "gold_market_overview", *DIMENSION_TABLES, "gold_gender_representation",
        "gold_technology_adoption_by_year", "gold_ai_adoption_overview", "gold_skill_priority_score",
    )
    return {name: spark.read.parquet(f"{root}/gold/{name}") for name in names}
