"""Mapping files of the survey: a folder of versioned tables that replace the built-in ones.

``mapping_<name>.csv`` replaces the table of that name; a table without a file stays as configured. Further columns of a file say
when and where a row holds: ``survey_year_scope`` (``all`` or a comma list of editions) or ``valid_from`` and ``valid_to`` (editions, the last
one not included, blank: open), and ``mapping_version``. Intervals are checked when a table is first used.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelloom.operators import effective
from panelloom.operators import mapping as M
from panelloom.plans import silver
from panelloom.plans import survey_config as S
from panelloom.sources.header_index import list_files
from panelloom.sources.sinks import write_csv
from panelloom.sources.tables import read_mapping

NAMES = ("gender", "seniority", "work_model", "employment_status", "ai_priority", "company_size", "role", "salary_band", "technology")
# Columns of some files under the names the tables use.
_RENAMED = {"raw_label": "raw_value", "canonical_technology": "canonical_value"}
_NOT_MEANING = ("notes",)


class StoredMappings(silver.Mappings):
    """The nine tables, those with a file below ``folder`` read from there."""

    def __init__(self, spark: SparkSession, folder: str):
        super().__init__(spark)
        self._files: dict[str, list[str]] = {}
        for file in list_files(spark, folder):
            for name in NAMES:
                # A file, or a folder of part files as Spark writes it.
                if f"/mapping_{name}.csv" in file:
                    self._files.setdefault(name, []).append(file)
        if not self._files:
            raise FileNotFoundError(f"no mapping_<name>.csv below {folder}")

    def _build(self, name: str) -> DataFrame:
        if name not in self._files:
            return super()._build(name)
        table = read_mapping(self._spark, self._files[name])
        table = table.withColumnsRenamed({a: b for a, b in _RENAMED.items() if a in table.columns}).drop(*_NOT_MEANING)
        keys = ["raw_value"]
        if "survey_year_scope" in table.columns:
            table = M.expand_scope(table, S.EDITIONS, "survey_year_scope", silver.EDITION)
            keys.append(silver.EDITION)
        if effective.START in table.columns:
            effective.require_intervals(table, keys)
            table = effective.expand_validity(table, S.EDITIONS, "__edition")
            if silver.EDITION in table.columns:
                table = table.where(F.col("__edition") == F.col(silver.EDITION)).drop("__edition")
            else:
                table = table.withColumnRenamed("__edition", silver.EDITION)
                keys.append(silver.EDITION)
        repeated = M.duplicate_mapping_keys(table, keys).limit(20).collect()
        if repeated:
            raise ValueError(f"mapping {name!r} has several rows for: {sorted(map(str, (tuple(r) for r in repeated)))}")
        if effective.VERSION not in table.columns:
            table = table.withColumn(effective.VERSION, F.lit(S.MAPPING_VERSION))
        return table


def fingerprints(tables: Mapping[str, DataFrame]) -> dict[tuple[str, str], str]:
    """``(edition, mapping) -> text`` that changes when any row in force in that edition does; one job over all mappings."""
    parts = []
    for name in NAMES:
        table = tables[name]
        editions = F.col(silver.EDITION) if silver.EDITION in table.columns else F.explode(F.array(*[F.lit(e) for e in S.EDITIONS]))
        content = F.to_json(F.struct(*sorted(c for c in table.columns if c != silver.EDITION)))
        parts.append(table.select(F.lit(name).alias("mapping"), content.alias("row"), editions.alias("edition")))
    rows = reduce(DataFrame.unionByName, parts).withColumns({"a": F.xxhash64("row"), "b": F.xxhash64("row", F.lit(1))})
    counted = rows.groupBy("edition", "mapping").agg(F.count(F.lit(1)).alias("n"), F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"))
    return {(r["edition"], r["mapping"]): f"{r['n']}:{r['a']}:{r['b']}" for r in counted.collect()}


def write_mappings(tables: Mapping[str, DataFrame], folder: str) -> None:
    """Mapping tables as files that :class:`StoredMappings` reads."""
    for name, table in tables.items():
        write_csv(table, f"{folder.rstrip('/')}/mapping_{name}.csv")
