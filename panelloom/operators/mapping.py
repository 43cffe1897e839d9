"""Harmonize raw values through mapping tables that fail loudly on unmapped values.

Mapping tables join without a hint: they are inline relations or small files, whose size
Spark knows and checks against its broadcast threshold.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelloom.functions.bands import parse_band
from panelloom.functions.scalars import quoted
from panelloom.operators.similar import nearest_known
from panelloom.sources.tables import literal_table

UNKNOWN = "UNKNOWN"
ALL_EDITIONS = "all"


def map_values(
    df: DataFrame,
    source: str,
    targets: Mapping[str, str],
    mapping: DataFrame,
    raw: str = "raw_value",
    also_on: Mapping[str, str] | None = None,
    unknown: str = UNKNOWN,
) -> DataFrame:
    """Left lookup of ``source``; every target column takes one column of the mapping.

    A NULL source meets the mapping row without a raw value; where the mapping has none, string
    targets become ``unknown``. A value missing from the mapping stays NULL here and is what
    :func:`unmapped_values` reports. ``also_on`` adds key columns (df column to mapping column).
    """
    also_on = dict(also_on or {})
    renamed = mapping.select(
        F.col(raw).alias("__raw"),
        *[F.col(c).alias(f"__key_{i}") for i, c in enumerate(also_on.values())],
        *[F.col(c).alias(f"__value_{i}") for i, c in enumerate(targets.values())],
    )
    on = quoted(source).eqNullSafe(F.col("__raw"))
    for i, column in enumerate(also_on):
        on = on & (quoted(column) == F.col(f"__key_{i}"))
    types = dict(renamed.dtypes)
    values = {}
    for i, target in enumerate(targets):
        value = F.col(f"__value_{i}")
        if types[f"__value_{i}"] == "string":
            value = F.when(quoted(source).isNull(), F.coalesce(value, F.lit(unknown))).otherwise(value)
        values[target] = value
    return df.join(renamed, on, "left").withColumns(values).drop(*renamed.columns)


def expand_scope(mapping: DataFrame, editions: Sequence[str], scope: str, edition: str = "survey_year") -> DataFrame:
    """One mapping row per edition from a scope that is ``all`` or a comma list."""
    listed = F.transform(F.split(F.col(scope), ","), lambda s: F.trim(s))
    every = F.array(*[F.lit(e) for e in editions])
    return mapping.withColumn(
        edition, F.explode(F.when(F.col(scope) == ALL_EDITIONS, every).otherwise(listed))
    ).drop(scope)


def band_table(labels: DataFrame, label: str = "raw_value", prefix: str = "salary_") -> DataFrame:
    """Bounds of each distinct band label, ready to be looked up."""
    band = parse_band(F.col(label))
    return labels.select(
        label,
        band["lower_bound"].alias(f"{prefix}lower_bound"),
        band["upper_bound"].alias(f"{prefix}upper_bound"),
        band["midpoint"].alias(f"{prefix}midpoint"),
        band["open_ended"].alias("open_ended"),
        band["anomaly_flag"].alias("anomaly_flag"),
    )


def attach_bands(df: DataFrame, source: str, bands: DataFrame, raw: str = "raw_value", prefix: str = "salary_") -> DataFrame:
    """Bounds, midpoint, open-ended kind and anomaly flag of a band label (false if unmatched)."""
    looked_up = bands.select(
        F.col(raw).alias("__raw"),
        *[F.col(f"{prefix}{c}").alias(f"__{c}") for c in ("lower_bound", "upper_bound", "midpoint")],
        F.col("open_ended").alias("__open_ended"),
        F.col("anomaly_flag").cast("boolean").alias("__anomaly_flag"),
    )
    attached = {
        f"{prefix}lower_bound": F.col("__lower_bound"),
        f"{prefix}upper_bound": F.col("__upper_bound"),
        f"{prefix}midpoint": F.col("__midpoint"),
        f"{prefix}open_ended": F.col("__open_ended"),
        f"{prefix}anomaly_flag": F.coalesce("__anomaly_flag", F.lit(False)),
    }
    joined = df.join(looked_up, quoted(source) == F.col("__raw"), "left")
    return joined.withColumns(attached).drop(*looked_up.columns)


def _known_values(specs: Sequence[tuple[str, DataFrame, str]], edition: str | None) -> DataFrame:
    parts = []
    for column, mapping, raw in specs:
        scoped = edition is not None and edition in mapping.columns
        parts.append(
            mapping.where(F.col(raw).isNotNull()).select(
                F.lit(column).alias("field"),
                F.col(raw).alias("raw_value"),
                (F.col(edition) if scoped else F.lit(None).cast("string")).alias("edition"),
            )
        )
    return reduce(DataFrame.unionByName, parts)


def unmapped_values(df: DataFrame, specs: Sequence[tuple[str, DataFrame, str]], edition: str | None = None) -> DataFrame:
    """``field, edition, raw_value`` of every value no mapping knows, for all columns in one job.

    ``specs`` lists (column, mapping, raw column of the mapping). A mapping that has the edition
    column is scoped: it is matched per edition. Values are made distinct before they leave
    the scan, so only the vocabulary is shuffled.
    """
    scoped = [c for c, m, _ in specs if edition is not None and edition in m.columns]
    ids = [edition] if scoped else []
    seen = (
        df.select(*ids, *[quoted(c).cast("string").alias(c) for c, _, _ in specs])
        .unpivot(ids, [c for c, _, _ in specs], "field", "raw_value")
        .where(F.col("raw_value").isNotNull())
        .select(
            "field",
            "raw_value",
            (F.when(F.col("field").isin(*scoped), F.col(edition)) if scoped else F.lit(None).cast("string")).alias("edition"),
        )
        .distinct()
    )
    known = _known_values(specs, edition).alias("known")
    seen = seen.alias("seen")
    match = (
        (F.col("seen.field") == F.col("known.field"))
        & (F.col("seen.raw_value") == F.col("known.raw_value"))
        & F.col("seen.edition").eqNullSafe(F.col("known.edition"))
    )
    return seen.join(known, match, "left_anti").select("field", "edition", "raw_value")


def require_mapped(df: DataFrame, specs: Sequence[tuple[str, DataFrame, str]], edition: str | None = None, sample: int = 20) -> None:
    """Fail with the first unmapped values and what each might be, if there are any."""
    found = unmapped_sample(df, specs, edition, sample).collect()
    if found:
        listing = [(r["field"], r["edition"] or "", r["raw_value"]) for r in found]
        raise ValueError(f"unmapped raw values (add them to the mapping tables): {listing}; nearest known values: {_advice(df, specs, listing)}")


def unmapped_sample(df: DataFrame, specs: Sequence[tuple[str, DataFrame, str]], edition: str | None = None, sample: int = 20) -> DataFrame:
    """The first ``sample`` unmapped values in order of field, edition and value: the same ones in every run."""
    return unmapped_values(df, specs, edition).orderBy("field", "edition", "raw_value").limit(sample)


def _advice(df: DataFrame, specs: Sequence[tuple[str, DataFrame, str]], listing: Sequence[tuple[str, str, str]]) -> dict[str, list[str]]:
    """Per listed value the known values of its field that are nearest; at most three for each of the few listed ones."""
    unknown = literal_table(df.sparkSession, sorted({(field, raw) for field, _, raw in listing}), "field string, raw_value string")
    known = _known_values(specs, None).select("field", F.col("raw_value").cast("string").alias("raw_value")).distinct()
    found: dict[str, list[str]] = {}
    for r in nearest_known(unknown, known, ["field"]).orderBy("field", "raw_value", "place").collect():
        found.setdefault(r["raw_value"], []).append(r["suggestion"])
    return found


def duplicate_mapping_keys(mapping: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Mapping keys that would fan out a lookup."""
    return mapping.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > 1)


def label_table(df: DataFrame, source: str, target: str, labels: DataFrame, key: str, label: str) -> DataFrame:
    """Display label with the code itself as fallback."""
    looked_up = labels.select(F.col(key).alias("__key"), F.col(label).alias("__label"))
    return df.join(looked_up, quoted(source) == F.col("__key"), "left").select(
        *[quoted(c) for c in df.columns], F.coalesce("__label", quoted(source)).alias(target)
    )
