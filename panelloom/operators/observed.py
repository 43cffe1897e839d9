"""A quality report that costs no scan: its counts are collected while a table is written.

:class:`Observed` adds an observation to a table. The job that writes the table runs the counts along with it, as plain conditional
counters; when it is done they are there, one long table of ``period, measure, field, hits, rows``. The usual reports are
views of that table. The periods must be known beforehand, as an observation has no groups; rows of any other period count under ``period``
NULL, so that none is left out.
"""

from __future__ import annotations

from collections.abc import Collection, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from panelloom.functions.scalars import quoted, ratio
from panelloom.operators.reshape import pivot_periods
from panelloom.sources.tables import literal_table

ROWS, MISSING, VALUE, OPEN_ENDED, ANOMALY = "rows", "missing", "value", "open_ended", "anomaly"
_OPEN = ("UPPER_OPEN", "LOWER_OPEN")


class Observed:
    """Counts to be taken of a table per period: rows, missing cells, one value of some fields, band flags."""

    def __init__(
        self,
        period: str,
        periods: Sequence[str],
        missing: Collection[str] = (),
        fields: Collection[str] = (),
        value: str = "UNKNOWN",
        open_ended: str | None = None,
        anomaly: str | None = None,
    ):
        self.period, self.periods = period, list(periods)
        self._measures: list[tuple[str, str | None, Column]] = [(ROWS, None, F.lit(True))]
        self._measures += [(MISSING, c, quoted(c).isNull()) for c in missing]
        self._measures += [(VALUE, c, quoted(c) == value) for c in fields]
        if open_ended:
            self._measures.append((OPEN_ENDED, open_ended, quoted(open_ended).isin(*_OPEN)))
        if anomaly:
            self._measures.append((ANOMALY, anomaly, quoted(anomaly)))
        self._observation: Observation | None = None

    def _of_period(self, period: str | None) -> Column:
        column = quoted(self.period)
        if period is None:
            return ~F.coalesce(column.isin(*self.periods), F.lit(False))
        return column.eqNullSafe(F.lit(period))

    def watch(self, df: DataFrame) -> DataFrame:
        """The same table; whatever job reads it whole first takes the counts."""
        self._observation = Observation()
        counters = [
            F.count_if(self._of_period(p) & F.coalesce(condition, F.lit(False))).alias(f"m{i}_{j}")
            for j, p in enumerate([*self.periods, None])
            for i, (_, _, condition) in enumerate(self._measures)
        ]
        return df.observe(self._observation, *counters)

    def counts(self, spark: SparkSession) -> DataFrame:
        """``period, measure, field, hits, rows`` of the periods that had rows, once the watched table has been written."""
        if self._observation is None:
            raise ValueError("nothing is watched")
        found = self._observation.get
        rows = []
        for j, p in enumerate([*self.periods, None]):
            total = found[f"m0_{j}"]
            if total:
                rows += [(p, measure, field, found[f"m{i}_{j}"], total) for i, (measure, field, _) in enumerate(self._measures)]
        schema = f"`{self.period}` string, measure string, field string, hits bigint, rows bigint"
        return literal_table(spark, rows or [(None, None, None, 0, 0)], schema).where("measure is not null")


def rows_per_period(counts: DataFrame, period: str) -> DataFrame:
    return counts.where(F.col("measure") == ROWS).select(period, "rows")


def missing_profile(counts: DataFrame) -> DataFrame:
    """What :func:`panelloom.operators.quality.missing_profile` gives for the watched columns."""
    per_column = counts.where(F.col("measure") == MISSING).groupBy(F.col("field").alias("column"))
    return per_column.agg(ratio(F.sum("hits"), F.sum("rows")).alias("missing_rate"))


def value_rate_matrix(counts: DataFrame, period: str, periods: Sequence[str]) -> DataFrame:
    """What :func:`panelloom.operators.quality.value_rate_matrix` gives for the watched fields."""
    rates = counts.where(F.col("measure") == VALUE).withColumn("rate", ratio(F.col("hits"), F.col("rows")))
    return pivot_periods(rates, "field", period, periods, "rate")


def band_counts(counts: DataFrame, period: str) -> DataFrame:
    """What :func:`panelloom.operators.quality.band_counts` gives."""
    def of(measure: str) -> Column:
        return F.sum(F.when(F.col("measure") == measure, F.col("hits"))).cast("bigint")

    flagged = counts.where(F.col("measure").isin(OPEN_ENDED, ANOMALY))
    return flagged.groupBy(period).agg(of(OPEN_ENDED).alias("open_ended_rows"), of(ANOMALY).alias("anomaly_rows"))


def reconcile(before: DataFrame, after: DataFrame, period: str) -> DataFrame:
    """Rows per period of two watched tables and the difference, from their counts alone."""
    sides = [
        rows_per_period(counts, period).select(period, *[(F.col("rows") if side == mine else F.lit(0)).cast("bigint").alias(side) for side in ("b", "a")])
        for counts, mine in ((before, "b"), (after, "a"))
    ]
    total = reduce(DataFrame.unionByName, sides).groupBy(period)
    return total.agg(F.sum("b").alias("rows_before"), F.sum("a").alias("rows_after"), (F.sum("b") - F.sum("a")).alias("rows_lost"))
