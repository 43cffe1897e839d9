"""Parse value-band labels into bounds without inventing any bound."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The wording of open bands and the money pattern.
UPPER_OPEN_PREFIX = "Acima de"
LOWER_OPEN_PREFIX = "Menos de"
MONEY = r"R\$\s*(\d[\d.]*)"


def parse_band(label: Column) -> Column:
    """Struct of lower_bound, upper_bound, midpoint, open_ended, anomaly_flag.

    A closed band has a midpoint unless its upper bound lies below its lower bound, which is
    flagged and left without one. Open bands keep the missing bound and the midpoint NULL.
    A label that is no band gives NULLs and no flag.
    """
    amounts = F.transform(
        F.regexp_extract_all(label, F.lit(MONEY), 1),
        lambda digits: F.replace(digits, F.lit("."), F.lit("")).cast("double"),
    )
    first, second = F.get(amounts, 0), F.get(amounts, 1)
    closed = F.size(amounts) == 2
    upper_open = (F.size(amounts) == 1) & F.startswith(label, F.lit(UPPER_OPEN_PREFIX))
    lower_open = (F.size(amounts) == 1) & F.startswith(label, F.lit(LOWER_OPEN_PREFIX))
    return F.struct(
        F.when(closed | upper_open, first).alias("lower_bound"),
        F.when(closed, second).when(lower_open, first).alias("upper_bound"),
        F.when(closed & (second >= first), (first + second) / 2).alias("midpoint"),
        F.when(closed, F.lit("CLOSED"))
        .when(upper_open, F.lit("UPPER_OPEN"))
        .when(lower_open, F.lit("LOWER_OPEN"))
        .alias("open_ended"),
        F.coalesce(closed & (second < first), F.lit(False)).alias("anomaly_flag"),
    )
