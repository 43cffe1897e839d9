"""Column expressions shared by the operators. All of them stay inside codegen."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def quoted(name: str) -> Column:
    """Column by its literal name, whatever dots, quotes or blanks the header has."""
    return F.col(_name(name))


def as_number(col: Column) -> Column:
    """Number or NULL; a malformed value never raises."""
    return col.try_cast("double")


def flag_to_boolean(col: Column) -> Column:
    """1 becomes true, 0 becomes false, anything else is NULL."""
    number = as_number(col)
    return F.when(number == 1.0, F.lit(True)).when(number == 0.0, F.lit(False))


def _name(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def any_answered(columns: Sequence[str]) -> Column:
    """True where at least one column of a block holds an answer."""
    if not columns:
        raise ValueError("an option block needs at least one column")
    return F.expr(f"coalesce({', '.join(_name(c) for c in columns)}) IS NOT NULL")


def selected_sql(column: str) -> str:
    """True only for an explicit 1; blank and malformed values are false.

    SQL text, because blocks have dozens of columns and one parsed expression per column keeps
    planning fast.
    """
    return f"coalesce(try_cast({_name(column)} AS DOUBLE) = 1.0D, false)"


def selected_or_null_sql(column: str) -> str:
    """1 for an explicit 1, else NULL: what ``count`` adds up with the least generated code."""
    return f"CASE WHEN try_cast({_name(column)} AS DOUBLE) = 1.0D THEN 1 END"


def is_selected(column: str) -> Column:
    return F.expr(selected_sql(column))


def blank_to_null(col: Column) -> Column:
    return F.nullif(col, F.lit(""))


def numbered_key(prefix: Column, number: Column) -> Column:
    """``prefix_000042``; numbers beyond six digits widen instead of being cut."""
    return F.format_string("%s_%06d", prefix, number.cast("bigint"))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division as double; NULL where the denominator is zero."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def relative_lift(value: Column, base: Column) -> Column:
    """(value - base) / base, NULL where the base is zero or either side is missing."""
    return ratio(value - base, base)


def sign_label(col: Column, positive: str, otherwise: str) -> Column:
    return F.when(col > 0, F.lit(positive)).otherwise(F.lit(otherwise))


def position_in(col: Column, order: Sequence[str]) -> Column:
    """1-based position in a fixed domain order; 0 when the value is not part of it."""
    return F.array_position(F.array(*[F.lit(v) for v in order]), col)


def display_label(col: Column, labels: Mapping[str, str], keep_unknown: bool = True) -> Column:
    """Label of a code from a short fixed dictionary; unknown codes stay or become NULL."""
    pairs = [F.lit(x) for item in labels.items() for x in item]
    label = F.try_element_at(F.create_map(*pairs), col)
    return F.coalesce(label, col) if keep_unknown else label


def any_of(col: Column, values: Sequence[str]) -> Column:
    """Membership where a missing value counts as not a member."""
    return F.coalesce(col.isin(*values), F.lit(False))
