from __future__ import annotations

from pyspark.sql import Column, functions as F

ColumnLike = Column | str | int | float


def col(value: ColumnLike) -> Column:
    """Names become columns, numbers become literals."""
    if isinstance(value, Column):
        return value
    if isinstance(value, str):
        return F.col(value)
    return F.lit(value)


def micros(value: ColumnLike) -> Column:
    """Microseconds since the epoch, as an exact integer."""
    return F.unix_micros(col(value).cast("timestamp"))


def finite(value: ColumnLike) -> Column:
    """NaN and infinities become NULL."""
    x = col(value)
    bad = F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    return F.when(~bad, x)


def let(value: Column, body) -> Column:
    """``body(value)`` with the value worked out once per row.

    Array expressions are not shared between branches of an expression; bound
    to a lambda variable they are.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))
