"""Geomagnetic index decoding."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tecframe.functions._col import ColumnLike, col


def null_if(x: ColumnLike, missing: float | int) -> Column:
    """The sentinel becomes NULL."""
    return F.nullif(col(x), F.lit(missing))


def kp_decimal(code: ColumnLike) -> Column:
    """43 is 4 1/3, 47 is 4 2/3; a remainder other than 0, 3, 7 is plain tenths."""
    c = col(code).cast("long")
    whole, rest = F.floor(c / 10).cast("double"), F.pmod(c, F.lit(10))
    return (
        F.when(rest == 0, whole)
        .when(rest == 3, whole + 1.0 / 3.0)
        .when(rest == 7, whole + 2.0 / 3.0)
        .otherwise(c / 10.0)
    )


def kp_level(kp: ColumnLike) -> Column:
    """Class behind the bar colour."""
    k = col(kp)
    return (
        F.when(k.isNull() | F.isnan(k), F.lit("missing"))
        .when(k < 4.0, F.lit("quiet"))
        .when(k < 5.0, F.lit("active"))
        .otherwise(F.lit("storm"))
    )
