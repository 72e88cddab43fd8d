"""Carrier-phase and code combinations."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tecframe import fixed
from tecframe.functions._col import ColumnLike, col

_LAMBDA_1 = fixed.LIGHT_SPEED / fixed.GPS_L1_HZ
_LAMBDA_2 = fixed.LIGHT_SPEED / fixed.GPS_L2_HZ
_LAMBDA_WIDE = fixed.LIGHT_SPEED / (fixed.GPS_L1_HZ - fixed.GPS_L2_HZ)


def gf_phase(l1: ColumnLike, l2: ColumnLike) -> Column:
    """Geometry-free phase in metres."""
    return col(l1) * _LAMBDA_1 - col(l2) * _LAMBDA_2


def phase_stec(l1: ColumnLike, l2: ColumnLike) -> Column:
    """Slant electron content from phases, TECU, unlevelled."""
    return gf_phase(l1, l2) * fixed.TECU_PER_METRE


def code_stec(c1: ColumnLike, c2: ColumnLike) -> Column:
    """Slant electron content from codes, TECU, no bias removed."""
    return (col(c2) - col(c1)) * fixed.TECU_PER_METRE


def melbourne_wubbena(
    l1: ColumnLike, l2: ColumnLike, c1: ColumnLike, c2: ColumnLike
) -> Column:
    """Wide-lane phase minus narrow-lane code, cycles."""
    narrow = (col(c1) * fixed.GPS_L1_HZ + col(c2) * fixed.GPS_L2_HZ) / (
        fixed.GPS_L1_HZ + fixed.GPS_L2_HZ
    )
    return ((col(l1) - col(l2)) * _LAMBDA_WIDE - narrow) / _LAMBDA_WIDE


def carrier(system: ColumnLike, band: ColumnLike) -> Column:
    """Carrier frequency in Hz; unknown pairs give L1."""
    table = F.create_map(
        *[F.lit(v) for (s, b), hz in fixed.CARRIERS.items() for v in (f"{s}/{b}", hz)]
    )
    key = F.concat_ws("/", col(system), F.upper(col(band)))
    return F.coalesce(F.element_at(table, key), F.lit(fixed.GPS_L1_HZ))


def stec_gf(p1: ColumnLike, p2: ColumnLike, f1: ColumnLike, f2: ColumnLike) -> Column:
    """Slant electron content from two ranges on any two carriers."""
    a, b = col(f1) * col(f1), col(f2) * col(f2)
    return (col(p2) - col(p1)) / fixed.STEC_K * (a * b / (a - b))


def dcb_m(ns: ColumnLike) -> Column:
    """Bias in nanoseconds to metres."""
    return col(ns) * 1e-9 * fixed.LIGHT_SPEED


def dcb_tecu(ns: ColumnLike) -> Column:
    """Bias in nanoseconds to TECU."""
    return dcb_m(ns) * fixed.TECU_PER_METRE


def vtec_source(code: ColumnLike, fallback: ColumnLike) -> Column:
    """A finite code value wins over the levelled phase, row by row."""
    c = col(code)
    ok = ~F.isnan(c) & (F.abs(c) < float("inf"))
    return F.coalesce(F.when(ok, c), col(fallback))
