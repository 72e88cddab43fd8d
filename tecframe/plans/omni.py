"""Solar-wind and geomagnetic index tables."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, functions as F

from tecframe import fixed
from tecframe.functions.indices import kp_decimal, kp_level, null_if
from tecframe.functions.timefn import plot_time
from tecframe.operators.aggregates import kp_3hour
from tecframe.operators.joins import tag_windows


class OmniTables(NamedTuple):
    bz: DataFrame
    hourly: DataFrame
    kp: DataFrame


def clean_bz(raw: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    return raw.select(*keep, "Time", null_if("IMF_Bz_nT", fixed.BZ_MISSING).alias("IMF_Bz_nT"))


def clean_hourly(raw: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    code = null_if("Kp_code", fixed.KP_MISSING)
    return raw.select(
        *keep, "Time", code.alias("Kp_code"), null_if("Dst_nT", fixed.DST_MISSING).alias("Dst_nT"),
        plot_time("Time").alias("PlotTime"), kp_decimal(code).alias("Kp"),
    )


def build_omni(bz: DataFrame, indices: DataFrame, by: Sequence[str] = ()) -> OmniTables:
    """The three index tables; ``by`` names series that are kept apart."""
    hourly = clean_hourly(indices, by)
    kp = kp_3hour(hourly, by).withColumn("level", kp_level("Kp"))
    return OmniTables(clean_bz(bz, by), hourly, kp)


def highlight(series: DataFrame, windows: DataFrame, *, time: str = "Time") -> DataFrame:
    """Rows inside highlight windows; an alpha outside 0..1 is an error."""
    ok = F.col("alpha").isNull() | F.col("alpha").between(0.0, 1.0)
    checked = windows.withColumn(
        "alpha", F.when(ok, F.col("alpha")).otherwise(F.raise_error(F.lit("alpha must lie in 0..1")).cast("double"))
    )
    return tag_windows(series, checked, time=time)
