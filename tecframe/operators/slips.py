"""Cycle-slip detection: each decision depends on the ones before it."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

from tecframe import fixed
from tecframe.functions._col import micros
from tecframe.operators.batches import whole_groups

FLAG_FIELDS = [
    T.StructField("keep", T.BooleanType()),
    T.StructField("arc_id", T.LongType()),
    T.StructField("gap_break", T.BooleanType()),
    T.StructField("mw_break", T.BooleanType()),
    T.StructField("gf_break", T.BooleanType()),
    T.StructField("mw_tested", T.BooleanType()),
]


@dataclass(frozen=True)
class SlipParams:
    gap_sec: float = fixed.TARGET_INTERVAL_SEC * fixed.ARC_GAP_FACTOR
    enable_gf: bool = True
    mw_window: int = fixed.MW_WINDOW
    mw_threshold: float = fixed.MW_THRESHOLD_CYCLES
    gf_window: int = fixed.GF_WINDOW
    gf_degree: int = fixed.GF_DEGREE
    gf_threshold: float = fixed.GF_THRESHOLD_M
    drop: bool = True


def detect_slips(
    df: DataFrame,
    keys: Sequence[str],
    params: SlipParams = SlipParams(),
    *,
    time: str = "time",
    gf: str = "gf_phase",
    mw: str | None = "mw",
) -> DataFrame:
    """Adds keep, arc_id (-1 when dropped) and the trigger flags to every row.

    Rows of a track arrive sorted in one partition and are worked through in
    Arrow batches of many tracks; a track has at most one row per sampling
    interval.
    """
    keys = list(keys)
    mw_col = F.col(mw).cast("double") if mw else F.lit(None).cast("double")
    prepared = (
        df.withColumn("_us", micros(time))
        .withColumn("_gf", F.col(gf).cast("double"))
        .withColumn("_mw", mw_col)
        .repartition(*keys)
        .sortWithinPartitions(*keys, "_us")
    )
    schema = T.StructType([*df.schema.fields, *FLAG_FIELDS])
    names = df.columns

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf, starts in whole_groups(batches, keys):
            flags = slip_flags(
                pdf["_us"].to_numpy(np.int64),
                pdf["_gf"].to_numpy(float),
                pdf["_mw"].to_numpy(float, na_value=np.nan),
                starts,
                params,
            )
            yield pd.concat([pdf[names], flags.set_index(pdf.index)], axis=1)

    return prepared.mapInPandas(run, schema)


def slip_flags(
    us: np.ndarray, gf: np.ndarray, mw: np.ndarray, starts: np.ndarray, p: SlipParams
) -> pd.DataFrame:
    """Flags of many tracks at once; ``starts`` are the first rows of the tracks.

    Between two resets the history is an unbroken run of rows, so both tests
    are worked out for all rows beforehand. Only rows that could trigger are
    then visited in order: a test counts when its history began after the
    last reset.
    """
    n = len(us)
    mw_n, gf_n = max(1, int(p.mw_window)), max(1, int(p.gf_window))
    first = np.zeros(n, dtype=bool)
    first[starts] = True
    gap = np.zeros(n, dtype=bool)
    gap[1:] = (us[1:] - us[:-1]) > p.gap_sec * 1e6
    gap[first] = False

    begin = np.where(first | gap, np.arange(n), 0)
    begin = np.maximum.accumulate(begin)

    mw_from = np.full(n, -1, dtype=np.int64)
    mw_over = np.zeros(n, dtype=bool)
    fin = np.flatnonzero(np.isfinite(mw))
    if len(fin) > mw_n:
        rows, oldest = fin[mw_n:], fin[:-mw_n]
        inside = oldest >= begin[rows]
        rows, oldest = rows[inside], oldest[inside]
        if len(rows):
            runs = np.lib.stride_tricks.sliding_window_view(mw[fin], mw_n)[:-1][inside]
            mw_from[rows] = oldest
            mw_over[rows] = np.abs(mw[rows] - np.median(runs, axis=1)) > p.mw_threshold

    gf_over = np.zeros(n, dtype=bool)
    if p.enable_gf and n > gf_n:
        rows = np.arange(gf_n, n)
        rows = rows[rows - gf_n >= begin[rows]]
        if len(rows):
            predicted = _predict(us, gf, rows, gf_n, min(max(0, int(p.gf_degree)), gf_n - 1))
            with np.errstate(invalid="ignore"):
                gf_over[rows] = np.abs(gf[rows] - predicted) > p.gf_threshold

    keep = np.ones(n, dtype=bool)
    mw_break = np.zeros(n, dtype=bool)
    gf_break = np.zeros(n, dtype=bool)
    resets: list[int] = []
    reset = 0
    for i in np.flatnonzero(mw_over | gf_over):
        reset = max(reset, int(begin[i]))
        if mw_over[i] and mw_from[i] >= reset:
            mw_break[i] = True
            if p.drop:
                keep[i] = False
                reset = int(i) + 1
                resets.append(reset)
                continue
        if gf_over[i] and i - gf_n >= reset:
            gf_break[i] = True
            if p.drop:
                keep[i] = False
                reset = int(i) + 1
                resets.append(reset)

    # arcs: one step at every gap row and one after every dropped row
    step = gap.astype(np.int64)
    dropped = np.flatnonzero(~keep)
    dropped = dropped[dropped + 1 < n]
    np.add.at(step, dropped + 1, 1)
    running = np.cumsum(step)
    group = np.maximum.accumulate(np.where(first, np.arange(n), 0))
    arc = running - running[group]
    arc[~keep] = -1

    effective = begin.copy()
    if resets:
        mark = np.zeros(n, dtype=np.int64)
        at = np.array([r for r in resets if r < n], dtype=np.int64)
        mark[at] = at
        effective = np.maximum(effective, np.maximum.accumulate(mark))
    return pd.DataFrame(
        {
            "keep": keep,
            "arc_id": arc,
            "gap_break": gap,
            "mw_break": mw_break,
            "gf_break": gf_break,
            "mw_tested": (mw_from >= 0) & (mw_from >= effective),
        }
    )


def _predict(us: np.ndarray, gf: np.ndarray, rows: np.ndarray, n: int, degree: int) -> np.ndarray:
    """Polynomial through the n rows before each row, read off at the row."""
    at = rows[:, None] - np.arange(n, 0, -1)[None, :]
    x = (us[at] - us[rows][:, None]).astype(float)
    span = np.abs(x[:, :1])
    x /= np.where(span > 0, span, 1.0)
    y = gf[at]
    out = np.full(len(rows), np.nan)
    ok = np.isfinite(y).all(axis=1)
    if ok.any():
        basis = x[ok][:, :, None] ** np.arange(degree + 1)
        fit = np.linalg.pinv(basis) @ y[ok][:, :, None]
        out[ok] = fit[:, 0, 0]
    return out


def slip_diagnostics(flagged: DataFrame, keys: Sequence[str], *, code_pair: str | None = None) -> DataFrame:
    """Counters per track; the input count is that of the flagged rows."""
    available = (
        F.coalesce(F.max(F.col(code_pair) != ""), F.lit(False)) if code_pair else F.lit(True)
    )
    return flagged.groupBy(*keys).agg(
        available.alias("code_pair_available"),
        F.max("mw_tested").alias("mw_used"),
        F.count_if("gap_break").alias("gap_break_count"),
        F.count_if("mw_break").alias("mw_break_count"),
        F.count_if("gf_break").alias("gf_break_count"),
        F.count_if(~F.col("keep")).alias("dropped_epoch_count"),
        F.count(F.lit(1)).alias("input_epoch_count"),
        F.count_if("keep").alias("accepted_epoch_count"),
    )
