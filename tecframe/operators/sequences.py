"""Operators that follow one satellite track in time order.

Every window here is partitioned by the track keys. A track is one satellite
of one station in one observation period; after :func:`regularise` it has at
most one row per sampling interval, 2,880 a day at 30 s, however many raw rows
came in. All windows of a plan start with the same keys, so that they share
one exchange and one sort.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.window import WindowSpec

from tecframe import fixed
from tecframe.functions._col import micros
from tecframe.functions.arrays import array_median

Keys = Sequence[str]


def track(keys: Keys, time: str = "time") -> WindowSpec:
    return Window.partitionBy(*keys).orderBy(time)


def regularise(
    df: DataFrame,
    keys: Keys,
    interval_sec: int = fixed.TARGET_INTERVAL_SEC,
    *,
    time: str = "time",
    position: str = "ingest_pos",
) -> DataFrame:
    """Epochs on the sampling interval, the last row of equal epochs.

    An aggregate, not a window: rows of equal epochs meet map-side first.
    Seconds are floored, so 30.7 s is on a 30 s interval.
    """
    on_grid = df.filter(F.pmod(F.floor(micros(time) / 1e6), F.lit(interval_sec)) == 0)
    return last_per_epoch(on_grid, keys, time=time, position=position)


def last_per_epoch(
    df: DataFrame, keys: Keys, *, time: str = "time", position: str = "ingest_pos"
) -> DataFrame:
    ids = [*keys, time]
    rest = [c for c in df.columns if c not in ids]
    newest = F.max_by(F.struct(*rest), F.col(position)).alias("_row")
    return df.groupBy(*ids).agg(newest).select(*ids, "_row.*")


def gap_arcs(
    df: DataFrame,
    keys: Keys,
    gap_sec: float,
    *,
    time: str = "time",
    jumps: dict[str, float] | None = None,
    out: str = "arc_id",
) -> DataFrame:
    """Numbers the stretches between gaps strictly longer than ``gap_sec``, from 0.

    ``jumps`` adds breaks where a column moves by more than its threshold.
    """
    w = track(keys, time)
    breaks = micros(time) - F.lag(micros(time)).over(w) > int(gap_sec * 1e6)
    for name, limit in (jumps or {}).items():
        breaks = F.coalesce(breaks, F.lit(False)) | F.coalesce(
            F.abs(F.col(name) - F.lag(name).over(w)) > limit, F.lit(False)
        )
    step = F.when(F.coalesce(breaks, F.lit(False)), 1).otherwise(0)
    return df.withColumn("_brk", step).withColumn(
        out, F.sum("_brk").over(w.rowsBetween(Window.unboundedPreceding, 0)).cast("long")
    ).drop("_brk")


def normalise_arc(
    df: DataFrame, keys: Keys, *, value: str = "stec", arc: str = "arc_id", time: str = "time",
    out: str | None = None,
) -> DataFrame:
    """Subtracts the first non-null value of the arc."""
    w = track([*keys, arc], time).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return df.withColumn(
        out or value, F.col(value) - F.first(value, ignorenulls=True).over(w)
    )


def fallback_source(
    df: DataFrame, keys: Keys, *, value: str = "stec", out: str = "vtec_fallback", p: float = 0.05
) -> DataFrame:
    """Value minus the low percentile of the whole track; 0 without finite values."""
    offset = F.percentile(F.col(value), F.lit(p)).over(Window.partitionBy(*keys))
    return df.withColumn(
        out,
        F.when(offset.isNull(), F.lit(0.0)).otherwise(F.col(value) - offset),
    )


def rot(
    df: DataFrame, keys: Keys, *, value: str = "stec", arc: str | None = "arc_id",
    time: str = "time", out: str = "rot",
) -> DataFrame:
    """Change per minute; NULL on the first row of an arc."""
    w = track([*keys, arc] if arc else keys, time)
    minutes = (micros(time) - F.lag(micros(time)).over(w)) / 6e7
    change = F.col(value) - F.lag(value).over(w)
    return df.withColumn(out, F.when(minutes > 0, change / minutes))


def roti(
    df: DataFrame, keys: Keys, rows: int, *, value: str = "rot", arc: str | None = "arc_id",
    time: str = "time", out: str = "roti",
) -> DataFrame:
    """Population deviation of the last ``rows`` rates, once all are present."""
    w = track([*keys, arc] if arc else keys, time).rowsBetween(-(rows - 1), 0)
    return df.withColumn(
        out, F.when(F.count(value).over(w) == rows, F.stddev_pop(value).over(w))
    )


def roti_rows(window_minutes: float, interval_sec: int) -> int:
    return max(1, int(window_minutes * 60 / interval_sec))


def rolling_median(
    df: DataFrame, keys: Keys, rows: int, *, value: str, time: str = "time",
    out: str = "residual",
) -> DataFrame:
    """Value minus the median of the ``rows`` rows before it, once all are present."""
    w = track(keys, time).rowsBetween(-rows, -1)
    history = F.collect_list(value).over(w)
    return df.withColumn("_hist", history).withColumn(
        out, F.when(F.size("_hist") == rows, F.col(value) - array_median("_hist"))
    ).drop("_hist")


def rolling_poly(
    df: DataFrame, keys: Keys, rows: int, degree: int, *, value: str, time: str = "time",
    out: str = "residual",
) -> DataFrame:
    """Value minus a least-squares polynomial through the ``rows`` rows before it.

    Times are counted from the current row in units of the history's length, so
    that the prediction is the constant term of the fit.
    """
    degree = min(degree, rows - 1)
    if degree > 2:
        raise ValueError("degrees above 2 are not supported")
    w = track(keys, time).rowsBetween(-rows, -1)
    now = micros(time)
    out_df = df.withColumn(
        "_hist", F.collect_list(F.struct(micros(time).alias("t"), F.col(value).alias("y"))).over(w)
    )
    span = F.greatest((now - F.get(F.col("_hist"), F.lit(0))["t"]).cast("double"), F.lit(1.0))
    out_df = out_df.withColumn(
        "_pts",
        F.transform(
            "_hist", lambda p: F.struct(((p["t"] - now) / span).alias("x"), p["y"].alias("y"))
        ),
    )

    def total(expr) -> Column:
        return F.aggregate("_pts", F.lit(0.0), lambda acc, p: acc + expr(p))

    powers = {f"_s{k}": total(lambda p, k=k: F.pow(p["x"], F.lit(float(k)))) for k in range(2 * degree + 1)}
    mixed = {f"_y{k}": total(lambda p, k=k: p["y"] * F.pow(p["x"], F.lit(float(k)))) for k in range(degree + 1)}
    out_df = out_df.withColumns({**powers, **mixed})
    s = [F.col(f"_s{k}") for k in range(2 * degree + 1)]
    y = [F.col(f"_y{k}") for k in range(degree + 1)]
    if degree == 0:
        top, bottom = y[0], s[0]
    elif degree == 1:
        top, bottom = y[0] * s[2] - y[1] * s[1], s[0] * s[2] - s[1] * s[1]
    else:
        minor0 = s[2] * s[4] - s[3] * s[3]
        minor1 = s[1] * s[4] - s[2] * s[3]
        minor2 = s[1] * s[3] - s[2] * s[2]
        top = y[0] * minor0 - y[1] * minor1 + y[2] * minor2
        bottom = s[0] * minor0 - s[1] * minor1 + s[2] * minor2
    return out_df.withColumn(
        out, F.when((F.size("_hist") == rows) & (bottom != 0.0), F.col(value) - top / bottom)
    ).drop("_hist", "_pts", *powers, *mixed)


def zero_crossings(
    field: DataFrame, keys: Keys, *, lat: str = "lat", mlat: str = "mlat", mode: str = "first"
) -> DataFrame:
    """Latitude where ``mlat`` changes sign along each line, by linear interpolation; lines without one are left out."""
    return crossing_table(field, keys, {"crossing_lat": mode}, lat=lat, mlat=mlat).filter(F.col("crossing_lat").isNotNull())


def crossing_table(field: DataFrame, keys: Keys, modes: dict[str, str], *, lat: str = "lat", mlat: str = "mlat") -> DataFrame:
    """One column for each rule of ``modes``, NULL where a line has no such crossing, from one pass over the lines.

    ``first``: the southernmost pair with a product <= 0. ``nearest``: the pair
    with different sign bits whose lower latitude is closest to zero. A line is
    one column of a lattice, so its length is the number of lattice rows.
    """
    w = Window.partitionBy(*keys).orderBy(lat)
    pairs = field.filter(F.col(mlat).isNotNull()).select(
        *keys,
        F.col(lat).alias("_b"), F.col(mlat).alias("_mb"),
        F.lag(lat).over(w).alias("_a"), F.lag(mlat).over(w).alias("_ma"),
    )
    rules = {
        "first": (F.col("_ma") * F.col("_mb") <= 0, (F.col("_a"),)),
        "nearest": ((F.col("_ma") < 0) != (F.col("_mb") < 0), (F.abs("_a"), F.col("_a"))),
    }
    span = F.col("_mb") - F.col("_ma")
    cross = F.when(
        span != 0, F.col("_a") - F.col("_ma") * (F.col("_b") - F.col("_a")) / span
    ).otherwise(F.col("_a"))
    best = []
    for name, mode in modes.items():
        hit, order = rules[mode]
        best.append(F.min(F.when(hit, F.struct(*order, cross.alias("_c"))))["_c"].alias(name))
    return pairs.groupBy(*keys).agg(*best)
