"""Aggregations."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tecframe import fixed
from tecframe.functions.arrays import axis
from tecframe.functions.geodesy import floor_bin, snap
from tecframe.functions.timefn import floor_time, time_index
from tecframe.operators.predicates import in_bbox
from tecframe.operators.quantiles import grouped_median

Extent = tuple[float, float, float, float]  # west, east, south, north


def grid_links(
    links: DataFrame,
    *,
    bbox: dict[str, float] = fixed.BBOX,
    lat_step: float = fixed.GRID_STEP_DEG,
    lon_step: float = fixed.GRID_STEP_DEG,
    cadence_min: int = fixed.GRID_CADENCE_MIN,
    by: Sequence[str] = (),
) -> DataFrame:
    """Median of vtec and roti per interval and cell; cells are centred on the nodes."""
    cells = in_bbox(links, bbox, lat="ipp_lat", lon="ipp_lon").select(
        *by,
        floor_time("time", cadence_min).alias("time"),
        snap("ipp_lat", bbox["lat_min"], lat_step).alias("lat"),
        snap("ipp_lon", bbox["lon_min"], lon_step).alias("lon"),
        "vtec", "roti", "sv",
    )
    return grouped_median(
        cells, [*by, "time", "lat", "lon"], {"vtec": "vtec", "roti": "roti"},
        counts={"sample_count": "sv"},
    )


def grid_links_floor(
    links: DataFrame,
    events: DataFrame,
    *,
    lat_step: float = fixed.GRID_STEP_DEG,
    lon_step: float = fixed.GRID_STEP_DEG,
    cadence_min: int = fixed.GRID_CADENCE_MIN,
) -> DataFrame:
    """Bins counted from zero, plus one empty row for every interval without data."""
    from tecframe.operators.sets import missing_times

    cells = links.select(
        "event_id", floor_time("time", cadence_min).alias("time"),
        floor_bin("ipp_lat", lat_step).alias("lat_bin"),
        floor_bin("ipp_lon", lon_step).alias("lon_bin"), "vtec", "roti", "sv",
    ).filter(F.col("lat_bin").isNotNull() & F.col("lon_bin").isNotNull())
    grid = grouped_median(
        cells, ["time", "event_id", "lat_bin", "lon_bin"],
        {"vtec_median": "vtec", "roti_median": "roti"},
        counts={"sample_count": "sv"},
    )
    gaps = missing_times(cells, events, cadence_min).select(
        "time", "event_id",
        *[F.lit(None).cast("double").alias(c) for c in ("lat_bin", "lon_bin", "vtec_median", "roti_median")],
        F.lit(0).cast("long").alias("sample_count"),
    )
    return grid.unionByName(gaps)


def kp_3hour(hourly: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """First Kp of every three hours of PlotTime, the least one of equal times."""
    return (
        hourly.filter(F.col("Kp").isNotNull() & F.col("PlotTime").isNotNull())
        .groupBy(*by, floor_time("PlotTime", 180).alias("KpStart"))
        .agg(F.min(F.struct("PlotTime", "Kp"))["Kp"].alias("Kp"))
        .withColumn("KpEnd", F.timestamp_micros(F.unix_micros("KpStart") + 10_800_000_000))
    )


def mean_grid(
    pixels: DataFrame, extent: Extent, step: float, *, value: str = "radiance",
    lat: str = "lat", lon: str = "lon", by: Sequence[str] = (),
) -> DataFrame:
    """Mean of all pixels in each half-open cell; outer east and north edges excluded."""
    west, east, south, north = extent
    if step <= 0:
        raise ValueError("the grid step must be positive")
    nx, ny = (math.ceil((hi + step - lo) / step - 1e-12) - 1 for lo, hi in ((west, east), (south, north)))
    if nx < 1 or ny < 1:
        raise ValueError("the extent holds less than one cell")
    ix = F.floor((F.col(lon) - west) / step)
    iy = F.floor((F.col(lat) - south) / step)
    return (
        pixels.filter(F.col(value).isNotNull())
        .select(*by, ix.alias("ix"), iy.alias("iy"), F.col(value).alias("_v"))
        .filter(F.col("ix").between(0, nx - 1) & F.col("iy").between(0, ny - 1))
        .groupBy(*by, "ix", "iy")
        .agg(F.avg("_v").alias(value), F.count("_v").alias("pixel_count"))
    )


def hot_bins(
    points: DataFrame, bin_deg: float, extent: Extent, *, by: Sequence[str] = (),
    lat: str = "lat", lon: str = "lon",
) -> DataFrame:
    """Centres of the bins that hold a point; no binning for a width of 0 or less."""
    if bin_deg <= 0:
        return points.select(*by, lon, lat)
    west, _, south, _ = extent
    xi = F.floor((F.col(lon) - west) / bin_deg)
    yi = F.floor((F.col(lat) - south) / bin_deg)
    bins = points.select(*by, xi.alias("xi"), yi.alias("yi")).distinct()
    return bins.select(
        *by,
        (west + (F.col("xi") + 0.5) * bin_deg).alias(lon),
        (south + (F.col("yi") + 0.5) * bin_deg).alias(lat),
    )


def catalog(rows: DataFrame, *, by: str = "path", metrics: Sequence[str] = ("vtec", "roti")) -> DataFrame:
    """Time span and available metrics per product, in the order of ``metrics``."""
    have = {m: F.bool_or(F.col(m).isNotNull()).alias("_" + m) for m in metrics}
    found = F.array_compact(F.array(*[F.when(F.col("_" + m), F.lit(m)) for m in metrics]))
    return (
        rows.groupBy(by)
        .agg(F.min("time").alias("time_start"), F.max("time").alias("time_end"), *have.values())
        .withColumn("metrics", found)
        .drop(*["_" + m for m in metrics])
    )


def coverage(series: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Valid counts, longest arc, score and qualification per satellite."""
    arcs = series.groupBy(*keys, "arc_id").agg(
        F.count("vtec").alias("_v"), F.count("roti").alias("_r"), F.count(F.lit(1)).alias("_n")
    )
    v, r = F.sum("_v"), F.sum("_r")
    return arcs.groupBy(*keys).agg(
        v.alias("valid_vtec"), r.alias("valid_roti"),
        F.max(F.when(F.col("arc_id").isNotNull(), F.col("_n")).otherwise(0)).alias("longest_arc"),
        (v + r).alias("score"), ((v > 0) & (r > 0)).alias("qualified"),
    )


def summarise_failures(reasons: DataFrame, keys: Sequence[str], *, reason: str = "reason",
                       order: Sequence[str] = fixed.SATELLITE_REASONS) -> DataFrame:
    """Dominant reason (ties by step order, then name), the sorted count list, and ``succeeded``.

    A NULL reason is a success and not counted as a failure.
    """
    counts = reasons.groupBy(*keys, reason).agg(F.count(F.lit(1)).alias("_n"))
    failed = F.col(reason).isNotNull()
    names = F.array(*[F.lit(o) for o in order])
    step = F.array_position(names, F.col(reason))
    step = F.when(step == 0, F.lit(len(order) + 1)).otherwise(step)
    entry = F.struct(F.col(reason), F.concat(F.col(reason), F.lit("="), F.col("_n")).alias("t"))
    return counts.groupBy(*keys).agg(
        F.min_by(reason, F.when(failed, F.struct(-F.col("_n"), step, F.col(reason)))).alias("reason"),
        F.array_join(
            F.transform(F.sort_array(F.collect_list(F.when(failed, entry))), lambda e: e["t"]), ", "
        ).alias("detail"),
        F.coalesce(F.sum(F.when(failed, F.col("_n"))), F.lit(0)).alias("failures"),
        F.bool_or(~failed).alias("succeeded"),
    )


def mad(df: DataFrame, column: str, by: Sequence[str]) -> DataFrame:
    """Median absolute deviation per group."""
    by = list(by)
    rows = df.filter(F.col(column).isNotNull()).select(*by, column)
    centre = grouped_median(rows, by, {"_m": column})
    gaps = rows.join(centre, by).withColumn("_gap", F.abs(F.col(column) - F.col("_m")))
    return grouped_median(gaps, by, {"mad": "_gap"})


def first_dates(records: DataFrame, *, code: str = "station_code4", date: str = "observation_date",
                station: str = "station_id") -> DataFrame:
    return records.groupBy(code).agg(
        F.min(date).alias("first_date"),
        F.min_by(station, F.struct(date, station)).alias(station),
    )


def union_window(presets: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return presets.groupBy(*by).agg(F.min("start_utc").alias("start_utc"), F.max("end_utc").alias("end_utc"))


def axis_bounds(df: DataFrame, column: str, by: Sequence[str] = (), *, floor_zero: bool = False) -> DataFrame:
    """Padded value range of an axis; groups without values get NULL."""
    return axis_table(df, {"": (column, "from zero" if floor_zero else "padded")}, by)


def kp_axis_top(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return axis_table(df, {"kp_": ("Kp", "kp")}, by).withColumnRenamed("kp_upper", "kp_top").drop("kp_lower")


def axis_table(df: DataFrame, axes: dict[str, tuple[str, str]], by: Sequence[str] = ()) -> DataFrame:
    """Ranges of several axes, each ``<prefix>lower`` and ``<prefix>upper``, from one aggregate.

    ``axes`` gives for each prefix its column and rule: ``padded`` (a margin on
    both sides), ``from zero``, or ``kp`` (from 0 to 9.2 at least).
    """
    def ends(at: int, rule: str) -> tuple[Column, Column]:
        lo, hi = F.col(f"_lo{at}"), F.col(f"_hi{at}")
        if rule == "kp":
            return F.lit(0.0), F.greatest(F.lit(9.2), hi + 0.5)
        if rule == "from zero":
            return F.when(hi.isNotNull(), F.lit(0.0)), F.when(hi > 0, hi * 1.08).when(hi.isNotNull(), F.lit(1.0))
        flat = F.abs(lo - hi) <= 1e-8 + 1e-5 * F.abs(hi)
        pad = F.when(flat, F.greatest(F.abs(hi) * 0.1, F.lit(1.0))).otherwise((hi - lo) * 0.12)
        return lo - pad, hi + pad

    columns = list(dict.fromkeys(column for column, _ in axes.values()))
    sizes = [f(c).alias(f"_{n}{i}") for i, c in enumerate(columns) for n, f in (("lo", F.min), ("hi", F.max))]
    out = {}
    for prefix, (column, rule) in axes.items():
        out[f"{prefix}lower"], out[f"{prefix}upper"] = ends(columns.index(column), rule)
    return df.groupBy(*by).agg(*sizes).select(*by, *[c.alias(n) for n, c in out.items()])


def arc_summary(links: DataFrame, keys: Sequence[str]) -> DataFrame:
    return links.groupBy(*keys, "arc_id").agg(
        F.min("time").alias("time_start"), F.max("time").alias("time_end"),
        F.count(F.lit(1)).alias("epochs"), F.avg("elev_deg").alias("mean_elev"),
    )


def cell_stats(cells: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Mean, median, deviation and count per cell."""
    return grouped_median(
        cells, keys, {"median": value},
        counts={"samples": value}, extra=[F.avg(value).alias("mean"), F.stddev_pop(value).alias("std")],
    )


def densify(
    grid: DataFrame,
    windows: DataFrame,
    *,
    bbox: dict[str, float] = fixed.BBOX,
    lat_step: float = fixed.GRID_STEP_DEG,
    lon_step: float = fixed.GRID_STEP_DEG,
    cadence_min: int = fixed.GRID_CADENCE_MIN,
    by: Sequence[str] = (),
) -> DataFrame:
    """Every node of the lattice at every time of the windows; grid rows off it are left out.

    ``windows`` has start_utc and end_utc (and ``by``). The lattice comes from
    sequences; times are spread over the cluster before the nodes are laid out.
    """
    times = windows.select(
        *by, F.explode(time_index("start_utc", "end_utc", cadence_min)).alias("time")
    ).distinct()
    lats = axis(bbox["lat_min"], bbox["lat_max"], lat_step)
    lons = axis(bbox["lon_min"], bbox["lon_max"], lon_step)
    frame = times.withColumn("lat", F.explode(lats)).withColumn("lon", F.explode(lons))
    key = lambda c: F.round(F.col(c) * 1e6).cast("long")
    frame = frame.withColumns({"_ky": key("lat"), "_kx": key("lon")})
    data = grid.select(
        *by, "time", key("lat").alias("_ky"), key("lon").alias("_kx"), "vtec", "roti", "sample_count"
    )
    return frame.join(data, [*by, "time", "_ky", "_kx"], "left").select(
        *by, "time", "lat", "lon",
        F.col("vtec").cast("float").alias("vtec", metadata={"units": "TECu"}),
        F.col("roti").cast("float").alias("roti", metadata={"units": "TECu/min"}),
        F.coalesce("sample_count", F.lit(0)).cast("long").alias("sample_count", metadata={"units": "count"}),
    )
