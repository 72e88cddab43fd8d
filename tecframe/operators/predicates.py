"""Filters and guards. Row filters stay plain predicates, so they reach the scan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tecframe import fixed
from tecframe.functions._col import ColumnLike, col, finite
from tecframe.functions.geodesy import to_geodetic, wrap180


def in_bbox(
    df: DataFrame, bbox: dict[str, float] = fixed.BBOX, *, lat: str = "lat", lon: str = "lon"
) -> DataFrame:
    """Closed on all four sides; rows without coordinates drop out."""
    return df.filter(
        F.col(lat).between(bbox["lat_min"], bbox["lat_max"])
        & F.col(lon).between(bbox["lon_min"], bbox["lon_max"])
    )


def in_window(df: DataFrame, start: ColumnLike, end: ColumnLike, *, time: str = "time") -> DataFrame:
    """Closed interval."""
    return df.filter((F.col(time) >= col(start)) & (F.col(time) <= col(end)))


def clip_to_day(
    station_days: DataFrame, events: DataFrame, *, keep_instant: bool = False, keep_empty: bool = False
) -> DataFrame:
    """Adds slice_start and slice_end; days outside the event drop out.

    ``keep_instant`` keeps windows of zero length, as the series tables do;
    ``keep_empty`` keeps days outside the event, too.
    """
    day = F.col("observation_date").cast("timestamp")
    out = (
        station_days.join(events, "event_id")
        .withColumn("slice_start", F.greatest(F.col("start_utc"), day))
        .withColumn("slice_end", F.least(F.col("end_utc"), day + F.expr("INTERVAL 1 DAY")))
        .drop("start_utc", "end_utc")
    )
    if keep_empty:
        return out
    order = F.col("slice_start") <= F.col("slice_end") if keep_instant else (
        F.col("slice_start") < F.col("slice_end")
    )
    return out.filter(order)


def of_system(system: str = "G", *, sv: str = "sv") -> Column:
    return F.coalesce(F.upper(F.col(sv)).startswith(system.upper()), F.lit(False))


def only_system(df: DataFrame, system: str = "G", *, sv: str = "sv") -> DataFrame:
    return df.filter(of_system(system, sv=sv))


def status_ok() -> Column:
    """Never NULL: a missing status is not ok."""
    return F.coalesce(
        (F.col("obs_status") == "ok") & (F.col("nav_status") == "ok"), F.lit(False)
    )


def split_ok(manifest: DataFrame) -> tuple[DataFrame, DataFrame]:
    return manifest.filter(status_ok()), manifest.filter(~status_ok())


def require(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with NULL or NaN in any of the columns drop out."""
    return df.dropna(subset=list(columns))


def mask_elevation(
    df: DataFrame, degrees: float = fixed.ELEVATION_MASK_DEG, *, elev: str = "elev_deg"
) -> DataFrame:
    return df.filter(F.col(elev) >= degrees)


def any_metric(df: DataFrame) -> DataFrame:
    return df.filter(F.col("vtec").isNotNull() | F.col("roti").isNotNull())


def station_metric(links: DataFrame, metric: str, *, keep: Sequence[str] = ()) -> DataFrame:
    """The per-station series of one metric; order belongs to the sink."""
    return links.filter(F.col(metric).isNotNull()).select(
        *keep, "time", "station_id", "station_code4", "sv", metric
    )


def station_metrics(links: DataFrame, metrics: Sequence[str], *, keep: Sequence[str] = ()) -> DataFrame:
    """The series of several metrics as rows (metric, value), from one pass over the links."""
    values = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics])
    rows = links.select(*keep, "time", "station_id", "station_code4", "sv", F.inline(values))
    return rows.filter(F.col("value").isNotNull())


def above(df: DataFrame, metric: str, threshold: float) -> DataFrame:
    """Strictly greater; NaN is not above anything."""
    return df.filter(finite(metric) > threshold)


def pixel_is_valid(
    *,
    lat: str = "lat",
    lon: str = "lon",
    value: str = "radiance",
    quality: str | None = "quality",
    emission: str | None = "emission",
    quality_mode: str = "all",
    max_angle: float | None = fixed.MAX_EMISSION_ANGLE_DEG,
) -> Column:
    ok = (
        finite(lat).between(-90.0, 90.0)
        & finite(lon).between(-180.0, 180.0)
        & finite(value).isNotNull()
    )
    if quality_mode == "good" and quality:
        ok = ok & (F.col(quality) == 0)
    if max_angle is not None and emission:
        ok = ok & finite(emission).between(0.0, float(max_angle))
    return F.coalesce(ok, F.lit(False))


def valid_pixels(df: DataFrame, *, lat: str = "lat", lon: str = "lon", value: str = "radiance",
                 **rules) -> DataFrame:
    """Invalid pixels keep their place; their coordinates and value become NULL."""
    ok = pixel_is_valid(lat=lat, lon=lon, value=value, **rules)
    out = df.withColumn("_ok", ok)
    for name in (lat, lon, value):
        out = out.withColumn(name, F.when(F.col("_ok"), F.col(name)))
    return out.drop("_ok")


def on_event_days(scenes: DataFrame, events: DataFrame, *, time: str = "midpoint") -> DataFrame:
    """Scenes whose midpoint lies on a calendar day of an event."""
    days = events.select(
        F.explode(F.sequence(F.to_date("start_utc"), F.to_date("end_utc"))).alias("_day")
    ).distinct()
    return scenes.join(days, F.to_date(F.col(time)) == F.col("_day"), "left_semi")


def wrap_slices(df: DataFrame, keys: Sequence[str], *, lon: str = "lon") -> DataFrame:
    """Slices that run 0..360 are moved to -180..180; the others stay."""
    wide = df.groupBy(*keys).agg((F.max(lon) > 180.0).alias("_wide"))
    return (
        df.join(wide, list(keys))
        .withColumn(lon, F.when(F.col("_wide"), wrap180(lon)).otherwise(F.col(lon)))
        .drop("_wide")
    )


def wrap_lon_axis(df: DataFrame, *, lon: str = "lon") -> DataFrame:
    """The same for slices that hold their longitude axis as an array."""
    return df.withColumn(
        lon,
        F.when(F.array_max(F.col(lon)) > 180.0, F.transform(F.col(lon), wrap180)).otherwise(F.col(lon)),
    )


def canonical_metric(df: DataFrame) -> DataFrame:
    """Renames metric and coordinate aliases: atec, vtec, tec in that order give vtec."""
    lowered = {name.lower(): name for name in df.columns}
    aliases = {
        "vtec": ("atec", "vtec", "tec"),
        "roti": ("roti",),
        "lat": ("lat", "latitude"),
        "lon": ("lon", "longitude"),
    }
    used = {a for names in aliases.values() for a in names}
    keep = [F.col(f"`{n}`") for low, n in lowered.items() if low not in used]
    found = []
    for target, names in aliases.items():
        present = [lowered[a] for a in names if a in lowered]
        if present:
            found.append(F.col(f"`{present[0]}`").alias(target))
    return df.select(*keep, *found)


def metric_of_name(path: ColumnLike) -> Column:
    """Metric of a product whose variables tell nothing."""
    name = F.lower(F.regexp_extract(col(path), r"([^/]*)$", 1))
    return F.when(F.contains(name, F.lit("roti")), F.lit("roti")).otherwise(F.lit("vtec"))


def guard(
    df: DataFrame, keys: Sequence[str], minimum: int, reason: str
) -> tuple[DataFrame, DataFrame]:
    """(rows of groups with at least ``minimum`` rows, one reason row per other group)."""
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    short = sizes.filter(F.col("n") < minimum)
    kept = df.join(short.select(*keys), list(keys), "left_anti")
    return kept, short.select(*keys, F.lit(reason).alias("reason"), "n")


def identifiers(ident: str | None) -> list[str]:
    text = (ident or "").strip().upper()
    if not text:
        return []
    return sorted({text, text[:4]}) if len(text) >= 4 else [text]


def match_station(df: DataFrame, ident: str) -> DataFrame:
    """The one row whose id or code fits; lowest (code, id) wins.

    No match gives no row; callers that need one check the result.
    """
    names = identifiers(ident)
    if not names:
        raise ValueError("a station identifier is required")
    hit = F.upper("station_id").isin(names) | F.upper("station_code4").isin(names)
    ordered = df.filter(hit).withColumn("_code", F.upper("station_code4"))
    return ordered.orderBy("_code", "station_id").limit(1).drop("_code")


def station_rows(df: DataFrame, station_id: str, code: str) -> DataFrame:
    """Rows of the id; only when no row has it, rows of the four-letter code."""
    by_code = (
        F.coalesce(F.upper("station_code4") == code.upper(), F.lit(False))
        if "station_code4" in df.columns
        else F.lit(False)
    )
    if "station_id" not in df.columns:
        return df.filter(by_code)
    by_id = F.coalesce(F.upper("station_id") == station_id.upper(), F.lit(False))
    id_exists = df.agg(F.coalesce(F.bool_or(by_id), F.lit(False)).alias("hit")).scalar()
    return df.filter(F.when(id_exists, by_id).otherwise(by_code))


def max_interval(df: DataFrame, seconds: int, *, interval: str = "sampling_sec") -> DataFrame:
    return df.filter(F.col(interval) <= seconds)


def resolve_position(df: DataFrame) -> DataFrame:
    """lat, lon, height_m from the manifest, or from header_x/y/z when that is all zero.

    Rows with neither get NULL and ``position_reason``.
    """
    given = [F.coalesce(F.col(c), F.lit(0.0)) for c in ("lat", "lon", "height_m")]
    known = (
        (F.abs(given[0]) >= 1e-9) | (F.abs(given[1]) >= 1e-9) | (F.abs(given[2]) >= 1e-9)
    ) & finite(given[0]).isNotNull() & finite(given[1]).isNotNull()
    header = to_geodetic("header_x", "header_y", "header_z")
    out = df.withColumn("_known", known)
    for name, value, fallback in zip(("lat", "lon", "height_m"), given, header):
        out = out.withColumn("_" + name, F.when(F.col("_known"), value).otherwise(fallback))
    return (
        out.withColumns({c: F.col("_" + c) for c in ("lat", "lon", "height_m")})
        .withColumn(
            "position_reason", F.when(F.col("lat").isNull(), F.lit("missing_station_position"))
        )
        .drop("_known", "_lat", "_lon", "_height_m")
    )
