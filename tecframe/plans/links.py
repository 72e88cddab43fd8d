"""Satellite links out of raw observations, and the tables made from links."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window, functions as F

from tecframe import fixed
from tecframe.functions import geodesy, signal
from tecframe.functions.arrays import pick_pair
from tecframe.functions.timefn import utc_hour
from tecframe.operators import aggregates, joins, predicates, sequences, sets, slips
from tecframe.operators.assertions import refuse
from tecframe.session import settle
from tecframe.sources.tables import with_chunks


@dataclass(frozen=True)
class LinkParams:
    system: str = "G"
    interval_sec: int = fixed.TARGET_INTERVAL_SEC
    elevation_mask: float = fixed.ELEVATION_MASK_DEG
    max_age_hours: float = fixed.MAX_EPHEMERIS_AGE_HOURS
    shell_km: float = fixed.SHELL_HEIGHT_KM
    roti_minutes: float = fixed.ROTI_WINDOW_MINUTES
    enable_mw: bool = True
    slips: slips.SlipParams = field(default_factory=slips.SlipParams)


class LinkTables(NamedTuple):
    links: DataFrame
    diagnostics: DataFrame
    failures: DataFrame


K = list(fixed.TRACK_KEYS)
STATION_DAY = ["event_id", "station_id", "observation_date"]
RECORD_COLUMNS = ["source", "obs_path", "nav_path"]


def observation_pairs(obs: DataFrame, keys: Sequence[str] = ("station_id", "observation_date"), own: Column | None = None) -> DataFrame:
    """Preferred phase and code pair of every station-day, from the codes that its ``own`` rows have, and whether it has any."""
    own = F.lit(True) if own is None else own
    known = dict.fromkeys(fixed.PHASE_FIRST + fixed.PHASE_SECOND + fixed.CODE_FIRST + fixed.CODE_SECOND)
    codes = [c for c in obs.columns if c in known]
    have = obs.groupBy(*keys).agg(
        F.bool_or(own).alias("own"), *[F.bool_or(own & F.col(c).isNotNull()).alias(c) for c in codes]
    )
    listed = F.array_compact(F.array(*[F.when(F.col(c), F.lit(c)) for c in codes]))
    return have.select(
        *keys, F.lit(True).alias("seen"), "own",
        pick_pair(listed, fixed.PHASE_FIRST, fixed.PHASE_SECOND).alias("phase"),
        pick_pair(listed, fixed.CODE_FIRST, fixed.CODE_SECOND).alias("code"),
    )


def _value_of(code: Column, options: Sequence[str], columns: Sequence[str]) -> Column:
    out = F.lit(None).cast("double")
    for name in options:
        if name in columns:
            out = F.when(code == name, F.col(name).cast("double")).otherwise(out)
    return F.nanvl(out, F.lit(None).cast("double"))


def station_windows(obs: DataFrame, records: DataFrame, events: DataFrame, params: LinkParams) -> DataFrame:
    """Every station-day with its window, position and pairs; ``day_reason`` names what rules it out."""
    windows = predicates.resolve_position(predicates.clip_to_day(records, events, keep_empty=True)).drop(
        "header_x", "header_y", "header_z"
    )
    overlaps = F.col("slice_start") < F.col("slice_end")
    slices = windows.filter(overlaps).select(*STATION_DAY, "slice_start", "slice_end")
    inside = obs.join(slices, ["station_id", "observation_date"]).filter(
        F.col("time").between(F.col("slice_start"), F.col("slice_end"))
    )
    # codes of other systems or other times don't choose the pair
    pairs = observation_pairs(inside, STATION_DAY, predicates.of_system(params.system))
    reason = (
        F.when(~overlaps, F.lit("out_of_window"))
        .when(F.col("seen").isNull(), F.lit("empty_observations"))
        .when(~F.col("own"), F.lit("empty_gps_rows"))
        .when(F.col("phase").isNull(), F.lit("missing_phase_pair"))
        .otherwise(F.col("position_reason"))
    )
    return windows.join(pairs, STATION_DAY, "left").withColumn("day_reason", reason).drop("seen", "own", "position_reason")


def build_outcomes(
    obs: DataFrame, eph: DataFrame, records: DataFrame, events: DataFrame,
    params: LinkParams = LinkParams(),
) -> tuple[DataFrame, DataFrame]:
    """(station-days, outcomes of their tracks), both stored: what the three tables of :func:`build_links` are cut from.

    Outcomes hold the rows of every track that reached slip detection, and one
    row for every other track, which names its ``early`` reason.
    """
    days = settle(station_windows(obs, records, events, params), "station-days")
    rows = predicates.only_system(obs, params.system).withColumn("sv", F.upper("sv"))
    usable = days.filter(F.col("day_reason").isNull())
    extra = [c for c in RECORD_COLUMNS if c in days.columns]
    rows = rows.join(usable.drop("day_reason", *extra), ["station_id", "observation_date"]).filter(
        F.col("time").between(F.col("slice_start"), F.col("slice_end"))
    )
    cols = obs.columns
    rows = rows.select(
        *K, "time", "ingest_pos", "station_code4", "lat", "lon", "height_m",
        _value_of(F.col("phase.first"), fixed.PHASE_FIRST, cols).alias("l1"),
        _value_of(F.col("phase.second"), fixed.PHASE_SECOND, cols).alias("l2"),
        _value_of(F.col("code.first"), fixed.CODE_FIRST, cols).alias("c1"),
        _value_of(F.col("code.second"), fixed.CODE_SECOND, cols).alias("c2"),
        F.concat_ws("/", "phase.first", "phase.second").alias("phase_pair"),
        F.coalesce(F.concat_ws("/", "code.first", "code.second"), F.lit("")).alias("code_pair"),
    )
    rows = sequences.regularise(rows, K, params.interval_sec)

    located = joins.asof_ephemeris(rows, eph, params.max_age_hours)
    located = geodesy.with_satellite_xyz(located).drop("eph")
    rx = geodesy.to_ecef("lat", "lon", "height_m")
    az, el = geodesy.look_angles(
        F.col("sat_x") - rx[0], F.col("sat_y") - rx[1], F.col("sat_z") - rx[2], "lat", "lon"
    )
    located = located.withColumns({"az_deg": az, "elev_deg": el})

    # the guards count rows per track; a failing track keeps the first reason
    whole = Window.partitionBy(*K)
    has_phase = F.col("l1").isNotNull() & F.col("l2").isNotNull()
    judged = located.withColumn("_s1", has_phase)
    judged = judged.withColumn("_n1", F.count_if("_s1").over(whole))
    judged = judged.withColumn("_s2", F.col("_s1") & (F.col("_n1") >= 2) & F.col("sat_x").isNotNull())
    judged = judged.withColumn("_n2", F.count_if("_s2").over(whole))
    judged = judged.withColumn(
        "_s3", F.col("_s2") & (F.col("_n2") >= 2) & (F.col("elev_deg") >= params.elevation_mask)
    )
    judged = judged.withColumn("_n3", F.count_if("_s3").over(whole)).withColumn("_first", F.min("time").over(whole))
    early = (
        F.when(F.col("_n1") < 2, F.lit("insufficient_phase_samples"))
        .when(F.col("_n2") < 2, F.lit("missing_navigation_solution"))
        .when(F.col("_n3") < 2, F.lit("below_elevation_mask"))
    )
    judged = judged.withColumn("early", early).filter(
        F.when(F.col("early").isNull(), F.col("_s3")).otherwise(F.col("time") == F.col("_first"))
    )
    measured = judged.withColumns(
        {
            "phase_stec": signal.phase_stec("l1", "l2"),
            "gf_phase": signal.gf_phase("l1", "l2"),
            "mw": signal.melbourne_wubbena("l1", "l2", "c1", "c2") if params.enable_mw else F.lit(None).cast("double"),
            "code_stec": signal.code_stec("c1", "c2"),
        }
    ).drop("l1", "l2", "c1", "c2", "ingest_pos", "sat_x", "sat_y", "sat_z", "height_m", "_s1", "_s2", "_s3", "_n1", "_n2", "_n3", "_first")
    tracks = finish_tracks(slips.detect_slips(measured, K, params.slips), K, params)
    finite = F.col("vtec").isNotNull() | F.col("roti").isNotNull()
    ipp_lat, ipp_lon = geodesy.pierce_point("lat", "lon", "az_deg", "elev_deg", params.shell_km)
    tracks = tracks.withColumns(
        {"delivered": F.col("early").isNull() & F.col("keep") & finite, "ipp_lat": ipp_lat, "ipp_lon": ipp_lon, "station_code4": F.upper("station_code4")}
    )
    return days, settle(tracks, "outcomes")


def build_links(
    obs: DataFrame, eph: DataFrame, records: DataFrame, events: DataFrame,
    params: LinkParams = LinkParams(),
) -> LinkTables:
    """Links, slip counters and failure reasons, cut from one stored table of outcomes.

    obs: station_id, observation_date, time, sv, ingest_pos and one column per
    observable code. eph: observation_date (day of the navigation file), sv,
    time and the orbit elements. records: event_id, station_id, station_code4,
    observation_date, lat, lon, height_m, header_x, header_y, header_z, and
    source, obs_path, nav_path where known. events: event_id, start_utc, end_utc.
    """
    days, tracks = build_outcomes(obs, eph, records, events, params)
    links = tracks.filter("delivered").select(*fixed.LINK_COLUMNS, "observation_date")
    reached = tracks.filter("early IS NULL")
    diagnostics = slips.slip_diagnostics(reached, [*K, "phase_pair", "code_pair"], code_pair="code_pair")

    # outcome of every track: NULL when it delivered links
    ends = tracks.groupBy(*K).agg(F.max("early").alias("_early"), F.count_if("keep").alias("_kept"), F.count_if("delivered").alias("_out")).select(
        *K,
        F.when(F.col("_out") > 0, F.lit(None)).when(F.col("_early").isNotNull(), F.col("_early"))
        .when(F.col("_kept") == 0, F.lit("finalize_empty")).otherwise(F.lit("no_finite_vtec_or_roti")).alias("reason"),
    )
    summary = aggregates.summarise_failures(ends, STATION_DAY)
    texts = F.create_map(*[F.lit(x) for pair in fixed.DAY_REASONS.items() for x in pair])
    known = {c: F.col(c) if c in days.columns else F.lit(None).cast("string") for c in RECORD_COLUMNS}
    failures = (
        days.withColumns(known).join(summary, STATION_DAY, "left")
        .filter(~F.coalesce("succeeded", F.lit(False)))
        .select(
            *STATION_DAY, *RECORD_COLUMNS, F.lit("process").alias("stage"),
            F.coalesce("day_reason", "reason", F.lit("no_valid_links")).alias("reason"),
            F.coalesce(texts[F.col("day_reason")], "detail", F.lit("")).alias("detail"),
        )
    )
    return LinkTables(links, diagnostics, failures)


def finish_tracks(flagged: DataFrame, keys: Sequence[str], params: LinkParams = LinkParams()) -> DataFrame:
    """stec, vtec and roti of the kept rows; one exchange on the keys serves every window.

    Dropped rows stay for the outcome of their track. They form arc -1, so
    they touch neither the arcs nor, being blanked, the percentile.
    """
    rows = flagged.withColumn("stec", F.when(F.col("keep"), F.col("phase_stec"))).repartition(*keys)
    rows = sequences.normalise_arc(rows, keys)
    rows = sequences.fallback_source(rows, keys)
    vtec = signal.vtec_source("code_stec", "vtec_fallback") / geodesy.mapping("elev_deg", params.shell_km)
    rows = rows.withColumn("vtec", F.when(F.col("keep"), vtec))
    width = sequences.roti_rows(params.roti_minutes, params.interval_sec)
    return sequences.roti(sequences.rot(rows, keys), keys, width)


class GridTables(NamedTuple):
    grid: DataFrame
    cube: DataFrame
    catalog: DataFrame


def build_grid(
    links: DataFrame, events: DataFrame, *, bbox: dict[str, float] = fixed.BBOX,
    step: float = fixed.GRID_STEP_DEG, cadence_min: int = fixed.GRID_CADENCE_MIN,
    dense: bool = True,
) -> GridTables:
    """Median grid, its dense hourly cube and the catalog of the hourly products.

    Reading the grid fails where an event has no links at all.
    """
    without = events.join(links, "event_id", "left_anti").agg(F.min("event_id").alias("e"))
    problem = without.select(F.when(F.col("e").isNotNull(), F.concat(F.lit("no valid links of event "), "e")).alias("problem"))
    grid = aggregates.grid_links(
        links, bbox=bbox, lat_step=step, lon_step=step, cadence_min=cadence_min,
        by=["event_id"],
    )
    grid = refuse(grid, problem)
    body = (
        aggregates.densify(grid, events, bbox=bbox, lat_step=step, lon_step=step,
                           cadence_min=cadence_min, by=["event_id"])
        if dense else grid
    )
    cube = with_chunks(body, events, cadence_min)
    path = F.concat("event_id", F.lit("_"), F.date_format("chunk_start", "yyyyMMdd_HH'00'"))
    products = aggregates.catalog(cube.withColumn("path", path))
    return GridTables(grid, cube, products)


def one_station(links: DataFrame, station: str, start: Column, end: Column) -> tuple[DataFrame, DataFrame]:
    """(rows of the station with the lowest (code, id) that the identifier fits, inside the window; problems)."""
    names = predicates.identifiers(station)
    if not names:
        raise ValueError("a station identifier is required")
    fits = F.upper("station_id").isin(names) | F.upper("station_code4").isin(names)
    found = predicates.in_window(links.filter(F.coalesce(fits, F.lit(False))), start, end)
    key = F.struct(F.coalesce(F.upper("station_code4"), F.lit("")), F.col("station_id"))
    lowest = found.agg(F.min(key).alias("_key")).scalar()
    missing = found.agg(F.count(F.lit(1)).alias("n")).select(
        F.when(F.col("n") == 0, F.lit(f"no rows of station {station} in the window")).alias("problem")
    )
    return found.filter(key == lowest), missing


def station_days_problems(records: DataFrame, station: str, start: Column, end: Column) -> DataFrame:
    """What speaks against one station over all days of the window: a day without it, or another id or code on a later day.

    records: observation_date, station_id, station_code4; of several rows of a
    day the lowest (code, id) counts.
    """
    names = predicates.identifiers(station)
    fits = F.upper("station_id").isin(names) | F.upper("station_code4").isin(names)
    code = F.upper("station_code4")
    own = records.filter(F.coalesce(fits, F.lit(False))).groupBy(F.to_date("observation_date").alias("day")).agg(F.min(F.struct(code.alias("code"), F.col("station_id").alias("id"))).alias("s"))
    days = records.sparkSession.range(1).select(F.explode(F.sequence(F.to_date(start), F.to_date(end))).alias("day"))
    judged = days.join(own, "day", "left").agg(
        F.min(F.when(F.col("s").isNull(), F.col("day"))).alias("gap"),
        F.count_distinct("s.id").alias("ids"), F.count_distinct("s.code").alias("codes"),
    )
    return judged.select(
        F.when(F.col("gap").isNotNull(), F.concat(F.lit(f"no row of station {station} on "), F.col("gap").cast("string")))
        .when(F.col("ids") > 1, F.lit(f"the id of station {station} changes within the window"))
        .when(F.col("codes") > 1, F.lit(f"the code of station {station} changes within the window"))
        .alias("problem")
    )


def build_series(
    links: DataFrame, station: str, start: Column, end: Column, *,
    satellites: Sequence[str] | None = None, k: int = 2, records: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(series of the chosen satellites with UTC hours, ranked coverage) of one station.

    Reading the series fails where the station has no rows in the window, has
    fewer than ``k`` qualified satellites, or lacks one of the named ``satellites``;
    with ``records``, also where a day of the window is without the station or
    its id or code changes.
    """
    if satellites is not None and not satellites:
        raise ValueError("satellites must not be empty")
    inside, problems = one_station(links, station, start, end)
    cov = sets.rank_satellites(aggregates.coverage(inside, ["station_id", "sv"]), ["station_id"])
    if satellites is None:
        best = sets.top_satellites(cov.drop("rank"), k, ["station_id"])
        chosen = inside.join(best.select("station_id", "sv"), ["station_id", "sv"], "left_semi")
        more = sets.too_few(cov, k, station)
    else:
        named = [s.upper() for s in satellites]
        chosen = joins.only_satellites(inside, named)
        seen = inside.agg(F.collect_set("sv").alias("have"))  # a station sees a few dozen satellites
        absent = F.filter(F.array(*[F.lit(n) for n in named]), lambda n: ~F.array_contains("have", n))
        more = seen.select(F.when(F.size(absent) > 0, F.concat(F.lit(f"station {station} has no data of satellites "), F.array_join(absent, ","))).alias("problem"))
    problems = problems.union(more) if records is None else problems.union(more).union(station_days_problems(records, station, start, end))
    series = chosen.select(
        "time", utc_hour("time", start).alias("utc_hour"), "station_id", "station_code4", "sv",
        "vtec", "roti", "arc_id",
    )
    return refuse(series, problems), cov


def write_station_series(links: DataFrame, root: str) -> None:
    """Series tables that the station figures read: one folder per metric and event."""
    for metric in ("vtec", "roti"):
        rows = predicates.station_metric(links, metric, keep=("event_id",))
        rows.write.mode("overwrite").partitionBy("event_id").parquet(f"{root}/{metric}")
