"""Joins of the event tables.

No join is hinted: Spark broadcasts a side whose measured size is small and
otherwise shuffles, splitting skewed partitions. Range and as-of joins are
turned into equi-joins on time slots first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from tecframe import fixed
from tecframe.functions._col import let, micros
from tecframe.functions.timefn import delta_seconds, midpoint


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of each key, as an aggregate that combines map-side; a missing value comes first."""
    rest = [c for c in df.columns if c not in keys]
    if rest == list(order) and len(rest) == 1:  # one value needs no row to be kept, and no sort
        least = F.when(F.count(rest[0]) == F.count(F.lit(1)), F.min(rest[0]))
        return df.groupBy(*keys).agg(least.alias(rest[0]))
    best = F.min_by(F.struct(*rest), F.struct(*order)).alias("_row")
    return df.groupBy(*keys).agg(best).select(*keys, "_row.*")


def last_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    if rest == list(order) and len(rest) == 1:
        return df.groupBy(*keys).agg(F.max(rest[0]).alias(rest[0]))
    best = F.max_by(F.struct(*rest), F.struct(*order)).alias("_row")
    return df.groupBy(*keys).agg(best).select(*keys, "_row.*")


# parts into which a slot is cut
_FINE = 64


def asof_latest(
    obs: DataFrame,
    eph: DataFrame,
    keys: Sequence[str],
    max_age_sec: float,
    *,
    obs_time: str = "time",
    eph_time: str = "time",
    position: str = "ingest_pos",
    out: str = "eph",
) -> DataFrame:
    """Adds struct ``out``: the latest record at or before each row, not older than the limit.

    Time is cut into slots as long as the age limit, so a record serves its own
    slot and the next, and slots into fine ones, in which rows and records are
    merged in order; every table takes this way. Of records at the same time
    the last one by position counts, and without a position column the largest
    one by its columns. No record gives NULL.
    """
    keys = list(keys)
    width = max(1, int(max_age_sec * 1e6))
    payload = F.struct(*[c for c in eph.columns if c not in keys and c != position])
    newest = F.max_by(payload, F.struct(position, payload)) if position in eph.columns else F.max(payload)
    records = eph.withColumn("_us", micros(eph_time)).groupBy(*keys, "_us").agg(newest.alias("rec"))
    joined = _latest_in_fine_slots(obs, records, keys, width, obs_time)
    fresh = micros(obs_time) - F.col("_hit.us") <= width
    return joined.withColumn(out, F.when(fresh, F.col("_hit.rec"))).drop("_hit")


def _latest_in_fine_slots(
    obs: DataFrame, records: DataFrame, keys: list[str], width: int, obs_time: str
) -> DataFrame:
    """Adds ``_hit`` by merging rows and records in time order.

    The order is kept inside fine slots only. What a fine slot inherits from
    the ones before it is the last record among at most 128 slot summaries.
    """
    fine = max(1, -(-width // _FINE))
    with_slots = lambda df: df.withColumn("_fine", F.floor(F.col("_us") / fine))
    r_rows = with_slots(records).select(
        *keys, "_fine", "_us", F.struct(F.col("_us").alias("us"), F.col("rec")).alias("_r")
    )
    o_rows = with_slots(obs.withColumn("_us", micros(obs_time))).withColumn("_row", F.struct(*obs.columns)).select(
        *keys, "_fine", "_us", "_row"
    )
    # a fine slot can inherit from the _FINE slots before it
    coarse = F.floor(F.col("_fine") / _FINE)
    tails = r_rows.groupBy(*keys, "_fine").agg(F.max_by("_r", "_us").alias("_tail"))
    asked = o_rows.select(*keys, "_fine").distinct()
    summary = tails.select(*keys, F.explode(F.array(coarse, coarse + 1)).alias("_coarse"), "_fine", "_tail").unionByName(
        asked.select(*keys, coarse.alias("_coarse"), "_fine"), allowMissingColumns=True
    )
    earlier = Window.partitionBy(*keys, "_coarse").orderBy("_fine").rangeBetween(Window.unboundedPreceding, -1)
    inherited = (
        summary.withColumn("_before", F.last("_tail", ignorenulls=True).over(earlier))
        .filter(F.col("_tail").isNull()).select(*keys, "_fine", "_before")
    )
    merged = o_rows.unionByName(r_rows, allowMissingColumns=True)
    order = Window.partitionBy(*keys, "_fine").orderBy("_us", F.col("_row").isNotNull())
    merged = merged.withColumn("_own", F.last("_r", ignorenulls=True).over(order)).filter(F.col("_row").isNotNull())
    same = merged.join(inherited, [*keys, "_fine"], "left")
    return same.select("_row.*", F.coalesce("_own", "_before").alias("_hit"))


def asof_ephemeris(
    obs: DataFrame, eph: DataFrame, max_age_hours: float = fixed.MAX_EPHEMERIS_AGE_HOURS,
    *, keys: Sequence[str] = ("observation_date", "sv"),
) -> DataFrame:
    """Broadcast orbit of each observation, from that day's navigation records."""
    clean = eph.dropna(subset=["sqrtA"])
    return asof_latest(obs, clean, keys, max_age_hours * 3600.0)


def tag_windows(
    series: DataFrame,
    windows: DataFrame,
    *,
    time: str = "time",
    start: str = "start_utc",
    end: str = "end_utc",
    slot_sec: int = 86_400,
    how: str = "inner",
) -> DataFrame:
    """Rows with every window that holds them, ends included.

    Windows are laid out on time slots, so that the join is an equi-join.
    """
    width = slot_sec * 1_000_000
    laid = windows.withColumn(
        "_slot",
        F.explode(F.sequence(F.floor(micros(start) / width), F.floor(micros(end) / width))),
    )
    rows = series.withColumn("_slot", F.floor(micros(time) / width))
    cond = [
        rows["_slot"] == laid["_slot"],
        rows[time] >= laid[start],
        rows[time] <= laid[end],
    ]
    return rows.join(laid, cond, how).drop("_slot")


# widths of the slots that intervals are laid on: powers of four days
_LEVELS, _DAY = 10, 86_400_000_000


def _holding(intervals: DataFrame, points: DataFrame, start: str, end: str, at: str) -> DataFrame:
    """Every interval [start, end] with the points in it, in microseconds.

    An interval lies on slots at least as wide as itself, so on two at most
    (longer than the widest slot: on as many as it spans); a point is looked up
    once for each width.
    """
    widths = F.array(*[F.lit(_DAY * 4**k) for k in range(_LEVELS)])
    length = F.col(end) - F.col(start)
    fits = F.filter(F.sequence(F.lit(0), F.lit(_LEVELS - 1)), lambda k: F.element_at(widths, k + 1) >= length)
    laid = intervals.withColumn("_level", F.coalesce(F.get(fits, F.lit(0)), F.lit(_LEVELS - 1)))
    width = F.element_at(widths, F.col("_level") + 1)
    laid = laid.withColumn("_slot", F.explode(F.sequence(F.floor(F.col(start) / width), F.floor(F.col(end) / width))))
    looked = points.select("*", F.posexplode(widths).alias("_level", "_width"))
    looked = looked.withColumn("_slot", F.floor(F.col(at) / F.col("_width"))).drop("_width")
    both = looked.join(laid, ["_level", "_slot"])
    return both.filter((F.col(start) <= F.col(at)) & (F.col(at) <= F.col(end))).drop("_level", "_slot")


def overlapping(files: DataFrame, events: DataFrame) -> DataFrame:
    """Every pair of a file (start, end) and an event (start_utc, end_utc) that overlap, once; ends belong to both.

    A pair belongs to the later one of the two starts: the event's start lies
    in the file, or the file's start lies in the event, after its start.
    Intervals that end before they start overlap nothing.
    """
    f = files.withColumns({"_a": micros("start"), "_b": micros("end")}).filter("_a <= _b")
    e = events.withColumns({"_s": micros("start_utc"), "_e": micros("end_utc")}).filter("_s <= _e")
    columns = [*events.columns, *files.columns]
    later_event = _holding(f, e, "_a", "_b", "_s").select(*columns)
    later_file = _holding(e, f, "_s", "_e", "_a").filter("_a > _s").select(*columns)
    return later_event.union(later_file)


def best_cover(
    files: DataFrame,
    events: DataFrame,
    *,
    event_keys: Sequence[str] = ("event_id",),
    kind: str = "kind",
    name: str = "name",
) -> DataFrame:
    """Per event and kind the narrowest file that overlaps the event; ties by name.

    ``files`` has start and end, ``events`` has start_utc and end_utc.
    """
    both = overlapping(files.select(kind, name, "start", "end"), events.select(*event_keys, "start_utc", "end_utc"))
    width = micros("end") - micros("start")
    return both.groupBy(*event_keys, kind).agg(
        F.min_by(F.struct(name, "start", "end"), F.struct(width, F.col(name))).alias("_best")
    ).select(*event_keys, kind, "_best.*")


def attach_position(records: DataFrame, manifest: DataFrame, *, order: str = "row_no") -> DataFrame:
    """Position of the first manifest row of each (event, date, station); absent is 0."""
    keys = ["event_id", "observation_date", "station_id"]
    wanted = manifest.select(*keys, order, "lat", "lon", "height_m")
    first = first_per_key(wanted, keys, [order]).drop(order)
    bare = records.drop("lat", "lon", "height_m")
    joined = bare.join(first, keys, "left")
    return joined.withColumns(
        {c: F.coalesce(F.when(~F.isnan(c), F.col(c)), F.lit(0.0)) for c in ("lat", "lon", "height_m")}
    )


def join_stations(available: DataFrame, meta: DataFrame, *, code: str = "station_code4", order: str = "row_no") -> DataFrame:
    """Available codes with their metadata; of equal codes the last row counts."""
    lookup = last_per_key(meta.withColumn("_code", F.lower(code)).drop(code), ["_code"], [order]).drop(order)
    codes = available.withColumn("_code", F.lower(code))
    return codes.join(lookup, "_code").drop("_code")


def station_calendar(stations: DataFrame, events: DataFrame) -> DataFrame:
    """Each station of an event on each of its days; days come from a sequence, not a join."""
    return stations.join(events, "event_id").withColumn(
        "observation_date",
        F.explode(F.sequence(F.to_date("start_utc"), F.to_date("end_utc"))),
    ).drop("start_utc", "end_utc")


def attach_nav(observations: DataFrame, nav: DataFrame) -> DataFrame:
    """Navigation file of the day; an ok file replaces an error file, else the first path."""
    ranked = nav.withColumn("_bad", (F.coalesce(F.col("status"), F.lit("")) != "ok").cast("int"))
    best = first_per_key(
        ranked.select("observation_date", "_bad", F.col("path").alias("nav_path"),
                      F.col("status").alias("nav_status")),
        ["observation_date"], ["_bad", "nav_path"],
    ).drop("_bad")
    out = observations.join(best, "observation_date", "left")
    missing = F.col("nav_status").isNull()
    return out.withColumns(
        {
            "nav_path": F.when(missing, F.lit("")).otherwise(F.col("nav_path")),
            "nav_status": F.coalesce(F.col("nav_status"), F.lit("error")),
            "nav_error": F.when(missing, F.lit("navigation_file_missing")).otherwise(F.lit("")),
        }
    )


def merge_roti(links: DataFrame, values: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Writes roti values back to their rows; the new value wins where there is one."""
    ids = [*keys, "time", "arc_id"]
    new = values.select(*ids, F.col("roti").alias("_new"))
    return (
        links.join(new, ids, "left")
        .withColumn("roti", F.coalesce(F.col("_new"), F.col("roti")))
        .drop("_new")
    )


def only_satellites(df: DataFrame, satellites: DataFrame | Sequence[str] | None) -> DataFrame:
    """None keeps every row."""
    if satellites is None:
        return df
    if isinstance(satellites, DataFrame):
        return df.join(satellites.select("sv").distinct(), "sv", "left_semi")
    return df.filter(F.col("sv").isin(list(satellites)))


def explicit_pairs(spec: DataFrame, slices: DataFrame, scenes: DataFrame) -> DataFrame:
    """Pairs asked for by exact times, with the reason when a side is missing.

    spec: gold_cha_time, gold_chb_time, gnss_time; slices: time, slice_id;
    scenes: cha_time, chb_time, scene_id. Of equal times the last slice and
    the last scene count.
    """
    s = last_per_key(slices.select("time", "slice_id"), ["time"], ["slice_id"])
    g = last_per_key(
        scenes.filter(F.col("cha_time").isNotNull() & F.col("chb_time").isNotNull())
        .select("cha_time", "chb_time", "scene_id"),
        ["cha_time", "chb_time"], ["scene_id"],
    )
    out = spec.join(s, spec["gnss_time"] == s["time"], "left").drop("time")
    out = out.join(
        g, (out["gold_cha_time"] == g["cha_time"]) & (out["gold_chb_time"] == g["chb_time"]), "left"
    ).drop("cha_time", "chb_time")
    no_s, no_g = F.col("slice_id").isNull(), F.col("scene_id").isNull()
    detail = (
        F.when(no_s & no_g, F.lit("explicit_pair_missing_gnss_and_gold"))
        .when(no_s, F.lit("explicit_pair_missing_gnss"))
        .when(no_g, F.lit("explicit_pair_missing_gold"))
        .otherwise(F.lit(""))
    )
    gold_time = midpoint("gold_cha_time", "gold_chb_time")
    return out.withColumns(
        {
            "gold_time": gold_time,
            "delta_seconds": F.when(detail == "", delta_seconds("gnss_time", gold_time)),
            "status": F.when(detail == "", F.lit("ready")).otherwise(F.lit("skipped")),
            "detail": detail,
        }
    )


def resolve_slots(slots: DataFrame, slices: DataFrame, scenes: DataFrame, *,
                  overlay_producer: str = "internal", overlay_metric: str = "roti") -> DataFrame:
    """Finds the slice and scene each panel slot asks for; only exact times count.

    slots: panel_name, slot_index, kind, producer, timestamp, gold_cha_time,
    gold_chb_time, gnss_time. slices: producer, metric, time, slice_id (last
    wins). scenes: cha_time, chb_time, scene_id (first wins).
    """
    last = last_per_key(
        slices.select(F.lower("producer").alias("_p"), F.lower("metric").alias("_m"), F.col("time").alias("_t"), "slice_id"),
        ["_p", "_m", "_t"], ["slice_id"],
    )
    first = first_per_key(
        scenes.select(F.col("cha_time").alias("_a"), F.col("chb_time").alias("_b"), "scene_id"),
        ["_a", "_b"], ["scene_id"],
    )
    kind = F.col("kind")
    is_map, is_over = kind.isin("gnss_roti", "gnss_vtec"), kind == "overlay"
    asked = (
        slots.withColumn(
            "_wp",
            F.when(is_map, F.lower(F.coalesce("producer", F.lit("isee")))).when(
                is_over, F.lit(overlay_producer)
            ),
        )
        .withColumn(
            "_wm",
            F.when(is_map, F.substring_index(kind, "_", -1)).when(is_over, F.lit(overlay_metric)),
        )
        .withColumn("_wt", F.when(is_map, F.col("timestamp")).when(is_over, F.col("gnss_time")))
    )
    out = asked.join(
        last,
        (F.col("_wp") == F.col("_p")) & (F.col("_wm") == F.col("_m")) & (F.col("_wt") == F.col("_t")),
        "left",
    ).join(
        first,
        (F.col("gold_cha_time") == F.col("_a")) & (F.col("gold_chb_time") == F.col("_b"))
        & kind.isin("gold", "overlay"),
        "left",
    )
    no_slice, no_scene = F.col("slice_id").isNull(), F.col("scene_id").isNull()
    detail = (
        F.when(is_map & no_slice, F.lit("missing_gnss_slice"))
        .when((kind == "gold") & no_scene, F.lit("missing_gold_pair"))
        .when(is_over & no_scene & no_slice, F.lit("missing_gold_pair_and_gnss_slice"))
        .when(is_over & no_scene, F.lit("missing_gold_pair"))
        .when(is_over & no_slice, F.lit("missing_gnss_slice"))
        .otherwise(F.lit(""))
    )
    requested = F.when(kind == "gold", midpoint("gold_cha_time", "gold_chb_time")).otherwise(F.col("_wt"))
    return out.select(
        "panel_name", "slot_index", "kind", requested.alias("requested_time"),
        F.when(detail == "", requested).alias("resolved_time"),
        F.when(detail == "", F.lit("ready")).otherwise(F.lit("placeholder")).alias("status"),
        detail.alias("detail"), "slice_id", "scene_id",
    )
