"""Composite tables over the given tables."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, functions as F

from tecframe.functions.timefn import floor_time, gps_seconds_of_week, gps_week
from tecframe.operators import slips
from tecframe.plans.links import LinkParams, build_grid, build_links, build_series, finish_tracks, write_station_series
from tecframe.queries.aggregation import VALUE_LINKS, event_bounds, value_links
from tecframe.queries.base import LINKS, RATES, TRACK, Tables, full_links, links, query, r6
from tecframe.queries.tracks import SLIP_PARAMS, SLIPS, as_phases
from tecframe.session import scratch_dir


@query("p03_link_tracks", f"""
WITH RECURSIVE {SLIPS},
kept AS (SELECT w.*, l.stec AS phase, l.elev_deg, CASE WHEN l.ingest_pos % 3 = 0 THEN l.stec * 1.5 END AS code FROM walk w JOIN links l USING (period, station_id, sv, time) WHERE keep),
based AS (SELECT *, phase - first_value(phase) OVER (PARTITION BY period, station_id, sv, arc ORDER BY time) AS st FROM kept),
lev AS (SELECT *, coalesce(code, st - quantile_cont(st, 0.05) OVER (PARTITION BY period, station_id, sv)) * sqrt(1 - pow(least(0.999999::DOUBLE, 6371.0::DOUBLE * cos(radians(elev_deg)) / 6721.0::DOUBLE), 2)) AS vtec FROM based),
rt AS (SELECT *, (st - lag(st) OVER w) / ((epoch_us(time) - epoch_us(lag(time) OVER w)) / 6e7) AS rot FROM lev WINDOW w AS (PARTITION BY period, station_id, sv, arc ORDER BY time))
SELECT station_id, sv, time, arc AS arc_id, round(st, 6) + 0.0::DOUBLE AS stec, round(vtec, 6) + 0.0::DOUBLE AS vtec,
       round(CASE WHEN count(rot) OVER f = 3 THEN stddev_pop(rot) OVER f END, 6) + 0.0::DOUBLE AS roti
FROM rt WINDOW f AS (PARTITION BY period, station_id, sv, arc ORDER BY time ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)
""")
def p03(t: Tables) -> DataFrame:
    rows = as_phases(t).withColumns(
        {"phase_stec": F.col("stec"), "code_stec": F.when(F.col("ingest_pos") % 3 == 0, F.col("stec") * 1.5)}
    )
    flagged = slips.detect_slips(rows, TRACK, SLIP_PARAMS)
    out = finish_tracks(flagged, TRACK, LinkParams(interval_sec=60, roti_minutes=3.0))
    return out.filter("keep").select("station_id", "sv", "time", "arc_id", *[r6(c).alias(c) for c in ("stec", "vtec", "roti")])


def raw_observations(t: Tables) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(observations, orbits, station-days, event) derived from the events table.

    Epochs are whole minutes, several rows of one epoch included. On every 13th
    only satellites of another system are seen; each station of an event has a
    twin without rows, and a day after the event.
    """
    base = links(t).withColumn("time", floor_time("time", 1)).withColumn("observation_date", F.to_date("time"))
    number = F.regexp_extract("sv", r"(\d+)", 1).cast("double")
    v = F.col("stec")
    obs = base.select(
        "station_id", "observation_date", "time", F.when(F.dayofmonth("observation_date") == 13, F.translate("sv", "G", "R")).otherwise(F.col("sv")).alias("sv"), "ingest_pos",
        (v * 1000.0).alias("L1C"), (v * 779.0).alias("L2W"), (v * 190.0 + 3.0).alias("C1C"),
        F.when(F.col("ingest_pos") % 5 != 0, v * 190.0 + 4.0).alias("C2W"),
    )
    slots = base.select("observation_date", "sv", floor_time("time", 120).alias("time")).distinct()
    zero = lambda *names: {n: F.lit(0.0) for n in names}
    eph = slots.withColumns(
        {
            "GPSWeek": gps_week("time").cast("double"), "Toe": gps_seconds_of_week("time"), "sqrtA": F.lit(5153.6), "Eccentricity": F.lit(0.01),
            "M0": number * 0.196, "Io": F.lit(0.96), "Omega0": number % 6 * 1.047, "OmegaDot": F.lit(-8e-9),
            **zero("DeltaN", "omega", "Cuc", "Cus", "Crc", "Crs", "Cic", "Cis", "IDOT"),
        }
    )
    place = F.regexp_extract("station_id", r"(\d+)", 1).cast("double")
    seen = base.select("station_id", "observation_date", F.date_format("observation_date", "yyyy-MM").alias("event_id")).distinct()
    span = seen.groupBy("event_id", "station_id").agg(F.min("observation_date").alias("first"), F.last_day(F.max("observation_date")).alias("last"))
    records = (
        seen.unionByName(span.select("event_id", F.concat("station_id", F.lit("X")).alias("station_id"), F.col("first").alias("observation_date")))
        .unionByName(span.select("event_id", "station_id", F.date_add("last", 1).alias("observation_date")))
    ).withColumns(
        {"station_code4": F.col("station_id"), "lat": place % 60 - 30, "lon": place * 17 % 160 - 150, "height_m": F.lit(100.0), **{f"header_{a}": F.lit(None).cast("double") for a in "xyz"}}
    ).withColumns({"source": F.lit("events"), "obs_path": F.concat_ws("/", "station_id", F.col("observation_date").cast("string")), "nav_path": F.col("observation_date").cast("string")})
    event = t.events.groupBy(F.date_format("ts", "yyyy-MM").alias("event_id")).agg(
        F.min("ts").alias("start_utc"), F.max("ts").alias("end_utc")
    )
    return obs, eph, records, event


FULL_PARAMS = LinkParams(
    interval_sec=60, elevation_mask=-20.0, roti_minutes=2.0,
    slips=slips.SlipParams(gap_sec=8 * 3600.0, mw_window=3, gf_window=3, gf_degree=1, gf_threshold=1e9),
)


_F1, _F2, _C = "1575.42e6::DOUBLE", "1227.60e6::DOUBLE", "299792458.0::DOUBLE"


def full_sql(mask: float) -> str:
    """The whole way from observations to links; the orbit of a row is that of its own two hours."""
    kepler = "".join(
        f", k{i} AS (SELECT * REPLACE (m + 0.01::DOUBLE * sin(e) AS e) FROM k{i - 1})" for i in range(1, 9)
    )
    return f"""{LINKS},
ev AS (SELECT strftime(ts, '%Y-%m') AS event_id, min(ts) AS s, max(ts) AS z FROM events GROUP BY 1),
o AS (SELECT event_id, station_id, CAST(time AS DATE) AS d, time, sv, stec * 1000.0::DOUBLE AS l1, stec * 779.0::DOUBLE AS l2, stec * 190.0::DOUBLE + 3.0::DOUBLE AS c1,
             CASE WHEN ingest_pos % 5 <> 0 THEN stec * 190.0::DOUBLE + 4.0::DOUBLE END AS c2, CAST(substr(sv, 2) AS DOUBLE) AS num, CAST(substr(station_id, 2) AS DOUBLE) AS place,
             time_bucket(INTERVAL 2 HOURS, time, TIMESTAMP '1970-01-01') AS slot
      FROM (SELECT * REPLACE (date_trunc('minute', time) AS time) FROM links QUALIFY row_number() OVER (PARTITION BY station_id, sv, date_trunc('minute', time) ORDER BY ingest_pos DESC) = 1)
      JOIN ev ON event_id = strftime(time, '%Y-%m') AND time >= s AND time <= z WHERE day(time) <> 13),
t0 AS (SELECT *, epoch_us(time - slot + TIMESTAMP '1970-01-01') / 1e6 AS tk, CAST((epoch_us(slot) - epoch_us(TIMESTAMP '1980-01-06')) // 1000000 % 604800 AS DOUBLE) AS toe,
              5153.6::DOUBLE * 5153.6::DOUBLE AS a, radians(place % 60 - 30) AS p, radians(place * 17 % 160 - 150) AS l FROM o),
t1 AS (SELECT *, num * 0.196::DOUBLE + sqrt(3.986005e14 / pow(a, 3)) * tk AS m FROM t0),
k0 AS (SELECT *, m AS e FROM t1){kepler},
q AS (SELECT *, atan2(sqrt(1 - 0.01::DOUBLE * 0.01::DOUBLE) * sin(e), cos(e) - 0.01::DOUBLE) AS u, a * (1 - 0.01::DOUBLE * cos(e)) AS r,
             num % 6 * 1.047::DOUBLE + (-8e-9 - 7.2921151467e-5) * tk - 7.2921151467e-5 * toe AS node, 1.0::DOUBLE / 298.257223563::DOUBLE AS f FROM k8),
g AS (SELECT *, 6378137.0::DOUBLE / sqrt(1 - f * (2 - f) * sin(p) * sin(p)) AS n FROM q),
dv AS (SELECT *, r * cos(u) * cos(node) - r * sin(u) * cos(0.96::DOUBLE) * sin(node) - (n + 100) * cos(p) * cos(l) AS dx,
              r * cos(u) * sin(node) + r * sin(u) * cos(0.96::DOUBLE) * cos(node) - (n + 100) * cos(p) * sin(l) AS dy,
              r * sin(u) * sin(0.96::DOUBLE) - (n * (1 - f * (2 - f)) + 100) * sin(p) AS dz FROM g),
en AS (SELECT *, -sin(l) * dx + cos(l) * dy AS ee, -sin(p) * cos(l) * dx - sin(p) * sin(l) * dy + cos(p) * dz AS nn, cos(p) * cos(l) * dx + cos(p) * sin(l) * dy + sin(p) * dz AS uu FROM dv),
ang AS (SELECT *, (degrees(atan2(ee, nn)) + 360) % 360 AS az, degrees(atan2(uu, sqrt(ee * ee + nn * nn))) AS el FROM en),
judged AS (SELECT *, count(*) OVER k AS n1, count_if(el >= {mask}) OVER k AS n3 FROM ang WINDOW k AS (PARTITION BY event_id, station_id, d, sv))"""


FULL_LINKS = full_sql(-20.0) + f""",
numbered AS MATERIALIZED (
  SELECT event_id, station_id, d, sv, time, el, az, p, l, epoch_us(time) / 1e6 AS s,
         (l1 * ({_C} / {_F1}) - l2 * ({_C} / {_F2})) * (({_F1} * {_F1} * {_F2} * {_F2}) / (40.3::DOUBLE * ({_F1} * {_F1} - {_F2} * {_F2})) / 1e16) AS phase,
         (c2 - c1) * (({_F1} * {_F1} * {_F2} * {_F2}) / (40.3::DOUBLE * ({_F1} * {_F1} - {_F2} * {_F2})) / 1e16) AS code,
         (l1 - l2) - ({_F1} * c1 + {_F2} * c2) / ({_F1} + {_F2}) / ({_C} / ({_F1} - {_F2})) AS mw,
         row_number() OVER (PARTITION BY event_id, station_id, d, sv ORDER BY time) AS n
  FROM judged WHERE n1 >= 2 AND n3 >= 2 AND el >= -20),
walk AS (
  SELECT event_id, station_id, d, sv, time, n, s, CAST(0 AS BIGINT) AS arc, CASE WHEN mw IS NULL THEN CAST([] AS DOUBLE[]) ELSE CAST([mw] AS DOUBLE[]) END AS hm, true AS keep FROM numbered WHERE n = 1
  UNION ALL
  SELECT event_id, station_id, d, sv, time, n, s, arc + CASE WHEN hit THEN 1 ELSE 0 END, CASE WHEN hit THEN [] WHEN mw IS NULL THEN hm ELSE list_append(hm, mw) END, NOT hit
  FROM (SELECT *, CASE WHEN mw IS NOT NULL AND len(hm) >= 3 THEN abs(mw - list_median(hm[-3:])) > 4.0 ELSE false END AS hit
        FROM (SELECT x.event_id, x.station_id, x.d, x.sv, x.time, x.n, x.s, x.mw, w.arc + CASE WHEN x.s - w.s > 28800 THEN 1 ELSE 0 END AS arc, CASE WHEN x.s - w.s > 28800 THEN [] ELSE w.hm END AS hm
              FROM walk w JOIN numbered x ON x.event_id = w.event_id AND x.station_id = w.station_id AND x.d = w.d AND x.sv = w.sv AND x.n = w.n + 1))),
kept AS (SELECT b.*, w.arc FROM walk w JOIN numbered b USING (event_id, station_id, d, sv, time) WHERE keep),
based AS (SELECT *, phase - first_value(phase) OVER (PARTITION BY event_id, station_id, d, sv, arc ORDER BY time) AS st FROM kept),
lev AS (SELECT *, coalesce(code, st - quantile_cont(st, 0.05) OVER (PARTITION BY event_id, station_id, d, sv)) * sqrt(1 - pow(least(0.999999::DOUBLE, 6371.0::DOUBLE * cos(radians(el)) / 6721.0::DOUBLE), 2)) AS vtec FROM based),
rt AS (SELECT *, (st - lag(st) OVER w) / ((epoch_us(time) - epoch_us(lag(time) OVER w)) / 6e7) AS rot FROM lev WINDOW w AS (PARTITION BY event_id, station_id, d, sv, arc ORDER BY time)),
done AS (SELECT *, CASE WHEN count(rot) OVER f = 2 THEN stddev_pop(rot) OVER f END AS roti,
                pi() / 2 - radians(el) - asin(6371.0::DOUBLE / 6721.0::DOUBLE * sin(pi() / 2 - radians(el))) AS psi
         FROM rt WINDOW f AS (PARTITION BY event_id, station_id, d, sv, arc ORDER BY time ROWS BETWEEN 1 PRECEDING AND CURRENT ROW)),
pp AS (SELECT *, asin(sin(p) * cos(psi) + cos(p) * sin(psi) * cos(radians(az))) AS ip FROM done)"""


@query("p03_links_from_observations", f"""
WITH RECURSIVE {FULL_LINKS}
SELECT event_id, station_id, sv, time, arc AS arc_id, round(az, 5) + 0.0::DOUBLE AS az_deg, round(el, 5) + 0.0::DOUBLE AS elev_deg, round(degrees(ip), 5) + 0.0::DOUBLE AS ipp_lat,
       round(((degrees(l + asin(sin(psi) * sin(radians(az)) / greatest(cos(ip), 1e-6::DOUBLE))) + 180) % 360 + 360) % 360 - 180, 5) + 0.0::DOUBLE AS ipp_lon,
       round(st, 4) + 0.0::DOUBLE AS stec, round(vtec, 4) + 0.0::DOUBLE AS vtec, round(roti, 4) + 0.0::DOUBLE AS roti FROM pp
""")
def p03_full(t: Tables) -> DataFrame:
    out = build_links(*raw_observations(t), FULL_PARAMS).links
    return out.select(
        "event_id", "station_id", "sv", "time", "arc_id", *[r6(c, 5).alias(c) for c in ("az_deg", "elev_deg", "ipp_lat", "ipp_lon")],
        *[r6(c, 4).alias(c) for c in ("stec", "vtec", "roti")],
    )


@query("p03_link_failures", f"""
WITH {full_sql(70.0)},
k AS (SELECT event_id, station_id, d, sv, CASE WHEN any_value(n1) < 2 THEN 'insufficient_phase_samples' WHEN any_value(n3) < 2 THEN 'below_elevation_mask' END AS reason
      FROM judged GROUP BY ALL),
c AS (SELECT event_id, station_id, d, reason, count(*) AS n FROM k GROUP BY ALL),
seen AS (SELECT DISTINCT strftime(time, '%Y-%m') AS event_id, station_id, CAST(time AS DATE) AS d FROM links),
days AS (
  SELECT *, CASE WHEN NOT EXISTS (SELECT 1 FROM links l JOIN ev ON ev.event_id = seen.event_id WHERE l.station_id = seen.station_id AND CAST(l.time AS DATE) = seen.d AND date_trunc('minute', l.time) BETWEEN s AND z) THEN 'empty_observations'
              WHEN day(d) = 13 THEN 'empty_gps_rows' END AS ruled
  FROM seen
  UNION ALL SELECT event_id, station_id || 'X', min(d), 'empty_observations' FROM seen GROUP BY 1, 2
  UNION ALL SELECT event_id, station_id, last_day(max(d)) + 1, 'out_of_window' FROM seen GROUP BY 1, 2),
s AS (SELECT event_id, station_id, d, first(reason ORDER BY n DESC, reason = 'below_elevation_mask') AS reason, string_agg(reason || '=' || CAST(n AS VARCHAR), ', ' ORDER BY reason) AS detail
      FROM c GROUP BY ALL HAVING count_if(reason IS NULL) = 0)
SELECT event_id, station_id, CAST(d AS DATE) AS observation_date, 'events' AS source, station_id || '/' || CAST(CAST(d AS DATE) AS VARCHAR) AS obs_path, CAST(CAST(d AS DATE) AS VARCHAR) AS nav_path,
       coalesce(ruled, reason, 'no_valid_links') AS reason,
       coalesce(CASE ruled WHEN 'out_of_window' THEN 'record does not overlap the event window' WHEN 'empty_observations' THEN 'georinex returned no GPS observation rows'
                WHEN 'empty_gps_rows' THEN 'no GPS rows remained after filtering' END, detail, '') AS detail
FROM days LEFT JOIN s USING (event_id, station_id, d) WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.event_id = days.event_id AND c.station_id = days.station_id AND c.d = days.d AND c.reason IS NULL)
""", texts=("observation_date",))
def p03_failures(t: Tables) -> DataFrame:
    return build_links(*raw_observations(t), replace(FULL_PARAMS, elevation_mask=70.0)).failures.drop("stage")


@query("p04_grid_products", f"""
WITH {VALUE_LINKS},
grid AS (SELECT event_id, time_bucket(INTERVAL 15 MINUTES, time, TIMESTAMP '1970-01-01') AS time, round_even(ipp_lat / 20.0, 0) * 20.0 AS lat, round_even(ipp_lon / 20.0, 0) * 20.0 AS lon,
                median(vtec) AS vtec, median(roti) AS roti, count(sv) AS n FROM vl WHERE ipp_lat BETWEEN 0 AND 100 AND ipp_lon BETWEEN 0 AND 100 GROUP BY ALL),
b AS (SELECT event_id, date_trunc('day', min(time)) AS a, date_trunc('day', max(time)) + INTERVAL 2 DAY AS z FROM vl GROUP BY 1),
ticks AS (SELECT event_id, z, unnest(generate_series(a, z, INTERVAL 15 MINUTES)) AS time FROM b),
hours AS (SELECT event_id, date_trunc('hour', time) AS h, min(time) AS time_start, max(time) AS time_end, min(least(date_trunc('hour', time) + INTERVAL 45 MINUTES, z)) AS chunk_end FROM ticks GROUP BY ALL)
SELECT hours.event_id || '_' || strftime(h, '%Y%m%d_%H00') AS path, time_start, time_end, CASE WHEN count(g.n) > 0 THEN 'vtec,roti' ELSE '' END AS metrics, CAST(coalesce(sum(g.n), 0) AS BIGINT) AS samples
FROM hours LEFT JOIN grid g ON g.event_id = hours.event_id AND date_trunc('hour', g.time) = h GROUP BY ALL
""")
def p04(t: Tables) -> DataFrame:
    rows = value_links(t)
    box = {"lat_min": 0.0, "lat_max": 100.0, "lon_min": 0.0, "lon_max": 100.0}
    out = build_grid(rows, event_bounds(rows), bbox=box, step=20.0)
    path = F.concat("event_id", F.lit("_"), F.date_format("chunk_start", "yyyyMMdd_HH'00'"))
    counts = out.cube.groupBy(path.alias("path")).agg(F.sum("sample_count").alias("samples"))
    return out.catalog.withColumn("metrics", F.array_join("metrics", ",")).join(counts, "path")


@query("p05_station_series", f"""
WITH {RATES},
m AS (SELECT *, CASE WHEN stec >= 20 THEN stec END AS vtec FROM full_links WHERE station_id = 'S0' AND time BETWEEN TIMESTAMP '2024-01-03 12:00:00' AND TIMESTAMP '2024-01-25 12:00:00'),
a AS (SELECT sv, arc_id, count(vtec) AS v, count(roti) AS r, count(*) AS n FROM m GROUP BY ALL),
c AS (SELECT sv, row_number() OVER (ORDER BY sum(v) + sum(r) DESC, max(n) DESC, sv) AS rk FROM a GROUP BY sv HAVING sum(v) > 0 AND sum(r) > 0)
SELECT time, round((epoch_us(time) - epoch_us(TIMESTAMP '2024-01-03')) / 3.6e9, 6) + 0.0::DOUBLE AS utc_hour, station_id, sv, vtec, round(roti, 6) + 0.0::DOUBLE AS roti, arc_id FROM m WHERE sv IN (SELECT sv FROM c WHERE rk <= 2)
""")
def p05(t: Tables) -> DataFrame:
    rows = full_links(t).withColumns(
        {"vtec": F.when(F.col("stec") >= 20, F.col("stec")), "station_code4": F.substring("station_id", 1, 4)}
    )
    at = lambda s: F.lit(s).cast("timestamp")
    series, _ = build_series(rows, "s0", at("2024-01-03 12:00:00"), at("2024-01-25 12:00:00"), k=2)
    return series.select("time", r6("utc_hour").alias("utc_hour"), "station_id", "sv", "vtec", r6("roti").alias("roti"), "arc_id")


@query("p04_station_tables", f"""
WITH {RATES}, f AS (SELECT *, CASE WHEN stec >= 20 THEN stec END AS vtec FROM full_links)
SELECT strftime(period, '%Y-%m') AS event_id, 'vtec' AS metric, time, station_id, sv, vtec AS value FROM f WHERE vtec IS NOT NULL
UNION ALL SELECT strftime(period, '%Y-%m'), 'roti', time, station_id, sv, round(roti, 6) + 0.0::DOUBLE FROM f WHERE roti IS NOT NULL
""")
def p04_station_tables(t: Tables) -> DataFrame:
    rows = full_links(t).withColumns(
        {"vtec": F.when(F.col("stec") >= 20, F.col("stec")), "station_code4": F.substring("station_id", 1, 4), "event_id": F.date_format("period", "yyyy-MM")}
    )
    root = scratch_dir(t.spark, "series")
    write_station_series(rows, root)
    read = lambda m: t.spark.read.schema(f"time timestamp, station_id string, sv string, {m} double, event_id string").parquet(f"{root}/{m}")
    part = lambda m, v: read(m).select("event_id", F.lit(m).alias("metric"), "time", "station_id", "sv", v.alias("value"))
    return part("vtec", F.col("vtec")).union(part("roti", r6("roti")))
