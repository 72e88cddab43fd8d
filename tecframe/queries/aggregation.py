"""Aggregations over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tecframe.functions.indices import kp_level, null_if
from tecframe.functions.timefn import floor_time
from tecframe.operators import aggregates, sets
from tecframe.operators.sequences import fallback_source, normalise_arc
from tecframe.plans.omni import build_omni, clean_hourly
from tecframe.queries.base import (
    ARCS, EVENT_TIME, LINKS, RATES, TRACK, Tables, arcs, event_time, full_links, links, query, r6,
)

VALUE_BOX = {"lat_min": 10.0, "lat_max": 90.0, "lon_min": 0.0, "lon_max": 90.0}


def value_links(t: Tables) -> DataFrame:
    """Events as links: value is the latitude and the metric, k of props the longitude."""
    k = F.get_json_object("props", "$.k").cast("double")
    return t.events.select(
        F.col("ts").alias("time"), F.col("value").alias("ipp_lat"), k.alias("ipp_lon"),
        F.col("value").alias("vtec"), (k / 10.0).alias("roti"), F.col("user_id").cast("string").alias("sv"),
        F.date_format("ts", "yyyy-MM").alias("event_id"),
    )


VALUE_LINKS = """
vl AS (
  SELECT ts AS time, value AS ipp_lat, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS ipp_lon, value AS vtec,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) / 10.0 AS roti, CAST(user_id AS VARCHAR) AS sv,
         strftime(ts, '%Y-%m') AS event_id FROM events)"""


@query("a01_median_grid", f"""
WITH {VALUE_LINKS}
SELECT time_bucket(INTERVAL 6 HOURS, time, TIMESTAMP '1970-01-01') AS time,
       round_even(10.0 + round_even((ipp_lat - 10.0) / 10.0, 0) * 10.0, 6) AS lat,
       round_even(0.0 + round_even((ipp_lon - 0.0) / 10.0, 0) * 10.0, 6) AS lon,
       round(median(vtec), 6) + 0.0::DOUBLE AS vtec, round(median(roti), 6) + 0.0::DOUBLE AS roti, count(sv) AS sample_count
FROM vl WHERE ipp_lat BETWEEN 10 AND 90 AND ipp_lon BETWEEN 0 AND 90 GROUP BY ALL
""")
def a01(t: Tables) -> DataFrame:
    grid = aggregates.grid_links(value_links(t), bbox=VALUE_BOX, lat_step=10.0, lon_step=10.0, cadence_min=360)
    return grid.withColumns({"vtec": r6("vtec"), "roti": r6("roti")})


@query("a02_floor_grid", f"""
WITH {VALUE_LINKS},
cells AS (SELECT event_id, date_trunc('hour', time) AS time, floor(ipp_lat / 10.0) * 10.0 AS lat_bin,
                 floor(ipp_lon / 25.0) * 25.0 AS lon_bin, vtec, roti, sv FROM vl),
grid AS (SELECT time, event_id, lat_bin, lon_bin, round(median(vtec), 6) + 0.0::DOUBLE AS vtec_median,
                round(median(roti), 6) + 0.0::DOUBLE AS roti_median, count(sv) AS sample_count FROM cells GROUP BY ALL),
bounds AS (SELECT event_id, date_trunc('day', min(time)) AS a, date_trunc('day', max(time)) + INTERVAL 2 DAY AS b FROM vl GROUP BY 1),
wanted AS (SELECT event_id, unnest(generate_series(a, b, INTERVAL 1 HOUR)) AS time FROM bounds)
SELECT * FROM grid
UNION ALL SELECT time, event_id, CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), CAST(0 AS BIGINT)
FROM wanted w WHERE NOT EXISTS (SELECT 1 FROM cells c WHERE c.event_id = w.event_id AND c.time = w.time)
""")
def a02(t: Tables) -> DataFrame:
    rows = value_links(t)
    grid = aggregates.grid_links_floor(rows, event_bounds(rows), lat_step=10.0, lon_step=25.0, cadence_min=60)
    return grid.withColumns({"vtec_median": r6("vtec_median"), "roti_median": r6("roti_median")})


def event_bounds(rows: DataFrame) -> DataFrame:
    """Whole days around the rows, two more at the end, so that some intervals stay empty."""
    return rows.groupBy("event_id").agg(
        F.date_trunc("day", F.min("time")).alias("start_utc"),
        (F.date_trunc("day", F.max("time")) + F.expr("INTERVAL 2 DAY")).alias("end_utc"),
    )


@query("u02_missing_times", f"""
WITH {VALUE_LINKS},
have AS (SELECT DISTINCT event_id, time_bucket(INTERVAL 15 MINUTES, time, TIMESTAMP '1970-01-01') AS time FROM vl),
bounds AS (SELECT event_id, date_trunc('day', min(time)) AS a, date_trunc('day', max(time)) + INTERVAL 2 DAY AS b FROM vl GROUP BY 1),
wanted AS (SELECT event_id, unnest(generate_series(a, b, INTERVAL 15 MINUTES)) AS time FROM bounds)
SELECT * FROM wanted EXCEPT SELECT event_id, time FROM have
""")
def u02(t: Tables) -> DataFrame:
    rows = value_links(t)
    return sets.missing_times(
        rows.withColumn("time", floor_time("time", 15)), event_bounds(rows), 15
    )


def raw_indices(t: Tables) -> DataFrame:
    """Index rows of each event type: every event is a row at its own time."""
    return t.events.select(
        F.col("event_type").alias("kind"), event_time().alias("Time"), "event_id",
        F.floor("value").cast("double").alias("Kp_code"),
        F.when(F.floor("value") == 7, 99999.0).otherwise(F.floor("value") - 80.0).alias("Dst_nT"),
    )


RAW_INDICES = f"""
raw AS (SELECT event_type AS kind, {EVENT_TIME} AS "Time", event_id, CAST(floor(value) AS DOUBLE) AS Kp_code,
               CASE WHEN floor(value) = 7 THEN 99999.0::DOUBLE ELSE CAST(floor(value) AS DOUBLE) - 80.0 END AS Dst_nT FROM events),
hourly AS (SELECT kind, event_id, "Time", nullif(Kp_code, 99.0::DOUBLE) AS Kp_code, nullif(Dst_nT, 99999.0::DOUBLE) AS Dst_nT,
                  "Time" - INTERVAL 30 MINUTES AS PlotTime FROM raw),
decoded AS (SELECT *, CASE WHEN CAST(Kp_code AS BIGINT) % 10 = 0 THEN CAST(Kp_code AS BIGINT) // 10
                           WHEN CAST(Kp_code AS BIGINT) % 10 = 3 THEN CAST(Kp_code AS BIGINT) // 10 + 1.0::DOUBLE / 3.0::DOUBLE
                           WHEN CAST(Kp_code AS BIGINT) % 10 = 7 THEN CAST(Kp_code AS BIGINT) // 10 + 2.0::DOUBLE / 3.0::DOUBLE
                           ELSE Kp_code / 10.0::DOUBLE END AS Kp FROM hourly),
kp AS (SELECT kind, time_bucket(INTERVAL 3 HOURS, PlotTime, TIMESTAMP '1970-01-01') AS time, arg_min(Kp, (PlotTime, Kp)) AS v
       FROM decoded WHERE Kp IS NOT NULL GROUP BY ALL)"""


@query("a03_kp_3hour", f"""
WITH {RAW_INDICES}
SELECT kind, time AS "KpStart", round(v, 6) + 0.0::DOUBLE AS "Kp", time + INTERVAL 3 HOURS AS "KpEnd" FROM kp
""")
def a03(t: Tables) -> DataFrame:
    return aggregates.kp_3hour(clean_hourly(raw_indices(t), keep=["kind"]), ["kind"]).withColumn("Kp", r6("Kp"))


@query("p08_omni_tables", f"""
WITH {RAW_INDICES},
bz AS (SELECT 'bz' AS series, event_type AS kind, ts AS time, nullif(CASE WHEN value < 5 THEN 9999.99 ELSE value - 50 END, 9999.99) AS v FROM events)
SELECT series, kind, time, round(v, 6) + 0.0::DOUBLE AS value, CAST(NULL AS VARCHAR) AS level FROM bz
UNION ALL SELECT 'hourly', kind, PlotTime, round(Kp, 6) + 0.0::DOUBLE, NULL FROM decoded
UNION ALL SELECT 'kp', kind, time, round(v, 6) + 0.0::DOUBLE, CASE WHEN v IS NULL THEN 'missing' WHEN v < 4 THEN 'quiet' WHEN v < 5 THEN 'active' ELSE 'storm' END FROM kp
""")
def p08(t: Tables) -> DataFrame:
    bz = t.events.select(
        F.col("event_type").alias("kind"), F.col("ts").alias("Time"),
        F.when(F.col("value") < 5, 9999.99).otherwise(F.col("value") - 50).alias("IMF_Bz_nT"),
    )
    out = build_omni(bz, raw_indices(t), by=["kind"])
    none = F.lit(None).cast("string").alias("level")
    return (
        out.bz.select(F.lit("bz").alias("series"), "kind", F.col("Time").alias("time"), r6("IMF_Bz_nT").alias("value"), none)
        .union(out.hourly.select(F.lit("hourly"), "kind", "PlotTime", r6("Kp"), none))
        .union(out.kp.select(F.lit("kp"), "kind", "KpStart", r6("Kp"), "level"))
    )


@query("m13_null_if_sentinel", """
SELECT event_id, nullif(CASE WHEN value < 5 THEN 9999.99 ELSE value END, 9999.99) AS "IMF_Bz_nT" FROM events
""")
def m13(t: Tables) -> DataFrame:
    raw = F.when(F.col("value") < 5, 9999.99).otherwise(F.col("value"))
    return t.events.select("event_id", null_if(raw, 9999.99).alias("IMF_Bz_nT"))


@query("m14_kp_level", """
SELECT event_id, CASE WHEN value < 2 THEN 'missing' WHEN value / 10 < 4 THEN 'quiet' WHEN value / 10 < 5 THEN 'active' ELSE 'storm' END AS level
FROM events
""")
def m14(t: Tables) -> DataFrame:
    kp = F.when(F.col("value") >= 2, F.col("value") / 10)
    return t.events.select("event_id", kp_level(kp).alias("level"))


@query("a04_mean_grid", """
SELECT CAST(floor((l_quantity - 5.0) / 2.5) AS BIGINT) AS ix, CAST(floor((l_discount * 100 - 0.0) / 2.5) AS BIGINT) AS iy,
       round(avg(l_extendedprice), 6) + 0.0::DOUBLE AS radiance, count(*) AS pixel_count
FROM lineitem WHERE l_quantity >= 5 AND l_quantity < 45 AND l_discount * 100 >= 0 AND l_discount * 100 < 10 GROUP BY ALL
""")
def a04(t: Tables) -> DataFrame:
    px = t.lineitem.select(
        F.col("l_quantity").alias("lon"), (F.col("l_discount") * 100).alias("lat"), F.col("l_extendedprice").alias("radiance")
    )
    return aggregates.mean_grid(px, (5.0, 45.0, 0.0, 10.0), 2.5).withColumn("radiance", r6("radiance"))


@query("a08_catalog", f"""
WITH {VALUE_LINKS}
SELECT event_id || '/' || CAST(CAST(floor(ipp_lat / 10) AS BIGINT) AS VARCHAR) AS path, min(time) AS time_start, max(time) AS time_end,
       concat_ws(',', CASE WHEN bool_or(vtec >= 50) THEN 'vtec' END, CASE WHEN bool_or(roti < 5) THEN 'roti' END) AS metrics
FROM vl GROUP BY 1
""")
def a08(t: Tables) -> DataFrame:
    rows = value_links(t).select(
        F.concat_ws("/", "event_id", F.floor(F.col("ipp_lat") / 10).cast("string")).alias("path"), "time",
        F.when(F.col("vtec") >= 50, F.col("vtec")).alias("vtec"), F.when(F.col("roti") < 5, F.col("roti")).alias("roti"),
    )
    return aggregates.catalog(rows).withColumn("metrics", F.array_join("metrics", ","))


@query("a09_coverage", f"""
WITH {RATES},
a AS (SELECT station_id, sv, arc_id, count(CASE WHEN stec >= 20 THEN stec END) AS v, count(roti) AS r, count(*) AS n FROM full_links GROUP BY ALL)
SELECT station_id, sv, CAST(sum(v) AS BIGINT) AS valid_vtec, CAST(sum(r) AS BIGINT) AS valid_roti, max(n) AS longest_arc,
       CAST(sum(v) + sum(r) AS BIGINT) AS score, sum(v) > 0 AND sum(r) > 0 AS qualified FROM a GROUP BY ALL
""")
def a09(t: Tables) -> DataFrame:
    return aggregates.coverage(series(t), ["station_id", "sv"])


def series(t: Tables) -> DataFrame:
    return full_links(t).withColumn("vtec", F.when(F.col("stec") >= 20, F.col("stec")))


COVER = RATES + """,
a AS (SELECT station_id, sv, arc_id, count(CASE WHEN stec >= 20 THEN stec END) AS v, count(roti) AS r, count(*) AS n FROM full_links GROUP BY ALL),
cov AS (SELECT station_id, sv, CAST(sum(v) AS BIGINT) AS valid_vtec, CAST(sum(r) AS BIGINT) AS valid_roti, max(n) AS longest_arc,
               CAST(sum(v) + sum(r) AS BIGINT) AS score, sum(v) > 0 AND sum(r) > 0 AS qualified FROM a GROUP BY ALL)"""


@query("w09_rank_satellites", f"""
WITH {COVER}
SELECT station_id, sv, score, longest_arc,
       CASE WHEN score > 0 THEN row_number() OVER (PARTITION BY station_id, score = 0 ORDER BY score DESC, longest_arc DESC, sv) END AS rank FROM cov
""", texts=("rank",))
def w09(t: Tables) -> DataFrame:
    cov = aggregates.coverage(series(t), ["station_id", "sv"])
    return sets.rank_satellites(cov, ["station_id"]).select("station_id", "sv", "score", "longest_arc", "rank")


@query("l02_top_satellites", f"""
WITH {COVER},
r AS (SELECT *, row_number() OVER (PARTITION BY station_id ORDER BY score DESC, longest_arc DESC, sv) AS rank FROM cov WHERE qualified)
SELECT station_id, sv, score, rank FROM r WHERE rank <= 2
""")
def l02(t: Tables) -> DataFrame:
    cov = aggregates.coverage(series(t), ["station_id", "sv"])
    return sets.top_satellites(cov, 2, ["station_id"]).select("station_id", "sv", "score", "rank")


@query("a10_failure_summary", """
WITH c AS (SELECT o_custkey, o_orderpriority AS reason, count(*) AS n FROM orders GROUP BY ALL)
SELECT o_custkey, first(reason ORDER BY n DESC, list_position(['2-HIGH', '1-URGENT'], reason) IS NULL, list_position(['2-HIGH', '1-URGENT'], reason), reason) AS reason,
       string_agg(reason || '=' || CAST(n AS VARCHAR), ', ' ORDER BY reason) AS detail, CAST(sum(n) AS BIGINT) AS failures
FROM c GROUP BY o_custkey
""")
def a10(t: Tables) -> DataFrame:
    rows = t.orders.select("o_custkey", F.col("o_orderpriority").alias("reason"))
    return aggregates.summarise_failures(rows, ["o_custkey"], order=("2-HIGH", "1-URGENT")).drop("succeeded")


@query("a12_percentile_offset", f"""
WITH {LINKS}
SELECT station_id, sv, time, round(stec - quantile_cont(stec, 0.05) OVER (PARTITION BY period, station_id, sv), 6) + 0.0::DOUBLE AS vtec_fallback FROM links
""")
def a12(t: Tables) -> DataFrame:
    return fallback_source(links(t), TRACK).select("station_id", "sv", "time", r6("vtec_fallback").alias("vtec_fallback"))


@query("a13_median_abs_deviation", """
WITH m AS (SELECT event_type, median(value) AS m FROM events GROUP BY 1)
SELECT event_type, round(median(abs(value - m)), 6) + 0.0::DOUBLE AS mad FROM events JOIN m USING (event_type) GROUP BY 1
""")
def a13(t: Tables) -> DataFrame:
    return aggregates.mad(t.events, "value", ["event_type"]).withColumn("mad", r6("mad"))


@query("a14_arc_baseline", f"""
WITH {ARCS}
SELECT station_id, sv, time, round(stec - first_value(stec) OVER (PARTITION BY period, station_id, sv, arc_id ORDER BY time), 6) + 0.0::DOUBLE AS stec FROM arcs
""")
def a14(t: Tables) -> DataFrame:
    return normalise_arc(arcs(t), TRACK).select("station_id", "sv", "time", r6("stec").alias("stec"))


@query("a15_first_dates", """
SELECT 'C' || CAST(o_custkey AS VARCHAR) AS station_code4, min(CAST(o_orderdate AS DATE)) AS first_date,
       arg_min(lpad(CAST(o_orderkey AS VARCHAR), 12, '0'), (CAST(o_orderdate AS DATE), o_orderkey)) AS station_id FROM orders GROUP BY 1
""", texts=("first_date",))
def a15(t: Tables) -> DataFrame:
    rec = t.orders.select(
        F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("station_code4"),
        F.to_date("o_orderdate").alias("observation_date"), F.lpad(F.col("o_orderkey").cast("string"), 12, "0").alias("station_id"),
    )
    return aggregates.first_dates(rec)


@query("a16_window_union", """
SELECT o_orderpriority AS preset, min(o_orderdate) AS start_utc, max(o_orderdate + INTERVAL 2 DAY) AS end_utc FROM orders GROUP BY 1
""")
def a16(t: Tables) -> DataFrame:
    presets = t.orders.select(
        F.col("o_orderpriority").alias("preset"), F.col("o_orderdate").alias("start_utc"),
        (F.col("o_orderdate") + F.expr("INTERVAL 2 DAY")).alias("end_utc"),
    )
    return aggregates.union_window(presets, ["preset"])


@query("a17_axis_bounds", """
WITH b AS (SELECT user_id, min(value) AS lo, max(value) AS hi FROM events GROUP BY 1),
k AS (SELECT user_id, CASE WHEN abs(lo - hi) <= 1e-8 + 1e-5 * abs(hi) THEN greatest(abs(hi) * 0.1, 1.0) ELSE (hi - lo) * 0.12 END AS pad, lo, hi FROM b)
SELECT user_id, round(lo - pad, 6) + 0.0::DOUBLE AS lower, round(hi + pad, 6) + 0.0::DOUBLE AS upper, round(CASE WHEN hi > 0 THEN hi * 1.08 ELSE 1.0 END, 6) + 0.0::DOUBLE AS roti_upper,
       round(greatest(9.2, hi / 10 + 0.5), 6) + 0.0::DOUBLE AS kp_top FROM k
""")
def a17(t: Tables) -> DataFrame:
    ev = t.events.withColumn("Kp", F.col("value") / 10)
    axes = {"": ("value", "padded"), "roti_": ("value", "from zero"), "kp_": ("Kp", "kp")}
    return aggregates.axis_table(ev, axes, ["user_id"]).select(
        "user_id", r6("lower").alias("lower"), r6("upper").alias("upper"), r6("roti_upper").alias("roti_upper"), r6("kp_upper").alias("kp_top")
    )


@query("a18_arc_and_cell_summary", f"""
WITH {ARCS}
SELECT 'arc' AS kind, station_id AS a, sv AS b, arc_id AS n, min(time) AS time_start, max(time) AS time_end, count(*) AS samples,
       round(avg(elev_deg), 6) + 0.0::DOUBLE AS mean, CAST(NULL AS DOUBLE) AS median, CAST(NULL AS DOUBLE) AS std FROM arcs GROUP BY period, station_id, sv, arc_id
UNION ALL
SELECT 'cell', event_type, CAST(CAST(floor(value / 10) AS BIGINT) AS VARCHAR), 0, NULL, NULL, count(value), round(avg(value), 6) + 0.0::DOUBLE, round(median(value), 6) + 0.0::DOUBLE, round(stddev_pop(value), 6) + 0.0::DOUBLE
FROM events GROUP BY 2, 3
""")
def a18(t: Tables) -> DataFrame:
    a = aggregates.arc_summary(arcs(t), TRACK)
    cells = t.events.select("event_type", F.floor(F.col("value") / 10).cast("string").alias("bin"), "value")
    c = aggregates.cell_stats(cells, ["event_type", "bin"], "value")
    nul = lambda ty: F.lit(None).cast(ty)
    return a.select(
        F.lit("arc").alias("kind"), F.col("station_id").alias("a"), F.col("sv").alias("b"), F.col("arc_id").alias("n"),
        "time_start", "time_end", F.col("epochs").alias("samples"), r6("mean_elev").alias("mean"),
        nul("double").alias("median"), nul("double").alias("std"),
    ).union(
        c.select(F.lit("cell"), "event_type", "bin", F.lit(0).cast("long"), nul("timestamp"), nul("timestamp"), "samples",
                 r6("mean"), r6("median"), r6("std"))
    )


DENSE_BOX = {"lat_min": 0.0, "lat_max": 100.0, "lon_min": 0.0, "lon_max": 100.0}


@query("a19_densify", f"""
WITH {VALUE_LINKS},
grid AS (SELECT event_id, date_trunc('day', time) AS time, round_even(ipp_lat / 10.0, 0) * 10.0 AS lat, round_even(ipp_lon / 20.0, 0) * 20.0 AS lon,
                median(vtec) AS vtec, median(roti) AS roti, count(sv) AS n FROM vl WHERE ipp_lat BETWEEN 0 AND 100 AND ipp_lon BETWEEN 0 AND 100 GROUP BY ALL),
b AS (SELECT event_id, date_trunc('day', min(time)) AS a, date_trunc('day', max(time)) + INTERVAL 2 DAY AS z FROM vl GROUP BY 1),
frame AS (SELECT event_id, unnest(generate_series(a, z, INTERVAL 1 DAY)) AS time FROM b),
nodes AS (SELECT event_id, time, CAST(i * 10 AS DOUBLE) AS lat, CAST(j * 20 AS DOUBLE) AS lon FROM frame, range(0, 11) x(i), range(0, 6) y(j))
SELECT n.event_id, n.time, n.lat, n.lon, CAST(g.vtec AS FLOAT) AS vtec, CAST(g.roti AS FLOAT) AS roti, CAST(coalesce(g.n, 0) AS BIGINT) AS sample_count
FROM nodes n LEFT JOIN grid g ON n.event_id = g.event_id AND n.time = g.time AND n.lat = g.lat AND n.lon = g.lon
""")
def a19(t: Tables) -> DataFrame:
    rows = value_links(t)
    grid = aggregates.grid_links(rows, bbox=DENSE_BOX, lat_step=10.0, lon_step=20.0, cadence_min=1440, by=["event_id"])
    return aggregates.densify(
        grid, event_bounds(rows), bbox=DENSE_BOX, lat_step=10.0, lon_step=20.0, cadence_min=1440, by=["event_id"]
    )
