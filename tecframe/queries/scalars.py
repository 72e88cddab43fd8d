"""Scalar functions over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tecframe import fixed
from tecframe.functions import signal, text as names, timefn
from tecframe.functions.arrays import axis
from tecframe.functions.geodesy import snap, wrap180
from tecframe.functions.indices import kp_decimal
from tecframe.queries.base import Tables, long, query, r6, text

OBS = """
obs AS (SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice AS l1, l_extendedprice * 0.78 + l_quantity AS l2,
               l_extendedprice * 0.19 + l_discount AS c1, l_extendedprice * 0.19 + l_tax * 100 AS c2 FROM lineitem)"""
ID = ["l_orderkey", "l_linenumber", "l_partkey"]


def obs(t: Tables) -> DataFrame:
    p = F.col("l_extendedprice")
    return t.lineitem.select(
        *ID, p.alias("l1"), (p * 0.78 + F.col("l_quantity")).alias("l2"), (p * 0.19 + F.col("l_discount")).alias("c1"),
        (p * 0.19 + F.col("l_tax") * 100).alias("c2"),
    )


F1, F2, C = "1575.42e6::DOUBLE", "1227.60e6::DOUBLE", "299792458.0::DOUBLE"
FACTOR = f"(({F1} * {F1} * {F2} * {F2}) / (40.3::DOUBLE * ({F1} * {F1} - {F2} * {F2})) / 1e16)"


@query("m01_phase_stec", f"WITH {OBS} SELECT l_orderkey, l_linenumber, l_partkey, round((l1 * ({C} / {F1}) - l2 * ({C} / {F2})) * {FACTOR}, 4) + 0.0::DOUBLE AS stec FROM obs")
def m01(t: Tables) -> DataFrame:
    return obs(t).select(*ID, r6(signal.phase_stec("l1", "l2"), 4).alias("stec"))


@query("m02_gf_phase", f"WITH {OBS} SELECT l_orderkey, l_linenumber, l_partkey, round(l1 * ({C} / {F1}) - l2 * ({C} / {F2}), 6) + 0.0::DOUBLE AS gf FROM obs")
def m02(t: Tables) -> DataFrame:
    return obs(t).select(*ID, r6(signal.gf_phase("l1", "l2")).alias("gf"))


@query("m03_melbourne_wubbena", f"""
WITH {OBS}
SELECT l_orderkey, l_linenumber, l_partkey,
       round((l1 - l2) - ({F1} * c1 + {F2} * c2) / ({F1} + {F2}) / ({C} / ({F1} - {F2})), 6) + 0.0::DOUBLE AS mw FROM obs
""")
def m03(t: Tables) -> DataFrame:
    return obs(t).select(*ID, r6(signal.melbourne_wubbena("l1", "l2", "c1", "c2")).alias("mw"))


@query("m04_code_stec", f"WITH {OBS} SELECT l_orderkey, l_linenumber, l_partkey, round((c2 - c1) * {FACTOR}, 4) + 0.0::DOUBLE AS stec FROM obs")
def m04(t: Tables) -> DataFrame:
    return obs(t).select(*ID, r6(signal.code_stec("c1", "c2"), 4).alias("stec"))


@query("m11_gps_week", """
SELECT o_orderkey, (CAST(o_orderdate AS DATE) - DATE '1980-01-06') // 7 AS week, (CAST(o_orderdate AS DATE) - DATE '1980-01-06') % 7 AS dow,
       CAST((CAST(o_orderdate AS DATE) - DATE '1980-01-06') % 7 * 86400 AS DOUBLE) AS sow FROM orders
""")
def m11(t: Tables) -> DataFrame:
    d = F.col("o_orderdate")
    return t.orders.select(
        "o_orderkey", timefn.gps_week(d).alias("week"), timefn.gps_day_of_week(d).alias("dow"), timefn.gps_seconds_of_week(d).alias("sow")
    )


@query("m12_kp_decode", """
SELECT event_id, round(CASE CAST(floor(value) AS BIGINT) % 10 WHEN 0 THEN CAST(floor(value) AS BIGINT) // 10 WHEN 3 THEN CAST(floor(value) AS BIGINT) // 10 + 1.0 / 3
       WHEN 7 THEN CAST(floor(value) AS BIGINT) // 10 + 2.0 / 3 ELSE floor(value) / 10 END, 6) + 0.0::DOUBLE AS kp FROM events
""")
def m12(t: Tables) -> DataFrame:
    return t.events.select("event_id", r6(kp_decimal(F.floor("value"))).alias("kp"))


@query("m15_wrap_longitude", "SELECT c_custkey, ((CAST(c_custkey * 37 % 1080 - 540 AS DOUBLE) + 180) % 360 + 360) % 360 - 180 AS lon FROM customer")
def m15(t: Tables) -> DataFrame:
    return t.customer.select("c_custkey", wrap180((F.col("c_custkey") * 37 % 1080 - 540).cast("double")).alias("lon"))


@query("m16_grid_snap", """
SELECT l_orderkey, l_linenumber, l_partkey, round_even(-80.0::DOUBLE + round_even((l_quantity / 2.0 - -80.0::DOUBLE) / 1.0, 0) * 1.0, 6) AS node,
       floor(l_discount * 100 / 2.5) * 2.5::DOUBLE AS floor_node FROM lineitem
""")
def m16(t: Tables) -> DataFrame:
    from tecframe.functions.geodesy import floor_bin

    return t.lineitem.select(
        *ID, snap(F.col("l_quantity") / 2.0, -80.0, 1.0).alias("node"), floor_bin(F.col("l_discount") * 100, 2.5).alias("floor_node")
    )


@query("m17_utc_hour", """
SELECT event_id, round((epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01')) / 3.6e9, 6) + 0.0::DOUBLE AS utc_hour,
       lpad(CAST(CAST(floor(epoch_us(ts) / 3.6e9) AS BIGINT) % 24 AS VARCHAR), 2, '0') AS label FROM events
""")
def m17(t: Tables) -> DataFrame:
    h = timefn.utc_hour("ts", F.lit("2024-01-01 07:30:00").cast("timestamp"))
    return t.events.select("event_id", r6(h).alias("utc_hour"), timefn.hour_label(h).alias("label"))


@query("m18_carrier_lookup", """
SELECT p_partkey, CASE system || '/' || band WHEN 'G/L2' THEN 1227.60e6 WHEN 'G/L5' THEN 1176.45e6 WHEN 'E/E5A' THEN 1176.45e6 WHEN 'E/L5' THEN 1176.45e6
       WHEN 'E/E6' THEN 1278.75e6 WHEN 'C/B1' THEN 1561.098e6 WHEN 'C/B2' THEN 1207.14e6 WHEN 'C/B3' THEN 1268.52e6 ELSE 1575.42e6 END::DOUBLE AS hz
FROM (SELECT p_partkey, ['G','E','C','R'][CAST(p_partkey % 4 + 1 AS INTEGER)] AS system, ['L1','L2','L5','E1','E5A','E6','B1','B2','B3'][CAST(p_partkey % 9 + 1 AS INTEGER)] AS band FROM part)
""")
def m18(t: Tables) -> DataFrame:
    pick = lambda items, n: F.get(F.array(*[F.lit(i) for i in items]), (F.col("p_partkey") % n).cast("int"))
    return t.part.select(
        "p_partkey", signal.carrier(pick("GECR", 4), pick(("l1", "L2", "L5", "E1", "E5a", "E6", "B1", "B2", "b3"), 9)).alias("hz")
    )


@query("m19_other_conversions", f"""
SELECT l_orderkey, l_linenumber, l_partkey, round((l_tax - l_discount) * 100 / 40.308e16 * ({F1} * {F1} * {F2} * {F2} / ({F1} * {F1} - {F2} * {F2})), 6) + 0.0::DOUBLE AS stec,
       round(l_quantity * 1e-9 * {C}, 6) + 0.0::DOUBLE AS bias_m, round(l_quantity * 1e-9 * {C} * {FACTOR}, 6) + 0.0::DOUBLE AS bias_tecu FROM lineitem
""")
def m19(t: Tables) -> DataFrame:
    f1, f2 = F.lit(fixed.GPS_L1_HZ), F.lit(fixed.GPS_L2_HZ)
    return t.lineitem.select(
        *ID, r6(signal.stec_gf(F.col("l_discount") * 100, F.col("l_tax") * 100, f1, f2)).alias("stec"),
        r6(signal.dcb_m("l_quantity")).alias("bias_m"), r6(signal.dcb_tecu("l_quantity")).alias("bias_tecu"),
    )


@query("m20_midpoint", """
SELECT o_orderkey, make_timestamp(epoch_us(o_orderdate) + (o_custkey * 61000000) // 2) AS mid, CAST(o_custkey * 61 AS DOUBLE) AS delta_sec,
       round(o_custkey * 61 / 60.0::DOUBLE, 6) + 0.0::DOUBLE AS delta_min FROM orders
""")
def m20(t: Tables) -> DataFrame:
    b = F.timestamp_micros(F.unix_micros("o_orderdate") + F.col("o_custkey") * 61_000_000)
    return t.orders.withColumn("b", b).select(
        "o_orderkey", timefn.midpoint("o_orderdate", "b").alias("mid"), timefn.delta_seconds("o_orderdate", "b").alias("delta_sec"),
        r6(timefn.delta_minutes("o_orderdate", "b")).alias("delta_min"),
    )


@query("m21_vtec_source", "SELECT event_id, CASE WHEN value >= 50 THEN value ELSE value - 10 END AS source FROM events")
def m21(t: Tables) -> DataFrame:
    code = F.when(F.col("value") >= 50, F.col("value")).otherwise(F.when(F.col("event_id") % 2 == 0, F.lit(float("nan"))))
    return t.events.select("event_id", signal.vtec_source(code, F.col("value") - 10).alias("source"))


@query("y03_axis", """
SELECT p_partkey, len(a) AS n, round(a[1], 6) + 0.0::DOUBLE AS first, round(a[len(a)], 6) + 0.0::DOUBLE AS last, round(list_sum(a), 6) + 0.0::DOUBLE AS total
FROM (SELECT p_partkey, list_transform(range(0, 161), lambda i: -80.0::DOUBLE + i * 0.1::DOUBLE + p_size) AS a FROM part)
""")
def y03(t: Tables) -> DataFrame:
    a = F.transform(axis(-80.0, -64.0, 0.1), lambda v: v + F.col("p_size"))
    return t.part.withColumn("a", a).select(
        "p_partkey", long(F.size("a")).alias("n"), r6(F.get("a", F.lit(0))).alias("first"),
        r6(F.get("a", F.size("a") - 1)).alias("last"), r6(F.aggregate("a", F.lit(0.0), lambda s, v: s + v)).alias("total"),
    )


@query("d01_parse_utc", """
SELECT event_id, CASE event_id % 4 WHEN 3 THEN NULL ELSE date_trunc('second', ts) END AS time FROM events
""")
def d01(t: Tables) -> DataFrame:
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    ahead = F.date_format(F.timestamp_micros(F.unix_micros("ts") + 28_800_000_000), "yyyy-MM-dd'T'HH:mm:ss")
    kind = F.col("event_id") % 4
    written = F.when(kind == 0, F.concat(iso, F.lit("Z"))).when(kind == 1, F.concat(ahead, F.lit("+08:00"))).when(
        kind == 2, F.concat(F.lit(" "), iso)).otherwise(F.lit("no time"))
    return t.events.select("event_id", timefn.parse_utc(written).alias("time"))


@query("d02_day_sequence", """
SELECT o_orderkey, CAST(unnest(generate_series(o_orderdate, o_orderdate + to_days(CAST(o_custkey % 4 AS INTEGER)), INTERVAL 1 DAY)) AS DATE) AS day FROM orders
""", texts=("day",))
def d02(t: Tables) -> DataFrame:
    end = F.date_add(F.to_date("o_orderdate"), (F.col("o_custkey") % 4).cast("int"))
    return t.orders.select("o_orderkey", F.explode(timefn.day_sequence("o_orderdate", end)).alias("day"))


@query("d03_time_index", """
WITH w AS (SELECT user_id, min(ts) AS a, max(ts) AS b FROM events GROUP BY 1)
SELECT user_id, unnest(generate_series(time_bucket(INTERVAL 12 HOURS, a, TIMESTAMP '1970-01-01'), time_bucket(INTERVAL 12 HOURS, b, TIMESTAMP '1970-01-01'), INTERVAL 12 HOURS)) AS time FROM w
""")
def d03(t: Tables) -> DataFrame:
    w = t.events.groupBy("user_id").agg(F.min("ts").alias("a"), F.max("ts").alias("b"))
    return w.select("user_id", F.explode(timefn.time_index("a", "b", 720)).alias("time"))


@query("d04_floor_time", "SELECT event_id, time_bucket(INTERVAL 15 MINUTES, ts, TIMESTAMP '1970-01-01') AS time FROM events")
def d04(t: Tables) -> DataFrame:
    return t.events.select("event_id", timefn.floor_time("ts", 15).alias("time"))


@query("d05_day_of_year", "SELECT o_orderkey, lpad(CAST(dayofyear(o_orderdate) AS VARCHAR), 3, '0') AS ddd, strftime(o_orderdate, '%y') AS yy FROM orders")
def d05(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", timefn.day_of_year("o_orderdate").alias("ddd"), timefn.year2("o_orderdate").alias("yy"))


@query("d06_plot_time", "SELECT event_id, ts - INTERVAL 30 MINUTES AS plot_time FROM events")
def d06(t: Tables) -> DataFrame:
    return t.events.select("event_id", timefn.plot_time("ts").alias("plot_time"))


def file_names(t: Tables) -> DataFrame:
    """Names of every kind, built from the order columns."""
    k, d = F.col("o_orderkey"), F.col("o_orderdate")
    ddd, yy, yyyy = timefn.day_of_year(d), timefn.year2(d), F.date_format(d, "yyyy")
    code = F.concat(F.lit("s"), F.lpad((F.col("o_custkey") % 1000).cast("string"), 3, "0"))
    kind = k % 4
    name = (
        F.when(kind == 0, F.concat(F.lit("/c/obs/"), code, F.lit("00bra_R_"), yyyy, ddd, F.lit("0000_01D_15S_MO.crx.gz")))
        .when(kind == 1, F.concat(F.lit("/c/obs/"), code, ddd, F.lit("0."), yy, F.lit("d.Z")))
        .when(kind == 2, F.concat(F.lit("x/GOLD_L1C_CH"), F.when(k % 8 == 2, "A").otherwise("B"), F.lit("_NI1_"), yyyy, F.lit("_"), ddd, F.lit("_13_05_v04_r01.nc")))
        .otherwise(F.concat(F.lit("omni_bz_1min_"), F.date_format(d, "yyyyMMdd"), F.lit("_"), F.date_format(F.date_add(F.to_date(d), 2), "yyyyMMdd"), F.lit(".csv")))
    )
    return t.orders.select("o_orderkey", "o_custkey", "o_orderdate", name.alias("path"))


@query("t01_file_name_fields", """
WITH c AS (SELECT *, 'S' || lpad(CAST(o_custkey % 1000 AS VARCHAR), 3, '0') AS code FROM orders)
SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN CASE WHEN code = 'S007' THEN 'OVERRIDE7' ELSE code || '00BRA' END WHEN 1 THEN CASE WHEN code = 'S007' THEN 'OVERRIDE7' ELSE code END END AS station_id,
       CASE WHEN o_orderkey % 4 < 2 THEN code END AS station_code4, CASE o_orderkey % 4 WHEN 0 THEN 15 WHEN 1 THEN 30 END AS sampling_sec,
       CASE o_orderkey % 8 WHEN 2 THEN 'CHA' WHEN 6 THEN 'CHB' END AS hemisphere,
       CASE WHEN o_orderkey % 4 = 2 THEN o_orderdate + INTERVAL 13 HOURS + INTERVAL 5 MINUTES END AS obs_time,
       CASE WHEN o_orderkey % 4 = 3 THEN 'bz' END AS kind, CASE WHEN o_orderkey % 4 = 3 THEN o_orderdate + INTERVAL 3 DAY - INTERVAL 1 SECOND END AS cover_end FROM c
""", texts=("sampling_sec",))
def t01(t: Tables) -> DataFrame:
    obs_f = names.parse_observation_name("path", default_sampling=30, overrides={"S007": "OVERRIDE7"})
    rows = file_names(t).withColumns({"o": obs_f, "s": names.parse_swath_name("path"), "m": names.parse_omni_name("path")})
    return rows.select(
        "o_orderkey", "o.station_id", "o.station_code4", "o.sampling_sec", "s.hemisphere", "s.obs_time",
        F.col("m.kind").alias("kind"), F.col("m.end").alias("cover_end"),
    )


@query("t02_path_template", """
SELECT o_orderkey, 'data/' || strftime(o_orderdate, '%Y') || '/' || strftime(o_orderdate, '%j') || '/' || lower(o_orderpriority) || strftime(o_orderdate, '%j') || '0.' || strftime(o_orderdate, '%y') || 'd.gz' AS obs,
       'sp3/' || CAST((CAST(o_orderdate AS DATE) - DATE '1980-01-06') // 7 AS VARCHAR) || '/igs' || CAST((CAST(o_orderdate AS DATE) - DATE '1980-01-06') % 7 AS VARCHAR) || '.sp3' AS orbit FROM orders
""")
def t02(t: Tables) -> DataFrame:
    fill = lambda tpl: names.fill_template(F.lit(tpl), day="o_orderdate", station="o_orderpriority")
    return t.orders.select(
        "o_orderkey", fill("data/{year}/{doy}/{station}{doy}0.{yy}d.gz").alias("obs"), fill("sp3/{gps_week}/igs{dow}.sp3").alias("orbit")
    )


@query("t03_asset_id", r"""
SELECT page_id, regexp_replace(regexp_extract(url, '([^/]*)$', 1), '^(.+)\.[^.]*$', '\1') || '-' || substr(md5(url), 1, 12) AS asset_id FROM pages
""")
def t03(t: Tables) -> DataFrame:
    return t.pages.select("page_id", names.asset_id("url").alias("asset_id"))


@query("t04_labels", """
WITH p AS (SELECT o_orderkey, o_custkey, o_orderpriority, o_orderdate + INTERVAL 90 MINUTES AS a, o_orderdate + INTERVAL 90 MINUTES + to_minutes(CAST(o_custkey % 3 * 2 AS INTEGER)) AS b FROM orders),
m AS (SELECT *, make_timestamp((epoch_us(a) + epoch_us(b)) // 2) AS mid FROM p)
SELECT o_orderkey, strftime(mid, '%Y-%m-%d %H:%MUT') || CASE WHEN a = b THEN '' ELSE '  |  CHA ' || strftime(a, '%H:%M') || ' + CHB ' || strftime(b, '%H:%M') END AS title,
       strftime(mid, '%Y%m%dT%H%MZ') || '_CHA-' || strftime(a, '%H%M') || '_CHB-' || strftime(b, '%H%M') || '_135p6nm.png' AS file,
       '(' || chr(CAST(97 + o_custkey % 4 AS INTEGER)) || ') ' || o_orderpriority || ' G' || CAST(o_custkey % 32 AS VARCHAR) || ' VTEC' AS panel,
       'ROTI > 1.0 10^16 el/m^2/min (n=' || CAST(o_custkey AS VARCHAR) || ')' AS legend,
       strftime(a, '%Y%m%dT%H%M%S') || '_' || strftime(b, '%Y%m%dT%H%M%S') || '_' || upper(o_orderpriority) || '_g05_g12_timeseries' AS series_file FROM m
""")
def t04(t: Tables) -> DataFrame:
    a = F.timestamp_micros(F.unix_micros("o_orderdate") + 5_400_000_000)
    rows = t.orders.withColumn("a", a).withColumn("b", F.timestamp_micros(F.unix_micros("a") + F.col("o_custkey") % 3 * 120_000_000))
    rows = rows.withColumn("mid", timefn.midpoint("a", "b"))
    sats = F.array(F.lit("G05"), F.lit("G12"))
    return rows.select(
        "o_orderkey", names.pair_title("a", "b", "mid").alias("title"), names.pair_file_name("a", "b", "mid", 135.6).alias("file"),
        names.panel_label(F.col("o_custkey") % 4, "o_orderpriority", F.concat(F.lit("G"), text(F.col("o_custkey") % 32)), "VTEC").alias("panel"),
        names.threshold_label("roti", 1.0, "o_custkey").alias("legend"),
        names.series_file_name("a", "b", "o_orderpriority", sats).alias("series_file"),
    )


@query("t05_sanitise_paths", """
SELECT page_id, CASE WHEN page_id % 3 = 0 THEN '' WHEN page_id % 3 = 1 THEN '' ELSE 'cache' || substr(url, 8) END AS obs_path, url FROM pages
""")
def t05(t: Tables) -> DataFrame:
    from tecframe.sources.catalogs import sanitise_paths

    tail = F.expr("substring(url, 8)")
    path = F.when(F.col("page_id") % 3 == 0, F.concat(F.lit("/"), tail)).when(F.col("page_id") % 3 == 2, F.concat(F.lit("cache"), tail))
    return sanitise_paths(t.pages.select("page_id", path.alias("obs_path"), "url"))


@query("t06_code_normalisation", "SELECT c_custkey, upper(substr(c_mktsegment, 1, 4)) AS code4, lower(c_mktsegment) AS low FROM customer")
def t06(t: Tables) -> DataFrame:
    return t.customer.select("c_custkey", names.code4(F.concat(F.lit(" "), F.lower("c_mktsegment"))).alias("code4"), F.lower("c_mktsegment").alias("low"))


@query("t07_status_text", """
SELECT o_orderkey, 'obs_status=' || o_orderstatus || '; nav_status=' || CASE WHEN o_custkey % 2 = 0 THEN 'ok' ELSE '' END AS error FROM orders
""")
def t07(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", names.status_error("o_orderstatus", F.when(F.col("o_custkey") % 2 == 0, "ok")).alias("error"))


@query("t08_retryable_errors", """
SELECT doc_id, doc_id % 3 = 0 OR contains(text, 'empty compressed payload') OR contains(text, 'Downloaded file is empty') AS retryable FROM documents
""")
def t08(t: Tables) -> DataFrame:
    err = F.when(F.col("doc_id") % 3 == 0, F.concat(F.col("text"), F.lit(" Downloaded file is empty"))).otherwise(F.col("text"))
    return t.documents.select("doc_id", names.is_retryable(err).alias("retryable"))
