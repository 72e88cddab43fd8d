"""Filters, guards and choices over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tecframe import fixed
from tecframe.functions.arrays import pick_pair
from tecframe.operators import joins, predicates, sets
from tecframe.queries.base import LINKS, RATES, STATIONS, Tables, full_links, links, query, r6, stations


@query("f01_bounding_box", f"WITH {STATIONS} SELECT key, lat, lon FROM stations WHERE lat BETWEEN -80 AND 80 AND lon BETWEEN -150 AND 10")
def f01(t: Tables) -> DataFrame:
    return predicates.in_bbox(stations(t)).select("key", "lat", "lon")


@query("f02_time_window", "SELECT event_id, ts FROM events WHERE ts BETWEEN TIMESTAMP '2024-01-05 06:00:00' AND TIMESTAMP '2024-01-12 18:00:00'")
def f02(t: Tables) -> DataFrame:
    at = lambda s: F.lit(s).cast("timestamp")
    return predicates.in_window(t.events, at("2024-01-05 06:00:00"), at("2024-01-12 18:00:00"), time="ts").select("event_id", "ts")


REGION_EVENTS = """
ev AS (SELECT r_name AS event_id, TIMESTAMP '2024-01-01 06:00:00' + to_days(CAST(r_regionkey * 5 AS INTEGER)) AS start_utc,
              TIMESTAMP '2024-01-07 12:00:00' + to_days(CAST(r_regionkey * 5 AS INTEGER)) AS end_utc FROM region)"""


def region_events(t: Tables) -> DataFrame:
    shift = F.make_interval(days=F.col("r_regionkey") * 5)
    return t.region.select(
        F.col("r_name").alias("event_id"), (F.lit("2024-01-01 06:00:00").cast("timestamp") + shift).alias("start_utc"),
        (F.lit("2024-01-07 12:00:00").cast("timestamp") + shift).alias("end_utc"),
    )


@query("f03_clip_to_day", f"""
WITH {REGION_EVENTS},
d AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS observation_date FROM events),
j AS (SELECT d.*, event_id, greatest(start_utc, CAST(observation_date AS TIMESTAMP)) AS slice_start,
             least(end_utc, CAST(observation_date AS TIMESTAMP) + INTERVAL 1 DAY) AS slice_end
      FROM d JOIN region ON r_regionkey = user_id % 5 JOIN ev ON event_id = r_name)
SELECT user_id, observation_date, event_id, slice_start, slice_end FROM j WHERE slice_start < slice_end
""", texts=("observation_date",))
def f03(t: Tables) -> DataFrame:
    ev = region_events(t)
    days = t.events.select("user_id", F.to_date("ts").alias("observation_date")).distinct()
    days = days.join(t.region, F.col("user_id") % 5 == F.col("r_regionkey")).withColumnRenamed("r_name", "event_id")
    return predicates.clip_to_day(days, ev).select("user_id", "observation_date", "event_id", "slice_start", "slice_end")


@query("f04_one_system", "SELECT event_id, event_type AS sv FROM events WHERE upper(event_type) LIKE 'P%'")
def f04(t: Tables) -> DataFrame:
    return predicates.only_system(t.events.select("event_id", F.col("event_type").alias("sv")), "p")


@query("f05_status_split", """
SELECT o_orderkey, coalesce(o_orderstatus = 'F' AND o_orderpriority <> '5-LOW', false) AS ok FROM orders
""")
def f05(t: Tables) -> DataFrame:
    man = t.orders.select(
        "o_orderkey", F.when(F.col("o_orderstatus") == "F", "ok").otherwise(F.col("o_orderstatus")).alias("obs_status"),
        F.when(F.col("o_orderpriority") != "5-LOW", "ok").alias("nav_status"),
    )
    good, bad = predicates.split_ok(man)
    return good.select("o_orderkey", F.lit(True).alias("ok")).union(bad.select("o_orderkey", F.lit(False)))


@query("f06_required_fields", "SELECT event_id, CASE WHEN value >= 10 THEN value END AS l1 FROM events WHERE value >= 10 AND event_type <> 'error'")
def f06(t: Tables) -> DataFrame:
    rows = t.events.select(
        "event_id", F.when(F.col("value") >= 10, F.col("value")).otherwise(F.lit(float("nan"))).alias("l1"),
        F.when(F.col("event_type") != "error", F.col("value")).alias("l2"),
    )
    return predicates.require(rows, ["l1", "l2"]).drop("l2")


@query("f07_elevation_mask", f"WITH {LINKS} SELECT station_id, sv, time, elev_deg FROM links WHERE elev_deg >= 15")
def f07(t: Tables) -> DataFrame:
    return predicates.mask_elevation(links(t)).select("station_id", "sv", "time", "elev_deg")


@query("f08_any_metric", f"""
WITH {RATES}, m AS (SELECT *, CASE WHEN stec >= 60 THEN stec END AS vtec FROM full_links)
SELECT station_id, sv, time, vtec, round(roti, 6) + 0.0::DOUBLE AS roti FROM m WHERE vtec IS NOT NULL OR roti IS NOT NULL
""")
def f08(t: Tables) -> DataFrame:
    rows = full_links(t).withColumn("vtec", F.when(F.col("stec") >= 60, F.col("stec")))
    return predicates.any_metric(rows).select("station_id", "sv", "time", "vtec", r6("roti").alias("roti"))


@query("f08_station_series", f"""
WITH {RATES}
SELECT 'vtec' AS metric, station_id, sv, time, stec AS value FROM full_links WHERE stec >= 60
UNION ALL SELECT 'roti', station_id, sv, time, round(roti, 6) + 0.0::DOUBLE FROM full_links WHERE roti IS NOT NULL
""")
def f08_series(t: Tables) -> DataFrame:
    rows = full_links(t).withColumns(
        {"vtec": F.when(F.col("stec") >= 60, F.col("stec")), "station_code4": F.substring("station_id", 1, 4)}
    )
    series = predicates.station_metrics(rows, ["vtec", "roti"])
    value = F.when(F.col("metric") == "roti", r6("value")).otherwise(F.col("value"))
    return series.select("metric", "station_id", "sv", "time", value.alias("value"))


@query("f09_strict_threshold", "SELECT event_id, value FROM events WHERE value > 50.0")
def f09(t: Tables) -> DataFrame:
    return predicates.above(t.events.select("event_id", "value"), "value", 50.0)


@query("f11_event_days", f"""
WITH {REGION_EVENTS}
SELECT event_id, ts FROM events e WHERE EXISTS (
  SELECT 1 FROM ev WHERE ev.event_id IN ('AFRICA', 'ASIA') AND CAST(e.ts AS DATE) BETWEEN CAST(start_utc AS DATE) AND CAST(end_utc AS DATE))
""")
def f11(t: Tables) -> DataFrame:
    ev = region_events(t).filter(F.col("event_id").isin("AFRICA", "ASIA"))
    return predicates.on_event_days(t.events.select("event_id", "ts"), ev, time="ts")


@query("f12_wrap_longitudes", """
WITH s AS (SELECT c_custkey AS key, c_nationkey AS slice, CAST(c_custkey * 7 % CASE WHEN c_nationkey % 2 = 0 THEN 360 ELSE 181 END AS DOUBLE) AS lon FROM customer)
SELECT key, slice, CASE WHEN max(lon) OVER (PARTITION BY slice) > 180 THEN (lon + 180) % 360 - 180 ELSE lon END AS lon FROM s
""")
def f12(t: Tables) -> DataFrame:
    k = F.col("c_custkey") * 7
    rows = t.customer.select(
        F.col("c_custkey").alias("key"), F.col("c_nationkey").alias("slice"),
        F.when(F.col("c_nationkey") % 2 == 0, k % 360).otherwise(k % 181).cast("double").alias("lon"),
    )
    return predicates.wrap_slices(rows, ["slice"]).select("key", "slice", "lon")


@query("f13_metric_aliases", """
SELECT event_id, value AS vtec, value / 10 AS roti, value - 50 AS lat, value * 2 AS lon,
       CASE WHEN lower(event_type) LIKE '%click%' THEN 'roti' ELSE 'vtec' END AS named FROM events
""")
def f13(t: Tables) -> DataFrame:
    v = F.col("value")
    rows = t.events.select(
        "event_id", v.alias("ATEC"), (v + 1).alias("tec"), (v / 10).alias("ROTI"), (v - 50).alias("Latitude"), (v * 2).alias("LON"),
        predicates.metric_of_name(F.concat(F.lit("/a/b/"), F.replace(F.col("event_type"), F.lit("click"), F.lit("x_ROTI")), F.lit(".nc"))).alias("named"),
    )
    return predicates.canonical_metric(rows)


@query("f14_observable_pair", """
WITH c AS (SELECT user_id, list_distinct(list(['L1C','L1W','L2W','L2C','L2X','C1C','P2'][CAST((user_id + event_id % 3) % 7 + 1 AS INTEGER)])) AS codes FROM events GROUP BY 1),
f AS (SELECT user_id, list_filter(['L1C','L1W','L1P','L1X','L1S','L1L','L1M','L1','L1N'], lambda x: list_contains(codes, x))[1] AS a,
             list_filter(['L2W','L2P','L2C','L2X','L2S','L2L','L2M','L2','L2N'], lambda x: list_contains(codes, x))[1] AS b FROM c)
SELECT user_id, CASE WHEN a IS NOT NULL AND b IS NOT NULL THEN a || '/' || b END AS phase_pair FROM f
""")
def f14(t: Tables) -> DataFrame:
    names = F.array(*[F.lit(x) for x in ("L1C", "L1W", "L2W", "L2C", "L2X", "C1C", "P2")])
    code = F.get(names, ((F.col("user_id") + F.col("event_id") % 3) % 7).cast("int"))
    # a handful of codes per station, distinct before they are gathered
    have = t.events.select("user_id", code.alias("code")).distinct()
    sets_ = have.groupBy("user_id").agg(F.collect_list("code").alias("codes"))
    pair = pick_pair("codes", fixed.PHASE_FIRST, fixed.PHASE_SECOND)
    return sets_.select("user_id", F.when(pair.isNotNull(), F.concat_ws("/", pair["first"], pair["second"])).alias("phase_pair"))


STATION_NAMES = """
sn AS (SELECT c_custkey AS key, upper('ST' || CAST(c_custkey % 97 AS VARCHAR) || c_mktsegment) AS station_id,
              substr(upper('ST' || CAST(c_custkey % 97 AS VARCHAR) || c_mktsegment), 1, 4) AS station_code4 FROM customer)"""


def station_names(t: Tables) -> DataFrame:
    ident = F.upper(F.concat(F.lit("ST"), (F.col("c_custkey") % 97).cast("string"), F.col("c_mktsegment")))
    return t.customer.select(F.col("c_custkey").alias("key"), ident.alias("station_id"), F.substring(ident, 1, 4).alias("station_code4"))


@query("f16_match_station", f"""
WITH {STATION_NAMES}
SELECT DISTINCT station_id, station_code4 FROM (
  SELECT *, row_number() OVER (ORDER BY station_code4, station_id) AS rn FROM sn WHERE station_id IN ('ST12BUILDING', 'ST12') OR station_code4 IN ('ST12BUILDING', 'ST12')) WHERE rn = 1
""")
def f16(t: Tables) -> DataFrame:
    return predicates.match_station(station_names(t), "st12building").select("station_id", "station_code4")


@query("f17_id_else_code", f"""
WITH {STATION_NAMES},
q AS (SELECT 1 AS ask, 'ST12BUILDING' AS id, 'ST33' AS code UNION ALL SELECT 2, 'NOSUCHSTATION', 'ST33')
SELECT CAST(ask AS BIGINT) AS ask, key, station_id FROM q, sn
WHERE CASE WHEN EXISTS (SELECT 1 FROM sn s2 WHERE s2.station_id = q.id) THEN station_id = id ELSE station_code4 = code END
""")
def f17(t: Tables) -> DataFrame:
    rows = station_names(t)
    one = predicates.station_rows(rows, "ST12BUILDING", "ST33").select(F.lit(1).cast("long").alias("ask"), "key", "station_id")
    two = predicates.station_rows(rows, "nosuchstation", "st33").select(F.lit(2).cast("long").alias("ask"), "key", "station_id")
    return one.union(two)


@query("f18_sampling_filter", "SELECT p_partkey, p_size AS sampling_sec FROM part WHERE p_size <= 15")
def f18(t: Tables) -> DataFrame:
    return predicates.max_interval(t.part.select("p_partkey", F.col("p_size").alias("sampling_sec")), 15)


@query("f19_position_fallback", """
WITH s AS (SELECT s_suppkey AS key, s_suppkey % 4 = 0 AS zero, s_suppkey % 8 = 0 AS blank, CAST(s_suppkey % 160 - 80 AS DOUBLE) AS lat,
                  CAST(s_suppkey * 7 % 360 - 180 AS DOUBLE) AS lon, s_acctbal AS h, radians(s_suppkey % 80) AS phi FROM supplier),
g AS (SELECT *, 6378137.0::DOUBLE AS a, 1.0::DOUBLE / 298.257223563::DOUBLE AS f FROM s),
n AS (SELECT *, a / sqrt(1 - f * (2 - f) * sin(phi) * sin(phi)) AS nn FROM g)
SELECT key, CASE WHEN blank THEN NULL WHEN zero THEN round(degrees(phi), 6) + 0.0::DOUBLE ELSE lat END AS lat,
       CASE WHEN blank THEN NULL WHEN zero THEN 30.0::DOUBLE ELSE lon END AS lon,
       CASE WHEN blank THEN NULL WHEN zero THEN 120.0::DOUBLE ELSE h END AS height_m,
       CASE WHEN blank THEN 'missing_station_position' END AS position_reason FROM n
""")
def f19(t: Tables) -> DataFrame:
    from tecframe.functions.geodesy import to_ecef

    k = F.col("s_suppkey")
    zero, blank = k % 4 == 0, k % 8 == 0
    x, y, z = to_ecef(k % 80, F.lit(30.0), F.lit(120.0))
    rows = t.supplier.select(
        k.alias("key"), F.when(~zero, (k % 160 - 80).cast("double")).otherwise(0.0).alias("lat"),
        F.when(~zero, (k * 7 % 360 - 180).cast("double")).otherwise(0.0).alias("lon"),
        F.when(~zero, F.col("s_acctbal")).otherwise(0.0).alias("height_m"),
        F.when(~blank, x).alias("header_x"), F.when(~blank, y).alias("header_y"), F.when(~blank, z).alias("header_z"),
    )
    out = predicates.resolve_position(rows)
    return out.select("key", *[r6(c).alias(c) for c in ("lat", "lon", "height_m")], "position_reason")


@query("j13_chosen_satellites", f"""
WITH {LINKS} SELECT station_id, sv, time, stec FROM links
WHERE sv IN (SELECT 'G' || lpad(CAST(n_nationkey + 1 AS VARCHAR), 2, '0') FROM nation WHERE n_regionkey = 1)
""")
def j13(t: Tables) -> DataFrame:
    sats = t.nation.filter("n_regionkey = 1").select(
        F.concat(F.lit("G"), F.lpad((F.col("n_nationkey") + 1).cast("string"), 2, "0")).alias("sv")
    )
    return joins.only_satellites(links(t), sats).select("station_id", "sv", "time", "stec")


@query("u01_union", """
SELECT event_id, value, CAST(NULL AS VARCHAR) AS props FROM events WHERE event_type = 'click'
UNION ALL SELECT event_id, value, props FROM events WHERE event_type IN ('view', 'click')
""")
def u01(t: Tables) -> DataFrame:
    e = t.events
    return sets.union_all(
        e.filter("event_type = 'click'").select("event_id", "value"),
        e.filter("event_type in ('view', 'click')").select("event_id", "value", "props"),
    )


@query("u03_key_union", """
SELECT CAST(o_orderdate AS DATE) AS observation_date, upper(o_orderstatus) AS station_code4 FROM orders
UNION SELECT CAST(l_shipdate AS DATE), upper(l_linestatus) FROM lineitem
""", texts=("observation_date",))
def u03(t: Tables) -> DataFrame:
    a = t.orders.select(F.to_date("o_orderdate").alias("observation_date"), F.lower("o_orderstatus").alias("station_code4"))
    b = t.lineitem.select(F.to_date("l_shipdate").alias("observation_date"), F.col("l_linestatus").alias("station_code4"))
    return sets.all_keys(a, b)


@query("u04_ordered_distinct", """
SELECT user_id, event_type, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS rn FROM events) WHERE rn = 1
""")
def u04(t: Tables) -> DataFrame:
    rows = t.events.select("user_id", "event_type", "event_id", "value")
    return sets.distinct_first(rows, ["user_id", "event_type"], position="event_id")


@query("l01_canonical_order", f"WITH {LINKS} SELECT time, station_id, sv, stec FROM links ORDER BY time, station_id, sv")
def l01(t: Tables) -> DataFrame:
    return sets.canonical(links(t).select("time", "station_id", "sv", "stec"), "links")


@query("l03_head", "SELECT event_id, ts, value FROM events ORDER BY value DESC, event_id LIMIT 50")
def l03(t: Tables) -> DataFrame:
    rows = t.events.select("event_id", "ts", "value")
    return sets.first_n(rows, 50, [F.desc("value"), F.asc("event_id")])
