"""Joins, pairings and manifests over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tecframe.operators import joins
from tecframe.operators.pairing import pair_nearest, unmatched
from tecframe.plans.omni import highlight
from tecframe.plans.overlay import OverlaySpec, build_overlay, build_panel
from tecframe.plans.scenes import build_scenes
from tecframe.plans.stations import build_station_days, normalise
from tecframe.queries.base import EVENT_TIME, Tables, event_time, long, query, r6
from tecframe.queries.filters import REGION_EVENTS, region_events
from tecframe.queries.scalars import file_names
from tecframe.sources.archives import swath_entries

HOURS = 3600 * 1_000_000

TIMED_EVENTS = f"""
me AS (SELECT user_id, event_type, CAST(ts AS DATE) AS day, {EVENT_TIME} AS time, event_id AS id FROM events)"""


def timed_events(t: Tables) -> DataFrame:
    return t.events.select("user_id", "event_type", F.to_date("ts").alias("day"), event_time().alias("time"), F.col("event_id").alias("id"))


# greedy pairing as a walk over the ranked candidates of each user and day
def greedy_sql(name: str, left: str, right: str, by: str, tol_us: int) -> str:
    return f"""
{name}_cand AS MATERIALIZED (
  SELECT {', '.join('l.' + b for b in by.split(', '))}, l.id AS l, r.id AS r, l.time AS lt, r.time AS rt, abs(epoch_us(l.time) - epoch_us(r.time)) AS d,
         row_number() OVER (PARTITION BY {', '.join('l.' + b for b in by.split(', '))} ORDER BY abs(epoch_us(l.time) - epoch_us(r.time)), l.time, r.time, l.id, r.id) AS n
  FROM {left} l JOIN {right} r ON {' AND '.join(f'l.{b} = r.{b}' for b in by.split(', '))} AND abs(epoch_us(l.time) - epoch_us(r.time)) <= {tol_us}),
{name}_walk AS (
  SELECT {by}, l, r, lt, rt, d, n, true AS taken, [l] AS ul, [r] AS ur FROM {name}_cand WHERE n = 1
  UNION ALL
  SELECT {by}, l, r, lt, rt, d, n, ok, CASE WHEN ok THEN list_append(ul, l) ELSE ul END, CASE WHEN ok THEN list_append(ur, r) ELSE ur END
  FROM (SELECT {', '.join('c.' + b for b in by.split(', '))}, c.l, c.r, c.lt, c.rt, c.d, c.n, w.ul, w.ur, NOT list_contains(w.ul, c.l) AND NOT list_contains(w.ur, c.r) AS ok
        FROM {name}_walk w JOIN {name}_cand c ON {' AND '.join(f'c.{b} = w.{b}' for b in by.split(', '))} AND c.n = w.n + 1))"""


PAIRS = TIMED_EVENTS + """,
clicks AS (SELECT * FROM me WHERE event_type = 'click'), views AS (SELECT * FROM me WHERE event_type = 'view'),""" + greedy_sql(
    "g", "clicks", "views", "user_id, day", 4 * HOURS
)


def click_view_pairs(t: Tables) -> tuple[DataFrame, DataFrame]:
    me = timed_events(t)
    clicks, views = me.filter("event_type = 'click'"), me.filter("event_type = 'view'")
    pairs = pair_nearest(clicks, views, 4 * 3600.0, ["user_id", "day"], left_id="id", right_id="id")
    return me.filter("event_type in ('click', 'view')"), pairs


@query("j01_pair_nearest", f"""
WITH RECURSIVE {PAIRS}
SELECT user_id, day, l AS left_id, r AS right_id, lt AS left_time, rt AS right_time, d / 1e6 AS delta_sec FROM g_walk WHERE taken
""", texts=("day",))
def j01(t: Tables) -> DataFrame:
    return click_view_pairs(t)[1]


@query("j02_unmatched", f"""
WITH RECURSIVE {PAIRS}
SELECT user_id, event_type, time, id FROM (SELECT * FROM clicks UNION ALL SELECT * FROM views)
WHERE id NOT IN (SELECT l FROM g_walk WHERE taken UNION ALL SELECT r FROM g_walk WHERE taken)
""")
def j02(t: Tables) -> DataFrame:
    entries, pairs = click_view_pairs(t)
    return unmatched(entries, pairs, entry_id="id").select("user_id", "event_type", "time", "id")


# names of swaths tell the minute
@query("p06_swath_scenes", f"""
WITH RECURSIVE {PAIRS.replace(EVENT_TIME, "date_trunc('minute', ts)")}, {REGION_EVENTS},
s AS (SELECT 'A' || CAST(user_id AS VARCHAR) AS tar_path, make_timestamp((epoch_us(lt) + epoch_us(rt)) // 2) AS midpoint, lt AS cha_time, rt AS chb_time, l AS cha, r AS chb,
             round(d / 6e7, 6) + 0.0::DOUBLE AS delta_minutes FROM g_walk WHERE taken)
SELECT 'scene' AS kind, * FROM s WHERE EXISTS (SELECT 1 FROM ev WHERE event_id IN ('AFRICA', 'ASIA') AND CAST(midpoint AS DATE) BETWEEN CAST(start_utc AS DATE) AND CAST(end_utc AS DATE))
UNION ALL
SELECT 'unmatched', 'A' || CAST(user_id AS VARCHAR), time, NULL, NULL, id, NULL, NULL FROM (SELECT * FROM clicks UNION ALL SELECT * FROM views)
WHERE id NOT IN (SELECT l FROM g_walk WHERE taken UNION ALL SELECT r FROM g_walk WHERE taken)
""", texts=("cha", "chb",))
def p06(t: Tables) -> DataFrame:
    me = timed_events(t).filter(F.col("event_type").isin("click", "view"))
    member = F.concat(
        F.lit("GOLD_L1C_"), F.when(F.col("event_type") == "click", "CHA").otherwise("CHB"), F.lit("_NI1_"),
        F.date_format("time", "yyyy_DDD_HH_mm"), F.lit("_v04_"), F.col("id").cast("string"), F.lit(".nc"),
    )
    members = me.select(
        F.concat(F.lit("A"), F.col("user_id").cast("string")).alias("tar_path"), member.alias("member"),
        F.lit(0).cast("long").alias("offset"), F.lit(1).cast("long").alias("size"),
    )
    ev = region_events(t).filter(F.col("event_id").isin("AFRICA", "ASIA"))
    out = build_scenes(swath_entries(members), ev, tolerance_min=240.0)
    number = lambda c: F.regexp_extract(c, r"_(\d+)\.nc$", 1).cast("long")
    none = lambda ty: F.lit(None).cast(ty)
    return out.scenes.select(
        F.lit("scene").alias("kind"), "tar_path", "midpoint", "cha_time", "chb_time", number("cha_member").alias("cha"),
        number("chb_member").alias("chb"), r6("delta_minutes").alias("delta_minutes"),
    ).union(
        out.unmatched.select(F.lit("unmatched"), "tar_path", "obs_time", none("timestamp"), none("timestamp"), number("member"), none("long"), none("double"))
    )


@query("j03_asof_latest", f"""
WITH {TIMED_EVENTS}, c AS (SELECT user_id, time, max(id) AS id FROM me WHERE event_type = 'click' GROUP BY ALL),
j AS (SELECT e.event_id, e.ts, c.time, c.id FROM (SELECT * FROM events WHERE event_type = 'view') e ASOF LEFT JOIN c ON e.user_id = c.user_id AND e.ts >= c.time)
SELECT event_id, CASE WHEN epoch_us(ts) - epoch_us(time) <= 14400000000 THEN id END AS eph_id, CASE WHEN epoch_us(ts) - epoch_us(time) <= 14400000000 THEN time END AS eph_time FROM j
""", texts=("eph_id",))
def j03(t: Tables) -> DataFrame:
    clicks = timed_events(t).filter("event_type = 'click'").select("user_id", "time", "id", F.col("id").alias("ingest_pos"))
    views = t.events.filter("event_type = 'view'").select("event_id", "user_id", F.col("ts").alias("time"))
    out = joins.asof_latest(views, clicks, ["user_id"], 4 * 3600.0)
    return out.select("event_id", F.col("eph.id").alias("eph_id"), F.col("eph.time").alias("eph_time"))


SPEC = """
spec AS (SELECT o_orderkey AS k, o_orderdate AS gold_cha_time, o_orderdate + to_days(CAST(o_custkey % 4 AS INTEGER)) AS gold_chb_time,
                o_orderdate + to_hours(o_custkey % 9) AS gnss_time FROM orders),
sl AS (SELECT l_shipdate + to_hours(l_linenumber) AS time, max(l_orderkey * 10 + l_linenumber) AS slice_id FROM lineitem GROUP BY 1),
sc AS (SELECT l_shipdate AS cha_time, l_shipdate + to_days(CAST(l_linenumber % 3 AS INTEGER)) AS chb_time, max(l_orderkey * 10 + l_linenumber) AS last_id,
              min(l_orderkey * 10 + l_linenumber) AS first_id FROM lineitem GROUP BY ALL)"""


def later(time: str, count, unit_us: int):
    return F.timestamp_micros(F.unix_micros(time) + count * unit_us)


def spec_tables(t: Tables) -> tuple[DataFrame, DataFrame, DataFrame]:
    c, n = F.col("o_custkey"), F.col("l_linenumber")
    spec = t.orders.select(
        F.col("o_orderkey").alias("k"), F.col("o_orderdate").alias("gold_cha_time"),
        later("o_orderdate", c % 4, 24 * HOURS).alias("gold_chb_time"), later("o_orderdate", c % 9, HOURS).alias("gnss_time"),
    )
    ident = F.col("l_orderkey") * 10 + n
    slices = t.lineitem.select(later("l_shipdate", n, HOURS).alias("time"), ident.alias("slice_id"))
    scenes = t.lineitem.select(
        F.col("l_shipdate").alias("cha_time"), later("l_shipdate", n % 3, 24 * HOURS).alias("chb_time"), ident.alias("scene_id")
    )
    return spec, slices, scenes


@query("j04_explicit_pairs", f"""
WITH {SPEC},
j AS (SELECT k, gold_cha_time, gold_chb_time, gnss_time, slice_id, last_id AS scene_id, make_timestamp((epoch_us(gold_cha_time) + epoch_us(gold_chb_time)) // 2) AS gold_time
      FROM spec LEFT JOIN sl ON sl.time = gnss_time LEFT JOIN sc ON sc.cha_time = gold_cha_time AND sc.chb_time = gold_chb_time)
SELECT k, slice_id, scene_id, gold_time, CASE WHEN slice_id IS NOT NULL AND scene_id IS NOT NULL THEN abs(epoch_us(gnss_time) - epoch_us(gold_time)) / 1e6 END AS delta_seconds,
       CASE WHEN slice_id IS NOT NULL AND scene_id IS NOT NULL THEN 'ready' ELSE 'skipped' END AS status,
       CASE WHEN slice_id IS NULL AND scene_id IS NULL THEN 'explicit_pair_missing_gnss_and_gold' WHEN slice_id IS NULL THEN 'explicit_pair_missing_gnss'
            WHEN scene_id IS NULL THEN 'explicit_pair_missing_gold' ELSE '' END AS detail FROM j
""", texts=("slice_id", "scene_id",))
def j04(t: Tables) -> DataFrame:
    out = joins.explicit_pairs(*spec_tables(t))
    return out.select("k", "slice_id", "scene_id", "gold_time", "delta_seconds", "status", "detail")


PANEL = SPEC.replace("AS slice_id FROM lineitem GROUP BY 1", "AS slice_id, CASE WHEN l_linenumber % 2 = 0 THEN 'roti' ELSE 'vtec' END AS metric FROM lineitem GROUP BY ALL") + """,
slots AS (SELECT k, ['gnss_roti', 'gnss_vtec', 'gold', 'overlay'][CAST(k % 4 + 1 AS INTEGER)] AS kind, gold_cha_time, gold_chb_time, gnss_time FROM spec),
found AS (SELECT k, kind, CASE WHEN kind = 'gold' THEN make_timestamp((epoch_us(gold_cha_time) + epoch_us(gold_chb_time)) // 2) ELSE gnss_time END AS requested_time, slice_id,
                 CASE WHEN kind IN ('gold', 'overlay') THEN first_id END AS scene_id
          FROM slots LEFT JOIN sl ON sl.time = gnss_time AND ((kind IN ('gnss_roti', 'overlay') AND metric = 'roti') OR (kind = 'gnss_vtec' AND metric = 'vtec'))
          LEFT JOIN sc ON sc.cha_time = gold_cha_time AND sc.chb_time = gold_chb_time AND kind IN ('gold', 'overlay')),
judged AS (SELECT *, CASE WHEN kind LIKE 'gnss%' AND slice_id IS NULL THEN 'missing_gnss_slice' WHEN kind = 'gold' AND scene_id IS NULL THEN 'missing_gold_pair'
                          WHEN kind = 'overlay' AND scene_id IS NULL AND slice_id IS NULL THEN 'missing_gold_pair_and_gnss_slice' WHEN kind = 'overlay' AND scene_id IS NULL THEN 'missing_gold_pair'
                          WHEN kind = 'overlay' AND slice_id IS NULL THEN 'missing_gnss_slice' ELSE '' END AS detail FROM found)"""


def panel_tables(t: Tables) -> tuple[DataFrame, DataFrame, DataFrame]:
    spec, slices, scenes = spec_tables(t)
    kinds = F.array(*[F.lit(k) for k in ("gnss_roti", "gnss_vtec", "gold", "overlay")])
    slots = spec.select(
        F.lit("panel").alias("panel_name"), F.col("k").alias("slot_index"), F.get(kinds, (F.col("k") % 4).cast("int")).alias("kind"),
        F.lit("Internal").alias("producer"), F.col("gnss_time").alias("timestamp"), "gold_cha_time", "gold_chb_time", "gnss_time",
    )
    named = slices.withColumns(
        {"producer": F.lit("internal"), "metric": F.when(F.col("slice_id") % 10 % 2 == 0, "ROTI").otherwise("vtec")}
    )
    return slots, named, scenes


@query("j05_panel_slots", f"""
WITH {PANEL}
SELECT k AS slot_index, kind, requested_time, CASE WHEN detail = '' THEN requested_time END AS resolved_time, CASE WHEN detail = '' THEN 'ready' ELSE 'placeholder' END AS status, detail, slice_id, scene_id FROM judged
""", texts=("slice_id", "scene_id",))
def j05(t: Tables) -> DataFrame:
    return joins.resolve_slots(*panel_tables(t)).drop("panel_name")


@query("p10_panel_table", f"""
WITH {PANEL}
SELECT k AS slot_index, kind, CASE WHEN detail = '' THEN 'ready' ELSE 'placeholder' END AS status,
       CASE WHEN detail = '' AND kind = 'overlay' AND slice_id // 10 % 100 < 40 THEN 'threshold_removed_all_pixels' ELSE detail END AS detail FROM judged
""")
def p10(t: Tables) -> DataFrame:
    slots, slices, scenes = panel_tables(t)
    # the order number decides how strong the slice is
    level = F.floor(F.col("slice_id") / 10) % 100 / 40.0 + 0.01
    lat, lon = F.array(F.lit(0.0), F.lit(1.0)), F.array(F.lit(-60.0), F.lit(-59.0))
    cubes = slices.withColumns({"lat": lat, "lon": lon, "values": F.array(F.array(level, F.lit(0.0)), F.array(F.lit(0.5), level))})
    return build_panel(slots, cubes, scenes, OverlaySpec(threshold=1.0)).select("slot_index", "kind", "status", "detail")


@query("j06_highlight_windows", f"""
WITH {REGION_EVENTS} SELECT e.event_id AS row_id, e.ts, ev.event_id AS name, 0.3::DOUBLE AS alpha FROM events e JOIN ev ON e.ts BETWEEN start_utc AND end_utc
""")
def j06(t: Tables) -> DataFrame:
    windows = region_events(t).select(F.col("event_id").alias("name"), "start_utc", "end_utc", F.lit(0.3).alias("alpha"))
    rows = t.events.select(F.col("event_id").alias("row_id"), "ts")
    return highlight(rows, windows, time="ts").select("row_id", "ts", "name", "alpha")


@query("j07_narrowest_cover", """
WITH f AS (SELECT o_orderstatus AS kind, lpad(CAST(o_orderkey AS VARCHAR), 15, '0') AS name, o_orderdate AS a, o_orderdate + to_days(CAST(o_custkey % 20 + 1 AS INTEGER)) - INTERVAL 1 SECOND AS b FROM orders),
ev AS (SELECT n_name AS event_id, TIMESTAMP '1995-01-01 06:00:00' + to_days(n_nationkey * 40) AS s, TIMESTAMP '1995-01-05 18:00:00' + to_days(n_nationkey * 40) AS e FROM nation),
r AS (SELECT event_id, kind, name, a AS start, b AS "end", row_number() OVER (PARTITION BY event_id, kind ORDER BY b - a, name) AS rn FROM ev JOIN f ON NOT (a > e OR b < s))
SELECT event_id, kind, name, start, "end" FROM r WHERE rn = 1
""")
def j07(t: Tables) -> DataFrame:
    files = t.orders.select(
        F.col("o_orderstatus").alias("kind"), F.lpad(F.col("o_orderkey").cast("string"), 15, "0").alias("name"), F.col("o_orderdate").alias("start"),
        F.timestamp_micros(F.unix_micros("o_orderdate") + (F.col("o_custkey") % 20 + 1) * 24 * HOURS - 1_000_000).alias("end"),
    )
    shift = F.make_interval(days=F.col("n_nationkey") * 40)
    events = t.nation.select(
        F.col("n_name").alias("event_id"), (F.lit("1995-01-01 06:00:00").cast("timestamp") + shift).alias("start_utc"),
        (F.lit("1995-01-05 18:00:00").cast("timestamp") + shift).alias("end_utc"),
    )
    return joins.best_cover(files, events)


@query("j08_first_match_lookup", """
WITH m AS (SELECT *, row_number() OVER (PARTITION BY o_orderpriority, CAST(o_orderdate AS DATE), o_custkey % 5 ORDER BY o_orderkey) AS rn FROM orders)
SELECT o.o_orderkey AS k, coalesce(m.o_totalprice, 0) AS lat, coalesce(CAST(m.o_orderkey AS DOUBLE), 0) AS lon, coalesce(CASE WHEN m.o_orderkey % 4 = 0 THEN 1.5 END, 0)::DOUBLE AS height_m
FROM orders o LEFT JOIN (SELECT * FROM m WHERE rn = 1) m ON m.o_orderpriority = o.o_orderpriority AND CAST(m.o_orderdate AS DATE) = CAST(o.o_orderdate AS DATE) AND m.o_custkey % 5 = o.o_custkey % 7
""")
def j08(t: Tables) -> DataFrame:
    k = F.col("o_orderkey")
    rows = t.orders.select(
        k.alias("k"), k.alias("row_no"), F.col("o_orderpriority").alias("event_id"), F.to_date("o_orderdate").alias("observation_date"),
        (F.col("o_custkey") % 5).alias("station_id"), (F.col("o_custkey") % 7).alias("asked"), F.col("o_totalprice").alias("lat"), k.cast("double").alias("lon"),
        F.when(k % 4 == 0, 1.5).otherwise(F.lit(float("nan"))).alias("height_m"),
    )
    records = rows.drop("row_no", "station_id").withColumnRenamed("asked", "station_id")
    return joins.attach_position(records, rows.drop("k", "asked")).select("k", "lat", "lon", "height_m")


@query("j09_station_metadata", """
WITH m AS (SELECT 'c' || CAST(s_suppkey % 80 AS VARCHAR) AS code, s_suppkey, s_name, row_number() OVER (PARTITION BY s_suppkey % 80 ORDER BY s_suppkey DESC) AS rn FROM supplier)
SELECT c_custkey, 'C' || CAST(c_custkey % 200 AS VARCHAR) AS station_code4, s_name FROM customer JOIN m ON code = 'c' || CAST(c_custkey % 200 AS VARCHAR) AND rn = 1
""")
def j09(t: Tables) -> DataFrame:
    have = t.customer.select("c_custkey", F.concat(F.lit("C"), (F.col("c_custkey") % 200).cast("string")).alias("station_code4"))
    meta = t.supplier.select(
        F.concat(F.lit("c"), (F.col("s_suppkey") % 80).cast("string")).alias("station_code4"), "s_name", F.col("s_suppkey").alias("row_no")
    )
    return joins.join_stations(have, meta)


@query("j10_station_calendar", f"""
WITH {REGION_EVENTS}
SELECT s_suppkey, event_id, CAST(unnest(generate_series(CAST(start_utc AS DATE), CAST(end_utc AS DATE), INTERVAL 1 DAY)) AS DATE) AS observation_date
FROM supplier JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey JOIN ev ON event_id = r_name
""", texts=("observation_date",))
def j10(t: Tables) -> DataFrame:
    st = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    return joins.station_calendar(st.select("s_suppkey", F.col("r_name").alias("event_id")), region_events(t))


@query("j11_navigation_of_day", """
WITH n AS (SELECT CAST(l_shipdate AS DATE) + CAST(day(l_shipdate) % 2 AS INTEGER) AS d, 'nav/' || lpad(CAST(l_orderkey AS VARCHAR), 12, '0') AS path, CASE WHEN l_returnflag = 'A' THEN 'ok' ELSE 'error' END AS st FROM lineitem),
b AS (SELECT *, row_number() OVER (PARTITION BY d ORDER BY st <> 'ok', path) AS rn FROM n)
SELECT o_orderkey, coalesce(path, '') AS nav_path, coalesce(st, 'error') AS nav_status, CASE WHEN path IS NULL THEN 'navigation_file_missing' ELSE '' END AS nav_error
FROM orders LEFT JOIN b ON d = CAST(o_orderdate AS DATE) AND rn = 1
""")
def j11(t: Tables) -> DataFrame:
    nav = nav_files(t)
    obs = t.orders.select("o_orderkey", F.to_date("o_orderdate").alias("observation_date"))
    return joins.attach_nav(obs, nav).select("o_orderkey", "nav_path", "nav_status", "nav_error")


def nav_files(t: Tables) -> DataFrame:
    """Files of the even days of a month; odd days have none."""
    day = F.date_add(F.to_date("l_shipdate"), F.dayofmonth("l_shipdate") % 2)
    return t.lineitem.select(
        day.alias("observation_date"), F.concat(F.lit("nav/"), F.lpad(F.col("l_orderkey").cast("string"), 12, "0")).alias("path"),
        F.when(F.col("l_returnflag") == "A", "ok").otherwise("error").alias("status"),
    )


@query("p01_station_days", """
WITH c AS (SELECT *, 'S' || lpad(CAST(o_custkey % 1000 AS VARCHAR), 3, '0') AS code, CAST(o_orderdate AS DATE) AS d FROM orders WHERE o_orderkey % 4 < 2),
f AS (SELECT o_orderkey, d, code AS station_code4, CASE o_orderkey % 4 WHEN 0 THEN code || '00BRA' ELSE code END AS station_id, CASE o_orderkey % 4 WHEN 0 THEN 15 ELSE 30 END AS sampling_sec,
             row_number() OVER (PARTITION BY d, code ORDER BY o_custkey % 3, o_orderpriority,
               CASE o_orderkey % 4 WHEN 0 THEN '/c/obs/' || lower(code) || '00bra_R_' || strftime(o_orderdate, '%Y%j') || '0000_01D_15S_MO.crx.gz' ELSE '/c/obs/' || lower(code) || strftime(o_orderdate, '%j') || '0.' || strftime(o_orderdate, '%y') || 'd.Z' END) AS rn,
             o_custkey % 3 AS source_priority, o_orderpriority AS source FROM c),
n AS (SELECT CAST(l_shipdate AS DATE) + CAST(day(l_shipdate) % 2 AS INTEGER) AS d, min(('nav/' || lpad(CAST(l_orderkey AS VARCHAR), 12, '0'))) FILTER (l_returnflag = 'A') AS okp, min(('nav/' || lpad(CAST(l_orderkey AS VARCHAR), 12, '0'))) AS anyp FROM lineitem GROUP BY 1)
SELECT f.d AS observation_date, station_code4, station_id, sampling_sec, source_priority, source, coalesce(okp, anyp, '') AS nav_path, CASE WHEN okp IS NOT NULL THEN 'ok' ELSE 'error' END AS nav_status
FROM f LEFT JOIN n USING (d) WHERE rn = 1
""", texts=("observation_date",))
def p01(t: Tables) -> DataFrame:
    names = file_names(t).join(t.orders.select("o_orderkey", "o_orderpriority"), "o_orderkey")
    listing = names.select(
        "path", F.to_date("o_orderdate").alias("observation_date"), (F.col("o_custkey") % 3).alias("source_priority"), F.col("o_orderpriority").alias("source")
    )
    out = build_station_days(listing, nav_files(t))
    return out.select("observation_date", "station_code4", "station_id", "sampling_sec", "source_priority", "source", "nav_path", "nav_status")


@query("p02_normalised_manifest", """
WITH m AS (SELECT o_orderkey AS k, o_orderstatus = 'F' AS ok, 'o/' || CAST(o_orderkey AS VARCHAR) AS obs_path, 'n/' || strftime(o_orderdate, '%Y-%m-%d') AS nav_path, o_orderstatus AS st, o_totalprice FROM orders),
p AS (SELECT DISTINCT 'o/' || CAST(l_orderkey AS VARCHAR) AS path FROM lineitem UNION SELECT DISTINCT 'n/' || strftime(CAST(l_shipdate AS DATE) + CAST(day(l_shipdate) % 2 AS INTEGER), '%Y-%m-%d') FROM lineitem),
j AS (SELECT m.*, CASE WHEN NOT ok THEN 'obs_status=' || st || '; nav_status=ok' WHEN obs_path NOT IN (SELECT path FROM p) THEN 'observation_file_missing'
                        WHEN nav_path NOT IN (SELECT path FROM p) THEN 'navigation_file_missing' END AS error FROM m)
SELECT obs_path, nav_path, error, CASE WHEN error IS NULL THEN o_totalprice END AS lat FROM j
""")
def p02(t: Tables) -> DataFrame:
    k = F.col("o_orderkey")
    manifest = t.orders.select(
        k.alias("row_no"), F.lit("ev").alias("event_id"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("observation_date"), F.col("o_orderpriority").alias("source"),
        k.cast("string").alias("station_id"), F.lit("abcd").alias("station_code4"), F.lit(30).alias("sampling_sec"),
        F.concat(F.lit("o/"), k.cast("string")).alias("obs_path"), F.concat(F.lit("n/"), F.date_format("o_orderdate", "yyyy-MM-dd")).alias("nav_path"),
        F.when(F.col("o_orderstatus") == "F", "ok").otherwise(F.col("o_orderstatus")).alias("obs_status"), F.lit("ok").alias("nav_status"),
        F.col("o_totalprice").alias("lat"), F.lit(0.0).alias("lon"), F.lit(0.0).alias("height_m"),
    )
    li = t.lineitem
    files = li.select(F.concat(F.lit("o/"), F.col("l_orderkey").cast("string")).alias("path")).union(
        nav_files(t).select(F.concat(F.lit("n/"), F.date_format("observation_date", "yyyy-MM-dd")))
    )
    good, bad = normalise(manifest, files)
    return good.select("obs_path", "nav_path", F.lit(None).cast("string").alias("error"), "lat").union(
        bad.select("obs_path", "nav_path", "error", F.lit(None).cast("double"))
    )


OVERLAY = """
s AS (SELECT vec_id AS id, TIMESTAMP '2024-01-01' + to_minutes(vec_id * 47) AS time, embedding FROM embeddings),
g AS (SELECT event_id AS id, ts AS time FROM events WHERE event_type = 'purchase'),
s1 AS (SELECT *, strftime(time, '%Y-%m') AS event FROM s), g1 AS (SELECT *, strftime(time, '%Y-%m') AS event FROM g),
cells AS (SELECT id, CAST((i - 1) // 8 * 0.2::DOUBLE - 0.8::DOUBLE AS DOUBLE) AS lat, CAST((i - 1) % 8 * 0.2::DOUBLE - 60.0::DOUBLE AS DOUBLE) AS lon, CAST(embedding[i] AS DOUBLE) AS v FROM s, range(1, 65) r(i)),
bins AS (SELECT DISTINCT id, floor((lon + 150.0::DOUBLE) / 0.5::DOUBLE) AS xi, floor((lat + 80.0::DOUBLE) / 0.5::DOUBLE) AS yi FROM cells WHERE v > 0.15::DOUBLE)"""


def overlay_tables(t: Tables) -> tuple[DataFrame, DataFrame]:
    v = F.transform("embedding", lambda x: x.cast("double"))
    start = F.lit("2024-01-01").cast("timestamp")
    eight = F.sequence(F.lit(0), F.lit(7))
    slices = t.embeddings.select(
        F.col("vec_id").alias("slice_id"), F.timestamp_micros(F.unix_micros(start) + F.col("vec_id") * 47 * 60_000_000).alias("time"),
        F.transform(eight, lambda i: i * 0.2 - 0.8).alias("lat"), F.transform(eight, lambda i: i * 0.2 - 60.0).alias("lon"),
        F.transform(eight, lambda r: F.slice(v, r * 8 + 1, 8)).alias("values"),
    )
    scenes = t.events.filter("event_type = 'purchase'").select(F.col("event_id").alias("scene_id"), F.col("ts").alias("midpoint"))
    month = lambda c: F.date_format(c, "yyyy-MM")
    return slices.withColumn("event", month("time")), scenes.withColumn("event", month("midpoint"))


@query("p09_overlay_pairs", f"""
WITH RECURSIVE {OVERLAY}, {greedy_sql('g', 's1', 'g1', 'event', 15 * 60_000_000)},
n AS (SELECT id, count(*) AS n FROM bins GROUP BY 1),
state AS (SELECT event, bool_or(s) AS s, bool_or(g) AS g FROM (SELECT event, true AS s, false AS g FROM s1 UNION ALL SELECT event, false, true FROM g1) GROUP BY 1)
SELECT event, NULL AS slice_id, NULL AS scene_id, NULL AS gnss_time, NULL AS gold_time, NULL AS delta_seconds, 'skipped' AS status,
       CASE WHEN s AND g THEN 'no_pairs_within_tolerance' ELSE 'missing_gnss_or_gold' END AS detail, NULL AS points
FROM state WHERE NOT (s AND g) OR event NOT IN (SELECT event FROM g_walk WHERE taken)
UNION ALL
SELECT event, l AS slice_id, r AS scene_id, lt AS gnss_time, rt AS gold_time, d / 1e6 AS delta_seconds, CASE WHEN n.n IS NULL THEN 'skipped' ELSE 'ready' END AS status,
       CASE WHEN n.n IS NULL THEN 'threshold_removed_all_pixels' ELSE '' END AS detail, coalesce(n.n, 0) AS points FROM g_walk LEFT JOIN n ON n.id = l WHERE taken
""")
def p09(t: Tables) -> DataFrame:
    slices, scenes = overlay_tables(t)
    out = build_overlay(slices, scenes, OverlaySpec(threshold=0.15), by=["event"])
    return out.pairs.drop("overlay_name", "metric", "label")


@query("p09_overlay_points", f"""
WITH RECURSIVE {OVERLAY}, {greedy_sql('g', 's1', 'g1', 'event', 15 * 60_000_000)}
SELECT id AS slice_id, round(-150.0::DOUBLE + (xi + 0.5::DOUBLE) * 0.5::DOUBLE, 6) + 0.0::DOUBLE AS lon, round(-80.0::DOUBLE + (yi + 0.5::DOUBLE) * 0.5::DOUBLE, 6) + 0.0::DOUBLE AS lat FROM bins WHERE id IN (SELECT l FROM g_walk WHERE taken)
""")
def p09_points(t: Tables) -> DataFrame:
    slices, scenes = overlay_tables(t)
    out = build_overlay(slices, scenes, OverlaySpec(threshold=0.15), by=["event"])
    return out.points.select("slice_id", r6("lon").alias("lon"), r6("lat").alias("lat"))


@query("p09_overlay_status", f"""
WITH {OVERLAY},
sd AS (SELECT id, time, CAST(CAST(time AS DATE) AS VARCHAR) AS event FROM s), gd AS (SELECT id, time, CAST(CAST(time AS DATE) AS VARCHAR) AS event FROM g),
state AS (SELECT event, bool_or(s) AS s, bool_or(g) AS g FROM (SELECT event, true AS s, false AS g FROM sd UNION ALL SELECT event, false, true FROM gd) GROUP BY 1)
SELECT event, 'skipped' AS status, CASE WHEN s AND g THEN 'no_pairs_within_tolerance' ELSE 'missing_gnss_or_gold' END AS detail
FROM state WHERE NOT (s AND g) OR NOT EXISTS (SELECT 1 FROM sd JOIN gd USING (event) WHERE sd.event = state.event AND abs(epoch_us(sd.time) - epoch_us(gd.time)) <= 30000000)
""")
def p09_status(t: Tables) -> DataFrame:
    slices, scenes = overlay_tables(t)
    day = lambda df, c: df.withColumn("event", F.to_date(c).cast("string"))
    out = build_overlay(day(slices, "time"), day(scenes, "midpoint"), OverlaySpec(threshold=0.15, tolerance_min=0.5), by=["event"])
    return out.pairs.filter("slice_id IS NULL").select("event", "status", "detail")


@query("p09_overlay_explicit", f"""
WITH {OVERLAY},
spec AS (SELECT event_id, ts AS a, CASE WHEN event_id % 3 = 0 THEN ts + INTERVAL 2 MINUTES ELSE ts + INTERVAL 1 MINUTE END AS b,
         TIMESTAMP '2024-01-01' + to_minutes(CASE WHEN event_id % 4 = 0 THEN 1 ELSE 0 END + event_id % 100 * 47) AS gnss_time FROM events WHERE event_type = 'purchase'),
n AS (SELECT id, count(*) AS n FROM bins GROUP BY 1),
j AS (SELECT gnss_time, make_timestamp((epoch_us(a) + epoch_us(b)) // 2) AS gold_time, s.id AS slice_id, CASE WHEN g.ts IS NOT NULL THEN g.id END AS scene_id
      FROM spec LEFT JOIN s ON s.time = gnss_time LEFT JOIN (SELECT max(event_id) AS id, ts, ts + INTERVAL 1 MINUTE AS e FROM events WHERE event_type = 'purchase' GROUP BY ts) g ON g.ts = a AND g.e = b)
SELECT slice_id, scene_id, gnss_time, gold_time,
       CASE WHEN slice_id IS NULL OR scene_id IS NULL OR n.n IS NULL THEN 'skipped' ELSE 'ready' END AS status,
       CASE WHEN slice_id IS NULL AND scene_id IS NULL THEN 'explicit_pair_missing_gnss_and_gold' WHEN slice_id IS NULL THEN 'explicit_pair_missing_gnss'
            WHEN scene_id IS NULL THEN 'explicit_pair_missing_gold' WHEN n.n IS NULL THEN 'threshold_removed_all_pixels' ELSE '' END AS detail, coalesce(n.n, 0) AS points
FROM j LEFT JOIN n ON n.id = slice_id
""", texts=("slice_id", "scene_id"))
def p09_explicit(t: Tables) -> DataFrame:
    slices, scenes = overlay_tables(t)
    minutes = lambda n: F.make_dt_interval(mins=n)
    scenes = scenes.withColumns({"cha_time": F.col("midpoint"), "chb_time": F.col("midpoint") + minutes(F.lit(1))}).drop("event")
    asked = t.events.filter("event_type = 'purchase'").select(
        F.col("ts").alias("gold_cha_time"), (F.col("ts") + minutes(F.when(F.col("event_id") % 3 == 0, 2).otherwise(1))).alias("gold_chb_time"),
        (F.lit("2024-01-01").cast("timestamp") + minutes((F.when(F.col("event_id") % 4 == 0, 1).otherwise(0) + F.col("event_id") % 100 * 47).cast("int"))).alias("gnss_time"),
    )
    out = build_overlay(slices.drop("event"), scenes, OverlaySpec(threshold=0.15), explicit=asked)
    return out.pairs.select("slice_id", "scene_id", "gnss_time", "gold_time", "status", "detail", "points")
