"""Sequence operators on satellite tracks."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tecframe.operators import predicates, sequences, sets, slips
from tecframe.operators.joins import merge_roti
from tecframe.queries.base import ARCS, GAP_SEC, LINKS, RATES, TRACK, Tables, arcs, full_links, links, long, query, r6


@query("w01_gap_arcs", f"WITH {ARCS} SELECT station_id, sv, time, arc_id FROM arcs")
def w01(t: Tables) -> DataFrame:
    return arcs(t).select("station_id", "sv", "time", "arc_id")


@query("w01_gap_and_jump_arcs", f"""
WITH {LINKS},
b AS (SELECT *, CASE WHEN epoch_us(time) - epoch_us(lag(time) OVER w) > 28800000000 OR abs(stec - lag(stec) OVER w) > 60 THEN 1 ELSE 0 END AS brk
      FROM links WINDOW w AS (PARTITION BY period, station_id, sv ORDER BY time))
SELECT station_id, sv, time, CAST(sum(brk) OVER (PARTITION BY period, station_id, sv ORDER BY time ROWS UNBOUNDED PRECEDING) AS BIGINT) AS arc_id FROM b
""")
def w01_jump(t: Tables) -> DataFrame:
    return sequences.gap_arcs(links(t), TRACK, GAP_SEC, jumps={"stec": 60.0}).select("station_id", "sv", "time", "arc_id")


def as_phases(t: Tables) -> DataFrame:
    """Both combinations from the event value, so that jumps occur in either."""
    return links(t).withColumns(
        {"gf_phase": F.col("stec") / 100.0, "mw": F.when(F.col("ingest_pos") % 7 != 0, F.col("stec") / 10.0)}
    )


# one step per row of a track; the state holds the history since the last reset
SLIPS = LINKS + """,
numbered AS MATERIALIZED (
  SELECT period, station_id, sv, time, epoch_us(time) / 1e6 AS s, stec / 100.0 AS gf,
         CASE WHEN ingest_pos % 7 <> 0 THEN stec / 10.0 END AS mw,
         row_number() OVER (PARTITION BY period, station_id, sv ORDER BY time) AS n FROM links),
walk AS (
  SELECT period, station_id, sv, time, n, s, CAST(0 AS BIGINT) AS arc, CAST([s] AS DOUBLE[]) AS hs, CAST([gf] AS DOUBLE[]) AS hg,
         CASE WHEN mw IS NULL THEN CAST([] AS DOUBLE[]) ELSE CAST([mw] AS DOUBLE[]) END AS hm,
         true AS keep, false AS gap, false AS mwb, false AS gfb FROM numbered WHERE n = 1
  UNION ALL
  SELECT period, station_id, sv, time, n, s, arc + CASE WHEN mwt OR gft THEN 1 ELSE 0 END,
         CASE WHEN mwt OR gft THEN [] ELSE list_append(hs, s) END, CASE WHEN mwt OR gft THEN [] ELSE list_append(hg, gf) END,
         CASE WHEN mwt OR gft THEN [] WHEN mw IS NULL THEN hm ELSE list_append(hm, mw) END,
         NOT (mwt OR gft), g, mwt, gft AND NOT mwt
  FROM (
    SELECT *, CASE WHEN NOT mwt AND len(hs) >= 4 THEN abs(gf - (
             (sy * sxx - sx * sxy) / (4 * sxx - sx * sx))) > 0.6 ELSE false END AS gft
    FROM (
      SELECT *, list_sum(list_transform(hs[-4:], lambda v: v - s)) AS sx, list_sum(hg[-4:]) AS sy,
             list_sum(list_transform(hs[-4:], lambda v: (v - s) * (v - s))) AS sxx,
             list_sum(list_transform(list_zip(hs[-4:], hg[-4:]), lambda p: (p[1] - s) * p[2])) AS sxy,
             CASE WHEN mw IS NOT NULL AND len(hm) >= 3 THEN abs(mw - list_median(hm[-3:])) > 4.0 ELSE false END AS mwt
      FROM (
        SELECT d.period, d.station_id, d.sv, d.time, d.n, d.s, d.gf, d.mw, d.s - w.s > 86400 AS g,
               w.arc + CASE WHEN d.s - w.s > 86400 THEN 1 ELSE 0 END AS arc,
               CASE WHEN d.s - w.s > 86400 THEN [] ELSE w.hs END AS hs, CASE WHEN d.s - w.s > 86400 THEN [] ELSE w.hg END AS hg,
               CASE WHEN d.s - w.s > 86400 THEN [] ELSE w.hm END AS hm
        FROM walk w JOIN numbered d ON d.period = w.period AND d.station_id = w.station_id AND d.sv = w.sv AND d.n = w.n + 1))))"""
SLIP_PARAMS = slips.SlipParams(
    gap_sec=86_400.0, mw_window=3, mw_threshold=4.0, gf_window=4, gf_degree=1, gf_threshold=0.6
)


@query("w02_cycle_slips", f"""
WITH RECURSIVE {SLIPS}
SELECT station_id, sv, time, keep, CASE WHEN keep THEN arc ELSE -1 END AS arc_id, gap AS gap_break, mwb AS mw_break, gfb AS gf_break FROM walk
""")
def w02(t: Tables) -> DataFrame:
    out = slips.detect_slips(as_phases(t), TRACK, SLIP_PARAMS)
    return out.select("station_id", "sv", "time", "keep", "arc_id", "gap_break", "mw_break", "gf_break")


@query("a11_slip_diagnostics", f"""
WITH RECURSIVE {SLIPS}
SELECT station_id, sv, CAST(count_if(gap) AS BIGINT) AS gap_break_count, CAST(count_if(mwb) AS BIGINT) AS mw_break_count, CAST(count_if(gfb) AS BIGINT) AS gf_break_count,
       CAST(count_if(NOT keep) AS BIGINT) AS dropped_epoch_count, count(*) AS input_epoch_count, CAST(count_if(keep) AS BIGINT) AS accepted_epoch_count
FROM walk GROUP BY period, station_id, sv
""")
def a11(t: Tables) -> DataFrame:
    flagged = slips.detect_slips(as_phases(t), TRACK, SLIP_PARAMS)
    return slips.slip_diagnostics(flagged, TRACK).select(
        "station_id", "sv", *[c + "_count" for c in ("gap_break", "mw_break", "gf_break", "dropped_epoch", "input_epoch", "accepted_epoch")]
    )


@query("w03_rate_of_change", f"WITH {RATES} SELECT station_id, sv, time, arc_id, rot FROM full_links")
def w03(t: Tables) -> DataFrame:
    return full_links(t).select("station_id", "sv", "time", "arc_id", "rot")


@query("w04_roti", f"WITH {RATES} SELECT station_id, sv, time, arc_id, round(roti, 6) + 0.0::DOUBLE AS roti FROM full_links")
def w04(t: Tables) -> DataFrame:
    return full_links(t).select("station_id", "sv", "time", "arc_id", r6("roti").alias("roti"))


@query("j12_merge_back", f"""
WITH {RATES}
SELECT station_id, sv, time, arc_id, round(coalesce(roti, stec), 6) + 0.0::DOUBLE AS roti FROM full_links
""")
def j12(t: Tables) -> DataFrame:
    rows = full_links(t)
    values = rows.filter(F.col("roti").isNotNull()).select(*TRACK, "time", "arc_id", "roti")
    base = arcs(t).withColumn("roti", F.col("stec"))
    return merge_roti(base, values, TRACK).select("station_id", "sv", "time", "arc_id", r6("roti").alias("roti"))


@query("w05_rolling_median", f"""
WITH {LINKS}
SELECT station_id, sv, time, round(CASE WHEN count(*) OVER w = 5 THEN stec - median(stec) OVER w END, 6) + 0.0::DOUBLE AS residual
FROM links WINDOW w AS (PARTITION BY period, station_id, sv ORDER BY time ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING)
""")
def w05(t: Tables) -> DataFrame:
    out = sequences.rolling_median(links(t), TRACK, 5, value="stec")
    return out.select("station_id", "sv", "time", r6("residual").alias("residual"))


@query("w06_rolling_polynomial", f"""
WITH {LINKS},
x AS (SELECT *, epoch_us(time) / 1e6 - 1704067200 AS s FROM links)
SELECT station_id, sv, time,
       round(CASE WHEN count(*) OVER w = 6 THEN stec - (regr_intercept(stec, s) OVER w + regr_slope(stec, s) OVER w * s) END, 4) + 0.0::DOUBLE AS residual
FROM x WINDOW w AS (PARTITION BY period, station_id, sv ORDER BY time ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING)
""")
def w06(t: Tables) -> DataFrame:
    out = sequences.rolling_poly(links(t), TRACK, 6, 1, value="stec")
    return out.select("station_id", "sv", "time", r6("residual", 4).alias("residual"))


@query("w10_regularise_epochs", """
WITH r AS (SELECT *, row_number() OVER (PARTITION BY user_id, date_trunc('hour', ts) ORDER BY event_id DESC) AS rn FROM events)
SELECT user_id, date_trunc('hour', ts) AS time, event_id, value FROM r WHERE rn = 1 AND epoch(date_trunc('hour', ts)) % 7200 = 0
""")
def w10(t: Tables) -> DataFrame:
    rows = t.events.select("user_id", F.date_trunc("hour", "ts").alias("time"), "event_id", "value", F.col("event_id").alias("ingest_pos"))
    return sequences.regularise(rows, ["user_id"], 7200).drop("ingest_pos")


@query("f15_minimum_samples", """
WITH n AS (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY ALL)
SELECT e.user_id, e.event_type, count(*) AS n, CAST(NULL AS VARCHAR) AS reason FROM events e JOIN n USING (user_id, event_type) WHERE n.n >= 12 GROUP BY ALL
UNION ALL SELECT user_id, event_type, n, 'insufficient_phase_samples' FROM n WHERE n < 12
""")
def f15(t: Tables) -> DataFrame:
    keys = ["user_id", "event_type"]
    kept, short = predicates.guard(t.events, keys, 12, "insufficient_phase_samples")
    good = kept.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).withColumn("reason", F.lit(None).cast("string"))
    return good.unionByName(short)


@query("w07_even_station_days", """
WITH p AS (SELECT p_brand AS event_id, CAST(p_partkey // 1000 AS BIGINT) AS day_no, DATE '2024-01-01' + CAST(p_partkey // 1000 AS INTEGER) AS observation_date,
                  p_partkey, CAST(p_size AS DOUBLE) AS lat, CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE p_retailprice END AS lon,
                  p_size IN (1, 2) AS prio FROM part),
k AS (SELECT *, count_if(prio) OVER (PARTITION BY event_id) AS np, count(*) OVER (PARTITION BY event_id) AS al,
             row_number() OVER (PARTITION BY event_id, prio ORDER BY observation_date, p_partkey) - 1 AS head,
             row_number() OVER (PARTITION BY event_id, prio ORDER BY observation_date, lon IS NULL, lat, lon NULLS LAST, p_partkey) - 1 AS rnk FROM p),
idx AS (SELECT event_id, CAST(floor(i * (al - np - 1) / (20 - np - 1)) AS BIGINT) AS want
        FROM (SELECT DISTINCT event_id, np, al FROM k WHERE np < 19 AND al - np > 20 - np) e, range(0, 20) g(i) WHERE i < 20 - np)
SELECT event_id, p_partkey FROM k WHERE al <= 20 OR (prio AND (np < 20 OR head < 20))
UNION SELECT k.event_id, p_partkey FROM k WHERE al > 20 AND np < 20 AND NOT prio
  AND (al - np <= 20 - np OR (np = 19 AND rnk = 0) OR EXISTS (SELECT 1 FROM idx WHERE idx.event_id = k.event_id AND idx.want = rnk))
""")
def w07(t: Tables) -> DataFrame:
    code = F.lpad(F.col("p_partkey").cast("string"), 15, "0")
    days = t.part.select(
        F.col("p_brand").alias("event_id"), F.expr("date_add(DATE'2024-01-01', cast(p_partkey div 1000 as int))").alias("observation_date"),
        "p_partkey", F.col("p_size").cast("double").alias("lat"),
        F.when(F.col("p_partkey") % 5 != 0, F.col("p_retailprice")).alias("lon"), F.lit(0).alias("source_priority"),
        code.alias("station_id"), F.when(F.col("p_size").isin(1, 2), F.lit("PRIO")).otherwise(code).alias("station_code4"),
    )
    return sets.select_station_days(days, 20, ["prio"]).select("event_id", "p_partkey")


@query("w08_best_source", """
WITH c AS (SELECT CAST(s_suppkey % 30 AS BIGINT) AS code, s_nationkey, s_name, s_nationkey % 3 AS prio, s_acctbal > 2000 AS ok,
                  row_number() OVER (PARTITION BY s_suppkey % 30 ORDER BY s_acctbal <= 2000, s_nationkey % 3, s_nationkey, s_name) AS rn FROM supplier)
SELECT 'C' || CAST(code AS VARCHAR) AS station_code4, s_name AS obs_path, CAST(prio AS BIGINT) AS source_priority, CASE WHEN ok THEN 'ok' ELSE 'error' END AS status FROM c WHERE rn = 1
""")
def w08(t: Tables) -> DataFrame:
    cand = t.supplier.select(
        F.lit("2024-01-01").alias("observation_date"), F.concat(F.lit("c"), (F.col("s_suppkey") % 30).cast("string")).alias("station_code4"),
        F.when(F.col("s_acctbal") > 2000, F.lit("ok")).otherwise(F.lit("error")).alias("status"),
        long(F.col("s_nationkey") % 3).alias("source_priority"), F.lpad(F.col("s_nationkey").cast("string"), 4, "0").alias("source"),
        F.col("s_name").alias("obs_path"),
    )
    return sets.best_source(cand).select("station_code4", "obs_path", "source_priority", "status")


@query("w11_zero_crossings", """
WITH f AS (SELECT vec_id AS lon, CAST(i - 33 AS DOUBLE) AS lat, CAST(embedding[i] AS DOUBLE) AS mlat FROM embeddings, range(1, 65) r(i)),
p AS (SELECT lon, lat AS b, mlat AS mb, lag(lat) OVER w AS a, lag(mlat) OVER w AS ma FROM f WINDOW w AS (PARTITION BY lon ORDER BY lat)),
h AS (SELECT lon, a, a - ma * (b - a) / (mb - ma) AS c, ma * mb <= 0 AS first_rule, (ma < 0) <> (mb < 0) AS sign_rule FROM p WHERE ma IS NOT NULL)
SELECT x.lon, round(x.c, 6) + 0.0::DOUBLE AS first_lat, round(y.c, 6) + 0.0::DOUBLE AS nearest_lat
FROM (SELECT lon, arg_min(c, a) AS c FROM h WHERE first_rule GROUP BY 1) x JOIN (SELECT lon, arg_min(c, (abs(a), a)) AS c FROM h WHERE sign_rule GROUP BY 1) y USING (lon)
""")
def w11(t: Tables) -> DataFrame:
    field = t.embeddings.select(F.col("vec_id").alias("lon"), F.posexplode("embedding").alias("p", "v")).select(
        "lon", (F.col("p") - 32).cast("double").alias("lat"), F.col("v").cast("double").alias("mlat")
    )
    both = sequences.crossing_table(field, ["lon"], {"first_lat": "first", "nearest_lat": "nearest"})
    return both.dropna(subset=["first_lat", "nearest_lat"]).select("lon", r6("first_lat").alias("first_lat"), r6("nearest_lat").alias("nearest_lat"))
