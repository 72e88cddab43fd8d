"""Swath operators over the embedding lattice."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tecframe.functions.arrays import axis_edges, native_step, pick_nearest
from tecframe.operators import aggregates, predicates, swaths
from tecframe.plans.scenes import build_pixel_grid
from tecframe.queries.base import SWATH, Tables, long, query, r6, swath

AS64 = "CAST(embedding[i] AS DOUBLE)"


@query("f10_pixel_validity", f"""
WITH {SWATH},
v AS (SELECT *, abs(value) * 400 AS emission, x % 5 AS quality FROM pixels)
SELECT entry_id, y, x, CASE WHEN ok THEN round(lat, 6) + 0.0::DOUBLE END AS lat, CASE WHEN ok THEN round(lon, 6) + 0.0::DOUBLE END AS lon, CASE WHEN ok THEN round(value, 6) + 0.0::DOUBLE END AS radiance
FROM (SELECT *, lat IS NOT NULL AND lat BETWEEN -90 AND 90 AND lon BETWEEN -180 AND 180 AND quality = 0 AND emission BETWEEN 0 AND 88 AS ok FROM v)
""")
def f10(t: Tables) -> DataFrame:
    px = swaths.to_points(swath(t), ["lat", "lon", "value"]).withColumns(
        {"radiance": F.col("value"), "emission": F.abs("value") * 400, "quality": F.col("x") % 5}
    )
    out = predicates.valid_pixels(px, quality_mode="good")
    return out.select("entry_id", "y", "x", *[r6(c).alias(c) for c in ("lat", "lon", "radiance")])


@query("y01_nearest_wavelength", """
SELECT vec_id, CAST(embedding[list_position(d, list_min(d))] AS DOUBLE) AS radiance
FROM (SELECT vec_id, embedding, list_transform(range(0, 64), lambda i: abs(133.0::DOUBLE + i * 0.04::DOUBLE + vec_id % 3 - 135.6::DOUBLE)) AS d FROM embeddings)
""")
def y01(t: Tables) -> DataFrame:
    wl = F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: F.lit(133.0) + i * 0.04 + F.col("vec_id") % 3)
    e = t.embeddings.select("vec_id", wl.alias("wavelength"), F.col("embedding"))
    return e.select("vec_id", pick_nearest("wavelength", "embedding", 135.6).cast("double").alias("radiance"))


@query("y02_masked_points", f"WITH {SWATH} SELECT entry_id, y, x, lat, lon, value FROM pixels WHERE lat IS NOT NULL AND lon IS NOT NULL")
def y02(t: Tables) -> DataFrame:
    px = swaths.to_points(swath(t), ["lat", "lon", "value"])
    return predicates.require(px, ["lat", "lon", "value"])


@query("y02_pixel_rows_to_lines", f"""
WITH {SWATH} SELECT entry_id, y, count(*) AS n, round(max(CASE WHEN x = 10 THEN value END), 6) + 0.0::DOUBLE AS tenth, round(max(CASE WHEN x = 63 THEN value END), 6) + 0.0::DOUBLE AS last FROM pixels GROUP BY ALL
""")
def y02_lines(t: Tables) -> DataFrame:
    px = swaths.to_points(swath(t), ["lat", "lon", "value"])
    lines = swaths.swath_lines(px, ["lat", "lon", "value"])
    return lines.select(
        "entry_id", "y", long(F.size("value")).alias("n"), r6(F.get("value", F.lit(10))).alias("tenth"), r6(F.get("value", F.lit(63))).alias("last")
    )


@query("a05_hot_bins", f"""
WITH {SWATH}, b AS (SELECT DISTINCT entry_id, floor((lon - -32.0::DOUBLE) / 2.5::DOUBLE) AS xi, floor((lat - -32.0::DOUBLE) / 2.5::DOUBLE) AS yi FROM pixels WHERE value > 0.2 AND lat IS NOT NULL)
SELECT entry_id, -32.0::DOUBLE + (xi + 0.5::DOUBLE) * 2.5::DOUBLE AS lon, -32.0::DOUBLE + (yi + 0.5::DOUBLE) * 2.5::DOUBLE AS lat FROM b
""")
def a05(t: Tables) -> DataFrame:
    px = swaths.to_points(swath(t), ["lat", "lon", "value"]).filter(F.col("lat").isNotNull())
    return aggregates.hot_bins(predicates.above(px, "value", 0.2), 2.5, (-32.0, 32.0, -32.0, 32.0), by=["entry_id"])


@query("a06_native_step", f"""
WITH d AS (SELECT vec_id, i % 2 AS axis, abs({AS64} - lag({AS64}) OVER (PARTITION BY vec_id, i % 2 ORDER BY i)) AS s FROM embeddings, range(1, 65) r(i)),
m AS (SELECT vec_id, axis, median(s) AS m FROM d WHERE s <> 0 GROUP BY ALL)
SELECT vec_id, round(min(m), 6) + 0.0::DOUBLE AS step FROM m GROUP BY 1
""")
def a06(t: Tables) -> DataFrame:
    part = lambda r: F.filter(F.transform("embedding", lambda v: v.cast("double")), lambda v, i: (i + 1) % 2 == r)
    return t.embeddings.select("vec_id", r6(native_step(part(0), part(1))).alias("step"))


@query("a07_median_spacing", f"""
WITH {SWATH},
g AS (SELECT entry_id, sqrt(pow(lon - lag(lon) OVER w, 2) + pow(lat - lag(lat) OVER w, 2)) AS g FROM pixels WINDOW w AS (PARTITION BY entry_id, y ORDER BY x)
      UNION ALL SELECT entry_id, sqrt(pow(lon - lag(lon) OVER w, 2) + pow(lat - lag(lat) OVER w, 2)) FROM pixels WINDOW w AS (PARTITION BY entry_id, x ORDER BY y))
SELECT entry_id, round(median(g), 6) + 0.0::DOUBLE AS spacing FROM g WHERE g > 0 GROUP BY 1
""")
def a07(t: Tables) -> DataFrame:
    return swaths.median_spacing(swath(t)).select("entry_id", r6("spacing").alias("spacing"))


EDGES = SWATH + """,
size AS (SELECT entry_id, max(y) + 1 AS m FROM pixels GROUP BY 1),
inner_edge AS (
  SELECT a.entry_id, a.y + 1 AS ey, a.x + 1 AS ex, (a.lat + b.lat + c.lat + d.lat) / 4 AS lat, (a.lon + b.lon + c.lon + d.lon) / 4 AS lon
  FROM pixels a JOIN pixels b ON b.entry_id = a.entry_id AND b.y = a.y + 1 AND b.x = a.x
  JOIN pixels c ON c.entry_id = a.entry_id AND c.y = a.y AND c.x = a.x + 1 JOIN pixels d ON d.entry_id = a.entry_id AND d.y = a.y + 1 AND d.x = a.x + 1),
all_edge AS (
  SELECT entry_id, ey, ex, lat, lon FROM inner_edge
  UNION ALL SELECT p.entry_id, 0, p.x + 1, 2 * p.lat - e.lat, 2 * p.lon - e.lon FROM pixels p JOIN inner_edge e ON e.entry_id = p.entry_id AND e.ey = 1 AND e.ex = p.x + 1 WHERE p.y = 0
  UNION ALL SELECT p.entry_id, s.m, p.x + 1, 2 * p.lat - e.lat, 2 * p.lon - e.lon FROM pixels p JOIN size s USING (entry_id) JOIN inner_edge e ON e.entry_id = p.entry_id AND e.ey = s.m - 1 AND e.ex = p.x + 1 WHERE p.y = s.m - 1
  UNION ALL SELECT p.entry_id, p.y + 1, 0, 2 * p.lat - e.lat, 2 * p.lon - e.lon FROM pixels p JOIN inner_edge e ON e.entry_id = p.entry_id AND e.ey = p.y + 1 AND e.ex = 1 WHERE p.x = 0
  UNION ALL SELECT p.entry_id, p.y + 1, 64, 2 * p.lat - e.lat, 2 * p.lon - e.lon FROM pixels p JOIN inner_edge e ON e.entry_id = p.entry_id AND e.ey = p.y + 1 AND e.ex = 63 WHERE p.x = 63
  UNION ALL SELECT p.entry_id, CASE WHEN p.y = 0 THEN 0 ELSE s.m END, CASE WHEN p.x = 0 THEN 0 ELSE 64 END, 2 * p.lat - e.lat, 2 * p.lon - e.lon
  FROM pixels p JOIN size s USING (entry_id) JOIN inner_edge e ON e.entry_id = p.entry_id AND e.ey = CASE WHEN p.y = 0 THEN 1 ELSE s.m - 1 END AND e.ex = CASE WHEN p.x = 0 THEN 1 ELSE 63 END
  WHERE p.x IN (0, 63) AND p.y IN (0, s.m - 1))"""


@query("w12_cell_mask", f"""
WITH {EDGES},
g AS (SELECT entry_id, sqrt(pow(lon - lag(lon) OVER w, 2) + pow(lat - lag(lat) OVER w, 2)) AS g FROM pixels WINDOW w AS (PARTITION BY entry_id, y ORDER BY x)
      UNION ALL SELECT entry_id, sqrt(pow(lon - lag(lon) OVER w, 2) + pow(lat - lag(lat) OVER w, 2)) FROM pixels WINDOW w AS (PARTITION BY entry_id, x ORDER BY y)),
t AS (SELECT entry_id, 1.2 * median(g) AS t FROM g WHERE g > 0 GROUP BY 1),
c AS (SELECT p.entry_id, p.y, p.x, p.lat, t.t, a.lat AS ay, a.lon AS ax, b.lat AS b_y, b.lon AS bx, e.lat AS ey, e.lon AS ex, f.lat AS fy, f.lon AS fx
      FROM pixels p JOIN t USING (entry_id) JOIN all_edge a ON a.entry_id = p.entry_id AND a.ey = p.y AND a.ex = p.x
      JOIN all_edge b ON b.entry_id = p.entry_id AND b.ey = p.y AND b.ex = p.x + 1 JOIN all_edge e ON e.entry_id = p.entry_id AND e.ey = p.y + 1 AND e.ex = p.x
      JOIN all_edge f ON f.entry_id = p.entry_id AND f.ey = p.y + 1 AND f.ex = p.x + 1)
SELECT entry_id, y, x, lat IS NULL OR ay IS NULL OR b_y IS NULL OR ey IS NULL OR fy IS NULL OR coalesce(
  sqrt(pow(bx - ax, 2) + pow(b_y - ay, 2)) > t OR sqrt(pow(fx - ex, 2) + pow(fy - ey, 2)) > t OR sqrt(pow(ex - ax, 2) + pow(ey - ay, 2)) > t
  OR sqrt(pow(fx - bx, 2) + pow(fy - b_y, 2)) > t OR sqrt(pow(fx - ax, 2) + pow(fy - ay, 2)) > t * 1.5 OR sqrt(pow(ex - bx, 2) + pow(ey - b_y, 2)) > t * 1.5, false) AS masked FROM c
""")
def w12(t: Tables) -> DataFrame:
    return swaths.cell_mask(swath(t), 1.2)


@query("w12_axis_edges", """
SELECT vec_id, len(e) AS n, round(e[1], 6) + 0.0::DOUBLE AS first, round(e[2], 6) + 0.0::DOUBLE AS second, round(e[len(e)], 6) + 0.0::DOUBLE AS last FROM (
  SELECT vec_id, list_concat(list_concat([v[1] - 0.5::DOUBLE * (v[2] - v[1])], list_transform(range(1, 64), lambda i: (v[i] + v[i + 1]) * 0.5::DOUBLE)),
                             [v[64] + 0.5::DOUBLE * (v[64] - v[63])]) AS e
  FROM (SELECT vec_id, list_transform(embedding, lambda q: CAST(q AS DOUBLE)) AS v FROM embeddings))
""")
def w12_axis(t: Tables) -> DataFrame:
    e = t.embeddings.select("vec_id", axis_edges(F.transform("embedding", lambda v: v.cast("double"))).alias("e"))
    return e.select(
        "vec_id", long(F.size("e")).alias("n"), *[r6(F.get("e", i)).alias(n) for n, i in (("first", F.lit(0)), ("second", F.lit(1)), ("last", F.size("e") - 1))]
    )


@query("s07_cube_rows", """
SELECT 'P' || CAST(vec_id // 64 AS VARCHAR) AS producer, CAST(vec_id % 64 AS BIGINT) AS time, CAST((i - 1) // 8 - 4 AS DOUBLE) AS lat, CAST((i - 1) % 8 * 10 AS DOUBLE) AS lon,
       CAST(embedding[i] AS DOUBLE) AS value FROM embeddings, range(1, 65) r(i) WHERE label % 2 = 0
""")
def s07(t: Tables) -> DataFrame:
    v = F.transform("embedding", lambda x: x.cast("double"))
    cubes = t.embeddings.select(
        F.concat(F.lit("P"), F.floor(F.col("vec_id") / 64).cast("string")).alias("producer"), (F.col("vec_id") % 64).alias("time"),
        F.when(F.col("label") % 2 == 0, "vtec").otherwise("roti").alias("metric"),
        F.transform(F.sequence(F.lit(-4), F.lit(3)), lambda i: i.cast("double")).alias("lat"),
        F.transform(F.sequence(F.lit(0), F.lit(7)), lambda i: (i * 10).cast("double")).alias("lon"),
        F.transform(F.sequence(F.lit(0), F.lit(7)), lambda r: F.slice(v, r * 8 + 1, 8)).alias("values"),
    )
    return swaths.explode_cube(cubes, "vtec")


@query("p07_pixel_grid", f"""
WITH {SWATH},
v AS (SELECT * FROM pixels WHERE lat IS NOT NULL AND abs(value) * 400 <= 88)
SELECT CAST(floor((lon - -32.0::DOUBLE) / 4.0::DOUBLE) AS BIGINT) AS ix, CAST(floor((lat - -32.0::DOUBLE) / 4.0::DOUBLE) AS BIGINT) AS iy, round(avg(value), 6) + 0.0::DOUBLE AS radiance, count(*) AS pixel_count
FROM v WHERE lon >= -32 AND lon < 32 AND lat >= -32 AND lat < 32 GROUP BY ALL
""")
def p07(t: Tables) -> DataFrame:
    px = swaths.to_points(swath(t), ["lat", "lon", "value"])
    shift = lambda a, b, c: F.array(F.lit(a), F.lit(b), F.lit(c))
    rows = px.withColumns(
        {"wavelength": shift(130.4, 135.5, 140.0), "radiance": F.array(F.lit(9.9), F.col("value"), F.lit(-9.9)), "emission": F.abs("value") * 400}
    )
    return build_pixel_grid(rows, (-32.0, 32.0, -32.0, 32.0), 4.0).withColumn("radiance", r6("radiance"))
