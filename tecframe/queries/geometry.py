"""Positions and angles over the station stand-in."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tecframe import fixed
from tecframe.functions import geodesy
from tecframe.functions.timefn import gps_week
from tecframe.queries.base import LINKS, STATIONS, Tables, links, query, r6, stations

XYZ = STATIONS + """,
st AS (SELECT *, radians(lat) AS p, radians(lon) AS l, 6378137.0::DOUBLE AS a, (1.0::DOUBLE / 298.257223563::DOUBLE) AS f FROM stations),
st2 AS (SELECT *, f * (2 - f) AS e2, a / sqrt(1 - f * (2 - f) * sin(p) * sin(p)) AS n FROM st),
xyz AS (SELECT *, (n + height_m) * cos(p) * cos(l) AS x, (n + height_m) * cos(p) * sin(l) AS y, (n * (1 - e2) + height_m) * sin(p) AS z FROM st2)"""


@query("m05_mapping_function", f"""
WITH {LINKS}
SELECT station_id, sv, time, round(1 / sqrt(1 - pow(least(0.999999::DOUBLE, 6371.0::DOUBLE * cos(radians(elev_deg)) / 6721.0::DOUBLE), 2)), 6) + 0.0::DOUBLE AS factor,
       round(stec * sqrt(1 - pow(least(0.999999::DOUBLE, 6371.0::DOUBLE * cos(radians(elev_deg)) / 6721.0::DOUBLE), 2)), 6) + 0.0::DOUBLE AS vtec FROM links
""")
def m05(t: Tables) -> DataFrame:
    m = geodesy.mapping("elev_deg")
    return links(t).select("station_id", "sv", "time", r6(m).alias("factor"), r6(F.col("stec") / m).alias("vtec"))


@query("m06_pierce_point", f"""
WITH {STATIONS},
z AS (SELECT key, radians(lat) AS p, radians(lon) AS l, radians(CAST(key * 13 % 360 AS DOUBLE)) AS az, pi() / 2 - radians(CAST(key % 75 + 15 AS DOUBLE)) AS z FROM stations),
y AS (SELECT *, z - asin(6371.0::DOUBLE / 6721.0::DOUBLE * sin(z)) AS psi FROM z),
q AS (SELECT *, asin(sin(p) * cos(psi) + cos(p) * sin(psi) * cos(az)) AS ip FROM y)
SELECT key, round(degrees(ip), 6) + 0.0::DOUBLE AS ipp_lat,
       round(((degrees(l + asin(sin(psi) * sin(az) / greatest(cos(ip), 1e-6::DOUBLE))) + 180) % 360 + 360) % 360 - 180, 6) + 0.0::DOUBLE AS ipp_lon FROM q
""")
def m06(t: Tables) -> DataFrame:
    lat, lon = geodesy.pierce_point("lat", "lon", (F.col("key") * 13 % 360).cast("double"), (F.col("key") % 75 + 15).cast("double"))
    return stations(t).select("key", r6(lat).alias("ipp_lat"), r6(lon).alias("ipp_lon"))


@query("m07_look_angles", f"""
WITH {STATIONS},
d AS (SELECT key, radians(lat) AS p, radians(lon) AS l, 1000.0::DOUBLE * (key % 17 + 1) AS dx, 1000.0::DOUBLE * (key % 11 - 5) AS dy, 2000.0::DOUBLE * (key % 7 + 1) AS dz FROM stations),
e AS (SELECT key, -sin(l) * dx + cos(l) * dy AS e, -sin(p) * cos(l) * dx - sin(p) * sin(l) * dy + cos(p) * dz AS n,
             cos(p) * cos(l) * dx + cos(p) * sin(l) * dy + sin(p) * dz AS u FROM d)
SELECT key, round((degrees(atan2(e, n)) + 360) % 360, 6) + 0.0::DOUBLE AS az_deg, round(degrees(atan2(u, sqrt(e * e + n * n))), 6) + 0.0::DOUBLE AS elev_deg FROM e
""")
def m07(t: Tables) -> DataFrame:
    k = F.col("key")
    az, el = geodesy.look_angles((k % 17 + 1) * 1000.0, (k % 11 - 5) * 1000.0, (k % 7 + 1) * 2000.0, "lat", "lon")
    return stations(t).select("key", r6(az).alias("az_deg"), r6(el).alias("elev_deg"))


@query("m08_to_ecef", f"WITH {XYZ} SELECT key, round(x, 3) + 0.0::DOUBLE AS x, round(y, 3) + 0.0::DOUBLE AS y, round(z, 3) + 0.0::DOUBLE AS z FROM xyz")
def m08(t: Tables) -> DataFrame:
    x, y, z = geodesy.to_ecef("lat", "lon", "height_m")
    return stations(t).select("key", r6(x, 3).alias("x"), r6(y, 3).alias("y"), r6(z, 3).alias("z"))


@query("m09_to_geodetic", f"""
WITH {XYZ} SELECT key, round(lat, 6) + 0.0::DOUBLE AS lat, (round(lon, 6) + 360) % 360 AS lon_360, round(height_m, 3) + 0.0::DOUBLE AS height_m FROM xyz
""")
def m09(t: Tables) -> DataFrame:
    x, y, z = geodesy.to_ecef("lat", "lon", "height_m")
    rows = stations(t).withColumns({"x": x, "y": y, "z": z})
    lat, lon, h = geodesy.to_geodetic("x", "y", "z")
    return rows.select("key", r6(lat).alias("lat"), F.pmod(r6(lon) + 360.0, F.lit(360.0)).alias("lon_360"), r6(h, 3).alias("height_m"))


def orbits(t: Tables) -> DataFrame:
    """Orbit elements of a plausible size, one set per part."""
    k = F.col("p_partkey").cast("double")
    tiny = lambda c: F.lit(c) * (k % 13 - 6)
    start = F.lit("2024-01-03 00:00:00").cast("timestamp")
    return t.part.select(
        "p_partkey", F.timestamp_micros(F.unix_micros(start) + F.col("p_partkey") % 240 * 30_000_000).alias("time"),
        F.struct(
            gps_week(start).cast("double").alias("GPSWeek"), F.lit(259200.0).alias("Toe"), (F.lit(5153.6) + (k % 7) * 0.01).alias("sqrtA"),
            ((k % 20) * 0.001).alias("Eccentricity"), tiny(1e-10).alias("DeltaN"), (k % 63 * 0.1 - 3.1).alias("M0"), (k % 31 * 0.2 - 3.0).alias("omega"),
            tiny(1e-6).alias("Cuc"), tiny(2e-6).alias("Cus"), tiny(10.0).alias("Crc"), tiny(7.0).alias("Crs"), tiny(3e-8).alias("Cic"), tiny(4e-8).alias("Cis"),
            (F.lit(0.96) + (k % 5) * 0.002).alias("Io"), tiny(1e-11).alias("IDOT"), (k % 61 * 0.1 - 3.0).alias("Omega0"), tiny(1e-10).alias("OmegaDot"),
        ).alias("eph"),
    )


@query("m10_satellite_position", """
WITH o AS (SELECT p_partkey, CAST(p_partkey AS DOUBLE) AS k, CAST(p_partkey % 240 * 30 AS DOUBLE) AS tk, 259200.0::DOUBLE AS toe FROM part),
e0 AS (SELECT *, (k % 13 - 6) AS q, 5153.6::DOUBLE + (k % 7) * 0.01::DOUBLE AS sa, (k % 20) * 0.001::DOUBLE AS ecc FROM o),
e1 AS (SELECT *, sa * sa AS a, (k % 63 * 0.1::DOUBLE - 3.1::DOUBLE) + (sqrt(3.986005e14 / pow(sa * sa, 3)) + 1e-10 * q) * tk AS m FROM e0),
k1 AS (SELECT *, m + ecc * sin(m) AS e FROM e1), k2 AS (SELECT * REPLACE (m + ecc * sin(e) AS e) FROM k1), k3 AS (SELECT * REPLACE (m + ecc * sin(e) AS e) FROM k2),
k4 AS (SELECT * REPLACE (m + ecc * sin(e) AS e) FROM k3), k5 AS (SELECT * REPLACE (m + ecc * sin(e) AS e) FROM k4), k6 AS (SELECT * REPLACE (m + ecc * sin(e) AS e) FROM k5),
k7 AS (SELECT * REPLACE (m + ecc * sin(e) AS e) FROM k6), k8 AS (SELECT * REPLACE (m + ecc * sin(e) AS e) FROM k7),
p AS (SELECT *, atan2(sqrt(1 - ecc * ecc) * sin(e), cos(e) - ecc) + (k % 31 * 0.2::DOUBLE - 3.0::DOUBLE) AS phi FROM k8),
r AS (SELECT *, phi + 1e-6 * q * cos(2 * phi) + 2e-6 * q * sin(2 * phi) AS u, a * (1 - ecc * cos(e)) + 10.0::DOUBLE * q * cos(2 * phi) + 7.0::DOUBLE * q * sin(2 * phi) AS r,
             (0.96::DOUBLE + (k % 5) * 0.002::DOUBLE) + 3e-8 * q * cos(2 * phi) + 4e-8 * q * sin(2 * phi) + 1e-11 * q * tk AS i,
             (k % 61 * 0.1::DOUBLE - 3.0::DOUBLE) + (1e-10 * q - 7.2921151467e-5) * tk - 7.2921151467e-5 * toe AS node FROM p)
SELECT p_partkey, round(r * cos(u) * cos(node) - r * sin(u) * cos(i) * sin(node), 2) + 0.0::DOUBLE AS sat_x,
       round(r * cos(u) * sin(node) + r * sin(u) * cos(i) * cos(node), 2) + 0.0::DOUBLE AS sat_y, round(r * sin(u) * sin(i), 2) + 0.0::DOUBLE AS sat_z FROM r
""")
def m10(t: Tables) -> DataFrame:
    out = geodesy.with_satellite_xyz(orbits(t))
    return out.select("p_partkey", *[r6(c, 2).alias(c) for c in ("sat_x", "sat_y", "sat_z")])
