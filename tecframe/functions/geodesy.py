"""Angles, positions and orbit geometry."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from tecframe import fixed
from tecframe.functions._col import ColumnLike, col, micros

_E2 = fixed.WGS84_F * (2 - fixed.WGS84_F)
_B = fixed.WGS84_A * (1 - fixed.WGS84_F)
_EP2 = (fixed.WGS84_A**2 - _B**2) / _B**2


def wrap180(x: ColumnLike) -> Column:
    """Longitude in [-180, 180)."""
    return F.pmod(col(x) + 180.0, F.lit(360.0)) - 180.0


def snap(x: ColumnLike, origin: float, step: float) -> Column:
    """Nearest node of origin + k * step; halves go to the even k."""
    node = F.lit(origin) + F.rint((col(x) - origin) / step) * step
    return F.bround(node, 6) + 0.0


def floor_bin(x: ColumnLike, step: float) -> Column:
    """Lower edge of the bin of x, bins counted from zero."""
    return F.floor(col(x) / step).cast("double") * step


def mapping(elev_deg: ColumnLike, shell_km: float = fixed.SHELL_HEIGHT_KM) -> Column:
    """Single-layer slant factor."""
    r = F.cos(F.radians(col(elev_deg))) * (
        fixed.EARTH_RADIUS_KM / (fixed.EARTH_RADIUS_KM + shell_km)
    )
    r = F.greatest(F.lit(-0.999999), F.least(F.lit(0.999999), r))
    return 1.0 / F.sqrt(1.0 - r * r)


def pierce_point(
    lat_deg: ColumnLike,
    lon_deg: ColumnLike,
    az_deg: ColumnLike,
    elev_deg: ColumnLike,
    shell_km: float = fixed.SHELL_HEIGHT_KM,
) -> tuple[Column, Column]:
    """(latitude, longitude) where the ray meets the shell, degrees."""
    lat, lon, az = F.radians(col(lat_deg)), F.radians(col(lon_deg)), F.radians(col(az_deg))
    zenith = F.lit(math.pi / 2) - F.radians(col(elev_deg))
    ratio = fixed.EARTH_RADIUS_KM / (fixed.EARTH_RADIUS_KM + shell_km)
    psi = zenith - F.asin(F.sin(zenith) * ratio)
    p_lat = F.asin(F.sin(lat) * F.cos(psi) + F.cos(lat) * F.sin(psi) * F.cos(az))
    p_lon = lon + F.asin(
        F.sin(psi) * F.sin(az) / F.greatest(F.cos(p_lat), F.lit(1e-6))
    )
    return F.degrees(p_lat), wrap180(F.degrees(p_lon))


def look_angles(
    dx: ColumnLike, dy: ColumnLike, dz: ColumnLike, lat_deg: ColumnLike, lon_deg: ColumnLike
) -> tuple[Column, Column]:
    """(azimuth, elevation) in degrees of an ECEF difference vector."""
    x, y, z = col(dx), col(dy), col(dz)
    lat, lon = F.radians(col(lat_deg)), F.radians(col(lon_deg))
    east = y * F.cos(lon) - x * F.sin(lon)
    outward = x * F.cos(lon) + y * F.sin(lon)
    north = z * F.cos(lat) - outward * F.sin(lat)
    up = outward * F.cos(lat) + z * F.sin(lat)
    az = F.pmod(F.degrees(F.atan2(east, north)) + 360.0, F.lit(360.0))
    return az, F.degrees(F.atan2(up, F.sqrt(east * east + north * north)))


def to_ecef(
    lat_deg: ColumnLike, lon_deg: ColumnLike, height_m: ColumnLike
) -> tuple[Column, Column, Column]:
    lat, lon, h = F.radians(col(lat_deg)), F.radians(col(lon_deg)), col(height_m)
    n = fixed.WGS84_A / F.sqrt(1.0 - _E2 * F.sin(lat) * F.sin(lat))
    return (
        (n + h) * F.cos(lat) * F.cos(lon),
        (n + h) * F.cos(lat) * F.sin(lon),
        (n * (1.0 - _E2) + h) * F.sin(lat),
    )


def to_geodetic(x: ColumnLike, y: ColumnLike, z: ColumnLike) -> tuple[Column, Column, Column]:
    """(latitude, longitude, height) by Bowring's closed form."""
    cx, cy, cz = col(x), col(y), col(z)
    p = F.sqrt(cx * cx + cy * cy)
    theta = F.atan2(cz * fixed.WGS84_A, p * _B)
    lat = F.atan2(
        cz + _EP2 * _B * F.pow(F.sin(theta), 3.0),
        p - _E2 * fixed.WGS84_A * F.pow(F.cos(theta), 3.0),
    )
    w = F.sqrt(1.0 - _E2 * F.sin(lat) * F.sin(lat))
    # p cos + z sin - a w stays exact near the poles, where p / cos does not
    height = p * F.cos(lat) + cz * F.sin(lat) - fixed.WGS84_A * w
    return F.degrees(lat), F.degrees(F.atan2(cy, cx)), height


def with_satellite_xyz(df: DataFrame, *, eph: str = "eph", time: str = "time") -> DataFrame:
    """Adds sat_x, sat_y, sat_z from the orbit elements in struct column ``eph``.

    The steps are separate columns, so that each is computed once per row and
    all of them stay in generated code.
    """
    e = {name: F.col(f"{eph}.{name}").cast("double") for name in fixed.EPHEMERIS_ELEMENTS}
    epoch_us = F.unix_micros(F.lit(fixed.GPS_EPOCH).cast("timestamp"))
    toe_us = ((e["GPSWeek"] * 604800.0 + e["Toe"]) * 1e6).cast("long") + epoch_us
    tk = F.pmod((micros(time) - toe_us) / 1e6 + 302400.0, F.lit(604800.0)) - 302400.0
    out = df.withColumns({"_tk": tk, "_a": e["sqrtA"] * e["sqrtA"]})
    motion = F.sqrt(fixed.EARTH_MU / F.pow(F.col("_a"), 3.0)) + e["DeltaN"]
    out = out.withColumn("_m", e["M0"] + motion * F.col("_tk"))
    anomaly = F.col("_m")
    for _ in range(8):
        anomaly = F.col("_m") + e["Eccentricity"] * F.sin(anomaly)
    out = out.withColumn("_e", anomaly)
    ecc = e["Eccentricity"]
    true_anomaly = F.atan2(F.sqrt(1.0 - ecc * ecc) * F.sin("_e"), F.cos("_e") - ecc)
    out = out.withColumn("_phi", true_anomaly + e["omega"])
    c2, s2 = F.cos(F.col("_phi") * 2.0), F.sin(F.col("_phi") * 2.0)
    out = out.withColumns(
        {
            "_u": F.col("_phi") + e["Cuc"] * c2 + e["Cus"] * s2,
            "_r": F.col("_a") * (1.0 - ecc * F.cos("_e")) + e["Crc"] * c2 + e["Crs"] * s2,
            "_i": e["Io"] + e["Cic"] * c2 + e["Cis"] * s2 + e["IDOT"] * F.col("_tk"),
            "_node": e["Omega0"] + (e["OmegaDot"] - fixed.EARTH_ROTATION) * F.col("_tk")
            - e["Toe"] * fixed.EARTH_ROTATION,
        }
    )
    px, py = F.col("_r") * F.cos("_u"), F.col("_r") * F.sin("_u")
    node, tilt = F.col("_node"), F.col("_i")
    return out.withColumns(
        {
            "sat_x": px * F.cos(node) - py * F.cos(tilt) * F.sin(node),
            "sat_y": px * F.sin(node) + py * F.cos(tilt) * F.cos(node),
            "sat_z": py * F.sin(tilt),
        }
    ).drop("_tk", "_a", "_m", "_e", "_phi", "_u", "_r", "_i", "_node")
