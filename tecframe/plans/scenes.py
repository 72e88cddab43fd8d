"""Swath scenes and their pixels."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, functions as F

from tecframe import fixed
from tecframe.functions.arrays import pick_nearest
from tecframe.functions.timefn import delta_minutes, midpoint
from tecframe.operators import aggregates, predicates
from tecframe.operators.assertions import refuse_empty
from tecframe.operators.pairing import pair_nearest, unmatched


class SceneTables(NamedTuple):
    scenes: DataFrame
    unmatched: DataFrame


def build_scenes(
    entries: DataFrame, events: DataFrame | None = None, *, tolerance_min: float = fixed.PAIR_TOLERANCE_MIN
) -> SceneTables:
    """Pairs of the two hemispheres, per archive and UTC date.

    entries: tar_path, member, hemisphere, obs_time; a member name is unique.
    Reading the scenes fails where there is none at all.
    """
    dated = entries.withColumn("obs_day", F.to_date("obs_time"))
    side = lambda h: dated.filter(F.col("hemisphere") == h)
    pairs = pair_nearest(
        side("CHA"), side("CHB"), tolerance_min * 60.0, ["tar_path", "obs_day"],
        left_id="member", right_id="member", left_time="obs_time", right_time="obs_time",
    )
    scenes = pairs.select(
        "tar_path", midpoint("left_time", "right_time").alias("midpoint"),
        F.col("left_id").alias("cha_member"), F.col("right_id").alias("chb_member"),
        F.col("left_time").alias("cha_time"), F.col("right_time").alias("chb_time"),
        delta_minutes("left_time", "right_time").alias("delta_minutes"),
    )
    rest = unmatched(entries, pairs, entry_id="member")
    if events is not None:
        scenes = predicates.on_event_days(scenes, events)
    return SceneTables(refuse_empty(scenes, "no scene pairs in the archives"), rest)


def build_pixels(
    swaths: DataFrame, *, target_nm: float = fixed.TARGET_NM, quality_mode: str = "all",
    max_angle: float | None = fixed.MAX_EMISSION_ANGLE_DEG,
) -> DataFrame:
    """Radiance at the target wavelength, invalid pixels masked."""
    picked = swaths.withColumn("radiance", pick_nearest("wavelength", "radiance", target_nm)).drop("wavelength")
    return predicates.valid_pixels(
        picked, quality="quality" if "quality" in swaths.columns else None,
        emission="emission" if "emission" in swaths.columns else None,
        quality_mode=quality_mode, max_angle=max_angle,
    )


def build_pixel_grid(swaths: DataFrame, extent: aggregates.Extent, step: float, **rules) -> DataFrame:
    """Mean radiance of all swaths on a regular grid."""
    return aggregates.mean_grid(build_pixels(swaths, **rules), extent, step)
