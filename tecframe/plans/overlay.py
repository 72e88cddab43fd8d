"""Hot spots of the electron-content maps over swath scenes, and panel tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from tecframe import fixed
from tecframe.functions.arrays import native_step
from tecframe.functions.text import threshold_label
from tecframe.operators import joins, predicates
from tecframe.operators.pairing import pair_nearest


@dataclass(frozen=True)
class OverlaySpec:
    name: str = "roti_on_gold"
    metric: str = "roti"
    producer: str = "internal"
    threshold: float = fixed.OVERLAY_THRESHOLD
    bin_deg: float = fixed.OVERLAY_BIN_DEG
    tolerance_min: float = fixed.OVERLAY_TOLERANCE_MIN


class OverlayTables(NamedTuple):
    pairs: DataFrame
    points: DataFrame


def slice_points(slices: DataFrame, spec: OverlaySpec, bbox: dict[str, float] = fixed.BBOX) -> DataFrame:
    """Cells above the threshold inside the map: native cells, or centres of wider bins.

    slices: slice_id, time, lat[], lon[], values[][].
    """
    wrapped = predicates.wrap_lon_axis(slices)
    inside = lambda v, lo, hi: F.filter(v, lambda x: x.between(lo, hi))
    step = native_step(
        inside(F.col("lat"), bbox["lat_min"], bbox["lat_max"]),
        inside(F.sort_array("lon"), bbox["lon_min"], bbox["lon_max"]),
    )
    rows = wrapped.select(
        "slice_id", (F.lit(spec.bin_deg) <= step + 1e-9).alias("native"), "lat",
        F.col("lon").alias("_lon"), F.posexplode("values").alias("_i", "_line"),
    ).select(
        "slice_id", "native", F.get("lat", F.col("_i")).alias("lat"),
        F.explode(F.arrays_zip(F.col("_lon").alias("lon"), F.col("_line").alias("v"))).alias("_c"),
    ).select("slice_id", "native", "lat", F.col("_c.lon").alias("lon"), F.col("_c.v").alias("value"))
    hot = predicates.above(predicates.in_bbox(rows, bbox), "value", spec.threshold)
    if spec.bin_deg <= 0:
        return hot.select("slice_id", "lat", "lon")
    west, south = bbox["lon_min"], bbox["lat_min"]
    # cells of one bin meet map-side; native cells are their own bin
    xi = F.when(~F.col("native"), F.floor((F.col("lon") - west) / spec.bin_deg))
    yi = F.when(~F.col("native"), F.floor((F.col("lat") - south) / spec.bin_deg))
    own = lambda c: F.when(F.col("native"), F.col(c))
    bins = hot.select("slice_id", xi.alias("xi"), yi.alias("yi"), own("lat").alias("lat"), own("lon").alias("lon")).distinct()
    return bins.select(
        "slice_id",
        F.coalesce("lat", south + (F.col("yi") + 0.5) * spec.bin_deg).alias("lat"),
        F.coalesce("lon", west + (F.col("xi") + 0.5) * spec.bin_deg).alias("lon"),
    )


def build_overlay(
    slices: DataFrame, scenes: DataFrame, spec: OverlaySpec = OverlaySpec(),
    explicit: DataFrame | None = None, bbox: dict[str, float] = fixed.BBOX, by: Sequence[str] = (),
) -> OverlayTables:
    """Pairs with their status, and the points of every paired slice.

    scenes: scene_id, midpoint, cha_time, chb_time. Explicit pairs replace the
    nearest-time pairing. ``by`` names the event column where the tables hold
    more than one event (explicit pairs have it, too). An event without slices
    or scenes, or without pairs within the tolerance, has one skipped row that
    says so.
    """
    by = list(by)
    if explicit is None:
        found = pair_nearest(
            slices, scenes, spec.tolerance_min * 60.0, by, left_id="slice_id", right_id="scene_id",
            right_time="midpoint",
        ).select(
            *by, F.col("left_id").alias("slice_id"), F.col("right_id").alias("scene_id"),
            F.col("left_time").alias("gnss_time"), F.col("right_time").alias("gold_time"),
            F.col("delta_sec").alias("delta_seconds"), F.lit("ready").alias("status"), F.lit("").alias("detail"),
        )
    else:
        found = joins.explicit_pairs(explicit, slices, scenes).select(
            *by, "slice_id", "scene_id", "gnss_time", "gold_time", "delta_seconds", "status", "detail"
        )
    state = event_state(slices, scenes, found, by)
    both = F.col("has_slices") & F.col("has_scenes")
    if by:
        found = found.withColumn("_k", event_key(by)).join(state.filter(both).select("_k"), "_k", "left_semi").drop("_k")
    else:
        found = found.filter(state.select(both.alias("both")).scalar())
    points = slice_points(slices, spec, bbox)
    counts = points.groupBy("slice_id").agg(F.count(F.lit(1)).alias("_n"))
    judged = found.join(counts, "slice_id", "left")
    n = F.coalesce("_n", F.lit(0))
    removed = (F.col("status") == "ready") & (n == 0)
    pairs = judged.select(
        F.lit(spec.name).alias("overlay_name"), F.lit(spec.metric).alias("metric"), *by,
        "slice_id", "scene_id", "gnss_time", "gold_time", "delta_seconds",
        F.when(removed, F.lit("skipped")).otherwise(F.col("status")).alias("status"),
        F.when(removed, F.lit("threshold_removed_all_pixels")).otherwise(F.col("detail")).alias("detail"),
        n.alias("points"),
        F.when(n > 0, threshold_label(spec.metric, spec.threshold, n)).alias("label"),
    )
    used = pairs.filter(F.col("status") == "ready").select("slice_id")
    reason = F.when(~(F.col("has_slices") & F.col("has_scenes")), F.lit("missing_gnss_or_gold"))
    if explicit is None:
        reason = reason.when(~F.col("has_pairs"), F.lit("no_pairs_within_tolerance"))
    reasons = state.withColumn("detail", reason).filter(F.col("detail").isNotNull()).select(
        F.lit(spec.name).alias("overlay_name"), F.lit(spec.metric).alias("metric"), *by, F.lit("skipped").alias("status"), "detail"
    )
    return OverlayTables(pairs.unionByName(reasons, allowMissingColumns=True), points.join(used, "slice_id", "left_semi"))


def event_key(by: Sequence[str]) -> Column:
    """One text for all columns that name an event, missing ones included."""
    return F.to_json(F.struct(*[F.col(b).alias(f"k{i}") for i, b in enumerate(by)]))


def event_state(slices: DataFrame, scenes: DataFrame, found: DataFrame, by: Sequence[str]) -> DataFrame:
    """by, _k, has_slices, has_scenes, has_pairs of every event; without ``by``, the flags of the one event there is."""
    none, some = F.lit(False), F.lit(True)
    sides = [df.select(*by, *flags) for df, flags in ((slices, (some, none, none)), (scenes, (none, some, none)), (found, (none, none, some)))]
    if not by:
        sides.append(slices.sparkSession.range(1).select(none, none, none))
    rows = sides[0].toDF(*by, "has_slices", "has_scenes", "has_pairs")
    for side in sides[1:]:
        rows = rows.union(side)
    flags = [F.bool_or(c).alias(c) for c in ("has_slices", "has_scenes", "has_pairs")]
    return rows.groupBy(*by, event_key(by).alias("_k")).agg(*flags) if by else rows.agg(*flags)


def build_panel(
    slots: DataFrame, slices: DataFrame, scenes: DataFrame, spec: OverlaySpec = OverlaySpec(),
    bbox: dict[str, float] = fixed.BBOX,
) -> DataFrame:
    """Status of every panel slot; overlay slots also tell when the threshold left nothing."""
    resolved = joins.resolve_slots(
        check_slots(slots), slices, scenes, overlay_producer=spec.producer, overlay_metric=spec.metric
    )
    # only slices that a slot shows are cut into cells
    shown = resolved.filter(F.col("kind") == "overlay").select("slice_id").distinct()
    counts = slice_points(slices.join(shown, "slice_id", "left_semi"), spec, bbox).groupBy("slice_id").agg(F.count(F.lit(1)).alias("_n"))
    out = resolved.join(counts, "slice_id", "left")
    nothing = (F.col("kind") == "overlay") & (F.col("status") == "ready") & F.col("_n").isNull()
    return out.withColumn(
        "detail", F.when(nothing, F.lit("threshold_removed_all_pixels")).otherwise(F.col("detail"))
    ).select(*resolved.columns)


# fixed values: slot kinds and producers that a panel may name
PANEL_KINDS = ("gnss_roti", "gnss_vtec", "gold", "overlay")
PRODUCERS = ("internal", "isee")


def check_slots(slots: DataFrame) -> DataFrame:
    """Rows that break a rule of the panel configuration fail when they are read."""
    fail = lambda text: F.raise_error(F.lit(text)).cast("string")
    kind = F.lower("kind")
    is_map = kind.isin("gnss_roti", "gnss_vtec")
    no_gold = F.col("gold_cha_time").isNull() | F.col("gold_chb_time").isNull()
    checked = (
        F.when(kind.isNull() | ~kind.isin(*PANEL_KINDS), fail("unknown panel slot kind"))
        .when(is_map & F.col("timestamp").isNull(), fail("a map slot needs a timestamp"))
        .when(is_map & ~F.lower("producer").isin(*PRODUCERS), fail("unknown producer of a map slot"))
        .when((kind == "gold") & no_gold, fail("a gold slot needs both times"))
        .when((kind == "overlay") & (no_gold | F.col("gnss_time").isNull()), fail("an overlay slot needs three times"))
        .otherwise(kind)
    )
    return slots.withColumn("kind", checked)


# fixed values: colour bars that a panel may share
COLORBARS = ("gold", "gnss_roti", "gnss_vtec")


def check_panels(panels: DataFrame, slots: DataFrame) -> DataFrame:
    """Panels with their slot count; a panel that breaks a layout rule fails when it is read.

    panels: panel_name, rows, cols, shared_colorbar.
    """
    counts = slots.groupBy("panel_name").agg(F.count(F.lit(1)).alias("slots"))
    out = panels.join(counts, "panel_name", "left").withColumn("slots", F.coalesce("slots", F.lit(0)))
    fail = lambda text: F.raise_error(F.lit(text)).cast("string")
    checked = (
        F.when((F.col("rows") <= 0) | (F.col("cols") <= 0), fail("panel rows and cols must be positive"))
        .when(~F.coalesce(F.lower("shared_colorbar").isin(*COLORBARS), F.lit(False)), fail("unknown shared colour bar"))
        .when(F.col("slots") != F.col("rows") * F.col("cols"), fail("a panel needs rows * cols slots"))
        .otherwise(F.col("panel_name"))
    )
    return out.withColumn("panel_name", checked)
