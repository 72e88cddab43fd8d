"""Station-day manifests."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tecframe.functions.text import status_error
from tecframe.operators import joins, predicates, sets
from tecframe.sources.listing import observation_candidates


def build_station_days(
    listing: DataFrame, nav: DataFrame, *, default_sampling: int = 30,
    overrides: dict[str, str] | None = None,
) -> DataFrame:
    """One row per date and code, with its navigation file.

    listing: event_id, path, source, source_priority, observation_date.
    nav: observation_date, path, status.
    """
    found = observation_candidates(listing, default_sampling=default_sampling, overrides=overrides)
    chosen = sets.best_source(
        found.withColumnRenamed("path", "obs_path").withColumn("status", F.lit("ok"))
    )
    return joins.attach_nav(
        chosen.withColumnRenamed("status", "obs_status").withColumn("obs_error", F.lit("")), nav
    )


def normalise(manifest: DataFrame, files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(records ready for processing, failures with their reason).

    ``files`` has the paths that exist. A row fails for its status, then for a
    missing observation file, then for a missing navigation file.
    """
    paths = files.select("path").distinct()
    obs_ok = paths.select(F.col("path").alias("obs_path"), F.lit(True).alias("_obs"))
    nav_ok = paths.select(F.col("path").alias("nav_path"), F.lit(True).alias("_nav"))
    known = manifest.join(obs_ok, "obs_path", "left").join(nav_ok, "nav_path", "left")
    error = (
        F.when(~predicates.status_ok(), status_error("obs_status", "nav_status"))
        .when(F.col("_obs").isNull(), F.lit("observation_file_missing"))
        .when(F.col("_nav").isNull(), F.lit("navigation_file_missing"))
    )
    judged = known.withColumn("error", error)
    good = judged.filter(F.col("error").isNull()).select(
        "event_id", "observation_date", "source", "station_id",
        F.upper("station_code4").alias("station_code4"),
        F.when(F.col("sampling_sec") == 0, 30).otherwise(F.coalesce("sampling_sec", F.lit(30))).alias("sampling_sec"),
        "obs_path", "nav_path", "lat", "lon", "height_m",
    )
    positioned = joins.attach_position(good, manifest.filter(predicates.status_ok()))
    failures = judged.filter(F.col("error").isNotNull()).select(
        "event_id", "observation_date", "station_id", "obs_path", "nav_path", "error"
    )
    return positioned, failures
