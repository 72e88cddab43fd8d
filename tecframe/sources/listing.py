"""File listings as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tecframe.functions.text import parse_observation_name


def list_assets(spark: SparkSession, root: str, glob: str = "*", path_regex: str | None = None) -> DataFrame:
    """(path, length) of the non-empty files below ``root``; contents are not read."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", "true")
        .load(root)
        .select("path", "length")
    )
    return usable(files, path_regex)


def usable(files: DataFrame, path_regex: str | None = None) -> DataFrame:
    """Empty files do not count."""
    kept = files.filter(F.col("length") > 0)
    return kept.filter(F.rlike("path", F.lit(path_regex))) if path_regex else kept


def first_path_per_day(files: DataFrame, *, day: str = "observation_date") -> DataFrame:
    return files.groupBy(day).agg(F.min("path").alias("path"))


def event_segments(files: DataFrame) -> DataFrame:
    """Files named ``<event>_...``; an event without such files keeps ``<event>.<suffix>``.

    files: event_id, path.
    """
    name = F.regexp_extract("path", r"([^/]*)$", 1)
    tagged = files.withColumn("_seg", F.startswith(name, F.concat("event_id", F.lit("_"))))
    whole = F.startswith(name, F.concat("event_id", F.lit(".")))
    tagged = tagged.filter(F.col("_seg") | whole)
    has = tagged.groupBy("event_id").agg(F.bool_or("_seg").alias("_has"))
    return tagged.join(has, "event_id").filter(F.col("_seg") == F.col("_has")).select("event_id", "path")


def observation_candidates(
    files: DataFrame, *, default_sampling: int = 30, overrides: dict[str, str] | None = None
) -> DataFrame:
    """Station fields of every observation file; other names drop out."""
    parsed = parse_observation_name("path", default_sampling=default_sampling, overrides=overrides)
    return files.withColumn("_f", parsed).filter(F.col("_f").isNotNull()).select(*files.columns, "_f.*")
