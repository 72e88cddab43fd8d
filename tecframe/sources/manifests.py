"""Manifest tables: provenance and status rows, kept as CSV or parquet."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tecframe.sources.tables import _format

# fixed values: columns of the manifest tables
SCHEMAS = {
    "source_assets": "event_id STRING, source_kind STRING, provider STRING, asset_id STRING, local_path STRING, status STRING, metadata_json STRING",
    "gnss_products": "event_id STRING, producer STRING, source_kind STRING, path STRING, metrics_json STRING, time_start TIMESTAMP, time_end TIMESTAMP, metadata_json STRING",
    "gnss_station_candidates": "event_id STRING, provider STRING, station_id STRING, station_code4 STRING, observation_date STRING, sampling_sec INT, lat DOUBLE, lon DOUBLE, height_m DOUBLE, obs_url STRING, nav_url STRING, status STRING, metadata_json STRING",
    "gnss_download_assets": "event_id STRING, source_kind STRING, provider STRING, protocol STRING, station_id STRING, station_code4 STRING, observation_date STRING, url STRING, local_path STRING, status STRING, attempts INT, error STRING, auth_ref STRING, metadata_json STRING",
    "gold_scenes": "event_id STRING, tar_path STRING, midpoint TIMESTAMP, cha_member STRING, chb_member STRING, cha_time TIMESTAMP, chb_time TIMESTAMP, delta_minutes DOUBLE",
    "omni_series": "event_id STRING, start_utc TIMESTAMP, end_utc TIMESTAMP, bz_csv_path STRING, hourly_csv_path STRING, kp_csv_path STRING",
    "migration": "project STRING, source_kind STRING, event_id STRING, cached_path STRING, original_relpath STRING, size_bytes BIGINT",
    "stage_status": "stage STRING, target STRING, status STRING, detail STRING",
    "panel_outputs": "panel_name STRING, slot_index INT, kind STRING, requested_time TIMESTAMP, resolved_time TIMESTAMP, status STRING, detail STRING, output_path STRING",
    "overlay_pairs": "overlay_name STRING, metric STRING, gnss_time TIMESTAMP, gold_time TIMESTAMP, delta_seconds DOUBLE, status STRING, detail STRING, output_path STRING",
}


def sorted_json(value: Column) -> Column:
    """A map as JSON text with its keys in order."""
    return F.to_json(F.map_from_entries(F.sort_array(F.map_entries(value))))


def decode(df: DataFrame) -> DataFrame:
    """JSON text to map and array columns; empty text to NULL."""
    out = df.withColumns(
        {f.name: F.nullif(F.col(f.name), F.lit("")) for f in df.schema.fields if f.dataType.typeName() == "string"}
    )
    if "metadata_json" in out.columns:
        parsed = F.from_json("metadata_json", "map<string,string>")
        empty = F.create_map().cast("map<string,string>")
        out = out.withColumn("metadata", F.coalesce(parsed, empty)).drop("metadata_json")
    if "metrics_json" in out.columns:
        names = F.transform(F.from_json("metrics_json", "array<string>"), lambda m: F.lower(m))
        out = out.withColumn("metrics", F.coalesce(names, F.array().cast("array<string>"))).drop("metrics_json")
    return out


def encode(df: DataFrame, name: str) -> DataFrame:
    """Map and array columns to JSON text, columns in the fixed order."""
    wanted = [part.strip().split(" ")[0] for part in SCHEMAS[name].split(",")]
    made = {"metadata_json": ("metadata", sorted_json), "metrics_json": ("metrics", F.to_json)}
    cols = []
    for c in wanted:
        if c in made and made[c][0] in df.columns:
            source, encoder = made[c]
            cols.append(encoder(F.col(source)).alias(c))
        elif c in df.columns:
            cols.append(F.col(c))
        else:
            cols.append(F.lit(None).cast("string").alias(c))
    return df.select(*cols)


def read_manifest(spark: SparkSession, name: str, path: str) -> DataFrame:
    reader = spark.read.schema(SCHEMAS[name])
    if _format(path) == "parquet":
        return decode(reader.parquet(path))
    return decode(reader.option("header", "true").option("escape", '"').option("multiLine", "true").csv(path))


def write_manifest(df: DataFrame, name: str, path: str) -> None:
    table = encode(df, name)
    if _format(path) == "parquet":
        table.write.mode("overwrite").parquet(path)
    else:
        table.write.mode("overwrite").option("header", "true").option("escape", '"').csv(path)
