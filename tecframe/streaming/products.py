"""Finished files picked up as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tecframe.session import scratch_dir


def stream_products(spark: SparkSession, folder: str, schema: StructType | str, *, max_files: int | None = None) -> DataFrame:
    """Parquet files of a folder as a stream; writers commit whole files only."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(folder)


def append_available(stream: DataFrame, target: str, *, checkpoint: str | None = None) -> StreamingQuery:
    """Appends everything that is there and stops; a rerun goes on where it left off."""
    place = checkpoint or scratch_dir(stream.sparkSession, "stream")
    return (
        stream.writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", place)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
