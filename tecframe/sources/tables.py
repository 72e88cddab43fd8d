"""Reading and writing of tables."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from tecframe import fixed
from tecframe.functions._col import micros
from tecframe.functions.indices import null_if

# fixed values: columns of the three index files
OMNI_SCHEMAS = {
    "bz": "Time TIMESTAMP, IMF_Bz_nT DOUBLE",
    "hourly": "Time TIMESTAMP, Kp_code DOUBLE, Dst_nT DOUBLE, PlotTime TIMESTAMP, Kp DOUBLE",
    "kp": "KpStart TIMESTAMP, Kp DOUBLE, KpEnd TIMESTAMP",
}


def read_parts(spark: SparkSession, root: str, stem: str) -> DataFrame:
    """``stem.parquet`` when it exists, else all ``stem.part*.parquet``."""
    try:
        return spark.read.parquet(f"{root}/{stem}.parquet")
    except AnalysisException:
        return spark.read.option("mergeSchema", "true").parquet(f"{root}/{stem}.part*.parquet")


def _format(path: str) -> str:
    for suffix in ("csv", "parquet"):
        if path.lower().endswith("." + suffix):
            return suffix
    raise ValueError(f"unsupported table suffix: {path}")


def load_table(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """The suffix decides the format. CSV takes a schema, so that no extra pass is made."""
    if _format(path) == "parquet":
        return spark.read.parquet(path)
    reader = spark.read.option("header", "true").option("escape", '"').option("multiLine", "true")
    return (reader.schema(schema) if schema else reader).csv(path)


def save_table(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    if _format(path) == "parquet":
        df.write.mode(mode).parquet(path)
    else:
        df.write.mode(mode).option("header", "true").option("escape", '"').csv(path)


def read_omni(spark: SparkSession, path: str, kind: str, *, header: bool = True) -> DataFrame:
    """Index series of one kind from one scan of the lines; blank lines are skipped.

    A line that reports a service error fails when it is read. With ``header``,
    lines that name the columns are left out, wherever a part of the file begins.
    """
    fields = T.StructType.fromDDL(OMNI_SCHEMAS[kind])
    line = F.regexp_replace("value", "^\ufeff", "")
    failed = F.raise_error(F.concat(F.lit("the service reported an error: "), F.substring(line, 1, 200))).cast("string")
    lines = spark.read.text(path).select(F.when(F.contains(line, F.lit("HAPI error")), failed).otherwise(line).alias("line"))
    lines = lines.filter(F.trim("line") != "")
    if header:
        title = F.lower(F.regexp_replace("line", "[\"\\s]", ""))
        lines = lines.filter(title != ",".join(fields.names).lower())
    frame = lines.select(F.from_csv("line", OMNI_SCHEMAS[kind]).alias("row")).select("row.*")
    if kind == "bz":
        frame = frame.withColumn("IMF_Bz_nT", null_if("IMF_Bz_nT", fixed.BZ_MISSING))
    return frame


def write_omni(df: DataFrame, path: str) -> None:
    """Times are written as ISO seconds with Z."""
    times = [f.name for f in df.schema.fields if f.dataType.typeName().startswith("timestamp")]
    text = df.withColumns({c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'Z'") for c in times}) if times else df
    text.write.mode("overwrite").option("header", "true").csv(path)


def with_chunks(grid: DataFrame, events: DataFrame, cadence_min: int = fixed.GRID_CADENCE_MIN) -> DataFrame:
    """Adds chunk_start (hour) and chunk_end (last interval of the hour, or the event's end)."""
    start = F.date_trunc("hour", F.col("time"))
    last = F.timestamp_micros(micros(start) + (3600 - cadence_min * 60) * 1_000_000)
    return (
        grid.join(events.select("event_id", "end_utc"), "event_id")
        .withColumns({"chunk_start": start, "chunk_end": F.least(last, F.col("end_utc"))})
        .drop("end_utc")
    )


# rows of one file of an hour, about
HOUR_ROWS = 2_000_000


def write_hourly(grid: DataFrame, path: str, rows: int = HOUR_ROWS) -> None:
    """A folder per event and hour, written side by side; an empty grid writes no data.

    An hour of more than ``rows`` rows is dealt to as many tasks as it needs
    files. The number of tasks is fixed: merging small partitions would leave
    one task with all the files.
    """
    tasks = int(grid.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hour = ["event_id", "chunk"]
    keyed = grid.withColumn("chunk", F.date_format("chunk_start", "yyyyMMdd_HH'00'"))
    sizes = keyed.groupBy(*hour).agg(F.ceil(F.count(F.lit(1)) / rows).alias("_files"))
    salt = F.pmod(F.xxhash64(*grid.columns), F.col("_files"))
    (
        keyed.join(sizes, hour).withColumn("_salt", salt)
        .repartition(tasks, *hour, "_salt").drop("_files", "_salt")
        .write.mode("overwrite").partitionBy(*hour).parquet(path)
    )


def save_by_key(df: DataFrame, path: str, key: str = "producer") -> None:
    """A folder per value of the key, so that one of them can be replaced alone."""
    df.write.mode("overwrite").partitionBy(key).parquet(path)


def replace_in_place(new: DataFrame, path: str, value: str, key: str = "producer") -> None:
    """Replaces the rows of one producer in a table of ``save_by_key``; files of the others are not touched.

    All rows of ``new`` count as the producer's, whatever their key says. No rows
    leave none. Rows without a key stay. ``new`` must not read the folder that is replaced.
    """
    if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9_.-]*", value):
        raise ValueError(f"not a folder name: {value!r}")
    new.drop(key).write.mode("overwrite").parquet(f"{path}/{key}={value}")


# rows of one file of an ordered table, at most
ORDERED_ROWS = 5_000_000


def write_ordered(df: DataFrame, path: str, order: Sequence[str], rows: int = ORDERED_ROWS) -> None:
    """A table whose files follow each other in the given order; nulls first.

    Rows are dealt by range and sorted inside their task, so no task sorts the
    table. Rows of one key may spread over several tasks: the other columns
    break the tie. ``_order`` keeps for each file its place, its least and
    greatest key, its rows and the rows before it; readers of the plain table
    don't see it. The same rows in any number of tasks give the same order.
    """
    if not order:
        raise ValueError("an ordered table needs the columns of its order")
    sortable = [f.name for f in df.schema.fields if f.name not in order and not isinstance(f.dataType, (T.MapType, T.VariantType))]
    full = [*order, *sortable]
    dealt = df.repartitionByRange(*full).sortWithinPartitions(*full)
    dealt.write.mode("overwrite").option("maxRecordsPerFile", rows).parquet(path)
    files = (
        df.sparkSession.read.schema(df.schema).parquet(path)
        .select(F.col("_metadata.file_name").alias("file"), F.struct(*order).alias("key"))
        .groupBy("file").agg(F.min("key").alias("low"), F.max("key").alias("high"), F.count(F.lit(1)).alias("rows"))
    )
    # one row per file; the part number of a name comes first, then the number inside the task
    place = F.struct(F.regexp_extract("file", r"part-(\d+)", 1).cast("int"), F.regexp_extract("file", r"-c(\d+)\.", 1).cast("int"))
    before = Window.orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    listed = files.withColumn("place", place).withColumns(
        {"before": F.coalesce(F.sum("rows").over(before), F.lit(0)), "nth": F.row_number().over(Window.orderBy("place"))}
    )
    listed.drop("place").coalesce(1).write.mode("overwrite").parquet(f"{path}/_order")


def read_ordered(spark: SparkSession, path: str, position: str = "position") -> DataFrame:
    """An ordered table with the place of each row, from 0: its file's rows before and its row in the file, without a sort."""
    files = spark.read.parquet(f"{path}/_order").select(F.col("file").alias("_file"), F.col("before").alias("_before"))
    rows = spark.read.parquet(path)
    at = rows.select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    return at.join(files, "_file").select(*rows.columns, (F.col("_before") + F.col("_row")).alias(position))


def order_problems(spark: SparkSession, path: str) -> DataFrame:
    """Neighbouring files whose ranges overlap: (nth, high, next_low); none where the order holds."""
    files = spark.read.parquet(f"{path}/_order")
    after = files.select((F.col("nth") - 1).alias("nth"), F.col("low").alias("next_low"))
    return files.join(after, "nth").where(F.col("high") > F.col("next_low")).select("nth", "high", "next_low")
