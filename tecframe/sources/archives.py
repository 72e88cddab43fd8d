"""Index of the members of tar archives."""

from __future__ import annotations

import tarfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from tecframe.functions.text import parse_swath_name
from tecframe.sources.listing import list_assets

MEMBER_SCHEMA = "tar_path string, member string, offset long, size long"


def index_archives(spark: SparkSession, root: str, glob: str = "*.tar") -> DataFrame:
    """One row per swath member: tar_path, member, hemisphere, obs_time, offset, size."""
    return swath_entries(tar_members(list_assets(spark, root, glob)))


def tar_members(files: DataFrame) -> DataFrame:
    """One row per regular member. A task seeks from header to header of its archives."""
    width = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    paths = files.select("path").repartition(width, "path")
    return paths.mapInPandas(_members, MEMBER_SCHEMA)


def _members(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        for path in pdf["path"]:
            rows = list(read_members(path))
            if rows:
                yield pd.DataFrame(rows, columns=["tar_path", "member", "offset", "size"])


def read_members(uri: str) -> Iterator[tuple[str, str, int, int]]:
    """Members up to the end or up to the point where the archive breaks off."""
    from pyarrow import fs

    system, path = fs.FileSystem.from_uri(uri) if ":" in uri else (fs.LocalFileSystem(), uri)
    with system.open_input_file(path) as handle, tarfile.open(fileobj=handle, mode="r:") as tar:
        while True:
            try:
                member = tar.next()
            except tarfile.ReadError:
                return
            if member is None:
                return
            if member.isfile():
                yield uri, member.name, member.offset_data, member.size


def swath_entries(members: DataFrame) -> DataFrame:
    """Members whose name tells hemisphere and time."""
    return (
        members.withColumn("_f", parse_swath_name("member"))
        .filter(F.col("_f").isNotNull())
        .select("tar_path", "member", "_f.hemisphere", "_f.obs_time", "offset", "size")
    )
