"""Session set-up and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings that every job relies on; cluster sizing stays with spark-submit.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # rows of a batch may be long texts
    "spark.sql.execution.arrow.maxBytesPerBatch": "64m",
    # call sites of every expression cost more than building the plans
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


_LOCAL_ROOTS: dict[str, str] = {}


def build_session(
    master: str | None = None, app: str = "tecframe", extra: dict[str, str] | None = None
) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """All times are UTC; a caller's session may have another zone."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint folder of the cluster.

    The folder is the one named in ``spark.checkpoint.dir``. Where that is
    unset, a session on this machine alone takes a temporary folder; on a
    cluster, whose machines don't see each other's folders, it is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = _LOCAL_ROOTS.setdefault(spark.sparkContext.applicationId, "") or tempfile.mkdtemp(prefix="tecframe-")
        _LOCAL_ROOTS[spark.sparkContext.applicationId] = root
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def settle(df: DataFrame, name: str) -> DataFrame:
    """Writes a table to the shared folder and reads it back: its plan ends there, and lost executors cost nothing."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Lets ``checkpoint()`` write to the shared folder; a folder already set stays."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(scratch_dir(spark, "checkpoint"))
