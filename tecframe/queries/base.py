"""Registration, table access and the stand-ins for domain tables.

The given tables hold no satellite data, so a few of them stand in for it.
``links``: events, user as satellite; times are cut to milliseconds and the event
number fills the microseconds, so that events of one minute stay apart. Of rows of
one epoch the last event counts, as in all tracks; rows without a time have no
epoch and all stay. A track is one user in one month.
``observations``: line items. ``stations``: suppliers or customers on a
lattice of coordinates. ``swath``: embeddings, 64 lines of 64 pixels each.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tecframe.operators.sequences import last_per_epoch
from tecframe.session import use_utc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The parquet tables of one folder; times become instants."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = use_utc(spark), folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        df = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        times = [f.name for f in df.schema.fields if f.dataType.typeName() == "timestamp_ntz"]
        return df.withColumns({c: F.col(c).cast("timestamp") for c in times}) if times else df


def plain(df: DataFrame) -> DataFrame:
    """Instants back to zone-less timestamps, as the parquet tables have them; dates as ISO text."""
    kinds = {"timestamp": "timestamp_ntz", "date": "string"}
    casts = {
        f.name: F.col(f.name).cast(kinds[f.dataType.typeName()])
        for f in df.schema.fields if f.dataType.typeName() in kinds
    }
    return df.withColumns(casts) if casts else df


def query(name: str, sql: str, *, texts: tuple[str, ...] = ()):
    """Registers a query with its SQL.

    ``texts`` are columns that both sides give as text: dates, and integers
    that may be missing.
    """
    def register(fn: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            out = plain(fn(Tables(spark, folder)))
            return out.withColumns({c: text(c) for c in texts}) if texts else out

        QUERIES[name] = run
        as_text = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in texts)
        ORACLES[name] = f"SELECT * REPLACE ({as_text}) FROM ({sql.strip()})" if texts else sql.strip()
        return fn

    return register


def r6(value: Column | str, digits: int = 6) -> Column:
    x = F.col(value) if isinstance(value, str) else value
    return F.round(x, digits) + F.lit(0.0)


def long(value: Column | str) -> Column:
    return (F.col(value) if isinstance(value, str) else value).cast("long")


def text(value: Column | str) -> Column:
    return (F.col(value) if isinstance(value, str) else value).cast("string")


TRACK = ["period", "station_id", "sv"]
GAP_SEC = 8 * 3600
ROTI_ROWS = 3


def event_time() -> Column:
    micros = F.unix_micros("ts")
    return F.timestamp_micros(micros - F.pmod(micros, F.lit(1000)) + F.pmod("event_id", F.lit(1000)))


EVENT_TIME = "make_timestamp(epoch_us(ts) - epoch_us(ts) % 1000 + event_id % 1000)"


def links_of(events: DataFrame) -> DataFrame:
    return events.select(
        F.date_trunc("month", "ts").alias("period"),
        F.concat(F.lit("S"), F.floor(F.col("user_id") / 32).cast("string")).alias("station_id"),
        F.concat(F.lit("G"), F.lpad((F.col("user_id") % 32 + 1).cast("string"), 2, "0")).alias("sv"),
        event_time().alias("time"),
        F.col("value").alias("stec"), "event_type",
        (F.col("event_id") % 80 + 10).cast("double").alias("elev_deg"),
        (F.col("event_id") * 7 % 360).cast("double").alias("az_deg"),
        F.col("event_id").alias("ingest_pos"),
    )


def links(t: Tables) -> DataFrame:
    timed = F.col("ts").isNotNull() & F.col("event_id").isNotNull()
    return last_per_epoch(links_of(t.events.filter(timed)), TRACK).unionByName(links_of(t.events.filter(~timed)))


LINKS = f"""
links AS (
  SELECT date_trunc('month', ts) AS period, 'S' || CAST(user_id // 32 AS VARCHAR) AS station_id,
         'G' || lpad(CAST(user_id % 32 + 1 AS VARCHAR), 2, '0') AS sv,
         {EVENT_TIME} AS time, value AS stec, event_type,
         CAST(event_id % 80 + 10 AS DOUBLE) AS elev_deg,
         CAST(event_id * 7 % 360 AS DOUBLE) AS az_deg, event_id AS ingest_pos
  FROM (SELECT *, row_number() OVER (PARTITION BY user_id, {EVENT_TIME} ORDER BY event_id DESC) AS rn FROM events)
  WHERE rn = 1 OR {EVENT_TIME} IS NULL)"""

# arcs, rates and rate deviations on the links, as SQL
ARCS = LINKS + """,
gaps AS (
  SELECT *, CASE WHEN epoch_us(time) - epoch_us(lag(time) OVER w) > 28800000000 THEN 1 ELSE 0 END AS brk
  FROM links WINDOW w AS (PARTITION BY period, station_id, sv ORDER BY time)),
arcs AS (
  SELECT * EXCLUDE (brk), CAST(sum(brk) OVER (PARTITION BY period, station_id, sv ORDER BY time
           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS arc_id FROM gaps)"""
RATES = ARCS + """,
rates AS (
  SELECT *, (stec - lag(stec) OVER w) / ((epoch_us(time) - epoch_us(lag(time) OVER w)) / 6e7) AS rot
  FROM arcs WINDOW w AS (PARTITION BY period, station_id, sv, arc_id ORDER BY time)),
full_links AS (
  SELECT *, CASE WHEN count(rot) OVER f = 3 THEN stddev_pop(rot) OVER f END AS roti
  FROM rates WINDOW f AS (PARTITION BY period, station_id, sv, arc_id ORDER BY time
                          ROWS BETWEEN 2 PRECEDING AND CURRENT ROW))"""


def arcs(t: Tables) -> DataFrame:
    from tecframe.operators.sequences import gap_arcs

    return gap_arcs(links(t), TRACK, GAP_SEC)


def full_links(t: Tables) -> DataFrame:
    from tecframe.operators.sequences import rot, roti

    return roti(rot(arcs(t), TRACK), TRACK, ROTI_ROWS)


# swath: entry = 64 consecutive vectors, line = vector, pixel = element
def swath(t: Tables) -> DataFrame:
    e = t.embeddings.select(
        F.floor(F.col("vec_id") / 64).alias("entry_id"), (F.col("vec_id") % 64).alias("y"),
        F.transform("embedding", lambda v: v.cast("double")).alias("value"),
    )
    # every element moves its pixel a little; small elements mark invalid pixels
    return e.withColumns(
        {
            "lat": F.transform("value", lambda v, i: F.when(F.abs(v) >= 0.001, F.col("y") - 32.0 + v)),
            "lon": F.transform("value", lambda v, i: F.when(F.abs(v) >= 0.001, i - 32.0 + v * 2.0)),
        }
    )


SWATH = """
px AS (
  SELECT vec_id // 64 AS entry_id, vec_id % 64 AS y, CAST(i - 1 AS BIGINT) AS x, CAST(embedding[i] AS DOUBLE) AS value
  FROM embeddings, range(1, 65) AS r(i)),
pixels AS (
  SELECT *, CASE WHEN abs(value) >= 0.001 THEN y - 32.0::DOUBLE + value END AS lat,
            CASE WHEN abs(value) >= 0.001 THEN x - 32.0::DOUBLE + value * 2.0::DOUBLE END AS lon FROM px)"""


def stations(t: Tables) -> DataFrame:
    k = F.col("s_suppkey")
    return t.supplier.select(
        k.alias("key"), F.upper("s_name").alias("station_id"), F.col("s_nationkey").alias("nation"),
        (k % 160 - 80).cast("double").alias("lat"), (k * 7 % 360 - 180).cast("double").alias("lon"),
        F.col("s_acctbal").alias("height_m"),
    )


STATIONS = """
stations AS (
  SELECT s_suppkey AS key, upper(s_name) AS station_id, s_nationkey AS nation,
         CAST(s_suppkey % 160 - 80 AS DOUBLE) AS lat, CAST(s_suppkey * 7 % 360 - 180 AS DOUBLE) AS lon,
         s_acctbal AS height_m FROM supplier)"""
