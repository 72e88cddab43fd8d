"""Set operations, rankings and selections."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from tecframe.functions.timefn import time_index
from tecframe.operators.joins import first_per_key


def union_all(*frames: DataFrame) -> DataFrame:
    """Bag union by column name; missing columns are NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def missing_times(rows: DataFrame, events: DataFrame, cadence_min: int) -> DataFrame:
    """(event_id, time) of the event's intervals without a row."""
    wanted = events.select(
        "event_id", F.explode(time_index("start_utc", "end_utc", cadence_min)).alias("time")
    ).distinct()
    return wanted.join(rows.select("event_id", "time").distinct(), ["event_id", "time"], "left_anti")


def all_keys(a: DataFrame, b: DataFrame) -> DataFrame:
    """(observation_date, upper code) of either table."""
    pick = lambda d: d.select("observation_date", F.upper("station_code4").alias("station_code4"))
    return pick(a).union(pick(b)).distinct()


def distinct_first(df: DataFrame, keys: Sequence[str], *, position: str) -> DataFrame:
    """First occurrence of every key."""
    return first_per_key(df, list(keys), [position])


def best_source(candidates: DataFrame) -> DataFrame:
    """One candidate per (date, code): ok before error, then priority, source, path."""
    ranked = candidates.withColumns(
        {
            "station_code4": F.upper("station_code4"),
            "_bad": (F.coalesce(F.col("status"), F.lit("")) != "ok").cast("int"),
        }
    )
    return first_per_key(
        ranked, ["observation_date", "station_code4"], ["_bad", "source_priority", "source", "obs_path"]
    ).drop("_bad")


def rank_satellites(cov: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rank by score, longest arc, name among the satellites of one station.

    A station has at most a few dozen satellites. Satellites without valid
    samples keep a NULL rank.
    """
    order = [F.desc("score"), F.desc("longest_arc"), F.asc("sv")]
    empty = F.col("score") == 0
    w = Window.partitionBy(*by, empty).orderBy(*order)
    return cov.withColumn("rank", F.when(~empty, F.row_number().over(w).cast("long")))


def top_satellites(cov: DataFrame, k: int, by: Sequence[str]) -> DataFrame:
    """The k best qualified satellites of each station."""
    return rank_satellites(cov.filter("qualified"), by).filter(F.col("rank") <= k)


def too_few(cov: DataFrame, k: int, station: str) -> DataFrame:
    """(problem): says so where a station has fewer than k qualified satellites, with the eight best coverage lines."""
    text = F.format_string("%s: score=%d, vtec=%d, roti=%d, longest_arc=%d", "sv", "score", "valid_vtec", "valid_roti", "longest_arc")
    line = F.struct((-F.col("score")).alias("a"), (-F.col("longest_arc")).alias("b"), "sv", text.alias("t"))
    # a station sees a few dozen satellites
    found = cov.agg(F.count_if("qualified").alias("n"), F.slice(F.sort_array(F.collect_list(line)), 1, 8).alias("best"))
    lines = F.when(F.size("best") == 0, F.lit("no candidate satellites")).otherwise(F.array_join(F.transform("best", lambda b: b["t"]), "; "))
    short = F.concat(F.lit(f"station {station} has only "), F.col("n").cast("string"), F.lit(" qualified satellites. Coverage: "), lines)
    return found.select(F.when(F.col("n") < k, short).alias("problem"))


def require_top(cov: DataFrame, k: int) -> None:
    """Raises at once when a station has fewer than k qualified satellites."""
    problem = too_few(cov, k, "here").first().problem
    if problem:
        raise ValueError(problem)


def select_station_days(
    days: DataFrame, limit: int, priority: Sequence[str] = (), *, by: str = "event_id"
) -> DataFrame:
    """At most ``limit`` station-days per event: priority stations, then an even spread.

    Ranks follow (date, has position, lat, lon, source priority, code, id). The
    rank inside a date is a window over the stations of that one date; the
    dates before it enter as a running count of dates.
    """
    if limit <= 0:
        return days
    codes = [c.upper() for c in priority]
    wanted = F.coalesce(
        F.upper("station_code4").isin(codes) | F.upper("station_id").isin(codes), F.lit(False)
    ) if codes else F.lit(False)
    has_pos = F.col("lat").isNotNull() & F.col("lon").isNotNull() & ~(
        (F.abs("lat") < 1e-9) & (F.abs("lon") < 1e-9)
    )
    flagged = days.withColumns({"_prio": wanted, "_pos": has_pos})
    per_day = flagged.groupBy(by, "_prio", "observation_date").agg(F.count(F.lit(1)).alias("_n"))
    run = Window.partitionBy(by, "_prio").orderBy("observation_date")
    per_day = per_day.withColumn("_before", F.sum("_n").over(run) - F.col("_n"))
    totals = flagged.groupBy(by).agg(
        F.count_if("_prio").alias("_np"), F.count(F.lit(1)).alias("_all")
    )
    rank = Window.partitionBy(by, "_prio", "observation_date")
    head_order = [F.asc_nulls_last("station_code4"), F.asc_nulls_last("station_id")]
    spread_order = [
        F.desc("_pos"), F.asc_nulls_last("lat"), F.asc_nulls_last("lon"), F.asc("source_priority"),
        *head_order,
    ]
    ranked = (
        flagged.withColumn(
            "_in_day",
            F.when(F.col("_prio"), F.row_number().over(rank.orderBy(*head_order)))
            .otherwise(F.row_number().over(rank.orderBy(*spread_order))),
        )
        .join(per_day.drop("_n"), [by, "_prio", "observation_date"])
        .join(totals, by)
        .withColumn("_rank", F.col("_before") + F.col("_in_day") - 1)
        .withColumn("_left", F.lit(limit) - F.col("_np"))
        .withColumn("_m", F.col("_all") - F.col("_np"))
    )
    # rank r is one of floor(i (m-1) / (left-1)) exactly when the next i reaches it
    i = F.ceil(F.col("_rank") * (F.col("_left") - 1) / F.greatest(F.col("_m") - 1, F.lit(1)))
    on_step = F.floor(i * (F.col("_m") - 1) / F.greatest(F.col("_left") - 1, F.lit(1))) == F.col("_rank")
    even = (
        F.when(F.col("_left") <= 0, F.lit(False))
        .when(F.col("_m") <= F.col("_left"), F.lit(True))
        .when(F.col("_left") == 1, F.col("_rank") == 0)
        .otherwise(on_step)
    )
    keep = F.when(F.col("_all") <= limit, F.lit(True)).when(
        F.col("_prio"), F.when(F.col("_np") >= limit, F.col("_rank") < limit).otherwise(F.lit(True))
    ).otherwise(even)
    return ranked.filter(keep).select(*days.columns)


def first_n(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """Head of an ordering; runs as a distributed top-n."""
    return df.orderBy(*order).limit(n)


def upsert(existing: DataFrame, new: DataFrame, value: str, *, key: str = "producer") -> DataFrame:
    """Replaces all rows of one producer."""
    return existing.filter(F.col(key) != value).unionByName(new)


CANONICAL_ORDER = {
    "links": ("time", "station_id", "sv"),
    "series": ("station_id", "sv", "time"),
    "grid": ("time", "lat", "lon"),
}


def canonical(df: DataFrame, table: str) -> DataFrame:
    """Order of a delivered table read at once; large tables are stored in order by ``sources.tables.write_ordered``."""
    return df.orderBy(*CANONICAL_ORDER[table])
