"""Panel tables: what is cut into cells, and single values as plain aggregates."""

import datetime as dt

from pyspark.sql import functions as F

from tecframe.operators.joins import first_per_key, last_per_key
from tecframe.plans.overlay import OverlaySpec, build_panel

T = dt.datetime(2024, 1, 5, 12, 0)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_only_slices_that_a_slot_shows_are_cut_into_cells(spark):
    times = [T + dt.timedelta(minutes=i) for i in range(4)]
    slots = spark.createDataFrame(
        [("p", i, "overlay", "internal", None, T, T, times[i]) for i in range(3)],
        "panel_name string, slot_index int, kind string, producer string, timestamp timestamp, gold_cha_time timestamp, gold_chb_time timestamp, gnss_time timestamp",
    )
    axis = [0.0, 1.0]
    cell = lambda v: [[v, 0.0], [0.0, v]]
    slices = spark.createDataFrame(
        [("internal", "roti", times[0], 1, axis, axis, cell(9.0)), ("internal", "roti", times[0], 2, axis, axis, cell(0.0)),  # the last of a time counts
         ("internal", "roti", times[1], 3, axis, axis, cell(0.0)), ("internal", "roti", times[1], 3, axis, axis, cell(9.0)),  # one slice in two rows
         ("internal", "roti", times[3], 4, axis, axis, cell(9.0))],
        "producer string, metric string, time timestamp, slice_id long, lat array<double>, lon array<double>, values array<array<double>>",
    )
    scenes = spark.createDataFrame([(T, T, 7), (T, T, 8)], "cha_time timestamp, chb_time timestamp, scene_id long")
    out = build_panel(slots, slices, scenes, OverlaySpec(threshold=1.0), {"lat_min": -5.0, "lat_max": 5.0, "lon_min": -5.0, "lon_max": 5.0})
    got = {r.slot_index: (r.slice_id, r.scene_id, r.detail) for r in out.collect()}
    assert got == {0: (2, 7, "threshold_removed_all_pixels"), 1: (3, 7, ""), 2: (None, 7, "missing_gnss_slice")}
    assert "LeftSemi" in plan_of(out)


def test_single_values_of_a_key_need_no_sort(spark):
    rows = spark.createDataFrame([("a", 1), ("a", 5), ("b", None), ("b", 2), ("c", None)], "k string, v long")
    first, last = first_per_key(rows, ["k"], ["v"]), last_per_key(rows, ["k"], ["v"])
    assert {r.k: r.v for r in first.collect()} == {"a": 1, "b": None, "c": None}  # a missing value comes first
    assert {r.k: r.v for r in last.collect()} == {"a": 5, "b": 2, "c": None}
    assert "SortAggregate" not in plan_of(first) + plan_of(last)
    more = last_per_key(rows.withColumn("w", F.col("v") * 2), ["k"], ["v"])
    assert {r.k: (r.v, r.w) for r in more.collect()} == {"a": (5, 10), "b": (2, 4), "c": (None, None)}
