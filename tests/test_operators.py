"""Operators on small literal inputs."""

import random
from datetime import date, datetime, timedelta, timezone

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tecframe import fixed
from tecframe.functions import arrays, geodesy, indices, text, timefn
from tecframe.operators import aggregates, joins, predicates, sequences, sets, swaths
from tecframe.plans.omni import highlight
from tecframe.plans.overlay import OverlaySpec, build_overlay, check_panels, check_slots, slice_points
from tecframe.sources import catalogs

UTC = timezone.utc
T0 = datetime(2024, 10, 10, tzinfo=UTC)


def ts(minutes: float) -> datetime:
    return T0 + timedelta(minutes=minutes)


def one(spark, *cols):
    return spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(cols)]).first()


def test_snap_sends_halves_to_the_even_node(spark):
    xs = [0.5, 1.5, 2.5, -0.5, -1.5, 2.4999]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    got = [r[0] for r in df.select(geodesy.snap("x", 0.0, 1.0)).collect()]
    assert got == [0.0, 2.0, 2.0, 0.0, -2.0, 2.0]
    assert str(got[3]) == "0.0"


def test_wrap180(spark):
    r = one(spark, *[geodesy.wrap180(x) for x in (190.0, -190.0, 180.0, -180.0, 359.0, 540.0)])
    assert list(r) == [-170.0, 170.0, -180.0, -180.0, -1.0, -180.0]


def test_kp_decode_and_level(spark):
    r = one(spark, *[indices.kp_decimal(F.lit(c)) for c in (40, 43, 47, 45, 0)])
    assert list(r) == pytest.approx([4.0, 4 + 1 / 3, 4 + 2 / 3, 4.5, 0.0])
    r = one(spark, *[indices.kp_level(F.lit(k)) for k in (2.0, 4.33, 7.0)], indices.kp_level(F.lit(None).cast("double")))
    assert list(r) == ["quiet", "active", "storm", "missing"]


def test_three_hour_reduction_takes_the_first_value(spark):
    codes = [13, 20, 23, 27, 30, 99, 43, 40, 37]
    rows = [(ts(60 * i + 30), float(c)) for i, c in enumerate(codes)]
    raw = spark.createDataFrame(rows, "Time timestamp, Kp_code double").withColumn("Dst_nT", F.lit(99999.0))
    from tecframe.plans.omni import build_omni

    bz = spark.createDataFrame([(ts(0), -5.0), (ts(1), 9999.99)], "Time timestamp, IMF_Bz_nT double")
    out = build_omni(bz, raw)
    assert [r.Kp for r in out.kp.orderBy("KpStart").collect()] == pytest.approx([1 + 1 / 3, 2 + 2 / 3, 4 + 1 / 3])
    assert out.hourly.filter("Dst_nT is not null").count() == 0
    assert [r.IMF_Bz_nT for r in out.bz.orderBy("Time").collect()] == [-5.0, None]


def test_time_index_of_two_days(spark):
    df = spark.createDataFrame([(T0, ts(2 * 1440) - timedelta(seconds=1))], "a timestamp, b timestamp")
    assert len(df.select(timefn.time_index("a", "b", 15)).first()[0]) == 192


def test_satellite_orbit_radius(spark):
    e = {n: 0.0 for n in fixed.EPHEMERIS_ELEMENTS} | {"GPSWeek": 2335.0, "Toe": 345600.0, "sqrtA": 5153.7, "Io": 0.96, "Eccentricity": 0.005}
    df = spark.createDataFrame([(T0 + timedelta(hours=h),) for h in range(4)], "time timestamp").withColumn(
        "eph", F.struct(*[F.lit(v).alias(k) for k, v in e.items()])
    )
    out = geodesy.with_satellite_xyz(df).select(F.sqrt(F.col("sat_x") ** 2 + F.col("sat_y") ** 2 + F.col("sat_z") ** 2))
    assert all(abs(r[0] - 26_560_000) < 200_000 for r in out.collect())


def test_geodetic_round_trip_near_a_pole(spark):
    df = spark.createDataFrame([(89.9999, 12.0, 300.0), (-45.0, -170.0, -20.0), (0.0, 0.0, 0.0)], "lat double, lon double, h double")
    x, y, z = geodesy.to_ecef("lat", "lon", "h")
    back = geodesy.to_geodetic("x", "y", "z")
    for r in df.withColumns({"x": x, "y": y, "z": z}).select("lat", "lon", "h", *back).collect():
        assert list(r)[3:] == pytest.approx(list(r)[:3], abs=1e-6)


def test_time_text_forms(spark):
    df = spark.createDataFrame([("2024-01-15T08:30:00Z",), ("2024-01-15T16:30:00+08:00",), ("2024-01-15T08:30:00",), ("x",)], "t string")
    got = [r[0] for r in df.select(F.date_format(timefn.parse_utc("t"), "yyyy-MM-dd HH:mm")).collect()]
    assert got == ["2024-01-15 08:30"] * 3 + [None]


def test_gps_week(spark):
    d = F.lit("2024-10-10").cast("date")
    assert list(one(spark, timefn.gps_week(d), timefn.gps_day_of_week(d), timefn.day_of_year(d))) == [2335, 4, "284"]


def test_file_names(spark):
    names = ["/a/BOAV00BRA_R_20242840000_01D_15S_MO.crx.gz", "ab/alb12840.24d.Z", "x.txt"]
    df = spark.createDataFrame([(n,) for n in names], "p string")
    got = [r[0] for r in df.select(text.parse_observation_name("p", default_sampling=30, overrides={"ALB1": "ALB100USA"})).collect()]
    assert got[0].asDict() == {"station_id": "BOAV00BRA", "station_code4": "BOAV", "sampling_sec": 15}
    assert got[1].asDict() == {"station_id": "ALB100USA", "station_code4": "ALB1", "sampling_sec": 30}
    assert got[2] is None


def test_swath_names(spark):
    df = spark.createDataFrame([("d/GOLD_L1C_CHA_NI1_2024_284_23_10_v04_r01.nc",), ("d/GOLD_L1C_CHB_DAY_2024.nc",), ("GOLD_L1C_CHA_NI1_2023_366_23_10_v.nc",)], "m string")
    got = [r[0] for r in df.select(text.parse_swath_name("m")).collect()]
    assert got[0].hemisphere == "CHA" and got[0].obs_time.strftime("%m-%d %H:%M") == "10-10 23:10"
    assert got[1] is None and got[2] is None


def test_panel_label(spark):
    assert one(spark, text.panel_label(F.lit(2), F.lit("BOAV"), F.lit("G21"), "ROTI"))[0] == "(c) BOAV G21 ROTI"


def test_pair_title_of_equal_times(spark):
    a = F.lit("2024-10-10 23:10:00").cast("timestamp")
    b = F.lit("2024-10-10 23:12:00").cast("timestamp")
    assert list(one(spark, text.pair_title(a, a, a), text.pair_title(a, b, timefn.midpoint(a, b)))) == [
        "2024-10-10 23:10UT", "2024-10-10 23:11UT  |  CHA 23:10 + CHB 23:12"]


def test_grid_median_skips_nulls_and_keeps_the_cell(spark):
    rows = [(ts(1), 10.4, -60.4, 1.0, None, "G01"), (ts(2), 9.6, -59.6, 3.0, None, "G02"), (ts(14), 10.0, -60.0, None, None, "G03"),
            (ts(16), 10.0, -60.0, 5.0, 0.5, "G01"), (ts(1), 81.0, 0.0, 1.0, 1.0, "G01"), (ts(1), None, 0.0, 1.0, 1.0, "G01")]
    df = spark.createDataFrame(rows, "time timestamp, ipp_lat double, ipp_lon double, vtec double, roti double, sv string")
    got = aggregates.grid_links(df).orderBy("time").collect()
    assert [(r.lat, r.lon, r.vtec, r.roti, r.sample_count) for r in got] == [(10.0, -60.0, 2.0, None, 3), (10.0, -60.0, 5.0, 0.5, 1)]


def test_floor_grid_places_every_interval(spark):
    df = spark.createDataFrame([("e", ts(20), -0.5, 0.5, 1.0, 2.0, "G01")], "event_id string, time timestamp, ipp_lat double, ipp_lon double, vtec double, roti double, sv string")
    ev = spark.createDataFrame([("e", ts(0), ts(59))], "event_id string, start_utc timestamp, end_utc timestamp")
    got = aggregates.grid_links_floor(df, ev).orderBy("time").collect()
    assert [(r.lat_bin, r.lon_bin, r.sample_count) for r in got] == [(None, None, 0), (-1.0, 0.0, 1), (None, None, 0), (None, None, 0)]


def test_mean_grid_is_half_open(spark):
    px = spark.createDataFrame([(0.0, 0.0, 1.0), (0.99, 0.99, 3.0), (1.0, 0.0, 5.0), (2.0, 0.0, 7.0), (0.0, 2.0, 9.0), (0.5, 0.5, None)], "lon double, lat double, radiance double")
    got = {(r.ix, r.iy): (r.radiance, r.pixel_count) for r in aggregates.mean_grid(px, (0.0, 2.0, 0.0, 2.0), 1.0).collect()}
    assert got == {(0, 0): (2.0, 2), (1, 0): (5.0, 1)}
    with pytest.raises(ValueError):
        aggregates.mean_grid(px, (0.0, 2.0, 0.0, 2.0), 0.0)


def test_hot_bin_centre_native_step_and_strict_threshold(spark):
    pts = spark.createDataFrame([(10.2, -69.9), (10.8, -69.1)], "lat double, lon double")
    got = aggregates.hot_bins(pts, 1.0, (-150.0, 10.0, -80.0, 80.0)).collect()
    assert [(r.lon, r.lat) for r in got] == [(-69.5, 10.5)]
    assert aggregates.hot_bins(pts, 0.0, (-150.0, 10.0, -80.0, 80.0)).count() == 2
    a = lambda *v: F.array(*[F.lit(float(x)) for x in v])
    assert list(one(spark, arrays.native_step(a(0, 0.5, 1.0), a(-70, -69, -68)), arrays.native_step(a(3), a(4)))) == [0.5, 0.5]
    df = spark.createDataFrame([(1.0,), (1.01,), (float("nan"),), (None,)], "v double")
    assert [r.v for r in predicates.above(df, "v", 1.0).collect()] == [1.01]


def test_axis_edges(spark):
    a = lambda *v: F.array(*[F.lit(float(x)) for x in v])
    r = one(spark, arrays.axis_edges(a(1, 2, 4)), arrays.axis_edges(a(5)))
    assert list(r) == [[0.5, 1.5, 3.0, 5.0], [4.75, 5.25]]


def test_pixel_at_a_steep_angle_is_masked(spark):
    df = spark.createDataFrame([(1.0, 2.0, 100.0, 0, 45.0), (1.0, 2.0, 130.0, 0, 89.5), (1.0, 2.0, float("nan"), 0, 45.0), (91.0, 2.0, 1.0, 0, 45.0)],
                               "lat double, lon double, radiance double, quality int, emission double")
    assert [r.radiance for r in predicates.valid_pixels(df).collect()] == [100.0, None, None, None]
    assert [r.radiance for r in predicates.valid_pixels(df, max_angle=None).collect()] == [100.0, 130.0, None, None]


def test_gap_break_is_strict_and_rates_need_full_windows(spark):
    times = [0, 1.5, 3.0, 4.51]
    df = spark.createDataFrame([("a", ts(m), float(i)) for i, m in enumerate(times)], "k string, time timestamp, stec double")
    arcs = sequences.gap_arcs(df, ["k"], 90.0)
    assert [r.arc_id for r in arcs.orderBy("time").collect()] == [0, 0, 0, 1]
    long = spark.createDataFrame([("a", ts(m / 2), float(m * m % 7)) for m in range(14)], "k string, time timestamp, stec double").withColumn("arc_id", F.lit(0))
    out = sequences.roti(sequences.rot(long, ["k"]), ["k"], 10).orderBy("time").toPandas()
    rate = pd.Series([float(m * m % 7) for m in range(14)]).diff() / 0.5
    want = rate.rolling(10, min_periods=10).std(ddof=0)
    assert out["roti"].isna().sum() == 10
    assert np.allclose(out["roti"].dropna(), want.dropna())


def test_regularise_keeps_the_last_of_equal_epochs(spark):
    rows = [("a", ts(0), 1.0, 1), ("a", ts(0), 2.0, 2), ("a", T0 + timedelta(seconds=30.7), 3.0, 3), ("a", T0 + timedelta(seconds=31.0), 4.0, 4)]
    df = spark.createDataFrame(rows, "k string, time timestamp, v double, ingest_pos int")
    assert sorted(r.v for r in sequences.regularise(df, ["k"], 30).collect()) == [2.0, 3.0]


def test_rolling_polynomial_matches_numpy(spark):
    rng = random.Random(1)
    ys = [rng.random() for _ in range(30)]
    xs = np.cumsum([rng.randint(1, 5) for _ in range(30)])
    df = spark.createDataFrame([("a", ts(float(x)), y) for x, y in zip(xs, ys)], "k string, time timestamp, v double")
    for degree in (0, 1, 2):
        got = [r.residual for r in sequences.rolling_poly(df, ["k"], 6, degree, value="v").orderBy("time").collect()]
        for i in range(30):
            if i < 6:
                assert got[i] is None
            else:
                fit = np.polyfit(xs[i - 6:i].astype(float), ys[i - 6:i], degree)
                assert got[i] == pytest.approx(ys[i] - np.polyval(fit, xs[i]), abs=1e-8)


def test_crossings_none_one_several(spark):
    lines = {0: [1.0, 2.0, 3.0], 1: [-1.0, 1.0, 2.0], 2: [1.0, -1.0, 1.0]}
    rows = [(lon, float(i * 10 - 10), v) for lon, vs in lines.items() for i, v in enumerate(vs)]
    df = spark.createDataFrame(rows, "lon int, lat double, mlat double")
    got = {r.lon: r.crossing_lat for r in sequences.zero_crossings(df, ["lon"]).collect()}
    assert got == {1: -5.0, 2: -5.0}
    near = {r.lon: r.crossing_lat for r in sequences.zero_crossings(df, ["lon"], mode="nearest").collect()}
    assert near == {1: -5.0, 2: 5.0}


def test_crossings_by_both_rules_from_one_pass(spark):
    lines = {0: [-2.0, -1.0, 1.0, 2.0], 1: [1.0, 2.0, 3.0, 4.0], 2: [0.0, 1.0, -1.0, 1.0], 3: [None, None, -1.0, 1.0]}
    df = spark.createDataFrame([(lon, float(i), v) for lon, vs in lines.items() for i, v in enumerate(vs)], "lon int, lat double, mlat double")
    both = sequences.crossing_table(df, ["lon"], {"a": "first", "b": "nearest"})
    assert {r.lon: (r.a, r.b) for r in both.collect()} == {0: (1.5, 1.5), 1: (None, None), 2: (0.0, 1.5), 3: (2.5, 2.5)}
    assert both._jdf.queryExecution().executedPlan().toString().count("Window") <= 2
    assert sequences.crossing_table(df.limit(0), ["lon"], {"a": "first"}).count() == 0


def test_axes_from_one_aggregate(spark):
    df = spark.createDataFrame([("a", 0.0, 3.0), ("a", 10.0, 9.5), ("b", 5.0, None), ("c", None, None), ("d", -2.0, 1.0), ("d", -1.0, None)], "g string, v double, Kp double")
    axes = {"": ("v", "padded"), "z_": ("v", "from zero"), "kp_": ("Kp", "kp")}
    out = aggregates.axis_table(df, axes, ["g"])
    got = {r.g: tuple(None if x is None else round(x, 9) for x in r[1:]) for r in out.collect()}
    assert got == {
        "a": (-1.2, 11.2, 0.0, 10.8, 0.0, 10.0), "b": (4.0, 6.0, 0.0, 5.4, 0.0, 9.2), "c": (None, None, None, None, 0.0, 9.2),
        "d": (-2.12, -0.88, 0.0, 1.0, 0.0, 9.2),
    }
    for one, name in ((aggregates.axis_bounds(df, "v", ["g"]), ""), (aggregates.axis_bounds(df, "v", ["g"], floor_zero=True), "z_")):
        want = out.select("g", F.col(f"{name}lower").alias("lower"), F.col(f"{name}upper").alias("upper"))
        assert one.exceptAll(want).count() == 0 and one.count() == 4
    assert {r.g: r.kp_top for r in aggregates.kp_axis_top(df, ["g"]).collect()} == {"a": 10.0, "b": 9.2, "c": 9.2, "d": 9.2}
    assert aggregates.axis_table(df, axes, ["g"])._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1


def test_series_of_several_metrics_from_one_pass(spark):
    df = spark.createDataFrame([(1, "s", "c", "G01", 2.0, None), (2, "s", "c", "G01", None, 0.5), (3, "s", "c", "G02", None, None)], "time int, station_id string, station_code4 string, sv string, vtec double, roti double")
    out = predicates.station_metrics(df, ["vtec", "roti"])
    assert sorted((r.metric, r.time, r.value) for r in out.collect()) == [("roti", 2, 0.5), ("vtec", 1, 2.0)]
    for metric in ("vtec", "roti"):
        one = predicates.station_metric(df, metric).collect()
        assert [r.time for r in one] == [r.time for r in out.where(F.col("metric") == metric).collect()]


def test_first_kp_of_equal_times_and_series_apart(spark):
    df = spark.createDataFrame([("a", 0, 2.0), ("a", 0, 1.0), ("a", 60, 0.5), ("b", 0, 3.0), ("b", 10800, None), (None, 5, 4.0)], "kind string, s long, Kp double")
    df = df.withColumn("PlotTime", F.timestamp_seconds("s"))
    assert {r.kind: r.Kp for r in aggregates.kp_3hour(df, ["kind"]).collect()} == {"a": 1.0, "b": 3.0, None: 4.0}
    assert [r.Kp for r in aggregates.kp_3hour(df).collect()] == [1.0]


def test_asof_age_limit_and_day_border(spark):
    d1, d2 = date(2024, 10, 10), date(2024, 10, 11)
    obs = spark.createDataFrame([(d1, "G01", ts(m), i) for i, m in enumerate((0, 60, 120, 359, 360, 361))] + [(d2, "G01", ts(1441), 9)],
                                "observation_date date, sv string, time timestamp, i int")
    eph = spark.createDataFrame([(d1, "G01", ts(60), "first", 1.0, 0), (d1, "G01", ts(120), "old", 1.0, 1), (d1, "G01", ts(120), "new", 1.0, 2), (d1, "G01", ts(350), "bad", None, 3)],
                                "observation_date date, sv string, time timestamp, tag string, sqrtA double, ingest_pos int")
    got = {r.i: r.eph.tag if r.eph else None for r in joins.asof_ephemeris(obs, eph, 4.0).collect()}
    assert got == {0: None, 1: "first", 2: "new", 3: "new", 4: "new", 5: None, 9: None}


def test_asof_against_pandas(spark):
    """Sparse records travel in arrays; with a limit of 0 all go through fine slots."""
    rng = random.Random(4)
    eph = pd.DataFrame({"sv": [rng.choice("ab") for _ in range(80)], "us": [rng.randint(0, 10_000) for _ in range(80)]})
    eph = eph.drop_duplicates().reset_index(drop=True)
    obs = pd.DataFrame({"sv": [rng.choice("abc") for _ in range(300)], "us": [rng.randint(0, 10_000) for _ in range(300)]})
    obs["i"] = range(len(obs))
    left = spark.createDataFrame(obs).withColumn("time", F.timestamp_seconds("us"))
    right = spark.createDataFrame(eph).withColumn("time", F.timestamp_seconds("us"))
    got = {r.i: r.eph.us if r.eph else None for r in joins.asof_latest(left, right, ["sv"], 150.0).collect()}
    want = pd.merge_asof(obs.sort_values("us"), eph.rename(columns={"us": "hit"}).assign(us=lambda d: d.hit).sort_values("us"), on="us", by="sv", tolerance=150)
    assert got == {int(r.i): (None if pd.isna(r.hit) else int(r.hit)) for r in want.itertuples()}


def test_even_choice_follows_linspace(spark):
    rng = random.Random(3)
    for n, limit, prio in ((50, 7, 0), (50, 7, 3), (12, 20, 2), (40, 1, 0), (9, 4, 6), (23, 22, 1), (30, 0, 2), (30, 5, 4)):
        rows = [("e", date(2024, 1, 1 + rng.randint(0, 3)), f"S{i:03d}", f"S{i:03d}", None if i % 7 == 0 else float(rng.randint(0, 9)), float(i), i % 3) for i in range(n)]
        codes = [f"S{i:03d}" for i in range(prio)]
        df = spark.createDataFrame(rows, "event_id string, observation_date date, station_id string, station_code4 string, lat double, lon double, source_priority int").repartition(3)
        got = sorted(r.station_id for r in sets.select_station_days(df, limit, codes).collect())
        p = pd.DataFrame(rows, columns=df.columns)
        if limit <= 0 or n <= limit:
            want = p
        else:
            mask = p.station_id.isin(codes)
            if mask.sum() >= limit:
                want = p[mask].sort_values(["observation_date", "station_code4"]).head(limit)
            else:
                rest = p[~mask].copy()
                rest["pos"] = rest.lat.notna()
                rest = rest.sort_values(["observation_date", "pos", "lat", "lon", "source_priority", "station_id"], ascending=[True, False, True, True, True, True])
                room = limit - mask.sum()
                if len(rest) > room:
                    rest = rest.iloc[np.unique(np.linspace(0, len(rest) - 1, num=room, dtype=int))]
                want = pd.concat([p[mask], rest])
        assert got == sorted(want.station_id), (n, limit, prio)


def test_top_satellites_and_the_error_text(spark):
    cov = spark.createDataFrame([("s", "G01", 5, 5, 9, 10, True), ("s", "G02", 6, 4, 9, 10, True), ("s", "G03", 0, 7, 9, 7, False), ("s", "G04", 0, 0, 0, 0, False)],
                                "station_id string, sv string, valid_vtec int, valid_roti int, longest_arc int, score int, qualified boolean")
    assert [r.sv for r in sets.top_satellites(cov, 2, ["station_id"]).orderBy("rank").collect()] == ["G01", "G02"]
    assert {r.sv: r.rank for r in sets.rank_satellites(cov, ["station_id"]).collect()} == {"G01": 1, "G02": 2, "G03": 3, "G04": None}
    sets.require_top(cov, 2)
    with pytest.raises(ValueError, match="only 2 qualified satellites. Coverage: G01: score=10, vtec=5"):
        sets.require_top(cov, 3)


def test_station_rows_fall_back_to_the_code(spark):
    df = spark.createDataFrame([("BOAV00BRA", "BOAV", 1), ("boav00bra", "BOAV", 2), ("X", "BOAV", 3)], "station_id string, station_code4 string, v int")
    assert sorted(r.v for r in predicates.station_rows(df, "boav00BRA", "BOAV").collect()) == [1, 2]
    assert sorted(r.v for r in predicates.station_rows(df, "none", "boav").collect()) == [1, 2, 3]
    assert predicates.station_rows(df.drop("station_id"), "none", "BOAV").count() == 3


def test_metric_aliases(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.0, 4.0)], "TEC double, atec double, Latitude double, lon double")
    assert predicates.canonical_metric(df).first().asDict() == {"vtec": 2.0, "lat": 3.0, "lon": 4.0}


def test_summary_breaks_ties_by_step_order(spark):
    rows = [("d", "below_elevation_mask")] * 2 + [("d", "insufficient_phase_samples")] * 2 + [("d", "finalize_empty")]
    got = aggregates.summarise_failures(spark.createDataFrame(rows, "k string, reason string"), ["k"]).first()
    assert got.reason == "insufficient_phase_samples"
    assert got.detail == "below_elevation_mask=2, finalize_empty=1, insufficient_phase_samples=2"


def test_highlight_windows_overlap_and_alpha_is_checked(spark):
    series = spark.createDataFrame([(ts(m),) for m in (0, 10, 20, 30)], "Time timestamp")
    win = spark.createDataFrame([("a", ts(0), ts(10), 0.2), ("b", ts(10), ts(20), None)], "name string, start_utc timestamp, end_utc timestamp, alpha double")
    assert highlight(series, win).groupBy("Time").count().count() == 3 and highlight(series, win).count() == 4
    with pytest.raises(Exception, match="alpha"):
        highlight(series, win.withColumn("alpha", F.lit(1.5))).collect()


def test_explicit_pairs_report_what_is_missing(spark):
    spec = spark.createDataFrame([(ts(0), ts(2), ts(1)), (ts(0), ts(2), ts(9)), (ts(5), ts(6), ts(1)), (ts(5), ts(6), ts(9))], "gold_cha_time timestamp, gold_chb_time timestamp, gnss_time timestamp")
    slices = spark.createDataFrame([(ts(1), 1), (ts(25), 2)], "time timestamp, slice_id int")
    scenes = spark.createDataFrame([(ts(0), ts(2), 7)], "cha_time timestamp, chb_time timestamp, scene_id int")
    got = sorted(r.detail for r in joins.explicit_pairs(spec, slices, scenes).collect())
    assert got == ["", "explicit_pair_missing_gnss", "explicit_pair_missing_gnss_and_gold", "explicit_pair_missing_gold"]


def cube(spark, values, times):
    rows = [(i, t, [-10.0, 0.0, 10.0], [280.0, 290.0, 300.0], v) for i, (t, v) in enumerate(zip(times, values))]
    return spark.createDataFrame(rows, "slice_id int, time timestamp, lat array<double>, lon array<double>, values array<array<double>>")


def test_overlay_points_and_statuses(spark):
    low, high = [[0.1] * 3] * 3, [[0.1, 2.0, 0.1], [0.1, 0.1, 3.0], [0.1, 0.1, 0.1]]
    slices = cube(spark, [high, low], [ts(0), ts(600)])
    scenes = spark.createDataFrame([(7, ts(5), ts(4), ts(6)), (8, ts(601), ts(600), ts(602))], "scene_id int, midpoint timestamp, cha_time timestamp, chb_time timestamp")
    out = build_overlay(slices, scenes, OverlaySpec())
    got = {r.slice_id: (r.status, r.detail, r.points) for r in out.pairs.collect()}
    assert got == {0: ("ready", "", 2), 1: ("skipped", "threshold_removed_all_pixels", 0)}
    assert sorted((r.lat, r.lon) for r in out.points.collect()) == [(-10.0, -70.0), (0.0, -60.0)]
    far = scenes.withColumn("midpoint", F.lit("2030-01-01").cast("timestamp"))
    why = lambda *tables, **more: [(r.status, r.detail) for r in build_overlay(*tables, OverlaySpec(), **more).pairs.collect()]
    assert why(slices, far) == [("skipped", "no_pairs_within_tolerance")]
    assert why(slices, far.limit(0)) == why(slices.limit(0), far) == why(slices.limit(0), far.limit(0)) == [("skipped", "missing_gnss_or_gold")]
    spec = spark.createDataFrame([(ts(4), ts(6), ts(0)), (ts(4), ts(6), ts(9))], "gold_cha_time timestamp, gold_chb_time timestamp, gnss_time timestamp")
    assert sorted(why(slices, scenes, explicit=spec)) == [("ready", ""), ("skipped", "explicit_pair_missing_gnss")]
    assert why(slices, scenes.limit(0), explicit=spec) == [("skipped", "missing_gnss_or_gold")]
    named = lambda df, event: df.withColumn("event", F.lit(event))
    both = build_overlay(named(slices, "a").union(named(slices.withColumn("slice_id", F.col("slice_id") + 10), "b")), named(scenes, "a").union(named(far, "c")), OverlaySpec(), by=["event"])
    assert sorted((r.event, r.slice_id or 0, r.detail) for r in both.pairs.collect()) == [("a", 0, ""), ("a", 1, "threshold_removed_all_pixels"), ("b", 0, "missing_gnss_or_gold"), ("c", 0, "missing_gnss_or_gold")]
    wide = slice_points(slices, OverlaySpec(bin_deg=30.0)).collect()
    assert sorted((r.slice_id, r.lat, r.lon) for r in wide) == [(0, -5.0, -75.0), (0, -5.0, -45.0)]


def test_long_intervals_are_not_copied_by_day(spark):
    rng = random.Random(4)
    day = lambda d: T0 + timedelta(days=d)
    spans = [(rng.randint(0, 4000), rng.choice([0, 1, 3, 30, 400, 3000])) for _ in range(150)]
    files = spark.createDataFrame([(f"k{i % 3}", f"f{i}", day(a), day(a + n)) for i, (a, n) in enumerate(spans)] + [("k0", "bad", day(5), day(4)), ("k0", "none", None, day(4))], "kind string, name string, start timestamp, end timestamp")
    events = spark.createDataFrame([(f"e{i}", day(a), day(a + n)) for i, (a, n) in enumerate(spans[::-1][:60])], "event_id string, start_utc timestamp, end_utc timestamp")
    got = sorted((r.event_id, r.name) for r in joins.overlapping(files, events).collect())
    want = sorted((f"e{i}", f"f{j}") for i, (a, n) in enumerate(spans[::-1][:60]) for j, (b, m) in enumerate(spans) if a <= b + m and b <= a + n)
    assert got == want
    f = files.selectExpr("unix_micros(start) AS _a", "unix_micros(end) AS _b").filter("_a <= _b")
    laid = joins._holding(f, f.select(F.col("_a").alias("_p")), "_a", "_b", "_p")
    copies = [m for m in str(laid._jdf.queryExecution().optimizedPlan().toString()).split("\n") if "Generate" in m]
    assert len(copies) == 2 and laid.count() == sum(1 for a, n in spans for b, _ in spans if a <= b <= a + n)


def test_map_files_as_xml_has_them(spark):
    mark = lambda p, name, xyz: f"<{p}Placemark id='1'><{p}name>{name}</{p}name><{p}Point><{p}coordinates> {xyz}\n</{p}coordinates></{p}Point></{p}Placemark>"
    nested = "<Folder><Folder><Document><Folder>" + mark("", "DEEP", "1,2,3") + "</Folder></Document></Folder>" + mark("", "UPPER", "4,5,6") + "</Folder>"
    docs = [
        "<?xml version='1.0'?><kml:kml xmlns:kml='http://k'><kml:Document>" + mark("kml:", "boav x", "-60.7,2.8,69.5") + "</kml:Document></kml:kml>",
        "<kml xmlns='http://k'><Document>" + mark("", "A&amp;B <![CDATA[<i>]]>", "1,2,3") + mark("", "", "1,2,3") + mark("", "two", "1,2") + "</Document></kml>",
        f"<kml>{nested}</kml>", "<kml>" + mark("", "TOP", "7,8,9") + "<!-- " + mark("", "NOT", "7,8,9") + " --></kml>", "not xml <", "", None,
    ]
    df = spark.createDataFrame([(d,) for d in docs], "kml string")
    got = sorted((r.station_id, r.station_code4, r.lat, r.lon, r.height_m) for r in catalogs.parse_placemarks(df).collect())
    assert got == sorted([("BOAV X", "boav", 2.8, -60.7, 69.5), ("A&B <I>", "a&b ", 2.0, 1.0, 3.0), ("DEEP", "deep", 2.0, 1.0, 3.0), ("UPPER", "uppe", 5.0, 4.0, 6.0), ("TOP", "top", 8.0, 7.0, 9.0)])


def test_bad_panel_slots_fail(spark):
    schema = "kind string, producer string, timestamp timestamp, gold_cha_time timestamp, gold_chb_time timestamp, gnss_time timestamp"
    for row in (("map", "isee", T0, None, None, None), ("gnss_roti", "other", T0, None, None, None), ("gold", None, None, T0, None, None)):
        with pytest.raises(Exception):
            check_slots(spark.createDataFrame([row], schema)).collect()
    assert check_slots(spark.createDataFrame([("GOLD", None, None, T0, T0, None)], schema)).first().kind == "gold"


def test_panel_layout_rules(spark):
    slots = spark.createDataFrame([("p", 0), ("p", 1)], "panel_name string, slot_index int")
    panel = lambda rows, cols, bar: spark.createDataFrame([("p", rows, cols, bar)], "panel_name string, rows int, cols int, shared_colorbar string")
    assert check_panels(panel(1, 2, "GOLD"), slots).first().slots == 2
    for bad in ((0, 2, "gold"), (2, 2, "gold"), (1, 2, "other")):
        with pytest.raises(Exception):
            check_panels(panel(*bad), slots).collect()


def test_cell_mask_against_numpy(spark):
    rng = np.random.default_rng(6)
    m, n = 5, 6
    lat = np.arange(m)[:, None] + 0.1 * rng.random((m, n))
    lon = np.arange(n)[None, :] + 0.1 * rng.random((m, n))
    lon[:, 4:] += 6.0
    lat[2, 1] = np.nan
    edges = {}
    for name, c in (("lat", lat), ("lon", lon)):
        e = np.full((m + 1, n + 1), np.nan)
        e[1:-1, 1:-1] = 0.25 * (c[:-1, :-1] + c[1:, :-1] + c[:-1, 1:] + c[1:, 1:])
        for k in range(1, n):
            e[0, k], e[m, k] = 2 * c[0, k - 1] - e[1, k], 2 * c[m - 1, k - 1] - e[m - 1, k]
        for k in range(1, m):
            e[k, 0], e[k, n] = 2 * c[k - 1, 0] - e[k, 1], 2 * c[k - 1, n - 1] - e[k, n - 1]
        e[0, 0], e[0, n] = 2 * c[0, 0] - e[1, 1], 2 * c[0, n - 1] - e[1, n - 1]
        e[m, 0], e[m, n] = 2 * c[m - 1, 0] - e[m - 1, 1], 2 * c[m - 1, n - 1] - e[m - 1, n - 1]
        edges[name] = e
    hyp = lambda a, b: np.hypot(edges["lon"][a] - edges["lon"][b], edges["lat"][a] - edges["lat"][b])
    gaps = np.concatenate([np.hypot(np.diff(lon, axis=k), np.diff(lat, axis=k)).ravel() for k in (0, 1)])
    t = 2.0 * np.median(gaps[np.isfinite(gaps) & (gaps > 0)])
    want = {}
    for y in range(m):
        for x in range(n):
            a, b, c, d = (y, x), (y, x + 1), (y + 1, x), (y + 1, x + 1)
            corner = [edges[q][p] for q in edges for p in (a, b, c, d)]
            want[y, x] = bool(not np.isfinite(lat[y, x]) or not np.isfinite(corner).all() or max(hyp(a, b), hyp(c, d), hyp(a, c), hyp(b, d)) > t or max(hyp(a, d), hyp(b, c)) > 1.5 * t)
    clean = lambda v: [None if np.isnan(q) else float(q) for q in v]
    df = spark.createDataFrame([(1, y, clean(lat[y]), clean(lon[y]), [1.0] * n) for y in range(m)], "entry_id int, y int, lat array<double>, lon array<double>, value array<double>")
    got = {(r.y, r.x): r.masked for r in swaths.cell_mask(df, 2.0).collect()}
    assert got == want and any(got.values()) and not all(got.values())


def test_densify_lattice(spark):
    grid = spark.createDataFrame([(ts(15), 0.0, 10.0, 1.5, None, 3), (ts(15), 0.4, 10.0, 9.9, None, 3)], "time timestamp, lat double, lon double, vtec double, roti double, sample_count int")
    win = spark.createDataFrame([(ts(0), ts(30))], "start_utc timestamp, end_utc timestamp")
    out = aggregates.densify(grid, win, bbox={"lat_min": -1.0, "lat_max": 1.0, "lon_min": 9.0, "lon_max": 10.0})
    rows = out.collect()
    assert len(rows) == 3 * 3 * 2
    assert [(r.time.minute, r.lat, r.lon, r.vtec, r.sample_count) for r in rows if r.vtec is not None] == [(15, 0.0, 10.0, 1.5, 3)]
    assert out.schema["vtec"].metadata == {"units": "TECu"}


def test_operators_take_empty_input(spark):
    links = spark.createDataFrame([], "event_id string, station_id string, observation_date date, sv string, time timestamp, stec double, vtec double, roti double, ipp_lat double, ipp_lon double")
    keys = list(fixed.TRACK_KEYS)
    assert sequences.roti(sequences.rot(sequences.gap_arcs(links, keys, 90.0), keys), keys, 10).count() == 0
    assert aggregates.grid_links(links).count() == 0
    assert aggregates.coverage(links.withColumn("arc_id", F.lit(0)), ["station_id", "sv"]).count() == 0


def test_asof_ties_have_a_total_order(spark):
    left = spark.createDataFrame([("a", 100.0)], "sv string, s double").withColumn("time", F.timestamp_seconds("s"))
    for rows in ([(1, "x"), (2, "y")], [(2, "y"), (1, "x")]):
        right = spark.createDataFrame([("a", 90.0, n, v) for n, v in rows], "sv string, s double, n int, v string").withColumn("time", F.timestamp_seconds("s"))
        assert joins.asof_latest(left, right.drop("s"), ["sv"], 60.0).first().eph.v == "y"
        placed = right.withColumn("ingest_pos", 3 - F.col("n")).drop("s")
        assert joins.asof_latest(left, placed, ["sv"], 60.0).first().eph.v == "x"
