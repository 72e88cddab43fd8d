"""Links of synthetic satellite passes, against the same steps in numpy."""

import math
import random
from datetime import date, datetime, timedelta, timezone

import numpy as np
import pytest
from pyspark.sql import functions as F

from tecframe import fixed
from tecframe.operators.slips import SlipParams
from tecframe.plans.links import build_grid, build_links, build_series, write_station_series
from tests.test_slips import walk

DAY = datetime(2024, 10, 10, tzinfo=timezone.utc)
R, H = 6371.0, 350.0
FACTOR = fixed.TECU_PER_METRE


def satellite(m0, node, seconds, toe=345600.0):
    """Circular orbit, inclination 0.96; seconds since the start of the day."""
    a = 5153.7**2
    tk = seconds
    n = math.sqrt(3.986005e14 / a**3)
    u = m0 + n * tk
    om = node - 7.2921151467e-5 * tk - 7.2921151467e-5 * toe
    x, y, i = a * np.cos(u), a * np.sin(u), 0.96
    return np.stack([x * np.cos(om) - y * np.cos(i) * np.sin(om), x * np.sin(om) + y * np.cos(i) * np.cos(om), y * np.sin(i)], axis=-1)


def angles(xyz, lat, lon, h=50.0):
    p, l = math.radians(lat), math.radians(lon)
    f = 1 / 298.257223563
    n = 6378137.0 / math.sqrt(1 - f * (2 - f) * math.sin(p) ** 2)
    rx = np.array([(n + h) * math.cos(p) * math.cos(l), (n + h) * math.cos(p) * math.sin(l), (n * (1 - f * (2 - f)) + h) * math.sin(p)])
    d = xyz - rx
    e = -math.sin(l) * d[:, 0] + math.cos(l) * d[:, 1]
    nn = -math.sin(p) * math.cos(l) * d[:, 0] - math.sin(p) * math.sin(l) * d[:, 1] + math.cos(p) * d[:, 2]
    up = math.cos(p) * math.cos(l) * d[:, 0] + math.cos(p) * math.sin(l) * d[:, 1] + math.sin(p) * d[:, 2]
    return np.degrees(np.arctan2(e, nn)) % 360, np.degrees(np.arctan2(up, np.hypot(e, nn)))


@pytest.fixture(scope="module")
def world(spark):
    rng = random.Random(8)
    obs, eph, raw = [], [], {}
    sats = {"G01": (0.3, 1.2), "G02": (1.9, 2.4), "G07": (4.0, 0.1), "G09": (2.2, 5.0)}
    for sv, (m0, node) in sats.items():
        eph.append((date(2024, 10, 10), sv, DAY, 0) + (m0, node))
        secs = [30 * k for k in range(480) if rng.random() > 0.02]
        t = np.array(secs, dtype=float)
        tec = 20 + 5 * np.sin(t / 3000)
        slip1 = np.where(t > 5000, 7.0, 0.0)
        l1 = 1.1e8 + 3 * t / 30 + rng.random()
        l2 = (l1 * (fixed.LIGHT_SPEED / fixed.GPS_L1_HZ) - tec / FACTOR) / (fixed.LIGHT_SPEED / fixed.GPS_L2_HZ)
        l1 = l1 + slip1
        c1 = 2.2e7 + np.array([rng.gauss(0, 0.2) for _ in secs])
        c2 = c1 + tec / FACTOR
        for k, s in enumerate(secs):
            code2 = None if k % 11 == 0 else float(c2[k])
            obs.append(("BOAV00BRA", date(2024, 10, 10), DAY + timedelta(seconds=s), sv, k, float(l1[k]), float(l2[k]), float(c1[k]), code2))
        raw[sv] = (t, l1, l2, c1, np.array([np.nan if k % 11 == 0 else c2[k] for k in range(len(secs))]))
    # off the interval, another system, and a satellite without orbit
    obs.append(("BOAV00BRA", date(2024, 10, 10), DAY + timedelta(seconds=31), "G01", 9999, 0.0, 0.0, 0.0, 0.0))
    obs += [("BOAV00BRA", date(2024, 10, 10), DAY + timedelta(seconds=30 * k), s, 0, 1.0 + k, 2.0, 3.0, 4.0) for k in range(3) for s in ("R01", "G30")]
    obs += [("NOPH00XXX", date(2024, 10, 10), DAY, "G01", 0, 1.0, None, None, None)]
    obs += [("RUSS00XXX", date(2024, 10, 10), DAY, "R05", 0, 1.0, 2.0, 3.0, 4.0), ("NOPO00XXX", date(2024, 10, 10), DAY, "G05", 0, 1.0, 2.0, 3.0, 4.0)]
    schema = "station_id string, observation_date date, time timestamp, sv string, ingest_pos int, L1C double, L2W double, C1C double, C2W double"
    obs_df = spark.createDataFrame(obs, schema).repartition(5)
    base = spark.createDataFrame(eph, "observation_date date, sv string, time timestamp, ingest_pos int, M0 double, Omega0 double")
    zero = {n: F.lit(0.0) for n in fixed.EPHEMERIS_ELEMENTS if n not in ("M0", "Omega0")}
    eph_df = base.withColumns({**zero, "GPSWeek": F.lit(2335.0), "Toe": F.lit(345600.0), "sqrtA": F.lit(5153.7), "Io": F.lit(0.96)})
    rec = [("ev", "BOAV00BRA", "boav", date(2024, 10, 10), 2.8, -60.7, 50.0), ("ev", "NOPH00XXX", "noph", date(2024, 10, 10), 1.0, 1.0, 1.0),
           ("ev", "ZERO00XXX", "zero", date(2024, 10, 10), 0.0, 0.0, 0.0), ("ev", "LATE00XXX", "late", date(2024, 10, 20), 1.0, 1.0, 1.0),
           ("ev", "RUSS00XXX", "russ", date(2024, 10, 10), 1.0, 1.0, 1.0), ("ev", "NOPO00XXX", "nopo", date(2024, 10, 10), 0.0, 0.0, 0.0)]
    records = spark.createDataFrame(rec, "event_id string, station_id string, station_code4 string, observation_date date, lat double, lon double, height_m double")
    records = records.withColumns({**{f"header_{c}": F.lit(None).cast("double") for c in "xyz"}, "source": F.lit("net"), "obs_path": F.concat("station_id", F.lit(".obs"))})
    events = spark.createDataFrame([("ev", DAY, DAY + timedelta(hours=48))], "event_id string, start_utc timestamp, end_utc timestamp")
    return build_links(obs_df, eph_df, records, events), raw, sats, events


def expected(raw, sats):
    out, counts = {}, {}
    for sv, (t, l1, l2, c1, c2) in raw.items():
        az, el = angles(satellite(*sats[sv], t), 2.8, -60.7)
        ok = (el >= 15.0) & (t <= 4 * 3600)
        if ok.sum() < 2:
            continue
        t, l1, l2, c1, c2, el, az = (v[ok] for v in (t, l1, l2, c1, c2, el, az))
        gf = l1 * fixed.LIGHT_SPEED / fixed.GPS_L1_HZ - l2 * fixed.LIGHT_SPEED / fixed.GPS_L2_HZ
        wide = fixed.LIGHT_SPEED / (fixed.GPS_L1_HZ - fixed.GPS_L2_HZ)
        mw = (wide * (l1 - l2) - (fixed.GPS_L1_HZ * c1 + fixed.GPS_L2_HZ * c2) / (fixed.GPS_L1_HZ + fixed.GPS_L2_HZ)) / wide
        flags = walk((t * 1e6).astype(np.int64), gf, mw, SlipParams())
        keep = np.array([f[0] for f in flags])
        arc = np.array([f[1] for f in flags])[keep]
        counts[sv] = (len(flags), int(keep.sum()), sum(f[3] for f in flags), sum(f[4] for f in flags))
        stec = gf[keep] * FACTOR
        t, el, az, c1, c2 = (v[keep] for v in (t, el, az, c1, c2))
        for a in np.unique(arc):
            stec[arc == a] -= stec[arc == a][0]
        code = (c2 - c1) * FACTOR
        source = np.where(np.isfinite(code), code, stec - np.percentile(stec, 5))
        ratio = R * np.cos(np.radians(el)) / (R + H)
        vtec = source * np.sqrt(1 - ratio**2)
        for a in np.unique(arc):
            rows = np.flatnonzero(arc == a)
            rate = np.full(len(rows), np.nan)
            rate[1:] = np.diff(stec[rows]) / (np.diff(t[rows]) / 60)
            for k, i in enumerate(rows):
                win = rate[max(0, k - 9):k + 1]
                roti = np.std(win) if k >= 10 else None
                out[sv, int(t[i])] = (int(a), stec[i], vtec[i], roti, el[i], az[i])
    return out, counts


@pytest.mark.filterwarnings("ignore")
def test_links_match_the_written_steps(world):
    (links, diagnostics, failures), raw, sats, _ = world
    want, counts = expected(raw, sats)
    assert len(want) > 300 and any(w[3] is not None for w in want.values())
    rows = links.collect()
    got = {(r.sv, int((r.time.replace(tzinfo=timezone.utc) - DAY).total_seconds())): r for r in rows}
    assert got.keys() == want.keys()
    for k, (arc, stec, vtec, roti, el, az) in want.items():
        r = got[k]
        assert (r.arc_id, r.station_code4) == (arc, "BOAV")
        assert (r.stec, r.vtec, r.elev_deg, r.az_deg) == pytest.approx((stec, vtec, el, az), abs=1e-4)
        assert (r.roti is None) == (roti is None) and (roti is None or r.roti == pytest.approx(roti, abs=1e-4))
    d = {r.sv: (r.input_epoch_count, r.accepted_epoch_count, r.mw_break_count, r.gf_break_count) for r in diagnostics.collect()}
    assert d == counts and sum(c[2] + c[3] for c in counts.values()) > 0
    failed = failures.collect()
    assert {r.station_id: r.reason for r in failed} == {
        "NOPH00XXX": "missing_phase_pair", "ZERO00XXX": "empty_observations", "LATE00XXX": "out_of_window",
        "RUSS00XXX": "empty_gps_rows", "NOPO00XXX": "missing_station_position",
    }
    assert failures.columns == ["event_id", "station_id", "observation_date", "source", "obs_path", "nav_path", "stage", "reason", "detail"]
    assert {(r.source, r.obs_path, r.nav_path) for r in failed if r.station_id == "LATE00XXX"} == {("net", "LATE00XXX.obs", None)}
    assert all(r.detail == fixed.DAY_REASONS[r.reason] for r in failed)


def test_the_three_tables_are_cut_from_one_stored_table(world):
    for df in world[0]:
        plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
        assert "MapInPandas" not in plan and plan.count("Exchange") <= 6, plan
    assert "Exchange" not in world[0].links._jdf.queryExecution().executedPlan().toString()


def test_reasons_name_the_first_failing_step(spark, world):
    (links, _, _), raw, sats, events = world
    obs = [("AAAA00XXX", date(2024, 10, 10), DAY + timedelta(seconds=30 * k), "G30", k, 1.0, 2.0) for k in range(5)]
    obs += [("AAAA00XXX", date(2024, 10, 10), DAY, "G31", 0, 1.0, 2.0)]
    df = spark.createDataFrame(obs, "station_id string, observation_date date, time timestamp, sv string, ingest_pos int, L1C double, L2W double")
    rec = spark.createDataFrame([("ev", "AAAA00XXX", "aaaa", date(2024, 10, 10), 1.0, 1.0, 1.0, None, None, None)],
                                "event_id string, station_id string, station_code4 string, observation_date date, lat double, lon double, height_m double, header_x double, header_y double, header_z double")
    eph = spark.createDataFrame([], "observation_date date, sv string, time timestamp, ingest_pos int, " + ", ".join(f"{n} double" for n in fixed.EPHEMERIS_ELEMENTS))
    out = build_links(df, eph, rec, events)
    assert out.links.count() == 0
    f = out.failures.collect()
    assert [(r.reason, r.detail) for r in f] == [("insufficient_phase_samples", "insufficient_phase_samples=1, missing_navigation_solution=1")]


def test_grid_and_series_of_the_links(spark, world, tmp_path):
    (links, _, _), _, _, events = world
    links = links.persist()
    write_station_series(links, str(tmp_path))
    back = spark.read.parquet(f"{tmp_path}/roti")
    assert back.count() == links.filter("roti is not null").count() and "event_id" in back.columns
    grid, cube, products = build_grid(links, events)
    total = sum(r.sample_count for r in grid.collect())
    assert total == links.count()
    assert all(r.lat == round(r.lat) and r.lon == round(r.lon) for r in grid.collect())
    assert products.count() == 49 and products.filter(F.size("metrics") > 0).count() >= 4
    first = products.orderBy("path").first()
    assert first.path == "ev_20241010_0000" and first.time_end.minute == 45
    at = lambda s: F.lit(s).cast("timestamp")
    series, cov = build_series(links, "boav", at("2024-10-10 00:30:00"), at("2024-10-10 05:00:00"), k=1)
    assert series.select("sv").distinct().count() == 1
    assert series.agg(F.min("utc_hour")).first()[0] >= 0.5
    seen = sorted(r.sv for r in cov.collect())
    fixed_set, _ = build_series(links, "BOAV00BRA", at("2024-10-10 00:30:00"), at("2024-10-10 05:00:00"), satellites=seen)
    assert sorted(r.sv for r in fixed_set.select("sv").distinct().collect()) == seen
    links.unpersist()


def test_series_of_one_station_and_its_refusals(spark):
    rows = [(DAY + timedelta(minutes=m), s, c, sv, v, 0.1, 0) for s, c in (("BOAV00BRA", "boav"), ("BOAV41636", "BOAV"), ("ZZZZ00XXX", None)) for sv, v in (("G01", 1.0), ("G02", 2.0), ("G03", None)) for m in range(5)]
    links = spark.createDataFrame(rows, "time timestamp, station_id string, station_code4 string, sv string, vtec double, roti double, arc_id int")
    at = lambda h: F.lit((DAY + timedelta(hours=h)).strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp")
    series, cov = build_series(links, "boav", at(0), at(1), k=2)
    assert {(r.station_id, r.sv) for r in series.collect()} == {("BOAV00BRA", "G01"), ("BOAV00BRA", "G02")} and cov.count() == 3
    assert build_series(links, "ZZZZ00XXX", at(0), at(1), satellites=["g03"])[0].count() == 5

    def refused(text, *args, **more):
        series, _ = build_series(links, *args, **more)  # planning runs nothing
        with pytest.raises(Exception, match=text):
            series.collect()

    refused("no rows of station NONE in the window", "NONE", at(0), at(1))
    refused("no rows of station boav in the window", "boav", at(5), at(6))
    refused("only 2 qualified satellites. Coverage: G01: score=10, vtec=5, roti=5, longest_arc=5; G02", "boav", at(0), at(1), k=9)
    refused("has no data of satellites G30,G31", "boav", at(0), at(1), satellites=["G01", "g30", "G31"])
    with pytest.raises(ValueError, match="must not be empty"):
        build_series(links, "boav", at(0), at(1), satellites=[])
    with pytest.raises(ValueError, match="identifier is required"):
        build_series(links, " ", at(0), at(1))
    days = lambda *r: spark.createDataFrame(list(r), "observation_date date, station_id string, station_code4 string")
    ten, eleven = date(2024, 10, 10), date(2024, 10, 11)
    fine = days((ten, "BOAV00BRA", "boav"), (ten, "BOAV41636", "BOAV"), (eleven, "BOAV00BRA", "BOAV"))
    assert build_series(links, "boav", at(0), at(30), records=fine)[0].count() == 10
    refused("no row of station boav on 2024-10-11", "boav", at(0), at(30), records=days((ten, "BOAV00BRA", "boav")))
    refused("the id of station boav changes", "boav", at(0), at(30), records=days((ten, "BOAV00BRA", "boav"), (eleven, "BOAV41636", "boav")))


def test_an_event_without_links_is_refused(spark, world):
    (links, _, _), _, _, events = world
    other = events.withColumn("event_id", F.lit("quiet"))
    with pytest.raises(Exception, match="no valid links of event quiet"):
        build_grid(links, events.union(other)).grid.collect()
