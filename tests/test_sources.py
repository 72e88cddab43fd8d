import io
import tarfile
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tecframe.operators.sets import upsert
from tecframe.plans.scenes import build_pixels, build_scenes
from tecframe.sources import archives, catalogs, listing, manifests, tables
from tecframe.session import ensure_checkpoint_dir, scratch_dir


def test_whole_file_wins_over_parts(spark, tmp_path):
    root = str(tmp_path)
    spark.range(3).write.parquet(f"{root}/ev.part0.parquet")
    spark.range(3, 5).withColumn("x", F.lit(1)).write.parquet(f"{root}/ev.part1.parquet")
    parts = tables.read_parts(spark, root, "ev")
    assert parts.count() == 5 and parts.columns == ["id", "x"]
    spark.range(1).write.parquet(f"{root}/ev.parquet")
    assert tables.read_parts(spark, root, "ev").count() == 1
    with pytest.raises(Exception):
        tables.read_parts(spark, root, "none").count()
    with pytest.raises(ValueError):
        tables.load_table(spark, f"{root}/ev.xlsx")


def test_index_file_with_byte_order_mark_and_error_answer(spark, tmp_path):
    p = tmp_path / "kp.csv"
    p.write_bytes("﻿KpStart,Kp,KpEnd\n2024-10-10T00:00:00Z,1.3333333333,2024-10-10T03:00:00Z\n".encode())
    r = tables.read_omni(spark, str(p), "kp").first()
    assert r.KpStart == datetime(2024, 10, 10) and r.Kp == pytest.approx(4 / 3)
    bad = tmp_path / "bad.csv"
    bad.write_text("HAPI error 1406\n")
    with pytest.raises(Exception, match="service reported an error"):
        tables.read_omni(spark, str(bad), "bz").collect()
    plain = tmp_path / "plain.csv"
    plain.write_text("2024-10-10T00:00:00Z,9999.99\n2024-10-10T00:01:00Z,-3.5\n")
    assert [x.IMF_Bz_nT for x in tables.read_omni(spark, str(plain), "bz", header=False).orderBy("Time").collect()] == [None, -3.5]


@pytest.mark.parametrize("suffix", ["csv", "parquet"])
@pytest.mark.parametrize("name", sorted(manifests.SCHEMAS))
def test_manifests_come_back_equal(spark, tmp_path, name, suffix):
    values = {"STRING": 'a "quoted", text', "TIMESTAMP": datetime(2024, 10, 10, 1, 2, 3), "DOUBLE": 1.5, "INT": 7, "BIGINT": 8}
    fields = [f.strip().split(" ") for f in manifests.SCHEMAS[name].split(",")]
    row, schema = [], []
    for col, kind in fields:
        if col == "metadata_json":
            row.append({"b": "2", "a": "x,y"})
            schema.append("metadata map<string,string>")
        elif col == "metrics_json":
            row.append(["VTEC", "roti"])
            schema.append("metrics array<string>")
        else:
            row.append(None if col in ("error", "detail") else values[kind])
            schema.append(f"{col} {kind}")
    df = spark.createDataFrame([tuple(row)], ", ".join(schema))
    path = f"{tmp_path}/{name}.{suffix}"
    manifests.write_manifest(df, name, path)
    back = manifests.read_manifest(spark, name, path)
    want = df.first().asDict()
    if "metrics" in want:
        want["metrics"] = ["vtec", "roti"]
    assert back.first().asDict() == want


def test_json_keys_are_sorted(spark):
    df = spark.createDataFrame([({"b": "2", "a": "1"},)], "metadata map<string,string>")
    assert df.select(manifests.sorted_json(F.col("metadata"))).first()[0] == '{"a":"1","b":"2"}'


def test_upsert_replaces_one_producer(spark):
    old = spark.createDataFrame([("internal", 1), ("isee", 2)], "producer string, v int")
    new = spark.createDataFrame([("internal", 9)], "producer string, v int")
    assert sorted(upsert(old, new, "internal").collect()) == [("internal", 9), ("isee", 2)]


def write_tar(path, names, cut=None):
    buf = io.BytesIO()
    with tarfile.open(fileobj=buf, mode="w") as tar:
        folder = tarfile.TarInfo("d")
        folder.type = tarfile.DIRTYPE
        tar.addfile(folder)
        for n in names:
            info = tarfile.TarInfo(n)
            info.size = 1000
            tar.addfile(info, io.BytesIO(b"x" * 1000))
    data = buf.getvalue()
    path.write_bytes(data[:cut] if cut else data)


def test_one_producer_is_replaced_in_place(spark, tmp_path):
    """The files of other producers keep their names and times; no rows leave none; names are checked."""
    path = str(tmp_path / "products")
    files = lambda: {(str(f.relative_to(path)), f.stat().st_mtime_ns) for f in (tmp_path / "products").glob("producer=*/*.parquet") if "=internal" not in str(f)}
    read = lambda: sorted(map(tuple, spark.read.schema("n LONG, producer STRING").parquet(path).collect()), key=str)
    tables.save_by_key(spark.createDataFrame([(1, "internal"), (2, "isee"), (3, None), (4, "internal")], "n long, producer string"), path)
    before = files()
    tables.replace_in_place(spark.createDataFrame([(9, "isee"), (9, "isee")], "n long, producer string"), path, "internal")
    assert read() == [(2, "isee"), (3, None), (9, "internal"), (9, "internal")] and files() == before and len(before) == 2
    tables.replace_in_place(spark.createDataFrame([], "n long"), path, "internal")
    assert read() == [(2, "isee"), (3, None)] and files() == before
    tables.replace_in_place(spark.createDataFrame([(5,)], "n long"), path, "new")
    assert read() == [(2, "isee"), (3, None), (5, "new")]
    with pytest.raises(ValueError):
        tables.replace_in_place(spark.createDataFrame([(5,)], "n long"), path, "../other")


def test_archive_index_and_scenes(spark, tmp_path):
    name = lambda ch, hh, mm, doy=284: f"d/GOLD_L1C_{ch}_NI1_2024_{doy}_{hh:02d}_{mm:02d}_v04_r01.nc"
    write_tar(tmp_path / "a.tar", [name("CHA", 23, 10), name("CHB", 23, 12), name("CHA", 23, 40), name("CHB", 0, 1, 285), "d/readme.txt"])
    write_tar(tmp_path / "b.tar", [name("CHA", 1, 0), name("CHB", 1, 2), name("CHB", 1, 30)], cut=512 + 512 + 1024 + 512 + 300)
    entries = archives.index_archives(spark, str(tmp_path))
    rows = entries.collect()
    assert len(rows) == 6 and {r.size for r in rows} == {1000}
    events = spark.createDataFrame([(datetime(2024, 10, 10), datetime(2024, 10, 11))], "start_utc timestamp, end_utc timestamp")
    out = build_scenes(entries, events)
    scenes = sorted((r.tar_path[-5:], r.midpoint, r.delta_minutes) for r in out.scenes.collect())
    assert scenes == [("a.tar", datetime(2024, 10, 10, 23, 11), 2.0), ("b.tar", datetime(2024, 10, 10, 1, 1), 2.0)]
    # the two left over lie 21 minutes apart and on different dates
    assert out.unmatched.count() == 2


def test_nearest_wavelength_of_pixels(spark):
    df = spark.createDataFrame([(1.0, 2.0, [130.0, 135.0, 136.3], [1.0, 2.0, 3.0], 0, 45.0), (1.0, 2.0, [135.5, 135.7], [5.0, 6.0], 0, 89.5)],
                               "lat double, lon double, wavelength array<double>, radiance array<double>, quality int, emission double")
    assert [r.radiance for r in build_pixels(df).collect()] == [2.0, None]


def test_listing_ignores_empty_files(spark, tmp_path):
    (tmp_path / "x").mkdir()
    (tmp_path / "x" / "a.nc").write_bytes(b"1")
    (tmp_path / "x" / "b.nc").write_bytes(b"")
    (tmp_path / "c.txt").write_bytes(b"1")
    assert [r.path[-4:] for r in listing.list_assets(spark, str(tmp_path), "*.nc").collect()] == ["a.nc"]


def test_segments_win_over_the_single_file(spark):
    df = spark.createDataFrame([("e1", "/n/e1.nc"), ("e1", "/n/e1_00.nc"), ("e1", "/n/e1_01.nc"), ("e2", "/n/e2.nc"), ("e2", "/n/x.nc")], "event_id string, path string")
    assert sorted(r.path for r in listing.event_segments(df).collect()) == ["/n/e1_00.nc", "/n/e1_01.nc", "/n/e2.nc"]


def test_links_of_a_page(spark):
    df = spark.createDataFrame([('<a href="b.NC">x</a><a href="a.nc">y</a><a href="b.NC">x</a><a href="c">z</a>',)], "html string")
    assert sorted(r.link for r in catalogs.extract_links(df, suffix=".nc").collect()) == ["a.nc", "b.NC"]
    assert [r.link for r in catalogs.extract_links(df, suffix=".nc", ignore_case=False).collect()] == ["a.nc"]


def test_checkpoint_folder_of_the_session_is_kept(spark):
    ensure_checkpoint_dir(spark)
    first = spark.sparkContext.getCheckpointDir()
    ensure_checkpoint_dir(spark)
    assert spark.sparkContext.getCheckpointDir() == first
    assert scratch_dir(spark, "a").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_a_full_hour_is_written_by_several_tasks(spark, tmp_path):
    from tecframe.sources.tables import write_hourly

    rows = spark.range(4000).select(
        F.lit("ev").alias("event_id"), "id", F.when(F.col("id") < 3800, F.lit("2024-10-10 05:00:00")).otherwise("2024-10-10 06:00:00").cast("timestamp").alias("chunk_start")
    )
    write_hourly(rows, str(tmp_path), rows=500)
    files = lambda hour: len(list((tmp_path / "event_id=ev" / f"chunk=20241010_{hour}00").glob("*.parquet")))
    assert files("05") >= 4 and files("06") == 1
    back = spark.read.parquet(str(tmp_path))
    assert back.count() == 4000 and back.select("id").distinct().count() == 4000
    write_hourly(rows.limit(0), str(tmp_path / "none"))
    assert not list((tmp_path / "none").glob("event_id=*"))


def test_index_lines_of_several_parts_and_blank_ones(spark, tmp_path):
    for i, rows in enumerate(("2024-10-10T00:00:00Z,1.5", "\n2024-10-10T00:01:00Z,9999.99\n2024-10-10T00:02:00Z,")):
        (tmp_path / f"p{i}.csv").write_text('"Time", IMF_Bz_nT\n' + rows + "\n")
    df = tables.read_omni(spark, str(tmp_path), "bz")
    assert [tuple(r) for r in df.orderBy("Time").collect()] == [
        (datetime(2024, 10, 10), 1.5), (datetime(2024, 10, 10, 0, 1), None), (datetime(2024, 10, 10, 0, 2), None)]
    # one scan, and nothing runs before the series is read
    assert df._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    (tmp_path / "p2.csv").write_text("Time,IMF_Bz_nT\nHAPI error 1500\n")
    late = tables.read_omni(spark, str(tmp_path), "bz")
    with pytest.raises(Exception, match="service reported an error"):
        late.collect()


def test_ordered_tables_keep_ranges_that_follow_each_other(spark, tmp_path):
    path = f"{tmp_path}/ordered"
    # one key holds a third of the rows, some are null, some repeat
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 1000 != 1, F.col("id") * 7919 % 30_011).alias("k"),
        F.struct((F.col("id") % 5).alias("x")).alias("s"), F.expr("map('a', id)").alias("m"), F.floor(F.col("id") / 2).alias("v"),
    )
    merge = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(merge, "false")
    tables.write_ordered(df, path, ["k"], rows=1000)
    spark.conf.unset(merge)
    files = spark.read.parquet(f"{path}/_order").orderBy("nth").collect()
    assert len(files) > 30 and max(f.rows for f in files) <= 1000 and sum(f.rows for f in files) == 30_000
    assert [f.before for f in files] == [sum(g.rows for g in files[:i]) for i in range(len(files))]
    assert tables.order_problems(spark, path).count() == 0
    # the hot key is not in one task's files alone
    assert len({f.file.split("-")[1] for f in files if f.low.k is not None and f.low.k <= 7 <= f.high.k}) > 1
    rows = tables.read_ordered(spark, path).orderBy("position").collect()
    assert [r.position for r in rows] == list(range(30_000))
    got = [(r.k is not None, r.k or 0, r.s.x, r.v) for r in rows]
    assert got == sorted((r.k is not None, r.k or 0, r.s.x, r.v) for r in df.collect())
    assert spark.read.parquet(path).count() == 30_000
    plan = tables.read_ordered(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert "Sort " not in plan and "rangepartitioning" not in plan
    tables.write_ordered(df.limit(0), f"{tmp_path}/none", ["k"])
    assert tables.read_ordered(spark, f"{tmp_path}/none").count() == 0
    with pytest.raises(ValueError):
        tables.write_ordered(df, path, [])
