"""The stand-in tables on rows of their own."""

import datetime as dt

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from tecframe.queries import ORACLES, QUERIES

MINUTE = dt.datetime(2024, 1, 5, 12, 0)
MS = dt.timedelta(milliseconds=1)


def write(rows, path):
    names, kinds = ("event_id", "ts", "user_id", "event_type", "value"), (pa.int64(), pa.timestamp("us"), pa.int64(), pa.string(), pa.float64())
    table = pa.table({n: pa.array(c, k) for n, c, k in zip(names, zip(*rows), kinds)})
    pq.write_table(table.append_column("props", pa.nulls(len(rows), pa.string())), path / "events.parquet")
    pq.write_table(pa.table({"n_nationkey": pa.array([2, 3, 4], pa.int32()), "n_regionkey": pa.array([1, 1, 0], pa.int32())}), path / "nation.parquet")
    return str(path)


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    rows = [(i, MINUTE + i * 400 * MS, 3, "view", 20.0 + i) for i in range(1, 9)]  # a few seconds of one track
    rows += [(1002, rows[1][1], 3, "click", 99.0), (3002, rows[1][1], 3, "click", 77.0)]  # the epoch of event 2 again
    rows += [(7, rows[6][1], 3, "view", 27.0)]  # a row that comes twice
    rows += [(50, None, 3, "view", 1.0), (51, None, 3, "view", 2.0), (None, MINUTE, 4, "view", 3.0)]  # no epoch
    return write(rows, tmp_path_factory.mktemp("standins"))


def both(spark, folder, name):
    got = [tuple(r) for r in QUERIES[name](spark, folder).collect()]
    con = duckdb.connect()
    for table in ("events", "nation"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    order = lambda rows: sorted(rows, key=lambda r: tuple((v is None, str(v)) for v in r))
    return order(got), order(con.execute(ORACLES[name]).fetchall())


def test_last_event_of_an_epoch_counts_and_rows_without_a_time_stay(spark, folder):
    got, want = both(spark, folder, "l01_canonical_order")
    assert got == want
    timed = sorted(r[3] for r in got if r[0] is not None)
    assert timed == [21.0, 23.0, 24.0, 25.0, 26.0, 27.0, 28.0, 77.0]  # all epochs of the minute
    assert sorted(r[3] for r in got if r[0] is None) == [1.0, 2.0, 3.0]


@pytest.mark.parametrize("name", ["w01_gap_and_jump_arcs", "w03_rate_of_change", "w05_rolling_median", "a14_arc_baseline", "f07_elevation_mask"])
def test_tracks_of_repeated_epochs_equal_their_sql(spark, folder, name):
    got, want = both(spark, folder, name)
    assert len(got) == len(want) and sum(r[2] is not None for r in got) == (8 if name != "f07_elevation_mask" else 5)
    timed = lambda rows: [tuple(round(v, 4) if isinstance(v, float) else v for v in r) for r in rows if r[2] is not None]
    assert timed(got) == timed(want)


@pytest.fixture(scope="module")
def repeated_and_lone(tmp_path_factory):
    """Two folders: tracks of three satellites with repeated epochs, and the rows of these that count."""
    lone = [(2000 + 7 * i + u, MINUTE + i * 400 * MS + u * 10 * MS, u, "view", 20.0 + i * i % 7 + u) for i in range(1, 13) for u in (3, 4, 35)]
    again = [(e - 1000, ts, u, "click", 5.0 * v) for e, ts, u, _, v in lone[::2]]  # earlier events of the same epochs
    return [write(rows, tmp_path_factory.mktemp(name)) for name, rows in (("repeated", [*again, *lone, *lone[:5]]), ("lone", lone))]


@pytest.mark.parametrize(
    "name",
    ["p05_station_series", "a09_coverage", "w09_rank_satellites", "a14_arc_baseline", "a18_arc_and_cell_summary", "w01_gap_and_jump_arcs", "w03_rate_of_change",
     "w04_roti", "j12_merge_back", "w05_rolling_median", "w06_rolling_polynomial", "f07_elevation_mask", "f08_any_metric", "f08_station_series", "j13_chosen_satellites"],
)
def test_repeated_epochs_count_once(spark, repeated_and_lone, name):
    rows = lambda got: [tuple(round(v, 5) if isinstance(v, float) else v for v in r) for r in got if r[0] != "cell"]  # cells count events, not links
    (got, want), (base, _) = (both(spark, path, name) for path in repeated_and_lone)
    assert len(base) > 0 and rows(got) == rows(base)
    assert rows(got) == rows(want)
