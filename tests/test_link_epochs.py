"""Epochs of link tracks: the last row of an epoch counts, rows of other epochs all do."""

import pytest

from tests.test_standins import MINUTE, MS, both, write


@pytest.mark.parametrize("name", ["p03_link_tracks", "p05_station_series"])
def test_only_rows_of_one_epoch_give_way(spark, tmp_path, name):
    lone = [(1100 + i, MINUTE + i * 700 * MS, 3, "view", 20.0 + i % 4) for i in range(12)] + [(1200 + i, MINUTE + i * 900 * MS, 4, "view", 30.0 + i % 3) for i in range(10)]
    again = [(e + 400 + 1000 * k, ts, u, "click", 7.0) for k, (e, ts, u, _, _) in enumerate(lone[::3])]  # other epochs: the events' own microseconds differ
    earlier = [(e - 1000, ts, u, "click", 9.0) for e, ts, u, _, _ in lone[1::3]]  # the same epochs, earlier events
    folders = []
    for key, rows in (("lone", [*lone, *again]), ("repeated", [*earlier, *lone, *again])):
        (tmp_path / key).mkdir()
        folders.append(write(rows, tmp_path / key))
    rounded = lambda rows: [tuple(round(v, 5) if isinstance(v, float) else v for v in r) for r in rows]
    (base, _), (got, want) = (both(spark, f, name) for f in folders)
    assert len(base) > 20 and rounded(got) == rounded(base) == rounded(want)
