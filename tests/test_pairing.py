import random
from datetime import datetime, timedelta

import numpy as np
import pytest

from tecframe.operators import pairing
from tecframe.operators.pairing import pair_nearest, unmatched

START = datetime(2024, 10, 10)


def brute(left, right, tol):
    """left, right: (by, id, second). The rule, written down directly."""
    pairs = []
    for by in {b for b, _, _ in left}:
        ls = [(t, i) for b, i, t in left if b == by]
        rs = [(t, i) for b, i, t in right if b == by]
        cand = sorted((abs(a - b), a, b, i, j) for a, i in ls for b, j in rs if abs(a - b) <= tol)
        used_l, used_r = set(), set()
        for _, _, _, i, j in cand:
            if i not in used_l and j not in used_r:
                used_l.add(i)
                used_r.add(j)
                pairs.append((by, i, j))
    return sorted(pairs)


def frames(spark, left, right):
    at = lambda rows: [(b, i, START + timedelta(seconds=s)) for b, i, s in rows]
    schema = "by string, id long, time timestamp"
    return spark.createDataFrame(at(left), schema).repartition(4), spark.createDataFrame(at(right), schema).repartition(3)


def test_two_pairs_one_minute_apart(spark):
    left = [("e", 0, 0), ("e", 1, 600)]
    right = [("e", 0, 60), ("e", 1, 660)]
    out = pair_nearest(*frames(spark, left, right), 120.0, ["by"], left_id="id", right_id="id").collect()
    assert sorted((r.left_id, r.right_id, r.delta_sec) for r in out) == [(0, 0, 60.0), (1, 1, 60.0)]


@pytest.mark.parametrize("seed,rows", [(1, 10**6), (2, 60), (3, 25)])
def test_against_the_written_rule(spark, seed, rows):
    """Few rows per chunk force several rounds, also with chunks below the tolerance."""
    rng = random.Random(seed)
    make = lambda n: [(rng.choice("ab"), i, rng.randint(0, 3000)) for i in range(n)]
    left, right = make(180), make(150)
    tol = 45
    out = pair_nearest(
        *frames(spark, left, right), float(tol), ["by"], left_id="id", right_id="id", chunk_rows=rows
    ).collect()
    assert sorted((r.by, r.left_id, r.right_id) for r in out) == brute(left, right, tol)


def rounds(rows, tol, chunk):
    """The rounds of one group without Spark: pairs, number of rounds, rows of the largest chunk. rows: (time, side, id)."""
    pairs, open_, shift, count, largest, before, idle = [], sorted(rows), 0, 0, 0, None, 0
    while open_:
        count, chunks, rest = count + 1, {}, []
        for n, row in enumerate(open_):
            chunks.setdefault((n + shift) // chunk, []).append(row)
        for k, own in chunks.items():
            largest = max(largest, len(own))
            times = lambda side, here: [t for j, c in chunks.items() if here(j) for t, s, _ in c if s == side]
            outside = [max(times(s, lambda j: j < k), default=-pairing._FAR) for s in (1, 2)] + [min(times(s, lambda j: j > k), default=pairing._FAR) for s in (1, 2)]
            us, side = np.array([r[0] for r in own]), np.array([r[1] for r in own])
            li, ri, left = pairing.greedy_rows(us, side, np.array([0]), tol, [np.array([o]) for o in outside])
            pairs += [(own[i][2], own[j][2]) for i, j in zip(li, ri)]
            rest += [own[i] for i in left]
        open_, shift = sorted(rest), 0 if shift else chunk // 2
        idle = idle + 1 if len(open_) == before else 0
        before = len(open_)
        if idle == 2:
            chunk, shift, idle = 2 * chunk, 0, 0
    return sorted(pairs), count, largest


def test_rounds_of_small_chunks_follow_the_rule():
    rng = random.Random(7)
    for trial in range(400):
        span, tol, share = rng.choice([5, 30, 200, 2000]), rng.choice([0, 1, 5, 40, 300]), rng.choice([0.05, 0.5, 0.9])
        rows = [(rng.randint(0, span) if trial % 3 else 7 * i, 1 if rng.random() < share else 2, i) for i in range(rng.randint(1, 50))]
        want = brute([("a", i, t) for t, s, i in rows if s == 1], [("a", i, t) for t, s, i in rows if s == 2], tol)
        assert rounds(rows, tol, rng.choice([2, 3, 4, 7, 16, 100]))[0] == [(i, j) for _, i, j in want]


def test_many_rows_of_one_side_never_meet_in_one_chunk():
    rng = random.Random(1)
    sparse = [(rng.randint(0, 10**7), 1, i) for i in range(40_000)] + [(rng.randint(0, 10**7), 2, 10**6 + i) for i in range(40)]
    pairs, count, largest = rounds(sparse, 10**6, 2000)
    assert (len(pairs), largest) == (40, 2000) and count <= 3
    apart = [(i, 1, i) for i in range(2000)] + [(10**5 + i, 2, 10**4 + i) for i in range(2000)]  # all pairs nested
    pairs, count, largest = rounds(apart, 2 * 10**5, 200)
    assert pairs == [(1999 - i, 10**4 + i) for i in range(1999, -1, -1)] and largest == 200


def test_many_rows_of_one_side_on_spark(spark):
    rng = random.Random(2)
    left, right = [("a", i, rng.randint(0, 10**5)) for i in range(4000)], [("a", i, rng.randint(0, 10**5)) for i in range(30)]
    out = pair_nearest(*frames(spark, left, right), 9000.0, ["by"], left_id="id", right_id="id", chunk_rows=500).collect()
    assert sorted((r.by, r.left_id, r.right_id) for r in out) == brute(left, right, 9000)


def test_tolerance_is_inclusive_and_ids_may_be_text(spark):
    l = spark.createDataFrame([("x", START)], "id string, time timestamp")
    r = spark.createDataFrame([("y", START + timedelta(seconds=300)), ("z", START - timedelta(seconds=301))], "id string, time timestamp")
    out = pair_nearest(l, r, 300.0, left_id="id", right_id="id").collect()
    assert [(o.left_id, o.right_id, o.delta_sec) for o in out] == [("x", "y", 300.0)]


def test_unmatched_and_pairs_make_up_all_entries(spark):
    left = [("a", i, i * 100) for i in range(20)]
    right = [("a", 100 + i, i * 130 + 7) for i in range(20)]
    l, r = frames(spark, left, right)
    pairs = pair_nearest(l, r, 30.0, ["by"], left_id="id", right_id="id")
    rest = unmatched(l.union(r), pairs, entry_id="id")
    assert rest.count() + 2 * pairs.count() == 40


def test_empty_sides(spark):
    l, r = frames(spark, [("a", 1, 0)], [])
    assert pair_nearest(l, r, 30.0, ["by"], left_id="id", right_id="id").count() == 0
    assert pair_nearest(r, r, 30.0, ["by"], left_id="id", right_id="id").count() == 0
