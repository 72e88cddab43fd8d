"""One-to-one nearest-time pairing.

The rule: of all pairs within the tolerance take the closest, each row once,
ties by left time, right time and ids. Only neighbours on the timeline can be
the next closest pair, so the work is linear in the rows and no list of
candidates is built.

How it spreads: the open rows of all groups are numbered along the timelines and
worked in chunks of so many rows, whatever their density. A chunk knows its own
rows and, of each side, the nearest open time before and after it. It takes the
pairs that nothing outside can better; a pair that something outside might
better leaves its rows open, and so do pairs next to such rows. Rows without an
open row of the other side within the tolerance are closed. What is open then
is numbered anew and worked in shifted chunks, until nothing is open. In the
closest open pair of all something is settled in every round or the next.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tecframe.functions._col import micros
from tecframe.operators.batches import whole_groups
from tecframe.operators.ordering import numbered
from tecframe.session import settle

_FAR = 2**62
# rows of a chunk; no task holds more of a group
CHUNK_ROWS = 1 << 16


def pair_nearest(
    left: DataFrame,
    right: DataFrame,
    max_delta_sec: float,
    by: Sequence[str] = (),
    *,
    left_id: str,
    right_id: str,
    left_time: str = "time",
    right_time: str = "time",
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """by, left_id, right_id, left_time, right_time, delta_sec; worked out and stored when called.

    Ids are integers or strings without NULLs. Rows without a time pair with nothing.
    Rows of one side at one time are taken in the order of their ids, together;
    only where such rows alone fill a chunk, chunks grow.
    """
    by = list(by)
    tol = int(max_delta_sec * 1e6)
    sides = (left.select(*by, F.col(left_id).alias("_l"), micros(left_time).alias("_us"), F.lit(1).alias("_side")),
             right.select(*by, F.col(right_id).alias("_r"), micros(right_time).alias("_us"), F.lit(2).alias("_side")))
    l_type, r_type = sides[0].schema["_l"].dataType, sides[1].schema["_r"].dataType
    rows = (
        sides[0].withColumn("_r", _blank(r_type))
        .unionByName(sides[1].withColumn("_l", _blank(l_type)))
        .filter(F.col("_us").isNotNull())
    )
    schema = T.StructType(
        [
            *[left.schema[b] for b in by],
            T.StructField("_l", l_type), T.StructField("_r", r_type),
            T.StructField("_lu", T.LongType()), T.StructField("_ru", T.LongType()),
            T.StructField("_side", T.IntegerType()),
        ]
    )
    chunk, shift, done, before, idle = max(chunk_rows, 2), 0, None, None, 0
    while True:
        out = settle(_round(rows, by, schema, tol, chunk, shift), "pairs")
        pairs = out.filter("_side = 0")
        done = pairs if done is None else done.unionByName(pairs)
        open_ = out.filter("_side > 0").count()
        if not open_:
            break
        rows = out.filter("_side > 0").select(*by, "_l", "_r", F.col("_lu").alias("_us"), "_side")
        shift = 0 if shift else chunk // 2
        idle = idle + 1 if open_ == before else 0
        if idle == 2:
            chunk, shift, idle = 2 * chunk, 0, 0
        before = open_
    return done.select(
        *by, F.col("_l").alias("left_id"), F.col("_r").alias("right_id"),
        F.timestamp_micros("_lu").alias("left_time"), F.timestamp_micros("_ru").alias("right_time"),
        (F.abs(F.col("_lu") - F.col("_ru")) / 1e6).alias("delta_sec"),
    )


def _blank(kind: T.DataType) -> Column:
    """Filler of the id column that a side does not have; integers keep their type in Arrow."""
    return F.lit("" if isinstance(kind, T.StringType) else 0).cast(kind)


# nearest open time outside a chunk: of left and right rows before it, of left and right rows after it
OUTSIDE = ("_l_before", "_r_before", "_l_after", "_r_after")


def _surroundings(rows: DataFrame, by: list[str]) -> DataFrame:
    """Of each group that a chunk's border cuts, the times next to that chunk: two rows a chunk at most."""
    of = lambda f, side: f(F.when(F.col("_side") == side, F.col("_us")))
    spans = rows.groupBy(*by, "_chunk").agg(*[of(f, s).alias(f"_{n}{s}") for f, n in ((F.max, "max"), (F.min, "min")) for s in (1, 2)])
    timeline = (Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))).orderBy("_chunk")
    earlier = timeline.rowsBetween(Window.unboundedPreceding, -1)
    later = timeline.rowsBetween(1, Window.unboundedFollowing)
    found = [F.max(f"_max{s}").over(earlier) for s in (1, 2)] + [F.min(f"_min{s}").over(later) for s in (1, 2)]
    cut = spans.select(*by, "_chunk", *[c.alias(n) for c, n in zip(found, OUTSIDE)])
    return cut.filter(F.coalesce(*OUTSIDE).isNotNull())


def _round(rows: DataFrame, by: list[str], schema: T.StructType, tol: int, chunk: int, shift: int) -> DataFrame:
    """Pairs (side 0) and rows that are still open (side 1 or 2)."""
    group = ["_chunk", *by]
    ordered = numbered(rows, [*by, "_us", "_side", "_l", "_r"]).withColumn("_chunk", F.expr(f"(_n + {shift}) div {chunk}")).drop("_n")
    around = _surroundings(ordered, by).select(*[F.col(c).alias("_o" + c) for c in group], *OUTSIDE)
    on = [F.col(c).eqNullSafe(F.col("_o" + c)) for c in group]
    known = ordered.join(around, on, "left").drop(*["_o" + c for c in group])
    known = known.withColumns({c: F.coalesce(c, F.lit(-_FAR if c.endswith("before") else _FAR)) for c in OUTSIDE})
    known = known.repartition("_chunk").sortWithinPartitions(*group, "_us", "_side", "_l", "_r")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf, starts in whole_groups(batches, group):
            us = pdf["_us"].to_numpy(np.int64)
            side = pdf["_side"].to_numpy(np.int64)
            li, ri, rest = greedy_rows(us, side, starts, tol, [pdf[c].to_numpy(np.int64)[starts] for c in OUTSIDE])
            a = np.concatenate([li, rest])
            b = np.concatenate([ri, rest])
            kind = np.concatenate([np.zeros(len(li), dtype=np.int32), side[rest].astype(np.int32)])
            yield pd.DataFrame(
                {
                    **{c: pdf[c].to_numpy()[a] for c in by},
                    "_l": pdf["_l"].to_numpy()[a], "_r": pdf["_r"].to_numpy()[b],
                    "_lu": us[a], "_ru": us[b], "_side": kind,
                }
            )

    return known.mapInPandas(run, schema)


def greedy_rows(
    us: np.ndarray, side: np.ndarray, starts: np.ndarray, tol: int, outside: Sequence[np.ndarray]
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(left rows, right rows, open rows) of all groups."""
    lefts: list[int] = []
    rights: list[int] = []
    rest: list[int] = []
    ends = np.append(starts[1:], len(us))
    for a, b, *known in zip(starts.tolist(), ends.tolist(), *(o.tolist() for o in outside)):
        if (side[a:b] != side[a]).any() or min(map(abs, known)) < _FAR:
            _greedy(us[a:b].tolist(), side[a:b].tolist(), a, tol, *known, lefts, rights, rest)
    as_rows = lambda v: np.array(v, dtype=np.int64)
    return as_rows(lefts), as_rows(rights), as_rows(rest)


def _greedy(us, side, first, tol, l_before, r_before, l_after, r_after, lefts, rights, rest) -> None:
    """Decides one group of a chunk; rows are given as numbers from ``first`` on.

    ``l_before`` is the latest time before the chunk that may hold an open left
    row, and so on. Of two pairs of one distance the earlier goes first, so an
    equal one before the chunk may win, one after it can't. The rows of a pair
    that is not certain become unknown, too.
    """
    # rows of one side at one time form a node; its rows are used in id order
    nodes: list[list[int]] = []
    for i in range(len(us)):
        if nodes and us[nodes[-1][0]] == us[i] and side[nodes[-1][0]] == side[i]:
            nodes[-1].append(i)
        else:
            nodes.append([i])
    count = len(nodes)
    at = [us[n[0]] for n in nodes]
    kind = [side[n[0]] for n in nodes]
    prev = list(range(-1, count - 1))
    nxt = list(range(1, count + 1))
    used = [0] * count
    bounds = l_before, r_before, l_after, r_after
    heap: list[tuple[int, int, int, int, int]] = []

    def offer(x: int, y: int) -> None:
        if x < 0 or y >= count or kind[x] == kind[y]:
            return
        delta = abs(at[x] - at[y])
        if delta <= tol:
            l, r = (x, y) if kind[x] == 1 else (y, x)
            heapq.heappush(heap, (delta, at[l], at[r], l, r))

    for x in range(count - 1):
        offer(x, x + 1)
    while heap:
        delta, tl, tr, l, r = heapq.heappop(heap)
        take = min(len(nodes[l]) - used[l], len(nodes[r]) - used[r])
        if take <= 0:
            continue
        if tl - r_before <= delta or tr - l_before <= delta:
            l_before, r_before = max(l_before, tl), max(r_before, tr)
            continue
        if r_after - tl < delta or l_after - tr < delta:
            l_after, r_after = min(l_after, tl), min(r_after, tr)
            continue
        lefts.extend(first + i for i in nodes[l][used[l]:used[l] + take])
        rights.extend(first + i for i in nodes[r][used[r]:used[r] + take])
        used[l] += take
        used[r] += take
        for x in (l, r):
            if used[x] == len(nodes[x]):
                p, q = prev[x], nxt[x]
                if p >= 0:
                    nxt[p] = q
                if q < count:
                    prev[q] = p
                offer(p, q)
    # a row stays open if an open row of the other side, here or outside, is within the tolerance
    left_over = [x for x in range(count) if used[x] < len(nodes[x])]
    near = dict.fromkeys(left_over, False)
    for walk, seen in ((left_over, {1: bounds[0], 2: bounds[1]}), (left_over[::-1], {1: bounds[2], 2: bounds[3]})):
        for x in walk:
            near[x] |= abs(at[x] - seen[3 - kind[x]]) <= tol
            seen[kind[x]] = at[x]
    for x in left_over:
        if near[x]:
            rest.extend(first + i for i in nodes[x][used[x]:])


def unmatched(
    entries: DataFrame, pairs: DataFrame, *, entry_id: str, sides: Sequence[str] = ("left_id", "right_id")
) -> DataFrame:
    """Entries that no pair uses."""
    used = pairs.select(F.explode(F.array(*sides)).alias("_used"))
    return entries.join(used, F.col(entry_id) == F.col("_used"), "left_anti")
