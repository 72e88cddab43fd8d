"""Near duplicates of vectors by NN-descent.

Equal vectors count once. A neighbour graph starts from the leaves of a few
trees of random hyperplanes (large leaves are split at random) and is refined
by local joins: the neighbours of a vector, in either direction, are compared
with each other and enter each other's lists where they are closer than the
last one there. The result is audited: slices of the vectors are compared with
all others until LINKED vectors with a link have been seen, or all vectors. While
too many of their links or components are wrong, trees are added, lists grow and
the descent goes on; where that doesn't help, or the audit has seen all vectors
anyway, lists come from a comparison of all with all.

Edges at the threshold give components. A list whose last neighbour is still at
the threshold is saturated: it is enlarged to all links of its component,
counted block against block. A link between two saturated vectors may be in
neither list, so saturated vectors of different components are compared as well:
blocks of them, except where centres and radii exclude a link. What links there
merges components.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tecframe.llm.graphs import components, settle
from tecframe.session import scratch_dir

THRESHOLD = 0.9
LIST, REVERSE = 12, 8  # neighbours kept, and as many from the other direction in a local join
TREES, LEAF = (4, 8, 16), 256  # trees that each attempt adds
ROUNDS = 5
DONE = 0.01  # share of changed entries below which a descent ends
LINKED, RECALL = 200, 0.98  # vectors with links that the audit has to see, and the share of their links that has to be found
SLICE, TOGETHER = 1024, 4  # vectors of a slice, about, and slices compared with all in one pass
BLOCK = 1024
CHUNK = 512  # centres that one local join task group holds
SLACK = 1e-6  # radians that rounding may add to an angle


def _unit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Packs vectors that can be linked, at length one; the others become null."""
    for b in batches:
        packed = []
        for v in b.column("embedding").to_pylist():
            x = np.array([np.nan if c is None else c for c in v], np.float64) if v else np.zeros(0)
            norm = np.linalg.norm(x / max(np.abs(x).max(), 1e-300)) * np.abs(x).max() if len(x) and np.isfinite(x).all() else 0.0
            packed.append((x / norm).tobytes() if norm > 0 and np.isfinite(norm) else None)
        yield pa.RecordBatch.from_arrays([b.column("vec_id"), pa.array(packed, pa.binary())], ["vec_id", "unit"])


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    return np.stack([np.frombuffer(x, np.float64) for x in column.to_pylist()])


def _leaves(dims: int, bits: int, trees: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes = np.random.default_rng(seed).normal(size=(dims, trees * bits))
        for b in batches:
            if b.num_rows:
                side = (_matrix(b.column("unit")) @ planes > 0).reshape(-1, trees, bits)
                code = (side << np.arange(bits)).sum(axis=2) + (np.arange(trees) << 40)
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(b.column("id").to_numpy(), trees)), pa.array(code.ravel())], ["id", "leaf"])

    return run


def _nearest(table: pa.Table) -> pa.Table:
    """The closest vectors of one leaf for each of its vectors."""
    ids, x = table["id"].to_numpy(), _matrix(table["unit"])
    s = x @ x.T
    np.fill_diagonal(s, -2)
    k = min(LIST, len(ids) - 1)
    if k < 1:
        return pa.table({"u": pa.array([], pa.int64()), "v": pa.array([], pa.int64()), "sim": pa.array([], pa.float64())})
    top = np.argpartition(-s, k - 1, axis=1)[:, :k]
    return pa.table({"u": np.repeat(ids, k), "v": ids[top].ravel(), "sim": np.take_along_axis(s, top, 1).ravel()})


def _local_join(table: pa.Table) -> pa.Table:
    """Pairs of neighbours of one centre that are closer than what either has last."""
    centre, ids, last = table["c"].to_numpy(), table["v"].to_numpy(), table["last"].to_numpy()
    x = _matrix(table["unit"])
    order = np.argsort(centre, kind="stable")
    cuts = np.flatnonzero(np.diff(centre[order])) + 1
    out = [[], [], []]
    for rows in np.split(order, cuts):
        s = x[rows] @ x[rows].T
        bound = last[rows]
        # vectors that are both saturated are settled later
        better = np.triu((s > np.minimum(bound[:, None], bound[None, :])) & (np.minimum(bound[:, None], bound[None, :]) < THRESHOLD), 1)
        i, j = np.nonzero(better & (ids[rows][:, None] != ids[rows][None, :]))
        a, b, sim = ids[rows][i], ids[rows][j], s[i, j]
        for x_, y_ in zip(out, (np.concatenate([a, b]), np.concatenate([b, a]), np.concatenate([sim, sim]))):
            x_.append(y_)
    return pa.table({"u": np.concatenate(out[0]), "v": np.concatenate(out[1]), "sim": np.concatenate(out[2])})


EDGE = "u long, v long, sim double"


def _top(edges: DataFrame, k: int) -> DataFrame:
    once = edges.where("u <> v").groupBy("u", "v").agg(F.max("sim").alias("sim"))
    ranked = once.withColumn("rank", F.row_number().over(Window.partitionBy("u").orderBy(F.desc("sim"), "v")))
    return ranked.where(F.col("rank") <= k)


def _descend(lists: DataFrame, nodes: DataFrame, k: int, chunks: int) -> DataFrame:
    for _ in range(ROUNDS):
        last = lists.groupBy("u").agg(F.when(F.count("*") >= k, F.min("sim")).otherwise(F.lit(-2.0)).alias("last"))
        known = nodes.select(F.col("id").alias("v"), "unit").join(last.withColumnRenamed("u", "v"), "v", "left").fillna({"last": -2.0})
        back = lists.select(F.col("v").alias("c"), F.col("u").alias("v"), F.row_number().over(Window.partitionBy("v").orderBy(F.xxhash64("u"))).alias("nth"))
        seats = lists.select(F.col("u").alias("c"), "v").union(back.where(F.col("nth") <= REVERSE).select("c", "v")).union(nodes.select("id", "id")).distinct()
        met = seats.join(known, "v").withColumn("chunk", F.pmod(F.xxhash64("c"), F.lit(chunks)))
        found = met.groupBy("chunk").applyInArrow(lambda t: _local_join(t), EDGE)
        new = settle(_top(lists.select("u", "v", "sim").union(found), k), "lists")
        total = new.count()
        changed = total - new.join(lists, ["u", "v"], "left_semi").count()
        lists = new
        if changed <= DONE * max(total, 1):
            break
    return lists


def _slices(nodes: DataFrame, slices: int, first: int, last: int) -> DataFrame:
    turn = F.pmod(F.xxhash64("id", F.lit("slice")), F.lit(slices))
    return nodes.where((turn >= first) & (turn < last))


def _close(q: np.ndarray, ids: np.ndarray, b: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Links (place in q, row of b, similarity) of a batch, some of q at a time."""
    x, other = _matrix(b.column("unit")), b.column("id").to_numpy()
    for a in range(0, len(q), BLOCK // 2):
        s = q[a: a + BLOCK // 2] @ x.T
        i, j = np.nonzero(s >= THRESHOLD)
        own = ids[a + i] == other[j]
        i, j = i[~own], j[~own]
        yield a + i, j, s[i, j]


def _audit(result: DataFrame, nodes: DataFrame, slices: int) -> tuple[float, bool]:
    """Mean share of their links that vectors with links have in (id, links, component), none if a link leaves its component; and whether all vectors were seen.

    Slices are compared with all vectors until LINKED vectors with a link have been seen.
    """
    placed = nodes.join(result, "id", "left").select("id", "unit", "copies", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("component", "id").alias("component"))
    placed = settle(placed, "placed")
    shares, first = [], 0
    while first < slices and len(shares) < LINKED:
        last = min(slices, first + min(TOGETHER, first + 1))
        sample = _slices(placed, slices, first, last).collect()
        first = last
        if not sample:
            continue
        q = np.stack([np.frombuffer(bytes(r.unit), np.float64) for r in sample])
        ids, component = np.array([r.id for r in sample]), np.array([r.component for r in sample])

        def run(batches: Iterator[pa.RecordBatch], q=q, ids=ids, component=component) -> Iterator[pa.RecordBatch]:
            links, leaving = np.zeros(len(ids)), np.zeros(len(ids))
            for b in batches:
                if b.num_rows:
                    times, comp = b.column("copies").to_numpy(), b.column("component").to_numpy()
                    for i, j, _ in _close(q, ids, b):
                        links += np.bincount(i, times[j], len(ids))
                        leaving += np.bincount(i[component[i] != comp[j]], minlength=len(ids))
            some = links > 0
            yield pa.RecordBatch.from_arrays([pa.array(ids[some]), pa.array(links[some].astype(np.int64)), pa.array(leaving[some].astype(np.int64))], ["id", "n", "leaving"])

        found = {r.id: r.links for r in sample}
        true = placed.mapInArrow(run, "id long, n long, leaving long").groupBy("id").agg(F.sum("n").alias("n"), F.sum("leaving").alias("leaving"))
        shares += [0.0 if r.leaving else min(found[r.id], r.n) / max(found[r.id], r.n) for r in true.collect()]  # a row per vector of the slices at most
    return float(np.mean(shares)) if shares else 1.0, first >= slices


def _all_lists(nodes: DataFrame, k: int, slices: int) -> DataFrame:
    """The k closest links of every vector, by comparing slices with all vectors."""
    path = scratch_dir(nodes.sparkSession, "exact")
    for first in range(0, slices, TOGETHER):
        sample = _slices(nodes, slices, first, first + TOGETHER).select("id", "unit").collect()
        q = np.stack([np.frombuffer(bytes(r.unit), np.float64) for r in sample]) if sample else np.zeros((0, 1))
        ids = np.array([r.id for r in sample], np.int64)

        def run(batches: Iterator[pa.RecordBatch], q=q, ids=ids) -> Iterator[pa.RecordBatch]:
            for b in batches:
                if b.num_rows:
                    for i, j, sim in _close(q, ids, b):
                        order = np.lexsort((-sim, i))
                        i, j, sim = i[order], j[order], sim[order]
                        top = np.arange(len(i)) - np.searchsorted(i, i) < k
                        yield pa.RecordBatch.from_arrays([pa.array(ids[i[top]]), pa.array(b.column("id").to_numpy()[j[top]]), pa.array(sim[top])], ["u", "v", "sim"])

        _top(nodes.select("id", "unit").mapInArrow(run, EDGE), k).write.mode("append").parquet(path)
    return nodes.sparkSession.read.schema(EDGE + ", rank int").parquet(path)


def _links_of_block(table: pa.Table) -> pa.Table:
    """Links between two blocks of a component, counted for the saturated vectors."""
    blk, i, j = table["blk"].to_numpy(), table["i"][0].as_py(), table["j"][0].as_py()
    ids, times, full = (table[c].to_numpy() for c in ("id", "copies", "full"))
    x = _matrix(table["unit"])
    a, b = np.flatnonzero(blk == i), np.flatnonzero(blk == j)
    near = x[a] @ x[b].T >= THRESHOLD
    if i == j:
        np.fill_diagonal(near, False)
    n = [near @ times[b]] if len(a) and len(b) else []
    who = [a] if n else []
    if n and i != j:
        n.append(near.T @ times[a])
        who.append(b)
    rows = np.concatenate(who) if who else np.zeros(0, np.int64)
    links = np.concatenate(n) if n else np.zeros(0, np.int64)
    keep = full[rows].astype(bool)
    return pa.table({"id": ids[rows][keep], "links": links[keep].astype(np.int64)})


def _ball(table: pa.Table) -> pa.Table:
    """Centre of a block of vectors, and the largest angle to it."""
    x = _matrix(table["unit"])
    mean = x.mean(axis=0)
    norm = np.linalg.norm(mean)
    centre = mean / norm if norm > 1e-9 else x[0]
    radius = float(np.arccos(np.clip(x @ centre, -1, 1)).max())
    return pa.table({"component": table["component"][:1], "spot": table["spot"][:1], "split": table["split"][:1], "centre": pa.array([centre.tobytes()], pa.binary()), "radius": [radius]})


def _reachable(table: pa.Table) -> pa.Table:
    """Pairs of blocks of different components that a link can join, by the angle between their centres."""
    part, i, j = table["part"].to_numpy(), table["i"][0].as_py(), table["j"][0].as_py()
    ids, component, radius = (table[c].to_numpy() for c in ("block", "component", "radius"))
    x = _matrix(table["centre"])
    a, b = np.flatnonzero(part == i), np.flatnonzero(part == j)
    angle = np.arccos(np.clip(x[a] @ x[b].T, -1, 1))
    able = (angle <= radius[a][:, None] + radius[b][None, :] + np.arccos(THRESHOLD) + SLACK) & (component[a][:, None] != component[b][None, :])
    p, q = np.nonzero(able & (ids[a][:, None] < ids[b][None, :]) if i == j else able)
    return pa.table({"p": ids[a][p], "q": ids[b][q]})


def _links_between(table: pa.Table) -> pa.Table:
    """Links between two blocks of different components, counted for the vectors of both."""
    block, p = table["block"].to_numpy(), table["p"][0].as_py()
    ids, times, component = (table[c].to_numpy() for c in ("id", "copies", "component"))
    x = _matrix(table["unit"])
    a, b = np.flatnonzero(block == p), np.flatnonzero(block != p)
    near = x[a] @ x[b].T >= THRESHOLD
    rows, links = np.concatenate([a, b]), np.concatenate([near @ times[b], near.T @ times[a]]).astype(np.int64)
    other = np.concatenate([np.repeat(component[b[:1]], len(a)), np.repeat(component[a[:1]], len(b))])
    keep = links > 0
    return pa.table({"id": ids[rows][keep], "links": links[keep], "a": component[rows][keep], "b": other[keep]})


def _across(full: DataFrame, codes: DataFrame) -> DataFrame:
    """id, links, a, b: links of saturated vectors (id, unit, copies, component) with saturated ones of other components, and what those join."""
    sizes = full.groupBy("component").agg((F.count("*") > BLOCK).alias("large"))
    spots = full.join(sizes, "component").join(codes, "id").withColumn("spot", F.when(F.col("large"), F.col("leaf")).otherwise(F.lit(-1)).cast("long"))
    splits = spots.groupBy("component", "spot").agg(F.ceil(F.count("*") / BLOCK).alias("splits"))
    dealt = spots.join(splits, ["component", "spot"]).withColumn("split", F.pmod(F.xxhash64("id"), F.col("splits")))
    dealt = settle(dealt.select("id", "unit", "copies", "component", "spot", "split"), "saturated")
    balls = dealt.groupBy("component", "spot", "split").applyInArrow(lambda t: _ball(t), "component long, spot long, split long, centre binary, radius double")
    balls = settle(balls.withColumn("block", F.monotonically_increasing_id()), "balls")
    parts = max(1, -(-balls.count() // BLOCK))
    halves = balls.withColumn("part", F.pmod(F.xxhash64("block"), F.lit(parts)).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    halves = halves.select("block", "component", "centre", "radius", "part", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"))
    pairs = settle(halves.groupBy("i", "j").applyInArrow(lambda t: _reachable(t), "p long, q long"), "pairs")
    sides = pairs.withColumn("block", F.explode(F.array("p", "q")))
    members = dealt.join(balls.select("component", "spot", "split", "block"), ["component", "spot", "split"]).select("block", "id", "unit", "copies", "component")
    return sides.join(members, "block").groupBy("p", "q").applyInArrow(lambda t: _links_between(t), "id long, links long, a long, b long")


def near_duplicates(vectors: DataFrame) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of vectors (vec_id, embedding).

    Vectors that are null, empty, zero or hold a null or non-finite component
    link with nothing; neither do vectors of another length than the most
    frequent one link across lengths. Equal vectors link with each other. A row
    without vec_id has a null component and is not kept. Other columns are
    ignored.
    """
    units = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")).mapInArrow(_unit, "vec_id long, unit binary")
    units = settle(units.withColumn("width", F.length("unit")), "units")
    named = units.where("unit IS NOT NULL AND vec_id IS NOT NULL")
    nodes = settle(named.groupBy("unit", "width").agg(F.min("vec_id").alias("id"), F.count("*").alias("copies")), "nodes")
    parts = []
    for r in nodes.select("width").distinct().orderBy("width").collect():  # one row per vector length
        parts.append(_of_one_length(nodes.where(F.col("width") == r.width), r.width // 8))
    if not parts:
        return units.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.col("vec_id").isNotNull().alias("kept"))
    per_node = parts[0]
    for p in parts[1:]:
        per_node = per_node.union(p)
    found = units.join(nodes.select("unit", "id", "copies"), "unit", "left").join(per_node, "id", "left")
    alone = F.col("vec_id").isNull() | F.col("id").isNull()
    return found.select(
        "vec_id", F.when(alone, F.lit(0)).otherwise(F.coalesce("links", F.lit(0)) + F.col("copies") - 1).cast("long").alias("n_links"),
        F.when(alone, F.col("vec_id")).otherwise(F.coalesce("component", "id")).alias("component_id"),
        F.coalesce(F.col("vec_id") == F.when(alone, F.col("vec_id")).otherwise(F.coalesce("component", "id")), F.lit(False)).alias("kept"),
    )


def _of_one_length(nodes: DataFrame, dims: int) -> DataFrame:
    """id, links, component of distinct vectors of one length."""
    n = nodes.count()
    bits = max(0, int(np.ceil(np.log2(max(n / LEAF, 1)))))
    chunks, slices = max(12, n // CHUNK), -(-n // SLICE)
    k, lists, whole = LIST, None, False
    codes = nodes.select("id", "unit").mapInArrow(_leaves(dims, bits, 1, 3), "id long, leaf long")
    for attempt, trees in enumerate(TREES):
        leaves = nodes.select("id", "unit").mapInArrow(_leaves(dims, bits, trees, 3 + attempt), "id long, leaf long")
        sizes = leaves.groupBy("leaf").agg(F.ceil(F.count("*") / (2 * LEAF)).alias("splits"))
        seated = leaves.join(sizes, "leaf").withColumn("split", F.pmod(F.xxhash64("id", "leaf"), F.col("splits"))).join(nodes.select("id", "unit"), "id")
        found = seated.groupBy("leaf", "split").applyInArrow(lambda t: _nearest(t), EDGE)
        lists = settle(_top(found if lists is None else found.union(lists.select("u", "v", "sim")), k), "lists")
        lists = _descend(lists, nodes, k, chunks)
        result = settle(_counted(lists, nodes, k, codes), "counted")
        share, whole = _audit(result, nodes, slices)
        if share == 1 or share >= RECALL and not whole:
            return result
        if whole:
            break
        k *= 2
    return settle(_counted(_all_lists(nodes, k, slices), nodes, k, codes), "counted")


def _counted(lists: DataFrame, nodes: DataFrame, k: int, codes: DataFrame) -> DataFrame:
    """id, links, component from lists of at most k neighbours."""
    near = lists.where(F.col("sim") >= THRESHOLD)
    edges = settle(near.select("u", "v").union(near.select("v", "u")).distinct(), "near")
    comp = settle(components(edges.select(F.col("u").alias("a"), F.col("v").alias("b"))), "components")
    full = near.groupBy("u").agg(F.count("*").alias("n")).where(F.col("n") >= k).select(F.col("u").alias("id"))
    copies = nodes.select(F.col("id").alias("v"), "copies")
    counted = edges.join(copies, "v").groupBy(F.col("u").alias("id")).agg(F.sum("copies").alias("links"))
    # saturated lists: all links of the component, block against block
    inside = nodes.join(comp.withColumnRenamed("node", "id"), "id").join(full.withColumn("full", F.lit(1)), "id", "left").fillna({"full": 0})
    wide = inside.groupBy("component").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"), F.max("full").alias("any")).where(F.col("any") == 1)
    dealt = inside.join(wide, "component").withColumn("blk", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("component", F.least("blk", "other").alias("i"), F.greatest("blk", "other").alias("j"), "blk", "id", "copies", "full", "unit")
    exact = dealt.groupBy("component", "i", "j").applyInArrow(lambda t: _links_of_block(t), "id long, links long").groupBy("id").agg(F.sum("links").alias("exact"))
    joined = counted.join(exact, "id", "full").select("id", F.coalesce("exact", "links").alias("links"))
    # saturated lists: links with saturated vectors of other components
    saturated = inside.where(F.col("full") == 1).select("id", "unit", "copies", "component")
    across = settle(_across(saturated, codes), "across")
    merged = components(across.select("a", "b").distinct()).select(F.col("node").alias("component"), F.col("component").alias("least"))
    more = across.groupBy("id").agg(F.sum("links").alias("more"))
    placed = joined.join(comp.withColumnRenamed("node", "id"), "id", "left").join(merged, "component", "left").join(more, "id", "left")
    return placed.select("id", (F.col("links") + F.coalesce("more", F.lit(0))).alias("links"), F.coalesce("least", "component").alias("component"))
