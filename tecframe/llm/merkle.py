"""Merkle manifest of a table: leaves per source, subroots, one root, and proofs of every row.

Levels are tables of nodes (tree, place, digest). Each level joins itself once per
sibling, by the computed place of that sibling: place XOR 1 where two nodes make
a parent, otherwise the slots 1, 2, ... further within the run. The row of slot
zero then knows the whole run and emits the parent. Paths go down again by a
join per level, from the few upper nodes to the leaves.

Places in a source come from one range sort of all leaves: no source is sorted or
numbered in one task, whatever share of the rows it holds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tecframe.llm.graphs import settle

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
ARITY = 3


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def _encoded(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaves(docs: DataFrame) -> DataFrame:
    """src (null first, then bytewise), doc_id, h, and the leaf `changed` of the tampered text where there is one."""
    fields = [_encoded(F.col(c)) for c in FIELDS]
    tampered = _encoded(F.replace("text", F.lit("\n"), F.lit("")))
    hit = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    return docs.select(
        F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")).alias("src"),
        F.col("doc_id").cast("long").alias("doc_id"),
        digest(*fields).alias("h"), F.when(hit, digest(*fields[:-1], tampered)).alias("changed"),
    )


def placed(rows: DataFrame, group: list[str], order: list[str]) -> tuple[DataFrame, DataFrame]:
    """The rows with `part` and `at`, and per group and part: `first` at, rows `before` the part, `total` of the group.

    A row's place in its group is at - first + before. All rows are sorted by
    range; only the parts' counts are summed by group.
    """
    dealt = rows.repartitionByRange(*group, *order).sortWithinPartitions(*group, *order)
    dealt = settle(dealt.withColumn("at", F.monotonically_increasing_id()), "placed").withColumn("part", F.shiftright("at", 33))
    stretches = dealt.groupBy(*group, "part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    own = Window.partitionBy(*(group or [F.lit(0)]))
    before = F.coalesce(F.sum("n").over(own.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return dealt, stretches.withColumn("before", before).withColumn("total", F.sum("n").over(own)).drop("n")


def sibling(place: Column, offset: int, arity: int) -> Column:
    """The place of the node `offset` slots on in the same run of `arity` nodes."""
    if arity == 2:
        return place.bitwiseXOR(F.lit(1).cast("long"))
    slot = place % arity
    return place - slot + (slot + offset) % arity


def with_siblings(nodes: DataFrame, arity: int) -> DataFrame:
    """Nodes (s, idx, m, h, ...) with the digests of their siblings, concatenated: l before them, r after them."""
    out = nodes
    for offset in range(1, arity):
        other = nodes.select(F.col("s").alias("_s"), F.col("idx").alias("_idx"), F.col("h").alias(f"_h{offset}"))
        out = out.join(other, (F.col("s") == F.col("_s")) & (sibling(F.col("idx"), offset, arity) == F.col("_idx")), "left").drop("_s", "_idx")
    slot = F.col("idx") % arity
    # the sibling of offset o stands before the node if the slot wraps around
    at = lambda o: F.coalesce(F.col(f"_h{o}"), F.lit(""))
    left = F.concat(*(F.when(slot + o >= arity, at(o)).otherwise("") for o in range(1, arity)))
    right = F.concat(*(F.when(slot + o < arity, at(o)).otherwise("") for o in range(1, arity)))
    return out.select(*nodes.columns, left.alias("l"), right.alias("r"))


def grow(nodes: DataFrame, largest: int, arity: int) -> list[DataFrame]:
    """The levels of all trees s from nodes (s, idx, m, h, ...) on, m nodes each; a tree ends at the level where m is 1."""
    levels = []
    while True:
        levels.append(settle(with_siblings(nodes, arity), "level"))
        if largest <= 1:
            return levels
        largest = -(-largest // arity)
        run = levels[-1].where((F.col("m") > 1) & (F.col("idx") % arity == 0))
        nodes = run.select("s", F.expr(f"idx div {arity} AS idx"), F.expr(f"(m + {arity - 1}) div {arity} AS m"), digest(F.col("h"), F.col("r")).alias("h"))


def descend(levels: list[DataFrame], tops: DataFrame, arity: int) -> DataFrame:
    """The lowest level with `path`, the siblings of every step up: its own, then those of its tree's top.

    tops: s, top (the level where the tree ends), path, and columns that every node of the tree gets.
    """
    given = [c for c in tops.columns if c not in ("s", "top", "path")]
    known = None
    for k in range(len(levels) - 1, -1, -1):
        above = tops.where(F.col("top") == k).select("s", F.lit(-1).cast("long").alias("up"), "path", *given)
        if known is not None:
            above = above.unionByName(known.select("s", F.col("idx").alias("up"), "path", *given))
        step = F.array(F.struct("l", "r"))
        up = F.expr(f"CASE WHEN m > 1 THEN idx div {arity} ELSE -1L END")
        known = levels[k].withColumn("up", up).join(above, ["s", "up"])
        known = known.withColumn("path", F.when(F.col("m") > 1, F.concat(step, "path")).otherwise(F.col("path"))).drop("up", "l", "r")
    return known


def height(m: int, arity: int) -> int:
    """Steps from m nodes to one."""
    steps = 0
    while arity**steps < m:
        steps += 1
    return steps


def proofs(docs: DataFrame, arity: int = ARITY) -> DataFrame:
    """doc_id, h (the leaf), changed, subroot, root and path (array of l, r) for every row of docs.

    Fields may be null. Rows that repeat a doc_id are leaves of their own, in
    the order of their digests. Rows without doc_id come first in their source
    and are never tampered with. An empty table has no rows; other columns are
    ignored.
    """
    rows, stretches = placed(settle(leaves(docs), "leaves"), ["src"], ["doc_id", "h"])
    sources, parts = placed(stretches.groupBy("src").agg(F.max("total").alias("m")), [], ["src"])
    sources = sources.join(parts, "part").select("src", "m", (F.col("at") - F.col("first") + F.col("before")).alias("s"), "total")
    sources = settle(sources, "sources")
    largest, number = sources.agg(F.max("m"), F.max("total")).first()
    largest, number = largest or 1, number or 1
    stretches = stretches.join(sources.drop("total"), "src").select("src", "part", "first", "before", "s", "m")
    nodes = rows.join(stretches, ["src", "part"]).select("s", (F.col("at") - F.col("first") + F.col("before")).alias("idx"), "m", "h", "doc_id", "changed")
    levels = grow(nodes, largest, arity)
    subroots = None
    for level in levels:
        ends = level.where("m = 1").select("s", F.col("h").alias("subroot"))
        subroots = ends if subroots is None else subroots.unionByName(ends)
    upper = sources.join(subroots, "s").select(F.lit(0).cast("long").alias("s"), F.col("s").alias("idx"), F.col("total").alias("m"), F.col("subroot").alias("h"), F.col("m").alias("below"))
    upper = grow(upper, number, arity)
    nothing = F.array().cast("array<struct<l:string,r:string>>")
    root = upper[-1].where("m = 1").select("s", F.lit(len(upper) - 1).alias("top"), nothing.alias("path"), F.col("h").alias("root"))
    top = sum(((F.col("below") > arity**t).cast("int") for t in range(height(largest, arity))), F.lit(0))
    tops = descend(upper, root, arity).select(F.col("idx").alias("s"), top.alias("top"), "path", F.col("h").alias("subroot"), "root")
    return descend(levels, settle(tops, "tops"), arity).select("doc_id", "h", "changed", "subroot", "root", "path")


def folded(leaf: Column, path: str) -> Column:
    """The root that a leaf and the siblings on its path give."""
    return F.aggregate(path, leaf, lambda node, step: digest(step["l"], node, step["r"]))


def manifest(docs: DataFrame, arity: int = ARITY) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified for every row of docs; see `proofs`."""
    siblings = F.array_join(F.transform("path", lambda step: F.concat(step["l"], step["r"])), "")
    back = folded(F.coalesce("changed", "h"), "path")
    out = proofs(docs, arity).select("doc_id", F.col("h").alias("leaf"), "subroot", "root", F.sha2(siblings, 256).alias("proof_sha256"), back.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
