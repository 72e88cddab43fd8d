"""Intermediate tables in the shared folder, and connected components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tecframe.session import scratch_dir


def settle(df: DataFrame, name: str) -> DataFrame:
    """Writes a table to the shared folder and reads it back: lineage ends there, a lost executor costs nothing."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replaces the edges of each batch by edges to the smallest node of their part."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = np.stack([batch.column(0).to_numpy(), batch.column(1).to_numpy()])
        nodes, index = np.unique(ends, return_inverse=True)
        a, b = index.reshape(2, -1)
        label = np.arange(len(nodes))
        while True:
            low = np.minimum(label[a], label[b])
            new = label.copy()
            np.minimum.at(new, label[a], low)
            np.minimum.at(new, label[b], low)
            new = new[new]
            if (new == label).all():
                break
            label = new
        apart = label != np.arange(len(nodes))
        yield pa.RecordBatch.from_arrays([pa.array(nodes[label[apart]]), pa.array(nodes[apart])], ["a", "b"])


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable over the edges (a, b), for every node that has one.

    Large-star and small-star steps alternate until every node points to its
    smallest one. Both are minimum aggregates joined back, so a node with very
    many neighbours is pre-aggregated and its join partition can be split.
    """
    low, high = F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    e = edges.select(low, high).where("a < b").mapInArrow(_contract, "a long, b long").distinct()
    e = settle(e, "edges")
    while True:
        both = e.select(F.col("b").alias("u"), F.col("a").alias("v")).union(e.select(F.col("a").alias("u"), F.col("b").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("a"), F.least("u", "m").alias("m"))
        large = e.join(least, "a").select(F.col("m").alias("a"), "b").distinct()
        floor = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(floor, "b")
        new = small.where("a <> m").select(F.col("m").alias("a"), F.col("a").alias("b")).union(floor.select(F.col("m").alias("a"), "b")).distinct()
        new = settle(new, "edges")
        # a forest of stars: every node has one edge up, and no parent has a parent
        tall = new.select(F.col("b").alias("a")).join(new, "a", "left_semi").limit(1).count()
        wide = new.count() - new.select("b").distinct().count()
        e = new
        if not tall and not wide:
            return e.select(F.col("b").alias("node"), F.col("a").alias("component")).union(e.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct())
