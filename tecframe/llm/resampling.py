"""Quality by importance resampling.

Words and word pairs fall into hashed buckets. Two bag-of-buckets models are
estimated: one of target text (documents labelled as good), one of the raw
corpus (all documents). A document's importance is the log ratio of its
probabilities under both. Gumbel noise, fixed by seed and doc_id, is added, and
the documents of the highest sums are the sample: this draws without
replacement in proportion to the importance.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tecframe.llm.graphs import settle
from tecframe.llm.tokens import MULTIPLIERS, Texts, below, mix, pieces

BUCKETS = 10_000
TARGET = 20_000  # labelled documents that the target model is estimated on, at most
KEEP = 0.5  # share of the rows that is drawn


def features(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all words and word pairs, and the text of each."""
    h, woff = texts.words()
    owner = np.repeat(np.arange(len(woff) - 1), np.diff(woff))
    pair = np.flatnonzero(owner[1:] == owner[:-1])
    both = mix(h[pair] * MULTIPLIERS[0] + h[pair + 1] * MULTIPLIERS[1])
    return below(np.concatenate([mix(h), both]), BUCKETS).astype(np.int64), np.concatenate([owner, owner[pair]])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(BUCKETS, np.int64)
    for _, texts in pieces(batches):
        total += np.bincount(features(texts)[0], minlength=BUCKETS)
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(BUCKETS, dtype=np.int32)), pa.array(total)], ["bucket", "n"])


def model(docs: DataFrame) -> np.ndarray:
    """Log probabilities of the buckets with add-one smoothing, over all rows."""
    count = np.ones(BUCKETS)
    for r in docs.select("text").mapInArrow(_count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # a row per bucket
        count[r.bucket] += r.n
    return np.log(count / count.sum())


def cut(keys: DataFrame, k: int) -> float | None:
    """The k-th largest key, by counts in ever finer bins."""
    if k <= 0:
        return None
    low, high, above = keys.agg(F.min("key"), F.max("key"), F.lit(0)).first()
    while low is not None and low < high:
        width = (high - low) / 4096
        inside = keys.where((F.col("key") >= low) & (F.col("key") <= high))
        bins = inside.groupBy(F.least(F.floor((F.col("key") - low) / width), F.lit(4095)).alias("bin")).agg(F.count("*").alias("n"), F.min("key").alias("lo"), F.max("key").alias("hi"))
        for r in sorted(bins.collect(), key=lambda r: -r.bin):  # 4,096 rows at most
            if above + r.n >= k:
                low, high = r.lo, r.hi
                break
            above += r.n
        else:
            return low
    return low


def resample(docs: DataFrame, labels: DataFrame, keep: float = KEEP, target: int = TARGET, seed: int = 1) -> DataFrame:
    """doc_id, log_weight, key, selected for every row of docs (doc_id, text).

    `selected` marks the share `keep` of the rows with the highest keys; rows
    tied at the cut are all in it. Null and empty texts weigh 0. A null doc_id
    draws the noise of the hash of null. Without labels the target model is
    flat. Other columns are ignored.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    good = labels.where("quality = 1 AND doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    good = good.orderBy(F.xxhash64("doc_id"), "doc_id").limit(target)
    ratio = model(docs.join(F.broadcast(good), "doc_id", "left_semi")) - model(docs)  # no more ids than `target`
    sent = spark.sparkContext.broadcast(ratio)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in pieces(batches):
            bucket, owner = features(texts)
            weight = np.bincount(owner, sent.value[bucket], minlength=len(texts)).astype(float)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(weight)], ["doc_id", "log_weight"])

    uniform = (F.shiftrightunsigned(F.xxhash64("doc_id", F.lit(seed)), 12).cast("double") + 0.5) / float(1 << 52)
    scored = docs.mapInArrow(run, "doc_id long, log_weight double").withColumn("key", F.col("log_weight") - F.log(-F.log(uniform)))
    scored = settle(scored, "weights")
    line = cut(scored, round(keep * scored.count()))
    return scored.select("doc_id", "log_weight", "key", F.lit(False).alias("selected") if line is None else (F.col("key") >= line).alias("selected"))
