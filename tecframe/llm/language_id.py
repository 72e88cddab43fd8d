"""Language identification with language-bitmask n-gram filters.

Each language owns the byte n-grams that are frequent in it and rare elsewhere,
counted on a bounded sample of training documents. A Bloom filter holds them
all: every slot is a bitmask with a bit per language (the filters of all
languages, sliced by bit; 64 languages to a word), and the AND over the slots of an n-gram is the set of
languages that contain it. Per language the hits of a text are counted, the
expected false positives of that language's filter are taken off, and the count
is put in proportion to what a text of that language usually reaches.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window, functions as F

from tecframe.llm.tokens import BASE, BYTES, INVERSE, SPACE, U64, Texts, below, mix, pieces, powers, signed
from tecframe.llm.toxicity import held_out

SAMPLE = 8000  # training documents, at most
GRAMS = (2, 3, 4, 5)
PER_LANGUAGE = 40_000  # n-grams that one language owns, at most
SLOTS, PROBES = 1 << 21, 3
SHARE = 0.5  # of an n-gram's relative frequency, for its language to own it

LETTER = regex.compile(r"\p{L}")
FLAT = BYTES.copy()
FLAT[SPACE] = BYTES[32]


def grams(texts: Texts) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(hash, text) of all n-grams of one length after the other; white space of any kind is a blank."""
    data, off = texts.data, texts.off
    sums = np.zeros(len(data) + 1, U64)
    np.cumsum(FLAT[data] * powers(len(data), BASE), out=sums[1:])
    owner = np.repeat(np.arange(len(off) - 1), np.diff(off))
    inverse = powers(len(sums), INVERSE)
    for n in GRAMS:
        if len(data) >= n:
            h = mix((sums[n:] - sums[:-n]) * inverse[: len(data) - n + 1] + U64(n))
            inside = owner[n - 1:] == owner[: len(data) - n + 1]
            yield h[inside], owner[: len(data) - n + 1][inside]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, texts in pieces(batches):
        langs = np.array(part.column("lang").to_pylist(), object)
        names, code = np.unique(langs.astype(str), return_inverse=True)
        for h, owner in grams(texts):
            for k, name in enumerate(names):
                g, n = np.unique(h[code[owner] == k], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(g), pa.string()), pa.array(signed(g)), pa.array(n)], ["lang", "gram", "n"])


class Filters:
    """Bit-sliced Bloom filters of all languages."""

    def __init__(self, names: list[str], codes: np.ndarray, hashes: np.ndarray) -> None:
        self.names = names
        self.slots = np.zeros((-(-len(names) // 64), SLOTS), U64)
        bits = U64(1) << (codes % 64).astype(U64)
        for p in range(PROBES):
            np.bitwise_or.at(self.slots, (codes // 64, self._slot(hashes, p)), bits)
        density = np.array([np.count_nonzero(self.slots[i // 64] & (U64(1) << U64(i % 64))) / SLOTS for i in range(len(names))])
        self.false = density**PROBES
        self.usual = np.ones(len(names))

    @staticmethod
    def _slot(hashes: np.ndarray, probe: int) -> np.ndarray:
        return below(mix(hashes + U64(probe * 0x9E3779B97F4A7C15 % 2**64)), SLOTS).astype(np.int64)

    def hits(self, texts: Texts) -> np.ndarray:
        """Share of each text's n-grams that each language contains, without the expected false ones."""
        count = np.zeros((len(texts), len(self.names)))
        total = np.zeros(len(texts))
        for h, owner in grams(texts):
            first = self._slot(h, 0)
            total += np.bincount(owner, minlength=len(texts))
            for k, slots in enumerate(self.slots):
                masks = slots[first]
                some = np.flatnonzero(masks)
                for p in range(1, PROBES):
                    masks_p = masks[some] & slots[self._slot(h[some], p)]
                    masks[some] = masks_p
                    some = some[masks_p != 0]
                for i in range(64 * k, min(64 * k + 64, len(self.names))):
                    own = some[(masks[some] >> U64(i % 64)) & U64(1) == 1]
                    count[:, i] += np.bincount(owner[own], minlength=len(texts))
        expected = total[:, None] * self.false[None, :]
        return np.maximum(count - expected, 0) / (1 - np.minimum(self.false, 0.99)) / np.maximum(total, 1)[:, None]

    def predict(self, texts: Texts) -> tuple[list[str], np.ndarray]:
        letters = np.array([LETTER.search(texts.bytes_of(i).decode("utf-8", "replace")) is not None for i in range(len(texts))], bool)
        if not self.names:
            return ["und"] * len(texts), np.zeros(len(texts))
        fit = self.hits(texts) / self.usual
        fit[:, 0] += 1e-12  # without any hit the most frequent language of the sample is left
        best = fit.argmax(axis=1)
        score = fit.max(axis=1) / fit.sum(axis=1)
        return [self.names[b] if ok else "und" for b, ok in zip(best.tolist(), letters.tolist())], np.where(letters, score, 0.0)


def train(docs: DataFrame, sample: int = SAMPLE) -> Filters:
    rows = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id"), 4, 2))
    chosen = rows.select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample).distinct()
    rows = rows.join(F.broadcast(chosen), "doc_id").select("text", F.col("lang").cast("string").alias("lang"))  # no more ids than the sample
    counts = rows.mapInArrow(_count, "lang string, gram long, n long").groupBy("gram", "lang").agg(F.sum("n").alias("n")).persist()
    sizes = {r.lang: r.n for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "lang").collect()}  # no more than the sample has rows
    names = list(sizes)
    if not names:
        return Filters([], np.zeros(0, np.int64), np.zeros(0, U64))
    size = F.create_map(*[F.lit(x) for pair in sizes.items() for x in pair])
    shares = counts.where(F.col("lang").isin(names)).withColumn("p", F.col("n") / size[F.col("lang")])
    shares = shares.withColumn("all", F.sum("p").over(Window.partitionBy("gram"))).where(F.expr(f"n >= 2 AND p >= {SHARE} * all"))
    top = shares.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))).where(F.col("rank") <= PER_LANGUAGE)
    owned = top.select("lang", "gram").toPandas()
    counts.unpersist()
    code = {x: i for i, x in enumerate(names)}
    filters = Filters(names, owned["lang"].map(code).to_numpy(np.int64), owned["gram"].to_numpy(np.int64).view(U64))
    sent = docs.sparkSession.sparkContext.broadcast(filters)

    def usual(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in pieces(batches):
            share = sent.value.hits(texts)
            langs = part.column("lang").to_pylist()
            own = [(x, float(share[i, code[x]])) for i, x in enumerate(langs) if x in code]
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in own], pa.string()), pa.array([s for _, s in own], pa.float64())], ["lang", "share"])

    for r in rows.mapInArrow(usual, "lang string, share double").groupBy("lang").agg(F.avg("share").alias("share")).collect():
        filters.usual[code[r.lang]] = max(r.share, 1e-3)
    return filters


def identify(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row of docs (doc_id, text, lang).

    A null text or one without a letter is `und` with score 0; so is everything
    when no row has a language. A null doc_id is in no fold. Other columns are
    ignored; predictions read the text alone.
    """
    filters = docs.sparkSession.sparkContext.broadcast(train(docs, sample))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in pieces(batches):
            names, score = filters.value.predict(texts)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(names), pa.array(score)], ["doc_id", "lang_pred", "score"])

    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, lang_pred string, score double")
    return found.select("doc_id", held_out(F.col("doc_id"), 4, 2).alias("held_out"), "lang_pred", "score")
