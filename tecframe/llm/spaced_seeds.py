"""Benchmark decontamination with spaced-seed hashes.

Words are lower-cased and read without punctuation. A mask is a fixed pattern
over a few neighbouring words: hashes of the words at its marked positions
ignore the others, so a substituted word hides from some mask. Training and
benchmark hashes are joined, and around each hit the two texts are compared
word by word along the diagonal: matches add one, substitutions cost three,
and the best stretch through the hit counts as an overlap when it holds enough
matching words.

The benchmark's hashes go to the workers in blocks of a fixed number of words;
a larger benchmark takes more passes over the documents, not more memory.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tecframe.llm.graphs import settle
from tecframe.llm.tokens import MARKS, MULTIPLIERS, U64, Texts, mix, pieces

# the last one ignores two words five apart, for passages of which every fifth word is another
MASKS = ("1101110101", "1110010111", "1011101011", "1101111011")
SHORTEST = 5  # words of an item; items shorter than a mask are hashed as a whole
MATCHES = 12  # matching words of an overlap; shorter items must match as a whole
COST = 3  # matches that one substitution outweighs
BLOCK_WORDS = 1 << 20  # benchmark words that are sent to the workers at once
FILTER_BITS = 22


def masked(h: np.ndarray, mask: str) -> np.ndarray:
    """Hash of the marked words from every position on."""
    n = len(h) - len(mask) + 1
    if n <= 0:
        return np.zeros(0, U64)
    g = np.full(n, U64(int(mask, 2)))
    for j, mark in enumerate(mask):
        if mark == "1":
            g = g + h[j: j + n] * MULTIPLIERS[j]
    return mix(g)


class Index:
    """Words and masked hashes of one block of benchmark items."""

    def __init__(self, ids: list[int], texts: list[str | None]) -> None:
        self.ids = np.array(ids, np.int64)
        self.words, self.off = Texts(pa.array(texts, pa.string())).words(MARKS)
        self.masks = []
        sizes = np.diff(self.off)
        short = sorted({n for n in sizes.tolist() if SHORTEST <= n < len(MASKS[0])})
        for mask in (*MASKS, *("1" * n for n in short)):
            keys = masked(self.words, mask)
            at = np.arange(len(keys))
            item = np.searchsorted(self.off, at, "right") - 1
            inside = at + len(mask) <= self.off[item + 1]
            if mask not in MASKS:
                inside &= sizes[item] == len(mask)
            keys, at = keys[inside], at[inside]
            order = np.argsort(keys, kind="stable")
            known = np.zeros(1 << FILTER_BITS, bool)
            known[(keys >> U64(64 - FILTER_BITS)).astype(np.int64)] = True
            self.masks.append((mask, keys[order], at[order], known))

    def hits(self, h: np.ndarray, woff: np.ndarray) -> np.ndarray:
        """Distinct (text, item, diagonal) of all mask hits, with one position each."""
        rows = []
        for mask, keys, places, known in self.masks:
            g = masked(h, mask)
            pos = np.flatnonzero(known[(g >> U64(64 - FILTER_BITS)).astype(np.int64)])
            left, right = np.searchsorted(keys, g[pos]), np.searchsorted(keys, g[pos], "right")
            each = right - left
            pos = np.repeat(pos, each)
            at = places[np.arange(each.sum()) + np.repeat(left - np.concatenate([[0], np.cumsum(each)[:-1]]), each)] if len(pos) else np.zeros(0, np.int64)
            text = np.searchsorted(woff, pos, "right") - 1
            inside = pos + len(mask) <= woff[text + 1]
            rows.append(np.stack([text, np.searchsorted(self.off, at, "right") - 1, pos - at, pos])[:, inside])
        found = np.concatenate(rows, axis=1)
        found = found[:, np.lexsort(found[::-1])]
        fresh = np.ones(found.shape[1], bool)
        # hits of one stretch share the diagonal and lie near each other
        fresh[1:] = (np.diff(found[:3], axis=1) != 0).any(axis=0) | (np.diff(found[3]) > len(MASKS[0]))
        return found[:, fresh]

    def overlaps(self, h: np.ndarray, woff: np.ndarray) -> list[tuple[int, int, int, int, int]]:
        """(text, item id, first word in the text, words, matching words) of verified overlaps."""
        out = set()
        for text, item, shift, pos in self.hits(h, woff).T.tolist():
            a = max(woff[text], shift + self.off[item])
            b = min(woff[text + 1], shift + self.off[item + 1])
            same = h[a:b] == self.words[a - shift: b - shift]
            s = np.concatenate([[0], np.cumsum(np.where(same, 1, -COST))])
            k = pos - a
            begin = k - int(s[: k + 1][::-1].argmin())
            end = k + int(s[k:].argmax())
            matches = int(same[begin:end].sum())
            if matches >= min(MATCHES, self.off[item + 1] - self.off[item]):
                out.add((text, int(self.ids[item]), int(a + begin - woff[text]), end - begin, matches))
        return sorted(out)


SCHEMA = "doc_id long, item_id long, doc_word int, n_words int, n_matches int"


def _search(index):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in pieces(batches):
            found = index.value.overlaps(*texts.words(MARKS))
            if found:
                text, item, word, n, matches = map(np.array, zip(*found))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").take(pa.array(text)), *(pa.array(x.astype(t)) for x, t in ((item, np.int64), (word, np.int32), (n, np.int32), (matches, np.int32)))],
                    ["doc_id", "item_id", "doc_word", "n_words", "n_matches"],
                )

    return run


def overlaps(docs: DataFrame, benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Every stretch of docs (doc_id, text) that repeats benchmark (item_id, text): doc_id, item_id, doc_word, n_words, n_matches.

    Overlaps need 12 matching words, or a whole item that is shorter but has five
    words. Null, empty and shorter texts overlap with nothing; so do items
    without an id. Repeated items or rows give repeated overlaps once per
    (doc_id, item_id, place). Other columns are ignored.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    items = benchmark.where("item_id is not null and text is not null").select(F.col("item_id").cast("long").alias("item_id"), "text").distinct()
    size = F.size(F.split("text", r"\s+"))
    total = items.agg(F.sum(size)).first()[0] or 0
    blocks = max(1, -(-int(total) // block_words))
    dealt = items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)).cast("int"))
    if blocks > 1:
        dealt = settle(dealt, "benchmark")
    found = None
    for k in range(blocks):
        rows = dealt.where(F.col("block") == k).orderBy("item_id", "text").collect()  # bounded by block_words
        index = spark.sparkContext.broadcast(Index([r.item_id for r in rows], [r.text for r in rows]))
        part = docs.mapInArrow(_search(index), SCHEMA)
        found = part if found is None else found.union(part)
    return found.distinct()
