"""Quality rules on repeated passages, found by a suffix array over the words of each text.

Words get ranks, ranks of twice as many words follow from pairs of ranks until
every suffix has a rank of its own; the ranks on the way give the longest
common prefix of neighbours in the array. Intervals of such prefixes are the
repeated passages; one is maximal if its places differ in the word before, too.
Positions count once however many passages cover them.

Texts are worked in pieces of about a megabyte; a text is always whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tecframe.llm.tokens import RAW, SPACE, U64, Texts, mix, pieces, prefix_sums, span_hash

WINDOW = 8  # words of a window of the base rules
SHORTEST = 8  # words of a passage that counts as repeated
MOST_COVERED = 30  # per cent of the code points of the words inside repeated passages
MOST_WORDS = 50  # of one repeated passage
FEWEST_WORDS, MOST_WINDOWED = 20, 30
SYMBOL = np.zeros(256, bool)
SYMBOL[list(b"#*$%&|<>")] = True


def suffix_array(symbols: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Order of the suffixes, and ranks by their first 1, 2, 4, ... symbols. The last symbol stands once."""
    n = len(symbols)
    order = np.argsort(symbols, kind="stable")
    new = np.concatenate([[True], np.diff(symbols[order]) != 0])
    starts = np.flatnonzero(new)
    rank = np.empty(n, np.int64)
    rank[order] = np.repeat(starts, np.diff(np.append(starts, n)))
    ranks, length = [rank.astype(np.int32)], 1
    alone = new & np.append(new[1:], True)
    open_ = order[~alone]
    while len(open_):
        own = rank[open_]
        pair = own * n + rank[open_ + length]
        by = np.argsort(pair, kind="stable")
        open_, own, pair = open_[by], own[by], pair[by]
        at = np.arange(len(pair))
        new = np.concatenate([[True], pair[1:] != pair[:-1]])
        group = np.concatenate([[True], own[1:] != own[:-1]])
        first = np.maximum.accumulate(np.where(new, at, 0))
        rank[open_] = own + first - np.maximum.accumulate(np.where(group, at, 0))
        ranks.append(rank.astype(np.int32))
        open_ = open_[~(new & np.append(new[1:], True))]
        length *= 2
    order = np.empty(n, np.int64)
    order[rank] = np.arange(n)
    return order, ranks


def common_prefixes(order: np.ndarray, ranks: list[np.ndarray], shortest: int) -> np.ndarray:
    """Words that each suffix shares with the one before it in the array; 0 where fewer than `shortest`."""
    out = np.zeros(len(order) + 1, np.int64)
    level = shortest.bit_length() - 1
    if level >= len(ranks):
        return out
    near = np.flatnonzero(ranks[level][order[1:]] == ranks[level][order[:-1]]) + 1
    p, q = order[near - 1], order[near]
    shared = np.zeros(len(near), np.int64)
    for k in range(len(ranks) - 1, -1, -1):
        shared += (ranks[k][p + shared] == ranks[k][q + shared]).astype(np.int64) << k
    out[near] = np.where(shared >= shortest, shared, 0)
    return out


def intervals(shared: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Length, first and last rank of every interval of common prefixes."""
    at = np.flatnonzero(shared)
    if not len(at):
        return at, at, at
    run = np.flatnonzero(np.concatenate([[True], np.diff(at) > 1]))
    size = np.diff(np.append(run, len(at)))
    single = run[size == 1]
    length, low, high = [shared[at[single]]], [at[single] - 1], [at[single]]
    more: list[tuple[int, int, int]] = []
    for a, n in zip(at[run[size > 1]].tolist(), size[size > 1].tolist()):
        stack: list[tuple[int, int]] = []  # (length, first rank), lengths ascending
        for r, value in enumerate([*shared[a: a + n].tolist(), 0], a):
            first = r - 1
            while stack and stack[-1][0] > value:
                got, first = stack.pop()
                more.append((got, first, r - 1))
            if value and (not stack or stack[-1][0] < value):
                stack.append((value, first))
    extra = np.array(more, np.int64).reshape(-1, 3)
    return tuple(np.concatenate([np.concatenate(x), extra[:, i]]) for i, x in enumerate((length, low, high)))


def _counts(owner: np.ndarray, n: int, weights: np.ndarray | None = None) -> np.ndarray:
    return np.bincount(owner, weights, n).astype(np.int64)


def _within(flags: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Flags that are set in each stretch off[i]:off[i + 1]."""
    return np.diff(np.concatenate([[0], np.cumsum(flags)])[off])


def duplicate_lines(texts: Texts, sums: np.ndarray) -> np.ndarray:
    """Lines of each text that hold a word and equal an earlier line."""
    breaks = np.flatnonzero(texts.data == 10)
    start, end = np.sort(np.concatenate([texts.off[:-1], breaks + 1])), np.sort(np.concatenate([breaks, texts.off[1:]]))
    word = np.concatenate([[0], np.cumsum(~SPACE[texts.data])])
    full = word[end] > word[start]
    start, end = start[full], end[full]
    owner = np.searchsorted(texts.off, start, "right") - 1
    line = span_hash(sums, start, end)
    order = np.lexsort((end - start, line, owner))
    same = np.zeros(len(order), bool)
    same[1:] = True
    for key in (owner, line, end - start):
        same[1:] &= key[order][1:] == key[order][:-1]
    return _counts(owner[order][same], len(texts))


class Passages:
    """Repeated passages of the texts of a piece."""

    def __init__(self, words: np.ndarray, woff: np.ndarray, shortest: int) -> None:
        """words: a hash of each word; a text shares no words with another one."""
        n = len(woff) - 1
        owner = np.repeat(np.arange(n), np.diff(woff))
        # every text is followed by an end mark that stands once
        self.place = np.arange(len(words)) + owner
        symbols = np.empty(len(words) + n, U64)
        symbols[self.place] = mix(words ^ mix(owner.astype(U64) + U64(1))) >> U64(1)
        symbols[woff[1:] + np.arange(n)] = np.arange(n, dtype=U64) | (U64(1) << U64(63))
        order, ranks = suffix_array(symbols)
        shared = common_prefixes(order, ranks, min(shortest, WINDOW))
        length, low, high = intervals(shared)
        text = np.repeat(np.arange(n), np.diff(woff) + 1)
        # different words before: neighbours that differ, counted up to each rank
        before = np.where(order > 0, symbols[order - 1], U64(0))
        before[text[order] != text[order - 1]] = order[text[order] != text[order - 1]]
        change = np.concatenate([[0], np.cumsum(before[1:] != before[:-1])])
        counts = length >= shortest
        maximal = counts & (change[high] > change[low])
        self.repeats = _counts(text[order[low[maximal]]], n)
        self.longest = np.zeros(n, np.int64)
        np.maximum.at(self.longest, text[order[low[counts]]], length[counts])
        # the longest passage from each place on; shorter ones from there lie inside
        reach = np.zeros(len(symbols), np.int64)
        reach[order] = np.maximum(shared[:-1], shared[1:])
        self.reach, self.size = reach[self.place], len(words)

    def covered(self, shortest: int) -> np.ndarray:
        """Marks the words inside repeated passages of `shortest` words or more."""
        at = np.flatnonzero(self.reach >= shortest)
        edge = np.zeros(self.size + 1, np.int64)
        np.add.at(edge, at, 1)
        np.add.at(edge, at + self.reach[at], -1)
        return np.cumsum(edge)[:-1] > 0


OUT = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long,"
    " covered_chars long, longest_repeat long, n_repeats long, spans array<struct<start:long,words:long>>"
)


def _measured(shortest: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in pieces(batches):
            starts, ends, woff = texts.word_spans()
            sums = prefix_sums(texts.data, RAW)
            found = Passages(span_hash(sums, starts, ends) if len(starts) else np.zeros(0, U64), woff, shortest)
            letter = (texts.data & 0xC0) != 0x80
            letters = np.concatenate([[0], np.cumsum(letter)])
            covered = found.covered(shortest)
            goes_on = covered.copy()  # from the word before, in the same text
            goes_on[1:] &= covered[:-1]
            goes_on[woff[:-1][woff[:-1] < len(covered)]] = False
            first = np.flatnonzero(covered & ~goes_on)
            last = np.flatnonzero(covered & ~np.append(goes_on[1:], False)[: len(covered)])
            offsets = np.searchsorted(first, woff)
            spans = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays([pa.array(first - np.repeat(woff[:-1], np.diff(offsets)), pa.int64()), pa.array(last - first + 1, pa.int64())], ["start", "words"]))
            columns = [
                np.diff(woff), _within(letter & ~SPACE[texts.data], texts.off), _within(SYMBOL[texts.data], texts.off), duplicate_lines(texts, sums),
                _within(found.covered(WINDOW), woff), _within_sum(letters[ends] - letters[starts], covered, woff), found.longest, found.repeats,
            ]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), *(pa.array(c, pa.int64()) for c in columns), spans], [f.split()[0] for f in OUT.split(", ")])

    return run


def _within_sum(values: np.ndarray, flags: np.ndarray, off: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0], np.cumsum(np.where(flags, values, 0))])[off])


def repetition(docs: DataFrame, shortest: int = SHORTEST) -> DataFrame:
    """Per row of docs (doc_id, text): counts of the base rules and its repeated passages of `shortest` words or more.

    covered_chars: code points of words in such passages; longest_repeat: words
    of the longest; n_repeats: maximal ones; spans: the stretches of words they
    cover, from word `start` on. Words are compared as they stand. A null or
    empty text has no words and zeros throughout. Rows are measured one by one,
    also where a doc_id is null or repeated; other columns are ignored.
    """
    if shortest < 1:
        raise ValueError("a passage has one word at least")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_measured(shortest), OUT)


def quality(docs: DataFrame, most_covered: float = MOST_COVERED, most_words: int = MOST_WORDS, shortest: int = SHORTEST) -> DataFrame:
    """doc_id, the counts of `repetition`, base_failed and kept.

    base_failed: fewer than 20 words, or over 30 % of them in repeated 8-word
    windows. kept: not base_failed, at most `most_covered` per cent of the words'
    code points in repeated passages, and none of over `most_words` words.
    """
    short, windowed = F.col("n_words") < FEWEST_WORDS, 100 * F.col("n_repeat_words") > MOST_WINDOWED * F.col("n_words")
    fine = (100 * F.col("covered_chars") <= F.lit(most_covered) * F.col("word_chars")) & (F.col("longest_repeat") <= most_words)
    return repetition(docs, shortest).drop("spans").withColumn("base_failed", short | windowed).withColumn("kept", ~F.col("base_failed") & fine)
