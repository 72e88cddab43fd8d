"""Best-fit packing into sequences of a fixed length by bin completion.

Every document becomes token ids and an end mark; only what is longer than a
sequence is cut. How many pieces there are of each length is all that decides a
packing, and that table has no more rows than a sequence has tokens. Bin
completion works on it: around the largest length left it enumerates the
undominated fillings of the rest, and the chosen one is repeated as often as
the counts allow. What is left in the end is searched by branch and bound,
pruned by the waste that a better packing could still afford, against best-fit
as the incumbent. Pieces then take their places by a distributed rank within
their length.
"""

from __future__ import annotations

import os
import zlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tecframe.llm.graphs import settle
from tecframe.llm.tokens import RAW, Texts, pieces, prefix_sums, span_hash

LENGTH = 2048
SALTS = 64  # parts at least that the pieces of one length are ranked in
RANKED = 500_000  # pieces of one part, at most on average, if all have one length
REOPENED = 384  # pieces that are searched again at most, about
WORDS_KEPT = 2_000_000  # words whose ids a worker remembers
TOGETHER = 50  # new words that are encoded in one call


class Encoder:
    """Token ids of texts by way of their distinct words; the vocabulary drops white space and never spans it."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.clear()

    def clear(self) -> None:
        self.known = np.zeros(0, np.uint64)
        self.begin = np.zeros(0, np.int64)
        self.size = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def ids_of(self, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, each ending in 0, and their offsets."""
        starts, ends, woff = texts.word_spans()
        h = span_hash(prefix_sums(texts.data, RAW), starts, ends)
        words, first, seq = np.unique(h, return_index=True, return_inverse=True)
        at = np.searchsorted(self.known, words)
        old = np.zeros(len(words), bool)
        inside = at < len(self.known)
        old[inside] = self.known[at[inside]] == words[inside]
        new = np.flatnonzero(~old)
        if len(new):
            data = texts.data
            strings = [data[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(starts[first[new]].tolist(), ends[first[new]].tolist())]
            ids, size = [], np.zeros(len(strings), np.int64)
            for a in range(0, len(strings), TOGETHER):
                group = strings[a: a + TOGETHER]
                code = self.tokenizer.encode(" ".join(group), add_special_tokens=False)
                ids.extend(code.ids)
                firsts = np.cumsum([0, *(len(x) + 1 for x in group[:-1])])
                owner = np.searchsorted(firsts, [x for x, _ in code.offsets], "right") - 1
                size[a: a + len(group)] = np.bincount(owner, minlength=len(group))
            begin = len(self.ids) + np.concatenate([[0], np.cumsum(size)[:-1]])
            self.ids = np.concatenate([self.ids, np.array(ids, np.uint32)])
            known = np.concatenate([self.known, words[new]])
            order = np.argsort(known, kind="stable")
            self.known, self.begin, self.size = known[order], np.concatenate([self.begin, begin])[order], np.concatenate([self.size, size])[order]
            at = np.searchsorted(self.known, words)
        # end marks stand between the words of neighbouring texts
        count = np.diff(woff)
        n = len(seq) + len(count)
        end = np.cumsum(count + 1) - 1
        begin, size = np.zeros(n, np.int64), np.ones(n, np.int64)
        word = np.ones(n, bool)
        word[end] = False
        begin[word], size[word] = self.begin[at][seq], self.size[at][seq]
        off = np.concatenate([[0], np.cumsum(size)])
        pos = np.arange(off[-1]) + np.repeat(begin - off[:-1], size)
        stops = off[:-1][end]
        pos[stops] = 0
        out = self.ids[pos] if len(self.ids) else np.zeros(len(pos), np.uint32)
        out[stops] = 0
        if len(self.known) > WORDS_KEPT:
            self.clear()
        return out, np.concatenate([[0], stops + 1])


_encoders: dict[str, Encoder] = {}


def _pieces_of(path: str, length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoders.setdefault(path, None) or Encoder(path)
        _encoders[path] = encoder
        for part, texts in pieces(batches):
            ids, off = encoder.ids_of(texts)
            size = np.diff(off)
            each = -(-size // length)
            doc = np.repeat(np.arange(len(size)), each)
            number = np.arange(len(doc)) - np.repeat(np.concatenate([[0], np.cumsum(each)[:-1]]), each)
            start = number * length
            span = np.minimum(length, size[doc] - start)
            raw = memoryview(ids.astype("<u4").tobytes())
            at = off[doc] + start
            crc = [zlib.crc32(raw[4 * a: 4 * (a + n)]) for a, n in zip(at.tolist(), span.tolist())]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").take(pa.array(doc)), pa.array(number.astype(np.int32)), pa.array(start), pa.array(span), pa.array(crc, pa.int64())],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return run


def fillings(count: np.ndarray, room: int, most: int, limit: int = 400) -> list[list[int]]:
    """Undominated ways to fill `room` with lengths up to `most`, fullest first.

    Longest lengths first, each as often as it fits and then less often, so that
    of two fillings with equal totals the one of fewer, longer pieces is met
    first; it dominates the other. The search ends at a perfect filling or after
    `limit` steps. Its depth is the number of different lengths in a filling.
    """
    found: dict[int, list[int]] = {}
    lengths = np.flatnonzero(count[: most + 1])[::-1].tolist()
    falling = [-n for n in lengths]
    chosen: list[list[int]] = []  # place in lengths, times
    i, left = 0, room
    for _ in range(limit):
        grown = False
        while (i := bisect_left(falling, -left, i)) < len(lengths):
            times = min(int(count[lengths[i]]), left // lengths[i])
            chosen.append([i, times])
            left -= times * lengths[i]
            grown = True
            i += 1
        if (grown or not chosen) and left not in found:
            found[left] = [lengths[k] for k, times in chosen for _ in range(times)]
        if chosen and chosen[-1][0] == len(lengths) - 1:  # fewer of the shortest only leave room
            k, times = chosen.pop()
            left += times * lengths[k]
        if 0 in found or not chosen:
            break
        k = chosen[-1][0]
        left += lengths[k]
        chosen[-1][1] -= 1
        if not chosen[-1][1]:
            chosen.pop()
        i = k + 1
    return [found[w] for w in sorted(found)]


def best_fit_counts(count: np.ndarray, size: int) -> list[tuple[int, list[int]]]:
    """Best-fit decreasing by counts, as (times, lengths of one sequence)."""
    groups: dict[int, list[tuple[int, list[int]]]] = {}
    for n in np.flatnonzero(count)[::-1].tolist():
        open_ = int(count[n])
        while open_:
            room = min((r for r in groups if r >= n), default=None)
            if room is None:
                room, times, held = size, open_, []
            else:
                times, held = groups[room].pop()
                if not groups[room]:
                    del groups[room]
            # a sequence that takes one piece is the tightest for the next one as well
            each = room // n
            filled = min(times, open_ // each)
            rest = open_ - filled * each if filled < times else 0
            for bins, k in ((filled, each), (1, rest)):
                if bins and k:
                    groups.setdefault(room - k * n, []).append((bins, held + [n] * k))
            untouched = times - filled - (rest > 0)
            if held and untouched:
                groups.setdefault(room, []).append((untouched, held))
            open_ -= filled * each + rest
    return [g for r in sorted(groups) for g in groups[r]]


def fewest(count: np.ndarray, size: int) -> int:
    """A lower bound on the sequences: pieces over half a sequence never meet, and short ones only fill what those leave."""
    n = np.arange(len(count))
    best = -(-int((n * count).sum()) // size)
    for k in range(1, size // 2 + 1):
        large, middle, small = n > size - k, (n > size // 2) & (n <= size - k), (n >= k) & (n <= size // 2)
        over = int((n * count)[small].sum()) - (size * int(count[middle].sum()) - int((n * count)[middle].sum()))
        best = max(best, int(count[large].sum() + count[middle].sum()) + max(0, -(-over // size)))
    return best


def best_fit(lengths: list[int], size: int) -> list[list[int]]:
    """Best-fit decreasing."""
    bins: list[list[int]] = []
    room: list[int] = []
    for n in sorted(lengths, reverse=True):
        fit = min((r, i) for i, r in enumerate(room) if r >= n) if any(r >= n for r in room) else None
        if fit is None:
            bins.append([n])
            room.append(size - n)
        else:
            bins[fit[1]].append(n)
            room[fit[1]] -= n
    return bins


def search(lengths: list[int], size: int, limit: int = 3000) -> list[list[int]]:
    """Branch and bound over completions of the largest length; best-fit is the first incumbent."""
    best = best_fit(lengths, size)
    total = sum(lengths)
    floor = -(-total // size)
    steps = 0

    def go(count: np.ndarray, bins: list[list[int]], waste: int) -> None:
        nonlocal best, steps
        steps += 1
        if len(best) == floor or steps > limit:
            return
        left = np.flatnonzero(count)
        if not len(left):
            if len(bins) < len(best):
                best = [list(b) for b in bins]
            return
        # a better packing has one sequence less at least; it can't waste more than that leaves
        spare = (len(best) - 1) * size - total
        top = int(left[-1])
        count[top] -= 1
        for rest in fillings(count, size - top, min(top, size - top)):
            lost = size - top - sum(rest)
            if waste + lost > spare:
                break  # fullest first: the others waste more
            np.subtract.at(count, rest, 1)
            go(count, [*bins, [top, *rest]], waste + lost)
            np.add.at(count, rest, 1)
            spare = (len(best) - 1) * size - total
        count[top] += 1

    count = np.bincount(lengths, minlength=size + 1) if lengths else np.zeros(size + 1, np.int64)
    go(count, [], 0)
    return best


def complete(count: np.ndarray, size: int, tail: int = 48) -> list[tuple[int, list[int]]]:
    """(times, lengths of one sequence) for a table of counts by length.

    Bin completion of the whole table; while it needs more sequences than the
    lower bound, its last ones are opened again and searched, more of them each
    time. Best-fit of the whole table stands in where that has fewer.
    """
    count = count.astype(np.int64).copy()
    floor, other = fewest(count, size), best_fit_counts(count, size)
    out: list[tuple[int, list[int]]] = []

    def needed(patterns: list[tuple[int, list[int]]]) -> int:
        return sum(times for times, _ in patterns)

    while count.sum() > tail:
        top = int(np.flatnonzero(count)[-1])
        count[top] -= 1
        rest = fillings(count, size - top, min(top, size - top))[0] if top < size else []
        count[top] += 1
        need = np.bincount([top, *rest], minlength=len(count))
        used = np.flatnonzero(need)
        times = int((count[used] // need[used]).min())
        count -= times * need
        out.append((times, [top, *rest]))
    left = np.repeat(np.arange(len(count)), count).tolist()
    best = out + [(1, b) for b in search(left, size)]
    while needed(best) > floor and out and tail < REOPENED:
        tail *= 2
        while out and len(left) < tail:
            times, lengths = out.pop()
            again = min(times, -(-(tail - len(left)) // len(lengths)))
            left += lengths * again
            if again < times:
                out.append((times - again, lengths))
        new = out + [(1, b) for b in search(left, size, 300)]
        best = new if needed(new) < needed(best) else best
    return other if needed(other) < needed(best) else best


class Places:
    """For each length the ranges of ranks, and where pieces of those ranks go."""

    def __init__(self, patterns: list[tuple[int, list[int]]]) -> None:
        rows, base, given = [], 0, {}
        for times, lengths in patterns:
            offset = 0
            for n in sorted(lengths, reverse=True):
                rows.append((n, given.get(n, 0), base, offset))
                given[n] = given.get(n, 0) + times
                offset += n
            base += times
        rows.sort()
        self.length, self.first, self.base, self.offset = (np.array(x, np.int64) for x in zip(*rows)) if rows else (np.zeros(0, np.int64),) * 4
        self.starts = {n: (int(a), int(b)) for n, a, b in zip(*self._runs())} if rows else {}

    def _runs(self) -> tuple[list[int], np.ndarray, np.ndarray]:
        lengths, begin = np.unique(self.length, return_index=True)
        return lengths.tolist(), begin, np.append(begin[1:], len(self.length))

    def put(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.zeros(len(length), np.int64)
        for n in np.unique(length).tolist():
            a, b = self.starts[n]
            mine = length == n
            at[mine] = a + np.searchsorted(self.first[a:b], rank[mine], "right") - 1
        return self.base[at] + rank - self.first[at], self.offset[at]


def pack(docs: DataFrame, tokenizer: str, length: int = LENGTH) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset for every piece of docs (doc_id, text).

    A null or empty text is one piece that holds the end mark alone. Rows that
    repeat are packed as often as they occur; a null doc_id is kept. An empty
    table gives no rows. Other columns are ignored. `tokenizer` is the path of
    a vocabulary file that every worker can read.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    cut = docs.mapInArrow(_pieces_of(tokenizer, length), "doc_id long, piece int, start long, length long, ids_crc32 long")
    cut = settle(cut, "pieces")
    salts = max(SALTS, cut.count() // RANKED)
    cut = cut.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(salts)))
    sizes = cut.groupBy("length", "salt").count()
    count = np.zeros(length + 1, np.int64)
    for r in sizes.groupBy("length").agg(F.sum("count").alias("n")).collect():  # a row per length
        count[r.length] = r.n
    places = spark.sparkContext.broadcast(Places(complete(count, length)))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("before", F.coalesce(F.sum("count").over(before), F.lit(0)))
    own = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")
    ranked = cut.withColumn("own", F.row_number().over(own) - 1).join(sizes.select("length", "salt", "before"), ["length", "salt"])
    ranked = ranked.withColumn("rank", F.col("own") + F.col("before"))

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                sequence, offset = places.value.put(b.column("length").to_numpy(), b.column("rank").to_numpy())
                yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")), pa.array(sequence), pa.array(offset)], ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "rank").mapInArrow(put, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
