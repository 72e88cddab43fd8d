"""Language-model scores from a log-frequency Bloom filter.

Unigram and bigram counts of the training texts are quantised to powers of a
base, and a key of level q enters the filter with the levels 1 .. q. A count is
read by probing levels in turn until one is missing. The filter is built in
slices: the hash range of a bucket owns a slice of the bits, so the reducer
that has summed a bucket's counts fills its slice alone. Every bigram is in its
slice, once seen ones too, and a slice is as large as its entries ask for.
Slices of texts of SENT_TOKENS or fewer are broadcast, those of bigrams no more
than PASS_BITS at a time. Those of larger ones stay where they were filled: the
texts are stored in pieces, each piece sends its distinct bigrams once, to be
counted and to be read from the filled slices, and the levels come back to the
piece, so the texts are not gone through more often as they grow. Words' slices
have a bounded number of bits; past the bound, which vocabularies don't come
near, more probes err, as the method has it.

A token's probability is
    LAMBDA * count(u, w) / count(u) + (1 - LAMBDA) * (count(w) + 1) / (N + V + 1)
and the second factor alone where the word before is unknown. Counts read from
the filter are the lower ends of their bins, the context's the upper end, so
that probabilities of a context don't sum to more than one.

The base score needs exact counts. Words of at least one token in FREQUENT (no
more than FREQUENT of them) are sent to all workers; the rest meet their counts
by bucket, as packed arrays, and come back as one sum per document and bucket.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from tecframe.llm.graphs import settle
from tecframe.llm.tokens import MULTIPLIERS, U64, Texts, below, mix, pieces, set_sum, signed
from tecframe.llm.toxicity import held_out

GROWTH, LEVELS = 1.5, 64
PROBES = 3
LAMBDA = 0.25
FREQUENT = 100_000
BITS_A_TOKEN, MOST_BITS = 2, 1 << 29  # of the words' slices
BITS_AN_ENTRY, PASS_BITS = 3, 1 << 29  # of bigrams: for each probe that is set, and sent at once
BUCKET_ROWS = 1 << 19
SENT_TOKENS = 1 << 23  # of texts whose slices are sent to all workers
PIECE_BYTES = 2 << 20  # of text that sends its bigrams together
END = U64(0x6A09E667F3BCC909)
SUMS = "bucket int, words long, tokens long, keys binary, counts binary, bits binary, pair_size long, pair_bits binary"
STATS = "doc_id long, rid long, n_tokens long, known long, logs double, score double"


def tokens(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes with one end after each text, and their offsets."""
    h, woff = texts.words()
    off = woff + np.arange(len(woff))
    out = np.full(off[-1], END, U64)
    word = np.ones(off[-1], bool)
    word[off[1:] - 1] = False
    out[word] = h
    return out, off


def pairs(t: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each token with the one before, and that one; a text starts after an end."""
    before = np.concatenate([[END], t[:-1]]) if len(t) else t
    before[off[:-1]] = END
    return mix(before * MULTIPLIERS[2] + t * MULTIPLIERS[3]) | U64(1), before


def _zip(*arrays: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(b"".join(a.tobytes() for a in arrays))


def _unzip(raw: bytes, n: int, *kinds: type) -> list[np.ndarray]:
    data, at, out = zstandard.ZstdDecompressor().decompress(raw), 0, []
    for kind in kinds:
        out.append(np.frombuffer(data, kind, n, at))
        at += n * np.dtype(kind).itemsize
    return out


def _bucketed(key: np.ndarray, buckets: int, *more: np.ndarray) -> Iterator[tuple]:
    bucket = below(key, buckets).astype(np.int32)
    order = np.lexsort((key, bucket))
    bucket = bucket[order]
    cuts = np.flatnonzero(np.diff(bucket)) + 1
    for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(key)]):
        if b > a:
            yield int(bucket[a]), b - a, key[order[a:b]], *(x[order[a:b]] for x in more)


def _counts(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in pieces(batches, 2 << 20):
            t, off = tokens(texts)
            rows = []
            for kind, keys in ((0, t), (1, pairs(t, off)[0])):
                key, n = np.unique(keys, return_counts=True)
                rows += [(b, kind, size, _zip(k, c.astype(np.uint32))) for b, size, k, c in _bucketed(key, buckets, n)]
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows), (pa.int32(), pa.int32(), pa.int32(), pa.binary()))], ["bucket", "kind", "n", "data"])

    return run


def level(count: np.ndarray) -> np.ndarray:
    return np.minimum(1 + np.floor(np.log(count) / np.log(GROWTH) + 1e-9).astype(np.int64), LEVELS)


def _places(key: np.ndarray, q: int, bits: int | np.ndarray) -> Iterator[np.ndarray]:
    base = mix(key ^ U64(q * 0x9E3779B97F4A7C15 % 2**64))
    for p in range(PROBES):
        yield (mix(base + U64(p)) % np.asarray(bits, U64)).astype(np.int64)


def levels(bits: np.ndarray, start: np.ndarray, size: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Level of each key in its slice of `size` bits from byte `start` on; 0 where it is missing."""
    out = np.zeros(len(key), np.int64)
    alive = np.arange(len(key))
    for q in range(1, LEVELS + 1):
        ok = np.ones(len(alive), bool)
        for place in _places(key[alive], q, size[alive]):
            ok &= (bits[start[alive] + (place >> 3)] >> (7 - (place & 7)).astype(np.uint8)) & 1 == 1
        alive = alive[ok]
        if not len(alive):
            break
        out[alive] = q
    return out


def low_end(q: np.ndarray) -> np.ndarray:
    return np.where(q > 0, np.ceil(GROWTH ** (q - 1.0) - 1e-9), 0)


def _filled(key: np.ndarray, count: np.ndarray, size: int | None = None) -> tuple[int, bytes]:
    """Bits of a slice with these keys, as many as they ask for or `size`."""
    q = level(count)
    bits = np.zeros(size or max(1 << 10, BITS_AN_ENTRY * PROBES * int(q.sum())), bool)
    for step in range(1, int(q.max(initial=0)) + 1):
        for place in _places(key[q >= step], step, len(bits)):
            bits[place] = True
    return len(bits), np.packbits(bits).tobytes()


def _sums(table: pa.Table, bucket: int, slice_bits: int) -> pa.Table:
    """Exact unigram counts of a bucket, and its slices of the filter."""
    words, slices = None, []
    for kind in (0, 1):
        rows = [(n, d.as_py()) for k, n, d in zip(table["kind"].to_pylist(), table["n"].to_pylist(), table["data"]) if k == kind]
        found = [_unzip(d, n, np.uint64, np.uint32) for n, d in rows]
        key = np.concatenate([k for k, _ in found]) if found else np.zeros(0, U64)
        count = np.concatenate([c for _, c in found]) if found else np.zeros(0, np.uint32)
        order = np.argsort(key)
        key, count = key[order], count[order].astype(np.int64)
        starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
        key, count = key[starts], np.add.reduceat(count, starts) if len(starts) else count
        if kind == 0:
            words = key, count
        slices.append(_filled(key, count, slice_bits if kind == 0 else None))
    key, count = words
    return pa.table({
        "bucket": pa.array([bucket], pa.int32()), "words": pa.array([len(key)], pa.int64()), "tokens": pa.array([int(count.sum())], pa.int64()),
        "keys": pa.array([key.tobytes()], pa.binary()), "counts": pa.array([count.tobytes()], pa.binary()), "bits": pa.array([slices[0][1]], pa.binary()),
        "pair_size": pa.array([slices[1][0]], pa.int64()), "pair_bits": pa.array([slices[1][1]], pa.binary()),
    })


def _summed(slice_bits: int):
    return lambda table: _sums(table, table["bucket"][0].as_py(), slice_bits)


def _stored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of PIECE_BYTES of text as one row, with a number of its own."""
    for part, _ in pieces(batches, PIECE_BYTES):
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, part.schema) as out:
            out.write_batch(part)
        packed = zstandard.ZstdCompressor(level=1).compress(sink.getvalue())
        yield pa.RecordBatch.from_arrays([pa.array([uuid.uuid4().int >> 65], pa.int64()), pa.array([packed], pa.binary())], ["piece", "packed"])


def _opened(packed: bytes) -> tuple[pa.RecordBatch, Texts]:
    rows = pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(packed)).read_all().combine_chunks()
    part = rows.to_batches()[0]
    return part, Texts(part.column("text"))


def _asks(buckets: int):
    """Distinct words of the training texts, and distinct bigrams of all texts, of each piece with their counts in training texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece, packed in zip(batch.column("piece").to_pylist(), batch.column("packed").to_pylist()):
                part, texts = _opened(packed)
                t, off = tokens(texts)
                counts = np.repeat(~part.column("held_out").to_numpy(zero_copy_only=False), np.diff(off))
                rows = []
                for kind, keys, some in ((0, t[counts], counts[counts]), (1, pairs(t, off)[0], counts)):
                    key, at = np.unique(keys, return_inverse=True)
                    n = np.bincount(at[some], minlength=len(key))
                    rows += [(b, piece, kind, size, _zip(k, c.astype(np.uint32))) for b, size, k, c in _bucketed(key, buckets, n)]
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows), (pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.binary()))], ["bucket", "piece", "kind", "n", "data"])

    return run


def _reduced(slice_bits: int, parts: int):
    """The sums of a bucket as _summed has them, without the bigrams' slice, and the levels that it gives to the bigrams of each piece."""

    def run(table: pa.Table) -> pa.Table:
        asked = table.filter(pa.array(table["kind"].to_numpy() == 1))
        found = [_unzip(d.as_py(), n, np.uint64, np.uint32) for n, d in zip(asked["n"].to_pylist(), asked["data"])]
        key, count = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, U64), np.zeros(0, np.uint32))
        sizes = np.array([len(k) for k, _ in found], np.int64)
        del found
        order = np.argsort(key)
        starts = np.flatnonzero(np.concatenate([[True], np.diff(key[order]) != 0])) if len(key) else np.zeros(0, np.int64)
        both, count = key[order][starts], np.add.reduceat(count[order].astype(np.int64), starts) if len(starts) else count
        size, bits = _filled(both[count > 0], count[count > 0])
        q = levels(np.frombuffer(bits, np.uint8), np.zeros(len(both), np.int64), np.full(len(both), size), both).astype(np.uint8)
        given = np.empty(len(key), np.uint8)
        given[order] = np.repeat(q, np.diff(np.append(starts, len(key))))
        piece = asked["piece"].to_numpy()
        part = below(mix(piece.view(U64)), parts).astype(np.int32)
        out = _sums(table.filter(pa.array(table["kind"].to_numpy() == 0)), table["bucket"][0].as_py(), slice_bits)
        rows = {"bucket": [table["bucket"][0].as_py()], "part": [None], "levels": [None]}
        ends = np.cumsum(sizes)
        for p in np.unique(part).tolist():
            mine = np.flatnonzero(part == p)
            levels_of = np.concatenate([given[ends[i] - sizes[i]: ends[i]] for i in mine.tolist()])
            rows["bucket"].append(rows["bucket"][0])
            rows["part"].append(p)
            rows["levels"].append(np.array([len(mine)], "<i8").tobytes() + _zip(piece[mine], sizes[mine], levels_of))
        n = len(rows["part"])
        more = {c: pa.concat_arrays([out[c].combine_chunks(), pa.nulls(n - 1, out[c].type)]) for c in out.column_names if c != "bucket"}
        return pa.table({"bucket": pa.array(rows["bucket"], pa.int32()), **more, "part": pa.array(rows["part"], pa.int32()), "levels": pa.array(rows["levels"], pa.binary())})

    return run


def _finished(model):
    """The rows of _stats of a part's pieces, their bigrams' levels given by the buckets."""

    def run(stored: pa.Table, answers: pa.Table) -> pa.Table:
        out = [pa.RecordBatch.from_pylist([], pa.schema([("doc_id", pa.int64()), *((c, pa.int64()) for c in ("rid", "n_tokens", "known")), ("logs", pa.float64()), ("score", pa.float64())]))]
        if not stored.num_rows:
            return pa.Table.from_batches(out)
        given: dict[int, list[tuple[int, np.ndarray]]] = {}
        for bucket, raw in zip(answers["bucket"].to_pylist(), answers["levels"].to_pylist()):
            n = int(np.frombuffer(raw, "<i8", 1)[0])
            data = zstandard.ZstdDecompressor().decompress(raw[8:])
            sizes, q = np.frombuffer(data, np.int64, n, 8 * n), np.frombuffer(data, np.uint8, -1, 16 * n)
            for piece, x in zip(np.frombuffer(data, np.int64, n).tolist(), np.split(q, np.cumsum(sizes)[:-1])):
                given.setdefault(piece, []).append((bucket, x))
        for piece, packed in zip(stored["piece"].to_pylist(), stored["packed"]):
            part, texts = _opened(packed.as_py())
            known = Given(np.concatenate([x for _, x in sorted(given.pop(piece), key=lambda a: a[0])]))
            out.append(_row_stats(model.value, known, part, texts))
        return pa.Table.from_batches(out)

    return run


def _dealt(parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            part = below(mix(b.column("piece").to_numpy().view(U64)), parts).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(part), b.column("piece"), b.column("packed")], ["part", "piece", "packed"])

    return run


class Given:
    """The levels of all distinct bigrams of a piece, by rising hash."""

    def __init__(self, q: np.ndarray) -> None:
        self.q = q.astype(np.int64)

    def own(self, key: np.ndarray, buckets: int) -> np.ndarray:
        self.every = np.unique(key)
        return np.ones(len(key), bool)

    def levels(self, key: np.ndarray, buckets: int) -> np.ndarray:
        return self.q[np.searchsorted(self.every, key)]


def _frequent(least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k, c in zip(b.column("keys"), b.column("counts")):
                key, count = np.frombuffer(k.as_py(), U64), np.frombuffer(c.as_py(), np.int64)
                top = count >= least
                yield pa.RecordBatch.from_arrays([pa.array(signed(key[top])), pa.array(count[top])], ["key", "count"])

    return run


class Model:
    """What every worker holds: the filter of words, the frequent words, N and V."""

    def __init__(self, bits: np.ndarray, slice_bits: int, buckets: int, key: np.ndarray, count: np.ndarray, n: int, v: int) -> None:
        order = np.argsort(key)
        self.bits, self.slice_bits, self.buckets = bits, slice_bits, buckets
        self.key, self.count, self.n, self.v = key[order], count[order], n, v

    def frequent(self, h: np.ndarray) -> np.ndarray:
        """Exact counts of frequent words; 0 for others."""
        if not len(self.key):
            return np.zeros(len(h), np.int64)
        at = np.minimum(np.searchsorted(self.key, h), len(self.key) - 1)
        return np.where(self.key[at] == h, self.count[at], 0)

    def log_probabilities(self, t: np.ndarray, off: np.ndarray, slices: Slices, first: bool) -> np.ndarray:
        """Of the tokens whose bigrams are in `slices`, and in the first pass of those without a known word before; 0 for others."""
        word, seq = np.unique(t, return_inverse=True)
        q = levels(self.bits, below(word, self.buckets).astype(np.int64) * (-(-self.slice_bits // 8)), np.full(len(word), self.slice_bits), word)
        exact = self.frequent(word)
        low = np.where(exact > 0, exact, low_end(q))
        high = np.where(exact > 0, exact, np.where(q > 0, np.floor(GROWTH ** q.astype(float)), 0))
        single = ((low + 1) / (self.n + self.v + 1))[seq]
        both, before = pairs(t, off)
        context = high[np.minimum(np.searchsorted(word, before), max(len(word) - 1, 0))]  # every word before is a token of the piece: a word or an end
        here = np.flatnonzero((context > 0) & slices.own(both, self.buckets))
        out = np.where(context > 0, 0.0, np.log10(single) if first else 0.0)
        pair, at = np.unique(both[here], return_inverse=True)
        seen = low_end(slices.levels(pair, self.buckets))[at]
        out[here] = np.log10(LAMBDA * np.minimum(seen, context[here]) / context[here] + (1 - LAMBDA) * single[here])
        return out


class Slices:
    """The filter of the bigrams of neighbouring buckets."""

    def __init__(self, first: int, sizes: list[int], bits: list[bytes]) -> None:
        self.first, self.sizes = first, np.array(sizes, np.int64)
        self.starts = np.concatenate([[0], np.cumsum([len(x) for x in bits])])[:-1].astype(np.int64)
        self.bits = np.frombuffer(b"".join(bits), np.uint8)

    def own(self, key: np.ndarray, buckets: int) -> np.ndarray:
        bucket = below(key, buckets).astype(np.int64)
        return (bucket >= self.first) & (bucket < self.first + len(self.sizes))

    def levels(self, key: np.ndarray, buckets: int) -> np.ndarray:
        at = below(key, buckets).astype(np.int64) - self.first
        return levels(self.bits, self.starts[at], self.sizes[at], key)


def passes(sizes: dict[int, int], buckets: int) -> list[tuple[int, int]]:
    """Ranges of buckets whose slices have no more than PASS_BITS, or of one bucket; they cover all buckets."""
    out, first, total = [], 0, 0
    for b in range(buckets):
        size = sizes.get(b, 0)
        if b > first and total + size > PASS_BITS:
            out.append((first, b))
            first, total = b, 0
        total += size
    return [*out, (first, buckets)]


def _row_stats(model: Model, slices: Slices | Given, part: pa.RecordBatch, texts: Texts) -> pa.RecordBatch:
    t, off = tokens(texts)
    count = model.frequent(t)
    logs = np.concatenate([[0.0], np.cumsum(np.where(count > 0, np.log10(count + 1.0), 0.0))])
    known = np.concatenate([[0], np.cumsum(count > 0)])
    score = np.add.reduceat(model.log_probabilities(t, off, slices, True), off[:-1])
    return pa.RecordBatch.from_arrays(
        [part.column("doc_id"), pa.array(signed(row_keys(part, t, off))), pa.array(np.diff(off)), pa.array(known[off[1:]] - known[off[:-1]]), pa.array(logs[off[1:]] - logs[off[:-1]]), pa.array(score)],
        ["doc_id", "rid", "n_tokens", "known", "logs", "score"],
    )


def _stats(model, slices):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in pieces(batches):
            yield _row_stats(model.value, slices.value, part, texts)

    return run


def _more(model, slices):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in pieces(batches):
            t, off = tokens(texts)
            score = np.add.reduceat(model.value.log_probabilities(t, off, slices.value, False), off[:-1])
            yield pa.RecordBatch.from_arrays([pa.array(signed(row_keys(part, t, off))), pa.array(score)], ["rid", "more"])

    return run


def row_keys(part: pa.RecordBatch, t: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Key of each row by doc_id and tokens; rows that agree in both have equal scores."""
    nth = np.arange(len(t)) - np.repeat(off[:-1], np.diff(off))
    ids = part.column("doc_id").fill_null(-1).to_numpy()
    return mix(mix(ids.view(U64)) + set_sum(mix(t + nth.astype(U64) * MULTIPLIERS[5]), off))


def _rare(model, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in pieces(batches, 2 << 20):
            t, off = tokens(texts)
            rid = row_keys(part, t, off)
            word, seq = np.unique(t, return_inverse=True)
            rare = (model.value.frequent(word) == 0)[seq]
            doc = np.repeat(np.arange(len(rid)), np.diff(off))[rare]
            both, n = np.unique(doc * len(word) + seq[rare], return_counts=True)
            key, doc = word[both % len(word)] if len(both) else word[:0], both // max(len(word), 1)
            rows = []
            bucket = below(key, buckets).astype(np.int32)
            order = np.lexsort((doc, bucket))
            cuts = np.flatnonzero(np.diff(bucket[order])) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(order)]):
                if b > a:
                    mine = order[a:b]
                    starts = np.flatnonzero(np.diff(doc[mine], prepend=-1))
                    runs = np.diff(np.append(starts, b - a)).astype(np.uint32)
                    rows.append((int(bucket[mine[0]]), len(starts), rid[doc[mine][starts]].tobytes(), runs.tobytes(), b - a, _zip(key[mine], n[mine].astype(np.uint32))))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows), (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.int32(), pa.binary()))], ["bucket", "docs", "rids", "runs", "n", "data"])

    return run


def _answer(parts: int):
    def run(asked: pa.Table, known: pa.Table) -> pa.Table:
        """Sums of a bucket's rare words per row, packed by the parts of the rows."""
        key = np.concatenate([np.frombuffer(x.as_py(), U64) for x in known["keys"]] or [np.zeros(0, U64)])
        count = np.concatenate([np.frombuffer(x.as_py(), np.int64) for x in known["counts"]] or [np.zeros(0, np.int64)])
        rids, logs, hits = [], [], []
        for rid, runs, n, data in zip(*(asked[c] for c in ("rids", "runs", "n", "data"))):
            k, tf = _unzip(data.as_py(), n.as_py(), np.uint64, np.uint32)
            c = np.zeros(len(k), np.int64)
            if len(key):
                at = np.minimum(np.searchsorted(key, k), len(key) - 1)
                c = np.where(key[at] == k, count[at], 0)
            start = np.concatenate([[0], np.cumsum(np.frombuffer(runs.as_py(), np.uint32))])[:-1].astype(np.int64)
            rids.append(np.frombuffer(rid.as_py(), U64))
            logs.append(np.add.reduceat(tf * np.log10(c + 1.0), start))
            hits.append(np.add.reduceat(np.where(c > 0, tf, 0).astype(np.int64), start))
        out = {"part": [], "data": []}
        if rids:
            rid, log, hit = map(np.concatenate, (rids, logs, hits))
            part = below(rid, parts).astype(np.int32)
            order = np.argsort(part, kind="stable")
            cuts = np.flatnonzero(np.diff(part[order])) + 1
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(order)]):
                mine = order[a:b]
                out["part"].append(int(part[mine[0]]))
                out["data"].append(rid[mine].tobytes() + log[mine].tobytes() + hit[mine].astype(np.uint32).tobytes())
        return pa.table({"part": pa.array(out["part"], pa.int32()), "data": pa.array(out["data"], pa.binary())})

    return run


def _gather(table: pa.Table) -> pa.Table:
    rids, logs, hits = [], [], []
    for x in table["data"]:
        raw = x.as_py()
        n = len(raw) // 20
        rids.append(np.frombuffer(raw, U64, n))
        logs.append(np.frombuffer(raw, np.float64, n, 8 * n))
        hits.append(np.frombuffer(raw, np.uint32, n, 16 * n))
    rid, at = np.unique(np.concatenate(rids), return_inverse=True)
    return pa.table({"rid": signed(rid), "rare_logs": np.bincount(at, np.concatenate(logs)), "rare_known": np.bincount(at, np.concatenate(hits)).astype(np.int64)})


def score(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every row of docs (doc_id, text).

    Null and empty texts are one end. A null doc_id is not held out. Rows that
    repeat count as often in training and get equal scores. Without training
    rows N and V are 0. Other columns are ignored.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    n_docs, size = docs.agg(F.count("*"), F.sum(F.octet_length("text"))).first()
    about = (size or 0) // 6 + n_docs
    buckets, parts = max(12, about // BUCKET_ROWS // 2), max(12, n_docs // 4000)
    slice_bits = max(1 << 14, min(MOST_BITS, BITS_A_TOKEN * about) // buckets // 8 * 8)
    held = held_out(F.col("doc_id"), 7, 2)
    stored = graded = None
    if about <= SENT_TOKENS:
        counted = docs.where(~held).mapInArrow(_counts(buckets), "bucket int, kind int, n int, data binary").repartition(buckets, "bucket").groupBy("bucket")
        summed = settle(counted.applyInArrow(_summed(slice_bits), SUMS), "counts")
    else:
        stored = settle(docs.withColumn("held_out", held).mapInArrow(_stored, "piece long, packed binary"), "pieces")
        at_once = max(12, (size or 0) // (4 * PIECE_BYTES))
        counted = stored.mapInArrow(_asks(buckets), "bucket int, piece long, kind int, n int, data binary").repartition(buckets, "bucket").groupBy("bucket")
        summed = settle(counted.applyInArrow(_reduced(slice_bits, at_once), f"{SUMS}, part int, levels binary"), "counts")
        summed, graded = summed.where("part IS NULL"), summed.where("part IS NOT NULL").select("bucket", "part", "levels")
    v, n = (x or 0 for x in summed.agg(F.sum("words"), F.sum("tokens")).first())
    top = summed.select("keys", "counts").mapInArrow(_frequent(max(2.0, n / FREQUENT)), "key long, count long").toPandas()  # FREQUENT rows at most
    width = -(-slice_bits // 8)
    bits = np.zeros(width * buckets, np.uint8)
    for r in summed.select("bucket", "bits").toLocalIterator():  # MOST_BITS altogether at most
        bits[r.bucket * width: (r.bucket + 1) * width] = np.frombuffer(bytes(r.bits), np.uint8)
    model = spark.sparkContext.broadcast(Model(bits, slice_bits, buckets, top["key"].to_numpy(np.int64).view(U64), top["count"].to_numpy(np.int64), n, v))
    asked = docs.mapInArrow(_rare(model, buckets), "bucket int, docs int, rids binary, runs binary, n int, data binary").repartition(buckets, "bucket").groupBy("bucket")
    answers = asked.cogroup(summed.select("bucket", "keys", "counts").repartition(buckets, "bucket").groupBy("bucket")).applyInArrow(_answer(parts), "part int, data binary")
    rare = answers.repartition(parts, "part").groupBy("part").applyInArrow(lambda t: _gather(t), "rid long, rare_logs double, rare_known long")
    stats, later = None, []
    if stored is not None:
        pieces_of = stored.mapInArrow(_dealt(at_once), "part int, piece long, packed binary").repartition(at_once, "part").groupBy("part")
        given = pieces_of.cogroup(graded.repartition(at_once, "part").groupBy("part"))
        stats = settle(given.applyInArrow(_finished(model), STATS), "scores")
        ranges = []
    else:
        ranges = passes(dict(summed.select("bucket", "pair_size").toLocalIterator()), buckets)
    for first, end in ranges:
        held = {r.bucket: (r.pair_size, bytes(r.pair_bits)) for r in summed.where(F.col("bucket").between(first, end - 1)).select("bucket", "pair_size", "pair_bits").toLocalIterator()}  # PASS_BITS at most
        sizes, raw = zip(*(held.get(b, (8, b"\0")) for b in range(first, end)))
        slices = spark.sparkContext.broadcast(Slices(first, list(sizes), list(raw)))
        if stats is None:
            stats = settle(docs.mapInArrow(_stats(model, slices), STATS), "scores")
        else:  # rows that repeat have equal parts
            later.append(settle(docs.mapInArrow(_more(model, slices), "rid long, more double"), "scores").groupBy("rid").agg(F.min("more").alias("more")))
        slices.unpersist()
    twice = stats.groupBy("rid").agg(F.count("*").alias("copies"))
    joined = stats.join(twice, "rid").join(rare, "rid", "left")
    if later:
        rest = reduce(DataFrame.union, later).groupBy("rid").agg(F.sum("more").alias("more"))
        joined = joined.join(rest, "rid").withColumn("score", F.col("score") + F.col("more"))
    logs = F.col("logs") + F.coalesce(F.col("rare_logs") / F.col("copies"), F.lit(0.0))
    known = F.col("known") + F.coalesce((F.col("rare_known") / F.col("copies")).cast("long"), F.lit(0))
    return joined.select(
        "doc_id", held_out(F.col("doc_id"), 7, 2).alias("held_out"), "n_tokens", known.alias("n_known"), F.lit(n).cast("long").alias("train_tokens"),
        (logs - F.col("n_tokens") * F.log10(F.lit(float(n + v + 1)))).alias("base_score"), "score",
    )
