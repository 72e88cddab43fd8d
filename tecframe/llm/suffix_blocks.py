"""Exact removal of repeated 50-byte strings by blockwise suffix sorting.

Every 50-byte string is anchored at its smallest hashed 16-gram (the leftmost
of equal ones), which depends on its bytes alone: equal strings have equal
anchors at equal distances. Anchors that one document holds alone need no
sorting. The strings of a shared anchor form a run of neighbouring suffixes;
runs travel to the bucket of their anchor, and buckets are sorted one at a
time, so that memory follows the bucket.

Within a bucket, the suffixes on a difference cover (positions whose distance to
the anchor, modulo 31, lies in a set whose differences give every residue) are
ranked first. All suffixes are then sorted by their first 16 bytes, and longer
ties by the rank of the next cover suffix, at most 13 bytes on, and the last 16
bytes; together these span all 50. Each run of equal suffixes keeps the
smallest doc_id and marks the others.

Texts meet their anchors, and later their spans, in parts of a few megabytes
of documents dealt by doc_id; they travel there compressed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from tecframe.llm.graphs import settle
from tecframe.llm.tokens import BASE, INVERSE, RAW, U64, Texts, below, mix, pieces, powers, prefix_sums, signed, span_hash

LENGTH, GRAM = 50, 16
GRAMS = LENGTH - GRAM + 1
COVER_MOD = 31
COVER = (1, 5, 11, 24, 25, 27)  # every residue modulo 31 is a difference of two of them
HEAD, TAIL, RANKED = 16, 16, 34
ANCHOR_ROWS, RUN_ROWS = 1 << 19, 30_000  # rows of a bucket, on average
PART_BYTES = 5 << 20  # of texts that meet their spans in one task
PLACE = 28  # bits of a position below the bits of its hash


def anchors(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows with one anchor: first window, windows, anchor, its hash, its text."""
    n = len(data) - GRAM + 1
    none = np.zeros(0, np.int64)
    if n < GRAMS:
        return none, none, none, np.zeros(0, U64), none
    s = prefix_sums(data, RAW)
    g = mix((s[GRAM:] - s[:-GRAM]) * powers(len(s), INVERSE)[:n])
    low = ((g >> U64(PLACE)) << U64(PLACE)) | np.arange(n, dtype=U64)
    step = 1
    while step < 32:
        low = np.minimum(low[:-step], low[step:])
        step *= 2
    low = np.minimum(low[: len(low) - (GRAMS - 32)], low[GRAMS - 32:])  # over 35 grams
    owner = np.repeat(np.arange(len(off) - 1), np.diff(off))
    ok = owner[: len(low)] == owner[LENGTH - 1:]
    windows = np.flatnonzero(ok)
    at = (low[windows] & U64((1 << PLACE) - 1)).astype(np.int64)
    if not len(windows):
        return none, none, none, np.zeros(0, U64), none
    new = np.flatnonzero(np.diff(at, prepend=-1))
    first = windows[new]
    return first, np.diff(np.append(new, len(at))), at[new], g[at[new]], owner[first]


def _keys(bucket: np.ndarray, g: np.ndarray) -> np.ndarray:
    return (bucket.astype(U64) << U64(40)) | (g & U64((1 << 40) - 1))


def _anchor_rows(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in pieces(batches):
            ids = part.column("doc_id").to_numpy()
            *_, g, owner = anchors(texts.data, texts.off)
            bucket = below(g, buckets).astype(np.uint32)
            order = np.lexsort((owner, bucket))
            g, owner, bucket = g[order], owner[order], bucket[order]
            cuts = np.flatnonzero(np.diff(bucket)) + 1
            out = [[], [], [], []]
            for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(g)]):
                if b > a:
                    starts = np.flatnonzero(np.diff(owner[a:b], prepend=-1))
                    out[0].append(int(bucket[a]))
                    out[1].append(ids[owner[a:b][starts]].tobytes())
                    out[2].append(np.diff(np.append(starts, b - a)).astype(np.uint32).tobytes())
                    out[3].append(g[a:b].astype(np.uint32).tobytes() + (g[a:b] >> U64(32)).astype(np.uint8).tobytes())
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int32()), *(pa.array(x, pa.binary()) for x in out[1:])], ["bucket", "docs", "counts", "grams"])

    return run


def _split(values: np.ndarray) -> list[tuple[int, int]]:
    """Bounds of the stretches of equal values."""
    cuts = np.flatnonzero(np.diff(values)) + 1
    return list(zip([0, *cuts.tolist()], [*cuts.tolist(), len(values)])) if len(values) else []


def _part(doc: np.ndarray, parts: int) -> np.ndarray:
    return below(mix(doc.view(U64)), parts).astype(np.int32)


def _code(doc: np.ndarray, key: np.ndarray) -> np.ndarray:
    """One number for a document's anchor; if two ever agree, an anchor too many is sorted, no result changes."""
    return mix(key ^ mix(doc.view(U64)))


def _shared(parts: int):
    def run(table: pa.Table) -> pa.Table:
        """The anchors of this bucket that several documents hold, by the parts of the documents."""
        keys, owners = [], []
        for docs, counts, grams in zip(table["docs"].to_pylist(), table["counts"].to_pylist(), table["grams"].to_pylist()):
            owner = np.repeat(np.frombuffer(docs, np.int64), np.frombuffer(counts, np.uint32))
            n = len(owner)
            keys.append(np.frombuffer(grams, np.uint32, n).astype(U64) | (np.frombuffer(grams, np.uint8, n, 4 * n).astype(U64) << U64(32)))
            owners.append(owner)
        key, owner = np.concatenate(keys), np.concatenate(owners)
        order = np.argsort(key, kind="stable")
        key, owner = key[order], owner[order]
        starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        several = np.minimum.reduceat(owner, starts) != np.maximum.reduceat(owner, starts)
        keep = np.repeat(several, np.diff(np.append(starts, len(key))))
        key, owner = key[keep] | U64(table["bucket"][0].as_py() << 40), owner[keep]
        part, code = _part(owner, parts), _code(owner, key)
        order = np.lexsort((code, part))
        part, code = part[order], code[order]
        runs = _split(part)
        found = [np.unique(code[a:b]) for a, b in runs]
        return pa.table({"part": pa.array([int(part[a]) for a, _ in runs], pa.int32()), "codes": pa.array([x.tobytes() for x in found], pa.binary()), "n": pa.array([len(x) for x in found], pa.int64())})

    return run


def _packed_texts(parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=3)
        for batch, texts in pieces(batches, 8 << 20):
            ids = batch.column("doc_id").to_numpy()
            part = _part(ids, parts)
            order = np.argsort(part, kind="stable")
            size = np.diff(texts.off)
            rows = [(int(part[order[a]]), order[a:b]) for a, b in _split(part[order])]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([p for p, _ in rows], pa.int32()), pa.array([ids[r].tobytes() for _, r in rows], pa.binary()),
                    pa.array([size[r].tobytes() for _, r in rows], pa.binary()),
                    pa.array([packer.compress(b"".join(texts.bytes_of(i) for i in r.tolist())) for _, r in rows], pa.binary()),
                ],
                ["part", "ids", "sizes", "texts"],
            )

    return run


PACKED = "part int, ids binary, sizes binary, texts binary"


def _unpacked(table: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray, Texts]]:
    """doc_id, mark and texts of the rows of a part, a row at a time; the mark is a hash of the text."""
    for ids, sizes, packed in zip(*(table[c] for c in ("ids", "sizes", "texts"))):
        off = np.concatenate([[0], np.cumsum(np.frombuffer(sizes.as_py(), np.int64))])
        data = zstandard.ZstdDecompressor().decompress(packed.as_py(), max_output_size=int(off[-1]) + 1)
        texts = Texts.of(np.frombuffer(data, np.uint8), off)
        mark = span_hash(prefix_sums(texts.data, RAW), off[:-1], off[1:]) if len(data) else np.zeros(len(off) - 1, U64)
        yield np.frombuffer(ids.as_py(), np.int64), signed(mark), texts


def _ragged(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    return np.arange(size.sum()) + np.repeat(first - np.concatenate([[0], np.cumsum(size)[:-1]]), size)


def _span_rows(doc: np.ndarray, mark: np.ndarray, start: np.ndarray, n: np.ndarray, parts: int) -> tuple[list[int], list[bytes]]:
    part = _part(doc, parts)
    order = np.argsort(part, kind="stable")
    runs = [(int(part[order[a]]), order[a:b]) for a, b in _split(part[order])]
    return [p for p, _ in runs], [doc[r].tobytes() + mark[r].tobytes() + start[r].astype(np.int32).tobytes() + n[r].astype(np.int32).tobytes() for _, r in runs]


def _run_rows(anchor_buckets: int, buckets: int, parts: int):
    """Runs of shared anchors with their bytes, by bucket; copies within a part are settled at once (bucket -1)."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        known = np.unique(np.concatenate([np.frombuffer(x, U64) for x in right["codes"].to_pylist()] or [np.zeros(0, U64)]))
        found = [[] for _ in range(7)]
        for ids, marks, texts in _unpacked(left) if len(known) else ():
            first, count, at, g, owner = anchors(texts.data, texts.off)
            code = _code(ids[owner], _keys(below(g, anchor_buckets).astype(np.int64), g))
            place = np.minimum(np.searchsorted(known, code), len(known) - 1)
            keep = known[place] == code
            first, count, at, g, owner = (x[keep] for x in (first, count, at, g, owner))
            if len(first):
                sums = span_hash(prefix_sums(texts.data, RAW), first, first + count + LENGTH - 1) ^ mix((at - first).astype(U64) * U64(BASE))
                values = (ids[owner], marks[owner], first - texts.off[owner], count, at - first, sums ^ mix(g), texts.data[_ragged(first, count + LENGTH - 1)])
                for x, v in zip(found, values):
                    x.append(v)
        out = {c: [] for c in COLUMNS}
        if found[0]:
            doc, mark, place, count, lead, code, data = map(np.concatenate, found)
            begin = np.concatenate([[0], np.cumsum(count + LENGTH - 1)])[:-1]
            order = np.lexsort((doc, code))
            head = np.concatenate([[True], code[order][1:] != code[order][:-1]])
            least = doc[order][np.flatnonzero(head)][np.cumsum(head) - 1]
            copies = order[doc[order] > least]
            for p, spans in zip(*_span_rows(doc[copies], mark[copies], place[copies], count[copies], parts)):
                _append(out, [-1, p, spans])
            sends = order[doc[order] == least]  # the places of the smallest document, all of them
            bucket = below(mix(_gram(data, begin[sends] + lead[sends])), buckets).astype(np.int32)
            order = np.argsort(bucket, kind="stable")
            sends, bucket = sends[order], bucket[order]
            packer = zstandard.ZstdCompressor(level=3)
            for a, b in _split(bucket):
                rows = sends[a:b]
                raw = doc[rows].tobytes() + mark[rows].tobytes() + place[rows].astype(np.int32).tobytes() + count[rows].astype(np.uint8).tobytes() + lead[rows].astype(np.uint8).tobytes()
                _append(out, [int(bucket[a]), len(rows), packer.compress(raw + data[_ragged(begin[rows], count[rows] + LENGTH - 1)].tobytes())])
        return pa.table({"bucket": pa.array(out["bucket"], pa.int32()), "n": pa.array(out["n"], pa.int32()), "data": pa.array(out["data"], pa.binary())})

    return run


COLUMNS = ["bucket", "n", "data"]
RUNS = "bucket int, n int, data binary"


def _append(out: dict[str, list], values: list) -> None:
    for c, v in zip(COLUMNS, values):
        out[c].append(v)


def _gram(data: np.ndarray, pos: np.ndarray) -> np.ndarray:
    """A number for the 16 bytes from each position on."""
    return mix(words_at(data, pos)) + words_at(data, pos + 8)


def words_at(data: np.ndarray, pos: np.ndarray) -> np.ndarray:
    """Eight bytes from each position as a big-endian number."""
    view = np.ndarray((len(data) - 7,), ">u8", data, strides=(1,))
    return view[pos].astype(U64)


def dense_rank(keys: list[np.ndarray]) -> np.ndarray:
    """Rank of each row by its keys, the first one most significant; equal rows share a rank."""
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), bool)
    for k in keys:
        s = k[order]
        new[1:] |= s[1:] != s[:-1]
    rank = np.empty(len(order), np.int64)
    rank[order] = np.cumsum(new)
    return rank


_cover_distance = np.array([min((c - r) % COVER_MOD for c in COVER) for r in range(COVER_MOD)])


def repeated(doc: np.ndarray, count: np.ndarray, lead: np.ndarray, data: np.ndarray) -> np.ndarray:
    """Marks the suffixes of a block (the windows of all runs in turn) that a smaller doc_id holds too."""
    data = np.concatenate([data, np.zeros(8, np.uint8)])
    begin = np.concatenate([[0], np.cumsum(count + LENGTH - 1)])[:-1]
    suffix_run = np.repeat(np.arange(len(count)), count)
    nth = np.arange(len(suffix_run)) - np.repeat(np.concatenate([[0], np.cumsum(count)[:-1]]), count)
    pos = begin[suffix_run] + nth
    residue = (nth - lead[suffix_run]) % COVER_MOD
    # ranks of the suffixes on the cover
    size = count + LENGTH - 1
    run = np.repeat(np.arange(len(count)), size)
    inner = np.arange(len(run)) - np.repeat(begin, size)
    on = np.isin((inner - lead[run]) % COVER_MOD, COVER) & (inner + RANKED <= size[run])
    cover = np.flatnonzero(on)
    last = (words_at(data, cover + 32) >> U64(48))
    ranks = np.zeros(len(run), np.int64)
    ranks[cover] = dense_rank([*(words_at(data, cover + 8 * j) for j in range(4)), last])
    ahead = pos + _cover_distance[residue]
    keys = [words_at(data, pos), words_at(data, pos + 8), residue, ranks[ahead], words_at(data, pos + LENGTH - TAIL), words_at(data, pos + LENGTH - 8)]
    rank = dense_rank(keys)
    least = np.full(rank.max() + 1, np.iinfo(np.int64).max)
    np.minimum.at(least, rank, doc[suffix_run])
    return doc[suffix_run] > least[rank]


def _sorted_block(parts: int):
    def run(table: pa.Table) -> pa.Table:
        """Repeated windows of one bucket as spans, packed by the parts of their documents."""
        if table["bucket"][0].as_py() < 0:
            return pa.table({"part": table["n"], "spans": table["data"]})
        docs, marks, places, counts, leads, data = [], [], [], [], [], []
        for n, packed in zip(table["n"].to_pylist(), table["data"]):
            raw = zstandard.ZstdDecompressor().decompress(packed.as_py())
            docs.append(np.frombuffer(raw, np.int64, n))
            marks.append(np.frombuffer(raw, np.int64, n, 8 * n))
            places.append(np.frombuffer(raw, np.int32, n, 16 * n))
            counts.append(np.frombuffer(raw, np.uint8, n, 20 * n))
            leads.append(np.frombuffer(raw, np.uint8, n, 21 * n))
            data.append(np.frombuffer(raw, np.uint8, -1, 22 * n))
        doc, mark, place, count, lead = map(np.concatenate, (docs, marks, places, counts, leads))
        count = count.astype(np.int64)
        hit = repeated(doc, count, lead.astype(np.int64), np.concatenate(data))
        run = np.repeat(np.arange(len(count)), count)
        nth = np.arange(len(run)) - np.repeat(np.concatenate([[0], np.cumsum(count)[:-1]]), count)
        at = np.flatnonzero(hit)
        new = np.flatnonzero(np.concatenate([[True], (np.diff(at) != 1) | (run[at][1:] != run[at][:-1])])) if len(at) else at
        lengths = np.diff(np.append(new, len(at)))
        at = at[new]
        part, spans = _span_rows(doc[run[at]], mark[run[at]], place[run[at]] + nth[at], lengths, parts)
        return pa.table({"part": pa.array(part, pa.int32()), "spans": pa.array(spans, pa.binary())})

    return run


OUT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _kept(raw: np.ndarray, start: np.ndarray, n: np.ndarray) -> tuple[int, int, int, str]:
    edge = np.zeros(len(raw) + 1, np.int32)
    np.add.at(edge, start, 1)
    np.add.at(edge, start + n + LENGTH - 1, -1)
    covered = np.cumsum(edge)[:-1] > 0
    runs = int(np.count_nonzero(covered[1:] & ~covered[:-1])) + int(len(raw) > 0 and covered[0])
    return len(raw), int(covered.sum()), runs, hashlib.sha256(raw[~covered].tobytes()).hexdigest()


def _cut(left: pa.Table, right: pa.Table) -> pa.Table:
    doc, mark, start, n = [], [], [], []
    for raw in right["spans"].to_pylist():
        k = len(raw) // 24
        doc.append(np.frombuffer(raw, np.int64, k))
        mark.append(np.frombuffer(raw, np.int64, k, 8 * k))
        start.append(np.frombuffer(raw, np.int32, k, 16 * k))
        n.append(np.frombuffer(raw, np.int32, k, 20 * k))
    doc, mark, start, n = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (doc, mark, start, n))
    order = np.lexsort((mark, doc))
    doc, mark, start, n = doc[order], mark[order], start[order], n[order]
    ids, rows = [], []
    for own, marks, texts in _unpacked(left):
        ids.append(own)
        low, high = np.searchsorted(doc, own), np.searchsorted(doc, own, "right")
        for i, (a, b) in enumerate(zip(low.tolist(), high.tolist())):
            mine = slice(a + int(np.searchsorted(mark[a:b], marks[i])), a + int(np.searchsorted(mark[a:b], marks[i], "right")))
            rows.append(_kept(texts.data[texts.off[i]: texts.off[i + 1]], start[mine], n[mine]))
    size, removed, spans, sha = zip(*rows) if rows else ((), (), (), ())
    return pa.table({
        "doc_id": np.concatenate(ids) if ids else np.zeros(0, np.int64), "n_bytes": pa.array(size, pa.int64()), "n_removed": pa.array(removed, pa.int64()),
        "n_spans": pa.array(spans, pa.int64()), "kept_sha256": pa.array(sha, pa.string()),
    })


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 for every row of docs (doc_id, text).

    Null texts are empty. Texts below 50 bytes keep all. A row without doc_id
    keeps all and is no source for others; rows that repeat a doc_id are the
    same document and do not remove from each other. Other columns are ignored.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    named = docs.where("doc_id IS NOT NULL")
    total = named.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    first, parts = max(12, total // 18 // ANCHOR_ROWS), max(12, total // PART_BYTES)
    rows = named.mapInArrow(_anchor_rows(first), "bucket int, docs binary, counts binary, grams binary")
    shared = rows.repartition(first, "bucket").groupBy("bucket").applyInArrow(_shared(parts), "part int, codes binary, n long")
    shared = settle(shared, "anchors")
    second = max(12, (shared.agg(F.sum("n")).first()[0] or 0) // RUN_ROWS)
    packed = named.mapInArrow(_packed_texts(parts), PACKED).repartition(parts, "part").groupBy("part")
    runs = packed.cogroup(shared.repartition(parts, "part").groupBy("part")).applyInArrow(_run_rows(first, second, parts), RUNS)
    salt = F.when(F.col("bucket") < 0, F.col("n")).otherwise(0)  # settled copies need no bucket of their own
    runs = runs.withColumn("salt", salt).repartition(second, "bucket", "salt").groupBy("bucket", "salt")
    spans = runs.applyInArrow(_sorted_block(parts), "part int, spans binary")
    cut = packed.cogroup(spans.repartition(parts, "part").groupBy("part")).applyInArrow(_cut, OUT)
    whole = docs.where("doc_id IS NULL").select("doc_id", F.octet_length("text").cast("long"), F.lit(0).cast("long"), F.lit(0).cast("long"), F.sha2(F.col("text").cast("binary"), 256))
    return cut.union(whole)
