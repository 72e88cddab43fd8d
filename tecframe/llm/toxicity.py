"""Toxicity scores from a convolutional text classifier over hashed word embeddings.

A word's vector is the mean of the embeddings of its hashed features (the word
and its byte n-grams). Filters of widths one to three slide over the words of a
text, each keeps its largest response, and a linear layer makes a logit of
them. Training sees all labelled rows, in parts of about PART_ROWS by hash of
doc_id. Counts of features and of words by language are summed over all parts;
from them every part starts alike and fits its rows with Adagrad in plain numpy,
and the weights of the parts are averaged. Sums and averages are aggregates by
pieces of the arrays; only tables of fixed size (by language) return.

Thresholds are calibrated by language on the rows that parts leave out of the
fitting, from counts of their logits by class. The language of a text is guessed
from the text itself, by a table of hashed words that the same rows fill;
neither label, lang, source nor doc_id reaches a score. The score is the logit moved by the threshold of that language and
squashed, so that 0.5 is the decision for every language.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

from tecframe.llm.graphs import settle
from tecframe.llm.tokens import BASE, BYTES, FOLD, INVERSE, U64, Texts, below, mix, pieces, powers, prefix_sums, span_hash

PART_ROWS, PART_DOCS = 4000, 20_000  # labelled rows that one task fits, and documents that it finds them among
CHUNK = 8192  # values of an array that are summed in one group
BINS, SPAN = 4096, 16.0  # of the counts of logits, from -SPAN to SPAN
BUCKETS = 1 << 17
WIDTH, FILTERS, SPANS = 8, 6, (1, 2, 3)
GRAMS = (3, 4, 5, 6)
EPOCHS, STEP, ROWS = 4, 0.15, 64
LANG_BUCKETS = 1 << 15


class Words:
    """Distinct words of a piece, their hashed features, and the sequence of words."""

    def __init__(self, texts: Texts) -> None:
        starts, ends, self.woff = texts.word_spans()
        h = span_hash(prefix_sums(texts.data, BYTES), starts, ends)
        self.hash, first, self.seq = np.unique(h, return_index=True, return_inverse=True)
        starts, length = starts[first], (ends - starts)[first]
        # the distinct words side by side, each between two marks
        off = np.concatenate([[0], np.cumsum(length + 2)])
        data = np.full(off[-1], 1, np.uint8)
        at = np.arange(length.sum()) + np.repeat(off[:-1] + 1 - np.concatenate([[0], np.cumsum(length)[:-1]]), length)
        source = np.arange(length.sum()) + np.repeat(starts - np.concatenate([[0], np.cumsum(length)[:-1]]), length)
        data[at] = FOLD[texts.data[source]]
        sums = np.zeros(len(data) + 1, U64)
        np.cumsum((BYTES[data] + U64(1)) * powers(len(data), BASE), out=sums[1:])
        size = length + 2
        self.features = [(np.arange(len(length)), np.arange(len(length)), below(mix(self.hash ^ U64(5)), BUCKETS).astype(np.int32))]
        for n in GRAMS:
            each = np.maximum(size - n + 1, 0)
            owner = np.flatnonzero(each)
            begin = np.concatenate([[0], np.cumsum(each[owner])])
            if not begin[-1]:
                continue
            pos = np.arange(begin[-1]) + np.repeat(off[:-1][owner] - begin[:-1], each[owner])
            g = mix((sums[pos + n] - sums[pos]) * powers(len(sums), INVERSE)[pos] + U64(n))
            self.features.append((owner, begin[:-1], below(g, BUCKETS).astype(np.int32)))
        self.count = np.ones(len(length), np.float32)
        for n in GRAMS:
            self.count += np.maximum(size - n + 1, 0)

    def vectors(self, table: np.ndarray) -> np.ndarray:
        out = np.zeros((len(self.hash), table.shape[1]), np.float32)
        for owner, begin, bucket in self.features:
            if len(owner):
                out[owner] += np.add.reduceat(table[bucket], begin, axis=0)
        return out / self.count[:, None]

    def spread(self, table: np.ndarray, word: np.ndarray, grad: np.ndarray) -> None:
        """Adds the gradients of words to the gradients of their features."""
        total = np.zeros((len(self.hash), grad.shape[1]), np.float32)
        np.add.at(total, word, grad)
        used = np.zeros(len(self.hash), bool)
        used[word] = True
        total /= self.count[:, None]
        for owner, begin, bucket in self.features:
            length = np.diff(np.append(begin, len(bucket)))
            keep = used[owner]
            rows = np.repeat(keep, length)
            np.add.at(table, bucket[rows], np.repeat(total[owner[keep]], length[keep], axis=0))


def responses(w: Words, vectors: np.ndarray, filters: list[np.ndarray], where: bool = False):
    """Largest response of each filter for each text (0 where none is positive), and its first word."""
    n = len(w.woff) - 1
    best = np.zeros((n, FILTERS * len(filters)), np.float32)
    place = np.full(best.shape, -1, np.int64)
    count = np.diff(w.woff)
    for k, weights in enumerate(filters):
        span = len(weights)
        owner = np.flatnonzero(count >= span)
        if not len(owner):
            continue
        last = len(w.seq) - span + 1
        r = sum((vectors @ weights[j])[w.seq[j: j + last]] for j in range(span))
        # windows that run over the end of a text do not count
        over = (w.woff[1:-1, None] - np.arange(1, span)[None, :]).ravel()
        r[over[(over >= 0) & (over < last)]] = -1.0
        cut = np.minimum(w.woff[owner], last - 1)
        cols = slice(k * FILTERS, (k + 1) * FILTERS)
        top = np.maximum.reduceat(r, cut, axis=0)
        best[owner, cols] = np.maximum(top, 0)
        if where:
            for i, a, b in zip(owner.tolist(), w.woff[owner].tolist(), (w.woff[1:][owner] - span + 1).tolist()):
                arg = r[a:b].argmax(axis=0) + a
                place[i, cols] = np.where(best[i, cols] > 0, arg, -1)
    return best, place


def _languages(w: Words, table: np.ndarray) -> np.ndarray:
    """Row of the language table that fits each text best."""
    n = len(w.woff) - 1
    if not len(table) or not len(w.seq):
        return np.zeros(n, np.int64)
    bucket = below(mix(w.hash ^ U64(9)), LANG_BUCKETS).astype(np.int64)
    best, row = np.full(n, -np.inf), np.zeros(n, np.int64)
    for first in range(0, len(table), 64):  # memory of 64 languages at a time
        per_word = table[first: first + 64, bucket].T
        sums = np.concatenate([np.zeros((1, per_word.shape[1])), np.cumsum(per_word[w.seq], axis=0, dtype=np.float64)])
        fits = sums[w.woff[1:]] - sums[w.woff[:-1]]
        top = fits.max(axis=1)
        row = np.where(top > best, fits.argmax(axis=1) + first, row)
        best = np.maximum(best, top)
    return row


Batch = tuple[Words, np.ndarray, list]


def _split(rows: list[dict], seed: int = 7) -> tuple[list[list[dict]], list[list[dict]]]:
    """Batches to fit on and batches to calibrate on; a single batch serves for both."""
    rows = sorted(rows, key=lambda r: (r["text"] or "", r["toxic"], r["lang"] or ""))
    order = np.random.default_rng(seed).permutation(len(rows))
    out = [[rows[i] for i in order[a: a + ROWS]] for a in range(0, len(order), ROWS)]
    held = max(1, len(out) // 5) if len(out) > 1 else 0
    return out[held:], out[:held] or out


def _batch(rows: list[dict]) -> Batch:
    return Words(Texts(pa.array([r["text"] for r in rows], pa.string()))), np.array([r["toxic"] for r in rows], np.float32), [r["lang"] for r in rows]


def _buckets(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """(text, bucket) of the distinct features of each text."""
    n = len(w.hash)
    both = np.unique(np.repeat(np.arange(len(w.woff) - 1), np.diff(w.woff)) * max(n, 1) + w.seq)
    text, word = both // max(n, 1), both % max(n, 1)
    found = [np.zeros(0, np.int64)]
    for owner, begin, bucket in w.features:
        place = np.full(n, -1)
        place[owner] = np.arange(len(owner))
        at = place[word]
        mine, at = text[at >= 0], at[at >= 0]
        size = np.diff(np.append(begin, len(bucket)))[at]
        pos = np.arange(size.sum()) + np.repeat(begin[at] - (np.cumsum(size) - size), size)
        found.append(np.repeat(mine, size) * BUCKETS + bucket[pos])
    both = np.unique(np.concatenate(found))
    return both // BUCKETS, both % BUCKETS


def _count(rows: list[dict]) -> Iterator[tuple[str, np.ndarray]]:
    """Texts by class, features by class of the texts to fit on, words by language."""
    train, check = _split(rows)
    seen, totals, langs = np.zeros((2, BUCKETS)), np.zeros(4), {}
    for batch in train if check is train else train + check:
        w, y, ls = _batch(batch)
        bucket = below(mix(w.hash ^ U64(9)), LANG_BUCKETS).astype(np.int64)[w.seq]
        for i, name in enumerate(ls):
            if name is not None:
                np.add.at(langs.setdefault(name, np.zeros(LANG_BUCKETS)), bucket[w.woff[i]: w.woff[i + 1]], 1.0)
        by_class = np.array([float((y == 0).sum()), float((y == 1).sum())])
        totals[2:] += by_class
        if any(batch is x for x in train):
            totals[:2] += by_class
            text, found = _buckets(w)
            for c in (0, 1):
                seen[c] += np.bincount(found[y[text] == c], minlength=BUCKETS)
    yield "totals", totals
    yield "seen", seen.ravel()
    yield from ((f"lang {name}", x) for name, x in langs.items())


def start(counts: dict[str, np.ndarray], seed: int = 7) -> dict:
    """Weights before training and the language table, from the counts of all labelled rows."""
    rng = np.random.default_rng(seed)
    model = {
        "table": rng.normal(0, 0.05, (BUCKETS, WIDTH)).astype(np.float32),
        "filters": [rng.normal(0, 0.3, (s, WIDTH, FILTERS)).astype(np.float32) for s in SPANS],
        "out": np.full(FILTERS * len(SPANS), 0.5, np.float32), "bias": np.float32(-2.0),
        "lang": np.zeros((0, LANG_BUCKETS), np.float32), "names": [], "shift": np.zeros(1, np.float32),
    }
    totals = counts.get("totals", np.zeros(4))
    if not totals[2] or not totals[3]:
        model["bias"] = np.float32(4.0 if totals[3] else -4.0)
        model["out"][:] = 0
        return model
    names = sorted(x[5:] for x in counts if x.startswith("lang "))
    if names:
        words = np.stack([counts[f"lang {x}"] for x in names]) + 0.1
        model["lang"], model["names"] = np.log(words / words.sum(axis=1, keepdims=True)).astype(np.float32), names
    # the first dimension starts as the log odds of a bucket to occur in toxic texts
    seen = counts["seen"].reshape(2, BUCKETS)
    odds = np.log((seen[1] + 0.5) / (totals[1] + 1)) - np.log((seen[0] + 0.5) / (totals[0] + 1))
    model["table"][:, 0] = np.where(seen.sum(axis=0) >= 3, odds, 0.0)
    for f in model["filters"]:
        f[:, 0, :3] = rng.uniform(0.3, 0.7, f[:, 0, :3].shape)
    model["rate"] = float(totals[3] / (totals[2] + totals[3]))
    return model


def fit(rows: list[dict], model: dict, seed: int = 7) -> dict:
    """Weights after training on the rows of a part."""
    rng = np.random.default_rng(seed)
    train = [_batch(x) for x in _split(rows)[0]]
    model = {**model, "table": model["table"].copy(), "out": model["out"].copy(), "filters": [f.copy() for f in model["filters"]]}
    rate = model["rate"]
    squares = {k: np.zeros_like(model[k]) for k in ("table", "out")} | {"filters": [np.zeros_like(f) for f in model["filters"]], "bias": 0.0}
    for epoch in range(EPOCHS):
        for k in rng.permutation(len(train)):
            w, y, _ = train[k]
            v = w.vectors(model["table"])
            best, place = responses(w, v, model["filters"], where=True)
            p = 1 / (1 + np.exp(-np.clip(best @ model["out"] + model["bias"], -30, 30)))
            d = (p - y) / len(y) * np.where(y == 1, 0.5 / rate, 0.5 / (1 - rate)).astype(np.float32)
            g_out, g_bias = best.T @ d, d.sum()
            g_best = d[:, None] * model["out"][None, :]
            g_table = np.zeros_like(model["table"])
            for s, f in enumerate(model["filters"]):
                cols = slice(s * FILTERS, (s + 1) * FILTERS)
                row, col = np.nonzero(place[:, cols] >= 0)
                at, g = place[:, cols][row, col], g_best[:, cols][row, col]
                g_filter = np.zeros_like(f)
                for j in range(len(f)):
                    word = w.seq[at + j]
                    np.add.at(g_filter[j].T, col, g[:, None] * v[word])
                    w.spread(g_table, word, g[:, None] * f[j].T[col])
                squares["filters"][s] += g_filter**2
                f -= 0.3 * STEP * g_filter / np.sqrt(squares["filters"][s] + 1e-8)
            hit = np.flatnonzero(g_table.any(axis=1))
            squares["table"][hit] += g_table[hit] ** 2
            model["table"][hit] -= STEP * g_table[hit] / np.sqrt(squares["table"][hit] + 1e-8)
            squares["out"] += g_out**2
            model["out"] -= 0.3 * STEP * g_out / np.sqrt(squares["out"] + 1e-8)
            squares["bias"] += g_bias**2
            model["bias"] = np.float32(model["bias"] - STEP * g_bias / np.sqrt(squares["bias"] + 1e-8))
    return model


def _fitted(rows: list[dict], model: dict) -> Iterator[tuple[str, np.ndarray]]:
    mine = fit(rows, model)
    yield "parts", np.ones(1)
    # what did not move is zero, and cheap to send
    yield from ((name, (mine[name] - model[name]).ravel()) for name in ("table", "out"))
    yield "bias", np.array([mine["bias"] - model["bias"]])
    yield from ((f"filter {i}", (f - g).ravel()) for i, (f, g) in enumerate(zip(mine["filters"], model["filters"])))


def moved(model: dict, total: dict[str, np.ndarray]) -> dict:
    """The model with the mean of what the parts changed."""
    step = lambda name, like: (like + (total[name] / total["parts"][0]).reshape(np.shape(like))).astype(np.float32)
    return {
        **model, "table": step("table", model["table"]), "out": step("out", model["out"]), "bias": step("bias", np.array([model["bias"]]))[0],
        "filters": [step(f"filter {i}", f) for i, f in enumerate(model["filters"])],
    }


def _logits(rows: list[dict], model: dict) -> Iterator[tuple[str, np.ndarray]]:
    """Counts of the logits of rows left out, by language, class and bin."""
    counts: dict[int, np.ndarray] = {}
    for w, y, _ in map(_batch, _split(rows)[1]):
        best, _ = responses(w, w.vectors(model["table"]), model["filters"])
        logit = best @ model["out"] + model["bias"]
        at = np.clip((logit + SPAN) * (BINS / (2 * SPAN)), 0, BINS - 1).astype(np.int64)
        group = _languages(w, model["lang"])
        for i in np.unique(group).tolist():
            counts[i] = counts.get(i, 0) + np.bincount(at[group == i] + BINS * (y[group == i] == 1), minlength=2 * BINS).astype(np.float64)
    yield from ((str(i), x) for i, x in counts.items())


def _threshold(counts: np.ndarray, default: float) -> float:
    """The cut with the best F1, halfway between neighbours; the default where too few rows tell."""
    bad, good = counts.reshape(2, BINS)
    if good.sum() < 5 or bad.sum() < 5:
        return default
    bins = np.flatnonzero(good + bad)[::-1]
    f1 = 2 * np.cumsum(good[bins]) / (np.cumsum((good + bad)[bins]) + good.sum())
    k = int(f1.argmax())
    value = (bins + 0.5) * (2 * SPAN / BINS) - SPAN
    return float((value[k] + (value[k + 1] if k + 1 < len(bins) else value[k] - 1)) / 2)


def _pack(texts: pa.Table, marks: pa.Table) -> pa.Table:
    """The labelled rows of a part as one value, which later passes read as it is."""
    at = pc.index_in(texts["doc_id"], marks["doc_id"].combine_chunks())
    known = pc.is_valid(at)
    rows = texts.filter(known).select(["text", "lang"]).append_column("toxic", marks["toxic"].take(at.filter(known)))
    if not rows.num_rows:
        return pa.table({"rows": pa.array([], pa.binary())})
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema) as out:
        out.write_table(rows)
    return pa.table({"rows": pa.array([zstandard.ZstdCompressor(level=1).compress(sink.getvalue().to_pybytes())], pa.binary())})


def _add(table: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(zstandard.ZstdDecompressor().decompress(x.as_py())) for x in table["data"])
    return pa.table({"name": table["name"][:1], "chunk": table["chunk"][:1], "data": pa.array([total.tobytes()], pa.binary())})


def summed(parts: DataFrame, work) -> dict[str, np.ndarray]:
    """Sums over all parts of the arrays that `work` gives for the rows of one."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for raw in b.column("rows"):
                rows = pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(raw.as_py())).read_all().to_pylist()
                for name, x in work(rows):
                    x = x.astype(np.float64)
                    cut = [zstandard.ZstdCompressor(level=1).compress(x[a: a + CHUNK].tobytes()) for a in range(0, len(x), CHUNK)]
                    yield pa.RecordBatch.from_arrays([pa.array([name] * len(cut)), pa.array(range(len(cut)), pa.int32()), pa.array(cut, pa.binary())], ["name", "chunk", "data"])

    schema = "name string, chunk int, data binary"
    got: dict[str, dict[int, bytes]] = {}
    for r in parts.mapInArrow(run, schema).groupBy("name", "chunk").applyInArrow(_add, schema).toLocalIterator():
        got.setdefault(r.name, {})[r.chunk] = bytes(r.data)
    return {name: np.concatenate([np.frombuffer(x[i]) for i in range(len(x))]) for name, x in got.items()}


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds == fold, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, part_rows: int = PART_ROWS) -> dict:
    """Fits on all labelled rows outside the held-out fold, in parts of about `part_rows`."""
    marks = labels.where("toxic in (0, 1)").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    marks = marks.where(~held_out(F.col("doc_id"), 5, 0)).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    n = max(1, -(-marks.count() // part_rows), -(-docs.count() // PART_DOCS))
    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    # texts move once: they meet their labels part by part
    part = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(n)).alias("part")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", lang.alias("lang")).where("doc_id IS NOT NULL").select("*", part)
    met = texts.repartition(n, "part").groupBy("part").cogroup(marks.select("*", part).repartition(n, "part").groupBy("part"))
    parts = settle(met.applyInArrow(lambda left, right: _pack(left, right), "rows binary"), "labelled")
    context = docs.sparkSession.sparkContext
    model = start(summed(parts, _count))
    if "rate" not in model:
        return model
    sent = context.broadcast(model)
    model = moved(model, summed(parts, lambda rows: _fitted(rows, sent.value)))
    sent = context.broadcast(model)
    counts = summed(parts, lambda rows: _logits(rows, sent.value))
    overall = _threshold(sum(counts.values()), 0.0)
    none = np.zeros(2 * BINS)
    shift = [_threshold(counts.get(str(i), none), overall) for i in range(max(1, len(model["names"])))]
    return {**model, "shift": np.array(shift, np.float32)}


def score_texts(texts: Texts, model: dict) -> np.ndarray:
    w = Words(texts)
    if not len(w.seq):
        logit = np.full(len(texts), model["bias"], np.float64)
    else:
        best, _ = responses(w, w.vectors(model["table"]), model["filters"])
        logit = (best @ model["out"] + model["bias"]).astype(np.float64)
    shift = model["shift"][np.minimum(_languages(w, model["lang"]), len(model["shift"]) - 1)]
    return 1 / (1 + np.exp(-np.clip(logit - shift, -30, 30)))


def toxicity(docs: DataFrame, labels: DataFrame, part_rows: int = PART_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of docs (doc_id, text, lang).

    Null and empty texts get the score of a text without words. A null doc_id
    is in no fold. Labels that repeat count once, as toxic if any says so; a
    table without labels gives the score of the bias. Other columns are ignored.
    """
    weights = docs.sparkSession.sparkContext.broadcast(train(docs, labels, part_rows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in pieces(batches):
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(score_texts(texts, weights.value))], ["doc_id", "score"])

    scored = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id"), 5, 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
