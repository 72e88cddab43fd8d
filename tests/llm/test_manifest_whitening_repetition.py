"""Merkle manifest, whitening and repetition rules against plain statements of them."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOC = "doc_id long, source string, lang string, n_chars long, text string, h string, s long, idx long, path string, part long, spans string"
EXTRA = ("x", 7, 7, "y", 7, "z")


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def tree(nodes, arity):
    """Root, and per node its siblings on every level as (before, after)."""
    paths, place = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[i: i + arity] for i in range(0, len(nodes), arity)]
        for i, p in enumerate(place):
            run, slot = runs[p // arity], p % arity
            paths[i].append((run[:slot], run[slot + 1:]))
        place = [p // arity for p in place]
        nodes = [H(*r) for r in runs]
    return nodes[0], paths


def plain_manifest(rows, arity):
    enc = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    sources = defaultdict(list)
    for i, source, lang, n, text in rows:
        leaf = H(*map(enc, (i, source, lang, n, text)))
        cut = i is not None and zlib.crc32(str(i).encode()) % 2 == 0 and text is not None
        given = H(*map(enc, (i, source, lang, n, text.replace("\n", "")))) if cut else leaf
        sources[source].append(((i is not None, i or 0, leaf), i, leaf, given))
    order = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: tree([r[2] for r in sorted(sources[s])], arity) for s in order}
    root, upper = tree([trees[s][0] for s in order], arity)
    out = []
    for s, top in zip(order, upper):
        for (_, i, leaf, given), path in zip(sorted(sources[s]), trees[s][1]):
            at = given
            for before, after in [*path, *top]:
                at = H(*before, at, *after)
            proof = H(*(x for before, after in [*path, *top] for x in [*before, *after]))
            out.append((i, leaf, trees[s][0], root, proof, at, at == root))
    return sorted(out, key=str)


ROWS = (
    [(i, "big", "en", i % 7, f"line {i}\nnext é") for i in range(60)]
    + [(5, "big", "en", 5, "line 5\nnext é"), (5, "big", None, 5, "other\n")]
    + [(100 + i, f"s{i % 4}", None, None, f"t\n{i}") for i in range(10)]
    + [(-3, None, "de", 1, None), (201, None, "de", None, ""), (None, "big", None, None, "no id\n"), (300, "", "fr", 2, "\n\n"), (301, "lone", "fr", 2, "x" * 100_000)]
)


@pytest.mark.parametrize("arity", [3, 2])
def test_manifest_equals_trees_built_one_by_one(spark, arity):
    from tecframe.llm.merkle import manifest

    docs = spark.createDataFrame([(*r, *EXTRA) for r in ROWS], DOC).repartition(7)
    got = sorted((tuple(r) for r in manifest(docs, arity).collect()), key=str)
    assert got == plain_manifest(ROWS, arity)
    assert {r[-1] for r in got} == {True, False}


def test_manifest_of_one_leaf_one_source_and_nothing(spark):
    from tecframe.llm.merkle import manifest

    for rows in ([(1, "a", None, None, None)], [(i, "a", None, None, "q") for i in range(9)], [(i, f"{i}", None, None, "q") for i in range(10)]):
        got = manifest(spark.createDataFrame([(*r, *EXTRA) for r in rows], DOC))
        assert sorted((tuple(r) for r in got.collect()), key=str) == plain_manifest(rows, 3)
    assert manifest(spark.createDataFrame([], DOC)).collect() == []


def test_one_source_is_spread_over_tasks(spark):
    from tecframe.llm.merkle import placed

    rows = spark.range(40_000).select(F.lit("hot").alias("src"), "id")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        dealt, stretches = placed(rows, ["src"], ["id"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert dealt.groupBy("part").count().agg(F.max("count")).first()[0] < 8_000
    place = dealt.join(stretches, ["src", "part"]).select("id", (F.col("at") - F.col("first") + F.col("before")).alias("place"))
    assert place.where("place <> id").count() == 0


def plain_repetition(text, m):
    w = WORD.findall(text or "")
    n, seen, dup = len(w), set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)

    def covered(m):
        c = Counter(tuple(w[i: i + m]) for i in range(n - m + 1))
        return {j for i in range(n - m + 1) if c[tuple(w[i: i + m])] > 1 for j in range(i, i + m)}

    longest, maximal = 0, 0
    for size in range(m, n):
        places = defaultdict(list)
        for i in range(n - size + 1):
            places[tuple(w[i: i + size])].append(i)
        several = [p for p in places.values() if len(p) > 1]
        if not several:
            break
        longest = size
        for p in several:
            after, before = {w[i + size] if i + size < n else i for i in p}, {w[i - 1] if i else -1 for i in p}
            maximal += len(after) > 1 and len(before) > 1
    spans = []
    for x in sorted(covered(m)):
        if spans and sum(spans[-1]) == x:
            spans[-1][1] += 1
        else:
            spans.append([x, 1])
    letters = sum(len(w[i]) for i in covered(m))
    return n, sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(covered(8)), letters, longest, maximal, [tuple(s) for s in spans]


def odd_texts():
    rng = np.random.default_rng(5)
    texts = [None, "", " \n\t", "one", "a " * 40, "\n".join(["x y z"] * 9), "a b c d " * 12, "É é É é\n" * 10]
    for vocabulary in (1, 2, 3, 6, 60):
        for _ in range(25):
            words = [f"w{v}é"[: 2 + v % 2] + "#" * (v % 3 == 0) for v in rng.integers(0, vocabulary, rng.integers(0, 70)).tolist()]
            texts.append("".join(w + str(rng.choice([" ", "\n", "  ", "\r\n"])) for w in words))
    block = " ".join(f"u{i}" for i in range(60))
    texts += [block + " mid dle " + block, block + " " + " ".join(f"v{i}" for i in range(300)) + " " + block, " ".join(f"v{i}" for i in range(400))]
    return texts


@pytest.mark.parametrize("shortest", [1, 4, 8, 11])
def test_repetition_equals_counting_all_substrings(spark, shortest):
    from tecframe.llm.repetition import repetition

    texts = odd_texts()
    rows = [(i if i % 9 else None, None, None, None, t, *EXTRA) for i, t in enumerate(texts)] + [(3, None, None, None, texts[40], *EXTRA)]
    got = [(r[0], *r[1:-1], [tuple(s) for s in r.spans]) for r in repetition(spark.createDataFrame(rows, DOC).repartition(3), shortest).collect()]
    assert sorted(got, key=str) == sorted(((r[0], *plain_repetition(r[4], shortest)) for r in rows), key=str)


def test_repetition_of_very_long_texts():
    from tecframe.llm.repetition import Passages
    from tecframe.llm.tokens import mix

    one = mix(np.arange(70_000, dtype=np.uint64))
    words = np.concatenate([one, one[:50_000], np.repeat(one[:1], 60_000)])
    found = Passages(words, np.array([0, 120_000, 180_000]), 8)
    assert found.longest.tolist() == [50_000, 59_999]
    assert found.repeats.tolist() == [1, 59_999 - 7]
    assert found.covered(8).sum() == 100_000 + 60_000


def test_quality_verdicts(spark):
    from tecframe.llm.queries import QUERIES
    from tecframe.llm.repetition import quality

    block = " ".join(f"u{i}" for i in range(60))
    other = lambda k, n: " ".join(f"{k}{i}" for i in range(n))
    texts = {
        1: other("a", 200), 2: other("a", 10), 3: block + " " + block, 4: None,
        5: " ".join([other("b", 200), block, other("c", 200), block]),  # 120 of 520 words, but a passage of 60
        6: " ".join([other("b", 200), other("r", 12), other("c", 50), other("r", 12)]),
    }
    docs = spark.createDataFrame([(i, None, None, None, t, *EXTRA) for i, t in texts.items()], DOC)
    got = {r.doc_id: (r.base_failed, r.kept) for r in quality(docs).collect()}
    assert got == {1: (False, True), 2: (True, False), 3: (True, False), 4: (True, False), 5: (False, False), 6: (False, True)}
    assert quality(docs.limit(0)).collect() == []
    given = QUERIES["op13_suffix_repetition"](spark, "/root/testdata/sf0.001").collect()
    plain = {r.doc_id: plain_repetition(r.text, 8) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    for r in given:
        n, chars, symbols, lines, repeat, covered, longest, *_ = plain[r.doc_id]
        failed = n < 20 or 100 * repeat > 30 * n
        assert tuple(r)[:6] == (r.doc_id, n, chars, symbols, lines, repeat) and r.base_failed == failed
        assert r.kept == (not failed and 100 * covered <= 30 * chars and longest <= 50)


def plain_whitening(vectors):
    x = np.floor(64 * np.array(vectors, float)).astype(np.int64) + 1_000_000
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(0)
    c = (fit - s // n) - (s % n) / n
    e, u = np.linalg.eigh(c.T @ c / n)
    e, u = e[::-1][:16], u[:, ::-1][:, :16]
    z = (((x - s // n) - (s % n) / n) @ u) / np.sqrt(np.maximum(e, 1e-30))
    return n, ((n * x - s) ** 2).sum(1), z, e / np.trace(c.T @ c / n)


VECTORS = "vec_id long, embedding array<float>, label int, x string, d int, n long, part long"


def whitened(spark, rows):
    from tecframe.llm.whitening import whiten

    return whiten(spark.createDataFrame([(i, v, 0, "x", 1, 2, 3) for i, v in rows], VECTORS).repartition(6)).collect()


@pytest.mark.parametrize("d", [1, 5, 24, 64])
def test_whitening_equals_the_full_decomposition(spark, d):
    rng = np.random.default_rng(d)
    values = (rng.standard_normal((300, d)) * np.linspace(0.3, 2, d)).astype(np.float32)
    rows = [(i, v) for i, v in enumerate(values.tolist())]
    rows += [(1000 + i, values[0].tolist()) for i in range(150)]  # copies count once
    odd = [(2000, None), (2001, [None] + values[1][1:].tolist()), (2002, [float("nan")] * d), (2003, [float("inf")] * d), (2004, []), (2005, [0.5] * (d + 1))]
    got = whitened(spark, rows + odd)
    n, deviation, z, share = plain_whitening([v for _, v in rows])
    k = min(16, d)
    assert sorted({r.vec_id for r in got}) == [i for i, _ in rows] and len(got) == k * len(rows)
    by = {(r.vec_id, r.component): r for r in got}
    mine = np.array([[by[i, j + 1].whitened for j in range(k)] for i, _ in rows])
    assert np.abs(mine * np.sign((mine * z[:, :k]).sum(0)) - z[:, :k]).max() < 1e-9
    assert [by[i, 1].deviation for i, _ in rows] == deviation.tolist() and {r.n for r in got} == {n}
    assert np.allclose([by[0, j + 1].explained for j in range(k)], share[:k], rtol=1e-9)
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-10


def test_whitening_of_few_vectors(spark):
    assert whitened(spark, []) == [] and whitened(spark, [(1, None), (2, [])]) == []
    assert whitened(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])]) == []  # no variance
    got = whitened(spark, [(1, [1.0, 2.0, 3.0]), (1, [3.0, 2.0, 3.0]), (None, [3.0, 2.0, 3.0])])  # one component has variance
    assert {r.component for r in got} == {1} and [abs(round(r.whitened, 12)) for r in got] == [1.0] * 3
    assert sorted(str(r.vec_id) for r in got) == ["1", "1", "None"] and {(r.n, r.explained) for r in got} == {(2, 1.0)}
    huge = whitened(spark, [(1, [1e30, 0.0]), (2, [0.0, 1.0]), (3, [0.0, 0.0])])  # beyond what is scaled, and beyond a long
    assert {r.deviation for r in huge} == {None} and all(math.isfinite(r.whitened) for r in huge)


@pytest.mark.parametrize("kind", ["slow", "repeated", "deficient"])
def test_jacobi_davidson_residuals(kind):
    from tecframe.llm.whitening import leading

    rng = np.random.default_rng(2)
    d = 200
    q = np.linalg.qr(rng.standard_normal((d, d)))[0]
    values = {"slow": np.linspace(1, 2, d), "repeated": np.repeat([4.0, 3.0, 2.0, 1.0], 50), "deficient": np.where(np.arange(d) < 7, 1.0 + np.arange(d), 0)}[kind]
    matrix = (q * values) @ q.T
    matrix = (matrix + matrix.T) / 2
    e, u = leading(lambda block: matrix @ block, d, 16)
    assert np.abs(e - np.sort(values)[::-1][:16]).max() < 1e-13 * values.max()
    assert np.linalg.norm(matrix @ u - u * e, axis=0).max() < 1e-13 * values.max()
    assert np.abs(u.T @ u - np.eye(16)).max() < 1e-13


def test_partial_products_are_summed_in_a_tree(spark, monkeypatch):
    from tecframe.llm import whitening

    monkeypatch.setattr(whitening, "FAN_IN", 2)
    y = np.arange(600).reshape(300, 2)
    rows = spark.createDataFrame([(v.astype("<i2").tobytes(),) for v in y], "x binary").repartition(9)
    centre = whitening.Centre(y.sum(0).tolist(), 300)
    got = whitening.blockwise(rows, 2, centre, lambda c: c.T @ c)
    assert np.allclose(got, np.cov(y.T, bias=True) * 300, rtol=1e-12)
