"""The operators over documents against brute force, with the awkward rows that each has to bear."""

import hashlib
import math
import os
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tecframe.llm.queries import ORACLES, QUERIES, tokenizer_path

FOLDER = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="the given tables are not here")
DOC = "doc_id long, text string, lang string, source string, n_chars long, n int, fp string, score double"


def words(text):
    return WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))


@pytest.fixture(scope="module")
def odd(spark):
    """Null and empty texts, a null id, repeated rows, a very long text, and columns whose names the operators use inside."""
    base = [(r.doc_id, r.text, r.lang) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").limit(60).collect()]
    long = " ".join(t for _, t, _ in base) * 3
    rows = base + [(1000, None, None), (1001, "", "en"), (1002, " \t\n", "en"), (1003, "Word", None), (None, base[0][1], "en"), base[5], base[5], (1004, base[7][1], "de"), (1005, long, "fr"), (1006, "!!! ??", None)]
    return spark.createDataFrame([(i, t, g, None, None, 1, "x", 0.5) for i, t, g in rows], DOC).repartition(5).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOC)


def labels_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def sets_of(rows):
    out = []
    for r in rows:
        w = words(r.text)
        out.append((r.doc_id, frozenset(tuple(w[i: i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()))
    return out


def similar(rows):
    sets = sets_of(rows)
    comp = {i: i for i, _ in sets if i is not None}
    for _ in range(len(sets)):
        before = dict(comp)
        for i, s in sets:
            for j, t in sets:
                if None not in (i, j) and s and t and 100 * len(s & t) >= 75 * len(s | t):
                    comp[i] = min(comp[i], comp[j])
        if comp == before:
            return sets, comp


def test_jaccard_join_equals_all_pairs(odd, none):
    from tecframe.llm.jaccard_join import jaccard_components

    sets, comp = similar(odd.select("doc_id", "text").collect())
    want = sorted(((i, len(s), comp.get(i)) for i, s in sets), key=str)
    assert sorted((tuple(r) for r in jaccard_components(odd).collect()), key=str) == want
    assert jaccard_components(none).collect() == []


def test_jaccard_join_of_a_large_group_in_rounds(spark, monkeypatch):
    """Many variants of one text, some on either side of the limit, in small blocks and with one proposal per round."""
    from tecframe.llm import jaccard_join

    monkeypatch.setattr(jaccard_join, "BLOCK", 40)
    monkeypatch.setattr(jaccard_join, "PARTNERS", 1)
    rng = np.random.default_rng(3)
    rows = []
    for i in range(150):
        text = [f"w{k}" for k in range(120)]
        for k in rng.integers(0, 120, rng.integers(1, 6)).tolist():
            text[k] = f"x{rng.integers(0, 10**6)}"
        rows.append((1000 - i, " ".join(text)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    sets, comp = similar(docs.collect())
    assert len(set(comp.values())) > 1
    got = sorted(tuple(r) for r in jaccard_join.jaccard_components(docs).collect())
    assert got == sorted((i, len(s), comp[i]) for i, s in sets)


def test_jaccard_bands_share_a_signature():
    """Sets of all sizes and just enough overlap share a signature, whatever differs, unless too few parts are filled."""
    from tecframe.llm.jaccard_join import band, parts_of, signatures
    from tecframe.llm.tokens import mix

    rng = np.random.default_rng(1)
    for size in [1, 2, 3, 4, 5, 7, 8, 15, 16, 31, 47, 63, 64, 100, 127, 128, 200, 255, 256, 300, 511, 512, 1000, 1023, 1500, 3000, 5000]:
        for other in {size, max(1, size * 3 // 4), size * 4 // 3}:
            apart = (size + other) // 7
            if (apart - abs(size - other)) % 2:
                apart -= 1
            if apart < abs(size - other):
                continue
            common = (size + other - apart) // 2
            values = mix(rng.integers(0, 2**62, size + other, dtype=np.uint64))
            a, b = np.sort(values[:size]), np.sort(np.concatenate([values[:common], values[size: size + other - common]]))
            keys = [set(np.concatenate([signatures(x, np.array([0, len(x)]), up, frozenset())[0] for up in (0, 1)]).tolist()) for x in (a, b)]
            larger = a if size >= other else b
            spared = int(signatures(larger, np.array([0, len(larger)]), 0, frozenset())[2][0])
            assert spared > 2 * len(larger) // 7 and keys[0] & keys[1], (size, other)
    n, split = parts_of(band(np.array([40, 100, 200, 3000])), frozenset())
    assert (n > 0).tolist() == [False, True, True, True] and split.tolist() == [1, 1, 3, 3]
    assert parts_of(np.array([7]), frozenset([7]))[0].tolist() == [0]


def test_jaccard_signatures_survive_differences_in_every_part():
    """One difference in each divided part leaves two of its smaller parts: the worst case for single parts."""
    from tecframe.llm.jaccard_join import band, parts_of, signatures
    from tecframe.llm.tokens import below, mix

    rng = np.random.default_rng(5)
    base = np.unique(mix(rng.integers(0, 2**62, 900, dtype=np.uint64)))
    n = int(parts_of(band(np.array([900])), frozenset())[0][0])
    gone = np.unique(below(base, n), return_index=True)[1]  # the first element of each part
    less = np.delete(base, gone)
    assert 4 * len(less) >= 3 * len(base)
    keys = [set(signatures(x, np.array([0, len(x)]), 0, frozenset())[0].tolist()) for x in (base, less)]
    assert keys[0] & keys[1]


def test_language_model_counts(odd, none):
    from tecframe.llm.language_model import score

    rows = odd.select("doc_id", "text").collect()
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    count = Counter(w for r in rows if not held(r.doc_id) for w in [*words(r.text), "\n"])
    n, v = sum(count.values()), len(count)
    want = sorted(((r.doc_id, held(r.doc_id), len(words(r.text)) + 1, sum(count[w] > 0 for w in [*words(r.text), "\n"]), n,
                    sum(math.log10((count[w] + 1) / (n + v + 1)) for w in [*words(r.text), "\n"])) for r in rows), key=str)
    got = sorted((tuple(r) for r in score(odd).collect()), key=str)
    for g, w in zip(got, want, strict=True):
        assert g[:5] == w[:5] and abs(g[5] - w[5]) < 1e-6 * max(1, abs(w[5])) and g[6] < 0
    assert score(none).collect() == []


def test_repeats_equal_brute_force(odd, none):
    from tecframe.llm.suffix_blocks import remove_repeats

    rows = [(r.doc_id, (r.text or "").encode()) for r in odd.collect()]
    least: dict[bytes, int] = {}
    for i, x in rows:
        if i is not None:
            for s in range(len(x) - 49):
                least[x[s: s + 50]] = min(i, least.get(x[s: s + 50], i))
    want = []
    for i, x in rows:
        gone = bytearray(len(x) + 1)
        for s in range(len(x) - 49 if i is not None else 0):
            if least[x[s: s + 50]] < i:
                gone[s: s + 50] = b"\1" * 50
        kept = bytes(b for b, g in zip(x, gone) if not g)
        spans = sum(1 for k in range(len(x)) if gone[k] and (k == 0 or not gone[k - 1]))
        want.append((i, len(x), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    assert sorted((tuple(r) for r in remove_repeats(odd).collect()), key=str) == sorted(want, key=str)
    assert remove_repeats(none).collect() == []


def test_packing_round_trip(odd, none):
    from tokenizers import Tokenizer

    from tecframe.llm.packing import pack

    t = Tokenizer.from_file(tokenizer_path())
    pieces, sequences = Counter(), {}
    for r in pack(odd, tokenizer_path()).collect():
        pieces[r.doc_id, r.piece, r.start, r.length, r.ids_crc32] += 1
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    want = Counter()
    for r in odd.collect():
        ids = t.encode(r.text or "", add_special_tokens=False).ids + [0]
        for k in range(0, len(ids), 2048):
            part = np.array(ids[k: k + 2048], "<u4")
            want[r.doc_id, k // 2048, k, len(part), zlib.crc32(part.tobytes())] += 1
    assert pieces == want
    for s in sequences.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= 2048
    total = sum(k[3] * n for k, n in want.items())
    assert len(sequences) <= -(-total // 2048) + 1
    assert pack(none, tokenizer_path()).collect() == []


def test_bin_completion_beats_or_equals_best_fit():
    from tecframe.llm.packing import best_fit, complete, search

    assert len(search([6, 6, 6, 5, 5, 5, 4, 4, 4, 3, 3, 2], 12)) == 5
    for seed in range(8):
        rng = np.random.default_rng(seed)
        lengths = rng.integers(1, 101, 300)
        patterns = complete(np.bincount(lengths, minlength=101), 100)
        assert sorted(x for n, p in patterns for x in p * n) == sorted(lengths.tolist()) and all(sum(p) <= 100 for _, p in patterns)
        assert sum(n for n, _ in patterns) <= len(best_fit(lengths.tolist(), 100))


def test_many_short_pieces_are_packed():
    from tecframe.llm.packing import best_fit, best_fit_counts, complete, fewest

    short = np.bincount([1] * 5000 + [2] * 3000 + [700] * 9, minlength=2049)  # empty texts, one-word texts
    patterns = complete(short, 2048)
    assert sum(n * np.bincount(p, minlength=2049) for n, p in patterns).tolist() == short.tolist()
    assert all(sum(p) <= 2048 for _, p in patterns) and sum(n for n, _ in patterns) == fewest(short, 2048) == 9
    for seed in range(6):
        lengths = np.random.default_rng(seed).choice([1, 7, 18, 30, 34, 41, 55, 80], 600)
        count = np.bincount(lengths, minlength=101)
        by_counts = best_fit_counts(count, 100)
        assert sum(n * np.bincount(p, minlength=101) for n, p in by_counts).tolist() == count.tolist()
        assert sum(n for n, _ in by_counts) == len(best_fit(lengths.tolist(), 100))
        assert fewest(count, 100) <= sum(n for n, _ in complete(count, 100)) <= len(best_fit(lengths.tolist(), 100))


def test_decontamination_tolerates_substitutions(spark, odd, none):
    from tecframe.llm.spaced_seeds import overlaps

    item = " ".join(f"bench{i}" for i in range(30))
    swapped = item.split()
    swapped[9], swapped[21] = "other", "thing"
    docs = spark.createDataFrame([(1, "lead in " + item.upper().replace(" ", ", ") + " out"), (2, " ".join(swapped)), (3, "bench1 bench2 bench3 nothing else"), (4, None), (5, ""), (None, item), (1, "x " + item)], "doc_id long, text string")
    bench = spark.createDataFrame([(7, item, 1), (8, "short one", 2), (9, None, 3), (None, item, 4), (7, item, 5)], "item_id long, text string, doc_id int")
    got = {tuple(r) for r in overlaps(docs, bench).collect()}
    assert got == {(1, 7, 2, 30, 30), (1, 7, 1, 30, 30), (2, 7, 0, 30, 28), (None, 7, 0, 30, 30)}
    assert got == {tuple(r) for r in overlaps(docs, bench, block_words=40).collect()}
    assert overlaps(none, bench).collect() == [] and overlaps(docs, bench.limit(0)).collect() == []
    assert {r.doc_id for r in overlaps(odd, bench).collect()} == set()


def test_benchmark_overlaps_equal_brute_force(spark):
    """Every diagonal of every text and item: the best stretch through each place where a mask agrees."""
    from tecframe.llm.spaced_seeds import MASKS, overlaps

    rng = np.random.default_rng(8)
    item = [f"b{i}" for i in range(60)]
    fifth = [w if i % 5 != 2 else "other" for i, w in enumerate(item)]
    few = [[f"v{x}" for x in rng.integers(0, 3, n)] for n in (40, 70, 25)]
    bench = {1: item, 2: item[5:13], 3: few[0][:20], 4: few[1][10:17], 5: ["b1", "b2"], 6: item[20:30], 7: []}
    docs = {1: ["x"] + fifth + ["y"], 2: ["z"] + item[5:13] + ["z"], 3: few[0] + few[2], 4: few[1], 5: item[18:31], 6: item[5:12], 7: [], 8: few[2][:12] + item[3:40]}
    want = set()
    for d, x in docs.items():
        for i, y in bench.items():
            masks = [*MASKS] if len(y) >= 10 else ["1" * len(y)] if len(y) >= 5 else []
            for shift in range(-len(y), len(x) + 1):
                same = {p: x[p] == y[p - shift] for p in range(max(0, shift), min(len(x), shift + len(y)))}
                for p in same:
                    if not any(all(m == "0" or same.get(p + j, False) for j, m in enumerate(mask)) and p + len(mask) - 1 in same for mask in masks):
                        continue
                    value = lambda a, b: sum(1 if same[k] else -3 for k in range(a, b))
                    begin = max(range(min(same), p + 1), key=lambda a: (value(a, p), a))
                    end = max(range(p, max(same) + 2), key=lambda b: (value(p, b), -b))
                    matches = sum(same[k] for k in range(begin, end))
                    if matches >= min(12, len(y)):
                        want.add((d, i, begin, end - begin, matches))
    frames = [spark.createDataFrame([(k, " ".join(w)) for k, w in rows.items()], f"{name} long, text string") for rows, name in ((docs, "doc_id"), (bench, "item_id"))]
    got = {tuple(r) for r in overlaps(*frames).collect()}
    assert got <= want and {r[:2] for r in got} == {r[:2] for r in want}
    assert {(1, 1), (2, 2)} <= {r[:2] for r in got} and not any(r[1] in (5, 7) for r in got)


def test_sets_that_share_signatures_with_a_centre_meet_it_once():
    import pyarrow as pa
    from tecframe.llm.jaccard_join import _packed, _shared_stars

    text = [f"w{i}" for i in range(300)]
    near = [" ".join(text[:i] + [f"x{i}"] + text[i + 1:]) for i in (5, 150, 290)]
    docs = pa.table({"doc_id": range(8), "text": [" ".join(text), *near, " ".join(text), "a b", None, " "]})
    rows = list(_packed(frozenset(), 1)(iter(docs.to_batches(max_chunksize=2))))
    stars = _shared_stars(pa.Table.from_batches(rows)).to_pylist()
    assert len(stars) == 3 and len({r["a"] for r in stars}) == 1 and len({r["b"] for r in stars}) == 3  # the copy is no set of its own
    keys = sum(len(k) for r in rows for k in r.column("keys").to_pylist()) // 5
    assert keys > 100  # though they share many signatures
    alone = list(_packed(frozenset(), 1)(iter(docs.slice(4).to_batches())))
    assert _shared_stars(pa.Table.from_batches(alone)).num_rows == 0


def test_passages_cover_equal_stretches_and_find_fuzzy_ones(spark, odd, none):
    from tecframe.llm.chaining import GAP_COST, chain, passages, remove_passages

    # 1005 strings several near copies together, three times over: it must not fail, but its inner borders differ
    rows = [r for r in odd.select("doc_id", "text").collect() if r.doc_id not in (None, 1005)]
    covered: dict[int, set] = {}
    for r in passages(odd).collect():
        assert r.source_id < r.doc_id
        covered.setdefault(r.doc_id, set()).update(range(r.start_word, r.start_word + r.n_words))
    first: dict[tuple, int] = {}
    for r in rows:
        w = words(r.text)
        for s in range(len(w) - 49):
            first[tuple(w[s: s + 50])] = min(r.doc_id, first.get(tuple(w[s: s + 50]), r.doc_id))
    for r in rows:
        w = words(r.text)
        for s in range(len(w) - 49):
            if first[tuple(w[s: s + 50])] < r.doc_id:
                assert set(range(s, s + 50)) <= covered[r.doc_id], (r.doc_id, s)
    passage = [f"w{i}" for i in range(80)]
    fuzzy = passage[:30] + ["new"] + passage[31:55] + passage[57:]
    docs = spark.createDataFrame([(1, "a b c " + " ".join(passage), "k"), (2, "d e " + " ".join(fuzzy) + " tail end", "k"), (3, " ".join(passage[:30]), None), (4, None, None), (5, " ".join(passage), None)], "doc_id long, text string, spans string")
    found = {(r.doc_id, r.source_id): r for r in passages(docs).collect()}
    assert set(found) == {(2, 1), (5, 1), (5, 2)} and found[2, 1].start_word == 2 and found[2, 1].n_words == 78
    cut = remove_passages(docs).collect()
    left = {r.doc_id: r.text for r in cut}
    assert {r.doc_id: r.spans for r in cut} == {1: "k", 2: "k", 3: None, 4: None}
    assert left[2].split() == ["d", "e", "tail", "end"] and 5 not in left and left[1].split()[:3] == ["a", "b", "c"] and left[4] is None
    assert passages(none).collect() == [] and remove_passages(none).collect() == []
    rng = np.random.default_rng(0)
    for _ in range(30):  # the Fenwick tree against the quadratic recurrence
        xy = np.unique(rng.integers(0, 40, (25, 2)), axis=0)
        x, y = xy[:, 0], xy[:, 1]
        f = []
        for i in range(len(x)):
            f.append(6 + max([0, *(f[j] - GAP_COST * (x[i] - x[j] + y[i] - y[j]) for j in range(i) if x[j] < x[i] and y[j] < y[i])]))
        best = chain(x, y)[0]
        gain = 6 * len(best) - GAP_COST * (x[best[-1]] - x[best[0]] + y[best[-1]] - y[best[0]])
        assert abs(gain - max(f)) < 1e-9


def test_passages_whose_parts_stand_elsewhere(spark):
    """Two sentences that earlier documents hold apart, and one that holds both."""
    from tecframe.llm.chaining import passages

    s = lambda t: [f"{t}{i}" for i in range(30)]
    texts = [s("a"), s("b"), s("a") + s("b"), s("a"), s("b"), s("a") + s("b")]
    docs = spark.createDataFrame([(i + 1, " ".join(w)) for i, w in enumerate(texts)], "doc_id long, text string")
    assert [(r.doc_id, r.source_id, r.start_word, r.n_words) for r in passages(docs).collect()] == [(6, 3, 0, 60)]


def test_passages_recall_of_substituted_copies(spark):
    """One passage copied with random substitutions between other words: most lengths and rates are nearly always found."""
    from tecframe.llm.chaining import passages

    rng = np.random.default_rng(5)
    fresh = lambda n: [f"w{x}" for x in rng.integers(0, 200_000, n)]
    rows, want = [], {}
    for n, rate in ((60, 0.1), (80, 0.1), (100, 0.15), (150, 0.18), (200, 0.1)):
        for _ in range(40):
            k, p = len(rows), fresh(n)
            q = [a if u >= rate else b for a, b, u in zip(p, fresh(n), rng.random(n))]
            rows += [(k, " ".join(fresh(100) + p + fresh(70))), (k + 1, " ".join(fresh(60) + q + fresh(120)))]
            want[k + 1] = (k, n, rate)
    found = {r.doc_id: r for r in passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert set(found) <= set(want) and all(r.source_id == want[d][0] and r.n_matches >= 0.8 * r.n_words for d, r in found.items())
    share = {}
    for d, (_, n, rate) in want.items():
        share.setdefault((n, rate), []).append(d in found)
    assert sum(map(sum, share.values())) >= 0.85 * len(want) and min(sum(v) / len(v) for v in share.values()) >= 0.7, share


def test_gaps_and_packed_places():
    from tecframe.llm.chaining import _from_planes, _planes, common

    rng = np.random.default_rng(2)
    for _ in range(200):  # the longest common subsequence by its plain recurrence
        x, y = (rng.integers(0, 4, rng.integers(0, 9)).tolist() for _ in range(2))
        best = {}
        for i in range(len(x) + 1):
            for j in range(len(y) + 1):
                best[i, j] = 0 if not i or not j else max(best[i - 1, j], best[i, j - 1], best[i - 1, j - 1] + (x[i - 1] == y[j - 1]))
        got = common(x, y)
        assert got == best[len(x), len(y)] or (len(x) == len(y) and got >= len(x) - 1)
    places = np.array([0, 1, 65535, 65536, 3_000_000])
    assert _from_planes(_planes(places)).tolist() == places.tolist() and len(_from_planes(_planes(places[:0]))) == 0


def test_neighbours_equal_brute_force(spark):
    from tecframe.llm.neighbours import near_duplicates

    rng = np.random.default_rng(5)
    centres = rng.normal(size=(12, 16))
    rows = [(i, (centres[i % 12] + rng.normal(0, 0.12, 16)).astype(np.float32).tolist()) for i in range(400)]
    rows += [(1000 + i, rows[3][1]) for i in range(30)] + [(2000, None), (2001, [0.0] * 16), (2002, [float("nan")] * 16), (2003, [None] + [1.0] * 15), (2004, []), (3, rows[3][1])]
    v = spark.createDataFrame([(i, x, 1, "u") for i, x in rows], "vec_id long, embedding array<float>, label int, unit string")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in near_duplicates(v).collect()}
    good = [(i, np.array(x, float)) for i, x in rows if x and None not in x and np.isfinite(x).all() and any(x)]
    m = np.stack([x / np.linalg.norm(x) for _, x in good])
    s = m @ m.T >= 0.9
    ids = np.array([i for i, _ in good])
    comp = ids.copy()
    while True:
        new = np.array([comp[row].min() for row in s])
        if (new == comp).all():
            break
        comp = new
    hits = sum(got[i][0] == n - 1 for i, n in zip(ids.tolist(), s.sum(axis=1).tolist()))
    assert hits >= 0.95 * len(ids) and all(got[i][1] == c for i, c in zip(ids.tolist(), comp.tolist()))
    assert all(got[i] == (0, i, True) for i in range(2000, 2005))
    assert near_duplicates(v.limit(0)).collect() == []


def test_clumps_of_saturated_vectors_are_joined(spark):
    from tecframe.llm.neighbours import near_duplicates

    rng = np.random.default_rng(11)
    first = rng.normal(size=32)
    second = rng.normal(size=32)
    second -= second @ first / (first @ first) * first
    first, second = first / np.linalg.norm(first), second / np.linalg.norm(second)
    angle = np.arccos(0.935)
    x = [c + rng.normal(0, 0.01, 32) for c in (first, np.cos(angle) * first + np.sin(angle) * second) for _ in range(600)]
    x += [rng.normal(size=32) for _ in range(200)]
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    m = np.stack([v / np.linalg.norm(v) for v in x])
    want = (m @ m.T >= 0.9).sum(axis=1) - 1
    assert want[0] > 1000 and want[1199] > 1000
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert {got[i][1] for i in range(1200)} == {0} and sum(got[i][2] for i in range(1200)) == 1
    assert [got[i][0] for i in range(1400)] == want.tolist()


def test_rare_pairs_are_found(spark, monkeypatch):
    from tecframe.llm import neighbours

    monkeypatch.setattr(neighbours, "LEAF", 8)  # as many planes as a far larger table has
    monkeypatch.setattr(neighbours, "ROUNDS", 0)  # neighbours of neighbours don't lead to them there
    rng = np.random.default_rng(17)
    x = rng.normal(size=(4000, 48))
    x[:20] = x[20:40] + rng.normal(size=(20, 48)) * 0.45
    m = x / np.linalg.norm(x, axis=1, keepdims=True)
    s = m @ m.T >= 0.9
    want = s.sum(axis=1) - 1
    assert 30 <= (want > 0).sum() <= 40
    v = spark.createDataFrame([(i, a.tolist()) for i, a in enumerate(x)], "vec_id long, embedding array<double>")
    got = {r.vec_id: (r.n_links, r.component_id) for r in neighbours.near_duplicates(v).collect()}
    assert [got[i] for i in range(4000)] == [(int(n), int(row.argmax())) for n, row in zip(want, s)]


def test_language_filters_on_held_out_rows(spark, odd, none):
    from tecframe.llm.language_id import identify

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in rows) > 0.97 * len(rows) and all(0 <= r.score <= 1 for r in rows)
    got = {r.doc_id: r.lang_pred for r in identify(odd).collect()}
    assert got[1000] == got[1001] == got[1002] == got[1006] == "und" and got[1003] in ("en", "de", "fr", "es")
    assert identify(none).collect() == [] and {r.lang_pred for r in identify(odd.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def test_toxicity_on_held_out_rows(spark, odd, none):
    from tecframe.llm.toxicity import toxicity

    folder = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    rows = toxicity(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert sum(r.predicted == r.toxic for r in rows) > 0.9 * len(rows)
    assert all(r.predicted == int(r.score >= 0.5) for r in rows)
    few = labels_of(spark, [(0, 1, 1), (1, 1, 0), (1000, None, 1), (None, 1, 1), (2, 0, None), (0, 1, 1)])
    assert toxicity(odd, few).count() == odd.count() and toxicity(none, few).collect() == []
    assert {r.predicted for r in toxicity(odd, few.limit(0)).collect()} == {0}


def test_resampling(spark, odd, none):
    from tecframe.llm.resampling import cut, resample

    docs, labels = (spark.read.parquet(f"{FOLDER}/{x}.parquet") for x in ("documents", "labels"))
    rows = resample(docs, labels, keep=0.25).collect()
    keys = sorted((r.key for r in rows), reverse=True)
    assert {r.doc_id for r in rows if r.selected} == {r.doc_id for r in rows if r.key >= keys[round(0.25 * len(rows)) - 1]}
    values = spark.createDataFrame([(float(x),) for x in [5, 5, 5, 1, 2, 9, 9, 0]], "key double")
    assert [cut(values, k) for k in (1, 2, 3, 5, 8, 0)] == [9, 9, 5, 5, 0, None]
    few = labels_of(spark, [(0, 1, 1), (None, 1, 0)])
    got = resample(odd, few)
    assert got.count() == odd.count() and got.where("doc_id = 1001").first().log_weight == 0 and resample(none, few).collect() == []


def test_pipeline_stages(spark, odd, none):
    import corpus_pipeline as p

    assert [n for n, _ in p.STAGES] == ["toxicity", "ngram_jaccard_join", "substring_dedup", "benchmark_decontamination", "best_fit_packing"]
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for name, stage in p.STAGES[:-1]:
        kept = stage(spark, docs, FOLDER)
        assert kept.columns == docs.columns and 0 < kept.count() <= docs.count(), name
        awkward = stage(spark, odd, FOLDER)
        assert awkward.columns == odd.columns and awkward.where("doc_id IS NULL").count() == 1, name
        assert stage(spark, none, FOLDER).collect() == [], name
    sets, comp = similar(docs.collect())
    kept = {r.doc_id for r in p.one_of_each_group(spark, docs, FOLDER).collect()}
    assert kept == {i for i, c in comp.items() if i == c}
    texts = [docs.where(f"doc_id = {i}").first().text for i in sorted(kept)[:2]]
    twice = spark.createDataFrame([(1, texts[0], "a", "b"), (1, texts[1], "c", "d"), (1, texts[1], "c", "d"), (1, None, "e", "f"), (2, texts[0], "g", "h")], "doc_id long, text string, copy string, spans string")
    assert sorted((r.copy, r.spans) for r in p.one_of_each_group(spark, twice, FOLDER).collect()) == [("a", "b"), ("c", "d"), ("e", "f")]
    assert p.run(spark, FOLDER).count() > 0


def test_training_does_not_gather_the_documents(spark, monkeypatch):
    """The scan of the documents is no part of the one training task."""
    from tecframe.llm import toxicity

    stages = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("training", "training")
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").repartition(6)
    toxicity.train(docs, spark.read.parquet(f"{FOLDER}/labels.parquet"), 50)
    tasks = [stages.getStageInfo(s).numTasks for j in stages.getJobIdsForGroup("training") for s in stages.getJobInfo(j).stageIds if stages.getStageInfo(s)]
    spark.sparkContext.setJobGroup("tests", "tests")
    assert len(tasks) >= 3 and max(tasks) > 1


def test_every_number_is_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14)) and set(ORACLES) <= set(QUERIES)


def test_more_languages_than_bits_of_a_word(spark):
    """Seventy languages, each with letters of its own, are all learned and told apart."""
    from tecframe.llm.language_id import identify
    from tecframe.llm.tokens import Texts
    from tecframe.llm.toxicity import LANG_BUCKETS, Words, _languages
    import pyarrow as pa

    rng = np.random.default_rng(4)
    letters = [[chr(0x4E00 + 40 * k + int(x)) for x in range(30)] for k in range(70)]
    text = lambda k: " ".join("".join(rng.choice(letters[k], 4)) for _ in range(60))
    docs = spark.createDataFrame([(i, text(i % 70), f"l{i % 70:02d}") for i in range(700)], "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in identify(docs).collect()}
    assert len(got) == 700 and any(r.held_out for r in got.values())
    assert all(r.lang_pred == f"l{i % 70:02d}" for i, r in got.items())
    w = Words(Texts(pa.array([text(k) for k in (0, 66, 5)] + [None], pa.string())))
    table = rng.normal(size=(150, LANG_BUCKETS)).astype(np.float32)
    whole = _languages(w, table)
    parts = [_languages(w, table[:64]), _languages(w, table[:128])]
    assert (whole[:3] >= 0).all() and all((p == w_) | (w_ >= n) for n, rows in ((64, parts[0]), (128, parts[1])) for p, w_ in zip(rows[:3].tolist(), whole[:3].tolist()))
