"""Scores of the language model against its formula on rows of their own."""

import math
import zlib
from collections import Counter

import numpy as np

from tecframe.llm.language_model import GROWTH, LAMBDA, score


def test_every_bigram_of_the_training_texts_counts(spark):
    """Bigrams that occur once are in the model; repeated rows have equal scores."""
    rng = np.random.default_rng(3)
    texts = [" ".join(f"w{x}" for x in rng.zipf(1.4, 80) % 400) for _ in range(120)]
    rows = [*enumerate(texts), (3, texts[3]), (500, ""), (501, None), (502, "never seen before")]
    train = [t for i, t in rows if zlib.crc32(str(i).encode()) % 7 != 2]
    tokens = lambda t: [*(t or "").split(), "\n"]
    one = Counter(w for t in train for w in tokens(t))
    two = Counter(p for t in train for p in zip(["\n", *tokens(t)], tokens(t)))
    assert sum(c == 1 for c in two.values()) > 500
    n, v = sum(one.values()), len(one)

    def bin_start(c):
        return math.ceil(GROWTH ** math.floor(math.log(c) / math.log(GROWTH) + 1e-9) - 1e-9) if c else 0

    def want(t):
        out = 0.0
        for before, w in zip(["\n", *tokens(t)], tokens(t)):
            single = (one[w] + 1) / (n + v + 1)
            out += math.log10(LAMBDA * min(bin_start(two[before, w]), one[before]) / one[before] + (1 - LAMBDA) * single if one[before] else single)
        return out

    got = score(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()
    by_id = dict(rows)
    off = [abs(r.score - want(by_id[r.doc_id])) for r in got]
    assert len(got) == len(rows) and np.median(off) < 0.3 and max(off) < 4.0  # a probe errs now and then; without them 11 and more
    assert len({r.score for r in got if r.doc_id == 3}) == 1


def test_more_passes_give_the_same_scores(spark, monkeypatch):
    """Slices of bigrams that are too many for one pass are scored in several."""
    from tecframe.llm import language_model

    rng = np.random.default_rng(4)
    rows = [(i, " ".join(f"w{x}" for x in rng.integers(0, 300, 60))) for i in range(80)] + [(5, None), (6, ""), (None, "w1 w2 w3 w1")]
    docs = spark.createDataFrame(rows + rows[:3], "doc_id long, text string").repartition(3)
    order = lambda got: sorted((str(r.doc_id), r.n_tokens, r.n_known, r.base_score, r.score) for r in got)
    whole = order(score(docs).collect())
    monkeypatch.setattr(language_model, "PASS_BITS", 20_000)
    assert len(language_model.passes({b: 9000 for b in range(12)}, 12)) == 6
    split = order(score(docs).collect())
    assert [x[:3] for x in whole] == [x[:3] for x in split] and np.allclose([x[3:] for x in whole], [x[3:] for x in split], atol=1e-9)


def test_large_models_go_through_the_texts_once(spark, monkeypatch):
    """Bigrams of larger texts are counted and answered by bucket: the texts are not gone through slice by slice."""
    from tecframe.llm import language_model

    rng = np.random.default_rng(6)
    rows = [(i, " ".join(f"w{x}" for x in rng.integers(0, 200, 70))) for i in range(90)] + [(7, None), (8, ""), (None, "w1 w2 w3 w1"), (2, "w1 w1")]
    docs = spark.createDataFrame(rows + rows[:4], "doc_id long, text string").repartition(3)
    order = lambda got: sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 7), round(r.score, 7)) for r in got)
    whole = order(score(docs).collect())
    names, store = [], language_model.settle
    monkeypatch.setattr(language_model, "settle", lambda df, name: names.append(name) or store(df, name))
    monkeypatch.setattr(language_model, "PASS_BITS", 2_000)  # many passes slice by slice
    monkeypatch.setattr(language_model, "SENT_TOKENS", 0, raising=False)
    monkeypatch.setattr(language_model, "PIECE_BYTES", 5_000, raising=False)
    assert order(score(docs).collect()) == whole
    assert names.count("scores") == 1
